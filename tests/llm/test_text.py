"""Line dedup, Jaccard join, classifier, pieces, pipeline: against brute force, libraries and round trips."""


import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import riverglass
from llm_fixtures import fold, rows, sentence
from riverglass.llm import jaccard_join, line_dedup, quality_classifier, sentence_pieces
from riverglass.llm.components import components
from riverglass.llm.wordhash import chunks, cut
from test_scans import WORD


def test_patience_finds_rising_equal_pairs():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(12) for _ in range(rng.randrange(15))] for _ in range(2))
        pairs = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False))
    assert line_dedup.patience(list("axbyc"), list("abc")) == [(0, 0), (2, 1), (4, 2)]


def test_line_dedup_cases(spark, empty):
    block = "this line is held by many documents\nand so is this other one"
    df = spark.createDataFrame([(1, f"head one of its own here\n{block}"), (2, f"{block}\n\ntail two of its own here"), (3, "a b\nshort"), (4, "a b\nother")], "doc_id int, text string")
    found = {r.doc_id: r.text for r in line_dedup.line_dedup(df).collect()}
    assert found == {1: f"head one of its own here\n{block}", 2: "\ntail two of its own here", 3: "a b\nshort", 4: "a b\nother"}
    assert line_dedup.line_dedup(empty).collect() == []


def _shingles(text):
    words = WORD.findall(fold(text))
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def _links(texts):
    sets = [_shingles(t) for t in texts]
    n, root = [0] * len(sets), list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] == sets[b] or both and both >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                n[a], n[b] = n[a] + 1, n[b] + 1
                root[find(a)] = find(b)
    return n, [find(x) for x in range(len(sets))]


def test_jaccard_join_equals_brute_force(messy, empty):
    found = rows()
    n, root = _links([r[1] for r in found])
    members = defaultdict(list)
    for k, r in enumerate(root):
        members[r].append(found[k][0])
    head = {r: min((i for i in ids if i is not None), default=None) for r, ids in members.items()}
    want = Counter((found[k][0], head[r], len(members[r]), n[k]) for k, r in enumerate(root))
    got = jaccard_join.jaccard_join(messy)
    assert Counter((r.doc_id, r.class_id, r.class_size, r.n_links) for r in got.collect()) == want
    assert jaccard_join.jaccard_join(empty).collect() == []
    kept = jaccard_join.keep_one(messy)
    assert kept.columns == messy.columns and kept.count() == len(members)


def test_many_near_copies_are_one_class(spark):
    rng = random.Random(9)
    base = sentence(rng, 200, [f"w{i}" for i in range(500)]).split()
    texts = []
    for i in range(700):
        words = list(base)
        words[rng.randrange(200)] = f"new{i}"
        texts.append(" ".join(words))
    found = jaccard_join.jaccard_join(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    assert {(r.class_id, r.class_size, r.n_links) for r in found} == {(0, 700, 699)}


def test_components_of_paths_and_stars(spark):
    edges = [(f"p{i:03}", f"p{i + 1:03}") for i in range(60)] + [("s000", f"s{i:03}") for i in range(1, 40)]
    df = spark.createDataFrame([(a.encode(), b.encode()) for a, b in edges], "a binary, b binary")
    found = {bytes(r.key): bytes(r.root) for r in components(df).collect()}
    assert len(found) == 101 and len({v for k, v in found.items() if k[:1] == b"p"}) == 1 and len(set(found.values())) == 2
    assert components(df.limit(0)).collect() == []


def test_word_hashes_are_those_of_the_words():
    texts = ["Ab c-d é1 x", "", "ab", "  ", "C d"]
    seen = {}
    for first, _, data, ends in chunks(pa.array(texts)):
        starts, stops, hashes, _ = cut(data, ends)
        where = np.searchsorted(ends, starts, "right") + first
        got = defaultdict(list)
        for s, e, h, t in zip(starts, stops, hashes, where, strict=True):
            word = bytes(data[s:e]).lower()
            assert seen.setdefault(word, h) == h
            got[int(t)].append(word.decode())
        assert [got[i] for i in range(len(texts))] == [WORD.findall(fold(t)) for t in texts]
    assert len(set(seen.values())) == len(seen)


def test_classifier_on_held_out_labels(spark, data):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    weights = quality_classifier.fit(docs, labels)
    assert weights == quality_classifier.fit(docs, labels)
    held = labels.where("crc32(cast(doc_id as string)) % 3 = 1").join(quality_classifier.score(docs, weights), "doc_id").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in held)


def test_classifier_takes_odd_rows(spark, messy, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (3, 0), (999, 1)], "doc_id bigint, quality int")
    weights = quality_classifier.fit(messy, labels)
    assert quality_classifier.score(messy, weights).count() == len(rows())
    assert quality_classifier.keep_good(messy, weights).columns == messy.columns
    assert quality_classifier.score(empty, weights).collect() == []
    none = quality_classifier.fit(messy, labels.limit(0))
    assert {(r.score, r.predicted) for r in quality_classifier.score(messy, none).collect()} == {(0.5, 1)}


def test_pieces_equal_the_library(spark, messy, empty):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.model_path())
    found = sentence_pieces.decode_pieces(sentence_pieces.encode_pieces(messy, keep=("text",)), into="again").collect()
    assert len(found) == len(rows())
    for r in found:
        text = r.text or ""
        assert list(r.ids) == library.encode(text) and r.n_pieces == len(r.ids)
        assert r.decoded == r.again == text.replace(sentence_pieces.SPACE, " ")
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    assert sentence_pieces.encode_pieces(empty).collect() == []


def test_unigram_paths_equal_the_library(tmp_path):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    with open(sentence_pieces.model_path(), "rb") as f:
        model = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    model.trainer_spec.model_type = sentence_pieces.UNIGRAM
    for p in model.pieces:
        p.score = max(p.score, -40_000.0)
    (tmp_path / "m").write_bytes(model.SerializeToString())
    library, own = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "m")), sentence_pieces.Pieces(str(tmp_path / "m"))
    rng = random.Random(1)
    texts = ["".join(rng.choice("abethionrs  \né☃1") for _ in range(rng.randrange(40))) for _ in range(300)]
    assert [x.tolist() for x in own.encode(texts)] == library.encode(texts)


def test_viterbi_is_the_best_of_all_paths():
    pieces = sentence_pieces.Pieces.__new__(sentence_pieces.Pieces)
    table = [("<unk>", 0.0, 2), ("a", -1.0, 1), ("b", -1.2, 1), ("ab", -1.5, 1), ("ba", -1.9, 1), ("aba", -2.1, 1), ("bab", -2.2, 1)]
    pieces._setup(table, sentence_pieces.UNIGRAM, False)
    scores = {p: s for p, s, t in table if t == 1}

    def best(word):
        return max((scores[word[:n]] + best(word[n:]) for n in range(1, len(word) + 1) if word[:n] in scores), default=0.0 if not word else float("-inf"))

    rng = random.Random(3)
    words = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 12))) for _ in range(100)]
    for word, ids in zip(words, pieces.paths(words), strict=True):
        assert "".join(pieces.texts[i] for i in ids) == word and sum(pieces.scores[i] for i in ids) == pytest.approx(best(word))


def test_pipeline(spark, data, tmp_path):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "n-gram Jaccard join", "source mix", "sentence pieces"]
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], data).write.parquet(str(tmp_path / str(k)))
        tables.append(spark.read.parquet(str(tmp_path / str(k))))
    assert all(t.columns == columns for t in tables[:-1])
    good, lines, near, mixed = ([tuple(r) for r in t.select("doc_id", "text").collect()] for t in tables[1:5])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    kept = {i for i, _ in good}
    assert sum((i in kept) != bool(q) for i, q in labels.items()) <= 0.05 * len(labels)
    assert {i for i, _ in lines} == kept and all(set(t.split("\n")) <= set(dict(good)[i].split("\n")) | {""} for i, t in lines)
    root = _links([t for _, t in lines])[1]
    assert len(near) == len(set(root)) and set(near) <= set(lines)
    assert set(mixed) <= set(near) and max(Counter(mixed).values()) <= 2
    final = tables[-1].collect()
    assert Counter((r.doc_id, r.decoded) for r in final) == Counter(mixed)


def test_the_package_needs_nothing_from_here():
    import pathlib

    root = pathlib.Path(riverglass.__file__).parent
    others = [p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts]
    assert others and not any("llm" in p.read_text(encoding="utf-8") for p in others)
