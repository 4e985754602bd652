"""Line dedup against an alignment of all pairs that is written apart from the operator's."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm_fixtures import fold, rows
from riverglass.llm import line_dedup

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _rise(pairs):
    """A longest rising run: the length up to each pair, then back from the last pair of the greatest length."""
    size, back = [], []
    for k, (_, y) in enumerate(pairs):
        below = [j for j in range(k) if pairs[j][1] < y]
        size.append(1 + max((size[j] for j in below), default=0))
        back.append(max((j for j in below if size[j] == size[k] - 1), default=None))
    k = max((k for k in range(len(pairs)) if size[k] == max(size)), default=None)
    out = []
    while k is not None:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            table[i][j] = table[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(table[i - 1][j], table[i][j - 1])
    out, i, j = [], len(a), len(b)
    while i and j:
        if table[i][j] == table[i][j - 1]:
            j -= 1
        elif table[i - 1][j] == table[i - 1][j - 1]:
            i, j = i - 1, j - 1
            out.append((i, j))
        else:
            i -= 1
    return out[::-1]


def _align(a, b):
    if not a or not b:
        return []
    if a[0] == b[0]:
        return [(0, 0), *((i + 1, j + 1) for i, j in _align(a[1:], b[1:]))]
    if a[-1] == b[-1]:
        return [*_align(a[:-1], b[:-1]), (len(a) - 1, len(b) - 1)]
    once = [x for x in a if a.count(x) == 1 == b.count(x)]
    anchors = _rise([(a.index(x), b.index(x)) for x in once])
    if not anchors:
        return _subsequence(a, b)
    out, i, j = [], 0, 0
    for p, q in [*anchors, (len(a), len(b))]:
        out += [(i + x, j + y) for x, y in _align(a[i:p], b[j:q])]
        if p < len(a):
            out.append((p, q))
        i, j = p + 1, q + 1
    return out


def _numbered(text):
    """(place, raw, line) of the lines that aren't blank."""
    there = [(k, fold(x.strip(" "))) for k, x in enumerate(text.split("\n")) if x.strip(" ")]
    return [(n, k, x) for n, (k, x) in enumerate(there)]


def _lost(theirs, mine, min_words):
    both = {x for *_, x in theirs} & {x for *_, x in mine}
    a, b = ([x for x in lines if x[2] in both] for lines in (theirs, mine))
    gone, block, before = set(), [], None
    for i, j in [*_align([x[2] for x in a], [x[2] for x in b]), (None, None)]:
        now = None if i is None else (a[i][0], b[j][0])
        if block and (now is None or now != (before[0] + 1, before[1] + 1)):
            if sum(len(WORD.findall(x)) for *_, x in block) >= min_words:
                gone |= {k for _, k, _ in block}
            block = []
        if now is not None:
            block.append(b[j])
        before = now
    return gone


def _brute(texts, min_words=line_dedup.MIN_WORDS):
    """The deleted raw lines of each text of a list, every earlier one being aligned with every later one."""
    lines = [_numbered(t) for t in texts]
    return [set().union(*(_lost(lines[a], lines[b], min_words) for a in range(b))) for b in range(len(texts))]


def test_odd_rows_equal_brute_force(spark, messy):
    marks = {(r.doc_id, r.text): r.m for r in messy.select("doc_id", "text", F.xxhash64("text").alias("m")).collect()}
    docs = sorted({(r[0], r[1]) for r in rows() if r[1] is not None}, key=lambda d: (d[0] is not None, d[0] or 0, marks[d]))
    gone = dict(zip(docs, _brute([t for _, t in docs]), strict=True))
    want = Counter()
    for i, t, *_ in rows():
        want[i, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i, t])] += 1
    found = line_dedup.line_dedup(messy)
    assert found.columns == messy.columns
    assert Counter((r.doc_id, r.text) for r in found.collect()) == want


def test_a_block_of_lines_with_other_first_holders_goes(spark):
    df = spark.createDataFrame([(1, "alpha beta gamma"), (2, "alpha beta gamma\ndelta eps zeta"), (3, "alpha beta gamma\ndelta eps zeta"), (4, "own\nalpha beta gamma\ndelta eps zeta\nend")], "doc_id int, text string")
    found = {r.doc_id: list(r.gone) for r in line_dedup.line_dedup(df, gone_col="gone").collect()}
    assert found == {1: [], 2: [], 3: [0, 1], 4: [1, 2]}


@pytest.mark.parametrize("block", [line_dedup.BLOCK, 3])
def test_all_pairs_are_aligned(spark, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    rng = random.Random(12)
    passages = [[f"passage {k} line {n} of some words" for n in range(rng.randrange(1, 4))] for k in range(5)] + [["short one", "short two", "---", "a b"], ["x y", "z"]]
    x, y = passages[0], passages[1]
    texts = ["\n".join(v) for v in ([*x, "own a", *y], [*y, "own b", *x], [*y, "own c", *x], [*x, "own a", *y], [*x, "", *y])]
    for i in range(150):
        parts = [p[:] for p in rng.choices(passages, k=rng.randrange(1, 5))] + [[f"own {i} {n}"] for n in range(rng.randrange(3))]
        rng.shuffle(parts)
        texts.append("\n".join(line for p in parts for line in (p if rng.random() < 0.8 else p[1:] + [""])))
    want = _brute(texts)
    found = line_dedup.line_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), gone_col="gone").collect()
    assert {r.doc_id: set(r.gone) for r in found} == dict(enumerate(want))
    assert want[2] == {k for k, v in enumerate(texts[2].split("\n")) if v != "own c"}


def test_a_run_that_most_documents_have_is_compared_in_blocks(spark, monkeypatch):
    settle = line_dedup._settle

    def watched(min_words):
        of = settle(min_words)

        def settled(asking, forms):
            assert asking.num_rows <= 200 and forms.num_rows <= 200
            return of(asking, forms)

        return settled

    monkeypatch.setattr(line_dedup, "_settle", watched)
    monkeypatch.setattr(line_dedup, "BLOCK", 100)
    rng = random.Random(3)
    texts = ["one two\nthree four five"]
    for i in range(900):  # the first holder has the lines in the other order; a line of few in between makes holders differ
        pair = ["three four five", "one two"]
        texts.append("\n".join([f"own {i}", *pair, rng.choice(["red", "blue", ""]) + f" {i % 300}"]))
    found = {r.doc_id: list(r.gone) for r in line_dedup.line_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), gone_col="gone").collect()}
    assert found[0] == found[1] == [] and all(set(found[i]) >= {1, 2} for i in range(2, 901))


def test_whole_documents_equal_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    rows_in = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    want = dict(zip([i for i, _ in rows_in], _brute([t or "" for _, t in rows_in]), strict=True))
    found = {r.doc_id: set(r.gone) for r in line_dedup.line_dedup(docs, gone_col="gone").collect()}
    assert found == want and any(want.values())


def test_rare_lines_are_those_of_fewest_equals():
    lines = [(0, 0, 3, b"a" * 16, 9), (1, 1, 3, b"b" * 16, 2), (2, 2, 3, b"c" * 16, 2)]
    assert line_dedup.rare_line(lines) == line_dedup.rare_line(lines[1:2]) != line_dedup.rare_line(lines[2:])
