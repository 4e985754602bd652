"""The token store against the library as it comes, and its index against plain dictionaries."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_fixtures import rows
from riverglass.llm import token_store

TEXTS = ["end<|endoftext|>start", "plain words here", "<|endoftext|>", "é ☃ <|endoftext|> x", "<|endoftext", None]


def _library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_store.vocabulary_path())


def _ids(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, token_store.END_ID], "<u4")


def test_query_equals_an_untouched_library(spark, tmp_path):
    library = _library()
    assert library.encode(TEXTS[0], add_special_tokens=False).ids == [437, 50256, 9688]
    start, want = 0, set()
    for i, t in enumerate(TEXTS):
        ids = _ids(library, t)
        want.add((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert set(map(tuple, token_store.op10_token_store(spark, str(tmp_path)).collect())) == want


def test_query_equals_the_library_on_all_documents(spark, data):
    library = _library()
    start, want = 0, set()
    for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect():
        ids = _ids(library, r.text)
        want.add((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert set(map(tuple, token_store.op10_token_store(spark, data).collect())) == want


@pytest.fixture
def small(monkeypatch):
    """Limits that small tables reach; workers fork from this process's modules, so only the driver's are set."""
    monkeypatch.setattr(token_store, "SHARD_BYTES", 1 << 14)


def test_round_trip_of_odd_rows(spark, messy, tmp_path, small):
    library = _library()
    library.encode_special_tokens = True
    marks = {r.t: r.m for r in messy.select(F.coalesce("text", F.lit("")).alias("t")).distinct().select("t", F.xxhash64("t").alias("m")).collect()}
    ordered = sorted(((r[0], r[1] or "") for r in rows()), key=lambda x: (x[0] is not None, x[0] or 0, marks[x[1]], x[1].encode()))
    start, want = 0, Counter()
    for i, t in ordered:
        ids = _ids(library, t)
        want[i, start, len(ids), zlib.crc32(ids.tobytes())] += 1
        start += len(ids)
    path = str(tmp_path / "a")
    token_store.write_tokens(messy, path)
    assert Counter(map(tuple, token_store.read_tokens(messy.select("doc_id"), path).collect())) == want
    some = spark.createDataFrame([(2,), (7,), (7,), (10_000,)], "doc_id bigint")
    assert {r.doc_id for r in token_store.lookup(some, path).collect()} == {2, 7}
    found = token_store.read_tokens(some, path, with_ids=True).where("doc_id = 2").first()
    assert found.ids == _ids(library, dict(ordered)[2]).tolist()


def test_one_id_in_many_shards(spark, tmp_path, small):
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN -5 ELSE id END AS doc_id", "concat('text number ', id, repeat(' x', 20)) AS text")
    token_store.write_tokens(df, path := str(tmp_path / "a"))
    places = token_store.lookup(spark.createDataFrame([(-5,), (None,)], "doc_id bigint"), path).collect()
    assert min(Counter(r.doc_id for r in places).values()) > 1  # each in several shards
    found = token_store.read_tokens(df.select("doc_id"), path)
    assert found.count() == 3000 and found.where("doc_id = -5").count() == 1000 and found.where("doc_id is null").count() == 1000
    starts = sorted((r.start, r.n_tokens) for r in found.collect())
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False)) and starts[0][0] == 0


def test_empty_store_and_no_keys(spark, empty, messy, tmp_path):
    token_store.write_tokens(empty, path := str(tmp_path / "a"))
    assert token_store.read_tokens(messy.select("doc_id"), path).collect() == []
    token_store.write_tokens(messy, path := str(tmp_path / "b"))
    assert token_store.read_tokens(empty.select("doc_id"), path).collect() == []


def test_a_key_takes_three_reads(spark, tmp_path):
    """What a lookup reads doesn't grow with the store."""
    took = []
    for n in (500, 20_000):
        path = str(tmp_path / str(n))
        token_store.write_tokens(spark.range(n).selectExpr("id AS doc_id", "concat('some text of number ', id) AS text"), path)
        index, shards = token_store.Index(f"{path}/index"), token_store.Files(f"{path}/shards")
        index.files.bytes_read = 0
        key = pa.array([123], pa.int64())
        places = index.places(int(token_store.marks(key)[0]) % index.buckets, key)
        assert places["at"].tolist() == [0]
        place = [(123, *(int(places[c][0]) for c in ("offset", "size", "start")))]
        (doc_id, start, raw, width), = token_store.payloads(shards, int(places["shard"][0]), place)
        assert _library().decode(np.frombuffer(raw, f"<u{width}")[:-1].tolist()) == "some text of number 123"
        assert shards.bytes_read == place[0][2] == token_store._RECORD.size + len(raw)
        took.append(index.files.bytes_read)
    assert max(took) < 2 * token_store.BUCKET_KEYS * 50 and sum(x.size for x in shards.found.values()) > 50 * shards.bytes_read


def test_perfect_hash_is_minimal_and_rejects_others():
    rng = np.random.default_rng(8)
    for n in (0, 1, 2, 1000):
        codes = rng.choice(1 << 40, n, replace=False).astype(np.uint64)
        places = [codes % np.uint64(k) for k in (7, 90, 100, 50, 3, 2)]
        bucket = token_store.Bucket(token_store.pack_bucket(codes, *places))
        assert sorted(token_store.find_slots(bucket.levels, codes).tolist()) == list(range(n))
        hit, found = bucket.find(codes)
        assert hit.all() and all((found[c] == x).all() for c, x in zip(token_store._PLACE, places, strict=True))
        assert not bucket.find(codes + np.uint64(1 << 41))[0].any()


def test_another_keys_fingerprint_gives_nothing():
    class Held:
        def read(self, shard, at, size):
            return file[at : at + size]

    file = token_store.pack(4, b"\1\0\2\0", 2) + b"\n" + token_store.pack(None, b"\3\0", 2) + token_store.pack(9, b"\4\0\0\0", 4)
    second = token_store._RECORD.size + 5
    assert [x[1:] for x in token_store.records(lambda a, n: file[a : a + n], 0, len(file))] == [(4, 14, 2, 2), (None, second + 14, 1, 2), (9, second + 30, 1, 4)]
    assert list(token_store.payloads(Held(), 0, [(4, 0, 18, 7)])) == [(4, 7, b"\1\0\2\0", 2)]
    assert list(token_store.payloads(Held(), 0, [(5, 0, 18, 7)])) == []


def test_encoder_equals_the_library_when_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(token_store, "CACHE", 50)
    code = token_store.Encoder(token_store.vocabulary_path())
    rng = random.Random(6)
    for _ in range(20):
        texts = ["".join(rng.choice("abcé '\n\t12.,!?s☃\x85\xa0²") for _ in range(rng.randrange(80))) for _ in range(20)]
        want = [np.array(x.ids, code.kind).tobytes() for x in code.library.encode_batch(texts, add_special_tokens=False)]
        assert code.encode(texts) == want
