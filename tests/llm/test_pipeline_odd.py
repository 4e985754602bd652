"""The pipeline on odd tables: nulls, repeats, empty and long texts, clashing columns, nothing at all."""

from collections import Counter

import pytest

import corpus_pipeline
from llm_fixtures import sentence, texts


def _rows():
    found = [(i, t, "en", None if i % 7 == 0 else f"s{i % 3}", len(t or "")) for i, t in enumerate(texts())]
    found += [found[3], found[3], (3, "another text with a known id", "de", "s1", 5), (None, found[5][1], None, None, None), (None, None, None, None, None)]
    return [(*r, "x", 1) for r in found]


KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint, N_Chars string, mark int"


@pytest.fixture
def folder(spark, tmp_path):
    spark.conf.set("spark.sql.caseSensitive", "true")

    def made(rows, labels=()):
        path = str(tmp_path / str(len(rows)))
        spark.createDataFrame(rows, KIND).write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
        return path

    yield made
    spark.conf.set("spark.sql.caseSensitive", "false")


def test_every_stage_takes_odd_rows(spark, folder, tmp_path):
    path = folder(_rows())
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], path).write.parquet(str(tmp_path / f"stage{k}"))
        tables.append(spark.read.parquet(str(tmp_path / f"stage{k}")))
    assert all(t.columns == columns for t in tables[:-1])
    rows = [[tuple(r) for r in t.collect()] for t in tables]
    assert Counter(rows[1]) == Counter(rows[0])  # no labels: all stay
    assert Counter(r[0] for r in rows[2]) == Counter(r[0] for r in rows[1])
    assert all(r[4] == (None if r[1] is None else len(r[1])) and r[5] == "x" for r in rows[2])
    assert set(rows[3]) <= set(rows[2]) and set(rows[4]) <= set(rows[3]) and max(Counter(rows[4]).values()) <= 2
    final = Counter((r.doc_id, r.decoded) for r in tables[-1].collect())
    assert final == Counter((r[0], (r[1] or "").replace("\u2581", " ")) for r in rows[4])


def test_bad_texts_go_first(spark, folder):
    import random

    rng = random.Random(1)
    rows, labels = [], []
    for i in range(200):
        good = i % 2 == 0
        text = sentence(rng, 40) + "." if good else " ".join(rng.choice(["!!!", "$$$", "CLICK", "###", "WIN"]) for _ in range(40))
        rows.append((i, text, "en", "s", len(text), "x", 1))
        labels.append((i, int(good), 0))
    path = folder(rows, labels)
    kept = {r.doc_id for r in corpus_pipeline.good_texts(spark, spark.read.parquet(f"{path}/documents.parquet"), path).collect()}
    assert kept == set(range(0, 200, 2))


def test_an_empty_table_stays_empty(spark, folder):
    assert corpus_pipeline.run(spark, folder([])).collect() == []
