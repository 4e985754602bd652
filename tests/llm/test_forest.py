"""The LSH forest: recall by measurement, links of chains and crowds by brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import sentence
from riverglass.llm import jaccard_join
from riverglass.llm.wordhash import mix


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_recall_of_ten_thousand_pairs_at_the_threshold(threshold):
    forest = jaccard_join.Forest(threshold)
    depth = jaccard_join.fitted_depth(jaccard_join.measured_recall(forest, [40, 90, 200, 400] * 64, threshold))
    assert 1 < depth < jaccard_join.DEPTH
    rng = np.random.default_rng(5)
    sizes = [20, 60, 120, 300, int(jaccard_join.FEW * 0.7), jaccard_join.FEW, jaccard_join.FEW + 40, 2500]
    shares = [8, 8, 8, 6, 4, 3, 2, 1]
    found = [forest.matched(*jaccard_join.planted_pair(n, threshold, rng)) >= depth for n, k in zip(sizes, shares, strict=True) for _ in range(250 * k)]
    assert len(found) == 10_000 and np.mean(found) >= 0.995


def test_sets_of_unlike_sizes_share_a_way():
    """A subset is at the threshold where the sizes differ most."""
    rng = np.random.default_rng(6)
    for threshold in (0.5, 0.8):
        forest = jaccard_join.Forest(threshold)
        for n in (jaccard_join.FEW, jaccard_join.FEW + 1, int(jaccard_join.FEW / threshold)):
            whole = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            part = whole[: int(np.ceil(threshold * len(whole)))]
            assert any(x is not None and y is not None for x, y in zip(forest.paths(whole), forest.paths(part), strict=True))


def test_prefixes_are_shortened_until_the_target():
    assert jaccard_join.fitted_depth([1, 1, 1, 0.999, 0.9], 0.998) == 3 and jaccard_join.fitted_depth([1, 1, 1], 0.998) == 2
    assert jaccard_join.fitted_depth([1, 0.5, 0.4], 0.998) == 1
    easy = jaccard_join.measured_recall(jaccard_join.Forest(0.95), [100], 0.95)
    assert easy == sorted(easy, reverse=True) and jaccard_join.fitted_depth(easy) >= 7


def _sets(texts):
    out = []
    for t in texts:
        w = t.split()
        out.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)})
    return out


def _counts(texts, threshold):
    sets = _sets(texts)
    number = {x: k for k, x in enumerate(set().union(*sets))}
    has = np.zeros((len(sets), len(number)), np.float32)
    for k, s in enumerate(sets):
        has[k, [number[x] for x in s]] = 1
    both, size = has @ has.T, has.sum(axis=1)
    near = both >= threshold * (size[:, None] + size - both) - 1e-6
    return near.sum(axis=1) - 1


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_a_long_chain_keeps_its_links(spark, threshold, monkeypatch):
    """Each text is a step from the one before, so a component is long and most of its pairs share nothing."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 64)
    rng = random.Random(11)
    words, texts = sentence(rng, 120, [f"w{i}" for i in range(300)]).split(), []
    for i in range(900):
        words[rng.randrange(len(words))] = f"v{i}"
        texts.append(" ".join(words))
    want = _counts(texts, threshold)
    found = {r.doc_id: r.n_links for r in jaccard_join.jaccard_join(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), threshold=threshold).collect()}
    got = np.array([found[k] for k in range(len(texts))])
    assert (got <= want).all() and got.sum() >= 0.995 * want.sum() and (want > 0).all()


def test_a_crowd_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 50)
    rng = random.Random(9)
    base = sentence(rng, 200, [f"w{i}" for i in range(500)]).split()
    texts = []
    for i in range(400):
        words = list(base)
        words[rng.randrange(200)] = f"new{i}"
        texts.append(" ".join(words))
    found = jaccard_join.jaccard_join(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    assert {(r.class_id, r.class_size, r.n_links) for r in found} == {(0, 400, 399)}


def test_blocks_without_a_common_node_are_not_compared(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 2)
    nodes = {"a": [1, 2], "b": [1], "c": [2], "d": [3], "e": [3], "f": [4], "g": [4, 3]}
    shared = spark.createDataFrame([(k.encode(), n) for k, x in nodes.items() for n in x], "key binary, node bigint")
    found = spark.createDataFrame([(k.encode(), b"r", 1, 4) for k in nodes], "key binary, root binary, shingles bigint, blocks bigint")
    placed, pairs = jaccard_join._blocks(found, shared)
    block = {bytes(r.key).decode(): r.block for r in placed.collect()}
    got = {(r.i, r.j) for r in pairs.collect()}
    want = {tuple(sorted((block[a], block[b]))) for a, x in nodes.items() for b, y in nodes.items() if set(x) & set(y)}
    assert got == want and set(block) == set(nodes)


def test_tries_link_every_node(spark):
    """Sorted paths dealt over tasks give the components that grouping by prefix gives."""
    rng = np.random.default_rng(3)
    depth, wide = 2, jaccard_join.DEPTH * 4
    rows = []
    for k in range(400):
        path = rng.integers(0, 3, jaccard_join.DEPTH).astype("<u4").tobytes()
        rows.append((f"k{k:04}".encode(), int(k % 3), path, 0))
    shared = spark.createDataFrame(rows, "key binary, tree int, path binary, node bigint")
    edges = {(bytes(r.a), bytes(r.b)) for r in jaccard_join._trie_links(shared, depth).collect()}
    prefix = {key: (tree, path[: 4 * depth]) for key, tree, path, _ in rows}
    assert all(prefix[a] == prefix[b] for a, b in edges) and wide == len(rows[0][2])
    root = {key: key for key in prefix}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(a)] = find(b)
    groups = {}
    for key, p in prefix.items():
        groups.setdefault(p, set()).add(find(key))
    assert all(len(x) == 1 for x in groups.values())


def test_kept_rows_of_odd_tables(spark):
    rows = [(None, "a b c d e f"), (2, "a b c d e f"), (2, "A b c d e f"), (2, "other words stand in this one"), (None, None), (5, ""), (5, ""), (6, "..."), (None, "alone here is this text of null id")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id int, text string, mark string, own int")
    kept = jaccard_join.keep_one(df)
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert kept.columns == df.columns and len(found) == 4
    assert (2, "other words stand in this one") in found and (5, "") in found and (None, "alone here is this text of null id") in found
    assert jaccard_join.keep_one(df.limit(0)).collect() == []


def test_a_mix_of_hashes_is_a_bijection():
    x = np.arange(1 << 16, dtype=np.uint64)
    assert len(np.unique(mix(x))) == len(x)
