"""Alignment where no line is unique."""

import random

from riverglass.llm import line_dedup


def _length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for k, y in enumerate(b):
            row.append(last[k] + 1 if x == y else max(last[k + 1], row[k]))
    return row[-1]


def test_gaps_without_anchors_are_aligned():
    assert len(line_dedup.patience(list("PQPQ"), list("QPQP"))) == 3 and len(line_dedup.patience(list("PQP"), list("QPQ"))) == 2
    rng = random.Random(7)
    for _ in range(500):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(14))] for _ in range(2))
        pairs = line_dedup._longest(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False))
        assert len(pairs) == _length(a, b)


def test_repeated_passages_go(spark):
    p, q = "this passage is long enough to go", "and so is this other passage here"
    df = spark.createDataFrame([(1, "\n".join([p, q, p, q])), (2, "\n".join([q, p, q, p]))], "doc_id int, text string")
    found = {r.doc_id: list(r.gone) for r in line_dedup.line_dedup(df, gone_col="gone").collect()}
    assert found[1] == [] and len(found[2]) == 3
