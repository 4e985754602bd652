"""The classifier's features, updates and scores against plain ones, number by number."""

import math
import random
import re

import numpy as np
import pyarrow as pa

from llm_fixtures import sentence, texts
from riverglass.llm import quality_classifier
from riverglass.llm.wordhash import chunks

TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+")


def _examples(found):
    out = []
    for _, _, data, ends in chunks(pa.array(found)):
        text, index = quality_classifier.features(data, ends)
        out += [index[text == k].ravel().tolist() for k in range(len(ends))]
    return out


def _plain_train(examples):
    """Dense updates one weight at a time."""
    z, n = {}, {}
    a, b, l1, l2 = quality_classifier.ALPHA, quality_classifier.BETA, quality_classifier.L1, quality_classifier.L2

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return (math.copysign(l1, z[i]) - z[i]) / ((b + math.sqrt(n[i])) / a + l2)

    for _ in range(quality_classifier.EPOCHS):
        for pairs, label in examples:
            p = 1 / (1 + math.exp(-sum(weight(i) * x for i, x in pairs)))
            for i, x in pairs:
                g = (p - label) * x
                s = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / a
                z[i], n[i] = z.get(i, 0.0) + g - s * weight(i), n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def test_updates_equal_plain_ones():
    rng = random.Random(3)
    examples = []
    for k in range(60):
        index = sorted(rng.sample(range(200), 12))
        examples.append(([(i, rng.random() * 3) for i in index] + [(1 << quality_classifier.BITS, 1.0)], int(index[0] < 10) if k % 9 else 0))
    want = _plain_train(examples)
    got = quality_classifier.train([(np.array([i for i, _ in x]), np.array([v for _, v in x]), y) for x, y in examples])
    assert all(math.isclose(got[i], w, rel_tol=1e-4, abs_tol=1e-5) for i, w in want.items())
    assert np.count_nonzero(got) == sum(w != 0 for w in want.values()) < len(want)  # some are regularised to zero


def test_every_token_has_its_features():
    for text, index in zip(found := [t or "" for t in texts()], _examples(found), strict=True):
        assert len(index) == quality_classifier.PER_TOKEN * len(TOKEN.findall(text.encode()))


def test_features_tell_words_pairs_and_forms():
    one, two, three, four = (np.array(x).reshape(-1, 4) for x in _examples(["good word", "GOOD word", "good good", "word good"]))
    assert (one[:, :2] == two[:, :2]).all() and one[0, 2] != two[0, 2] and one[1, 2] == two[1, 2]  # letters, forms
    assert one[1, 3] != two[1, 3] and three[0, 0] == three[1, 0] and three[1, 2] != three[0, 2]  # pairs of forms, a repeat
    assert one[0, 0] == four[1, 0] and one[0, 1] != four[1, 1]  # a word, and its pair


def test_scores_are_plain_dot_products(spark):
    rng = random.Random(8)
    found = [sentence(rng, rng.randrange(1, 60)) for _ in range(40)] + ["", "!!", "A b A b"]
    w = np.random.default_rng(1).normal(size=(1 << quality_classifier.BITS) + 1).astype(np.float32)
    df = spark.createDataFrame(list(enumerate(found)), "doc_id int, text string")
    got = {r.doc_id: r.score for r in quality_classifier.score(df, w.tobytes()).collect()}
    for k, index in enumerate(_examples(found)):
        total = float(w[-1]) + quality_classifier.SCALE * sum(float(w[i]) for i in index) / max(1, len(index))
        assert math.isclose(got[k], 1 / (1 + math.exp(-max(-35.0, min(35.0, total)))), rel_tol=1e-6, abs_tol=1e-12)
