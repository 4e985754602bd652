import random

import pytest

#: Names that clash with what operators return, in this and in another case.
EXTRA = ["n_chars", "Doc_ID", "spans", "size", "keep_id", "key", "mark"]
KIND = "doc_id bigint, text string, source string, n_chars bigint, Doc_ID string, spans string, size int, keep_id int, `key` string, mark int"


def sentence(rng, n, words=None):
    words = words or [a + b for a in ("ba", "ko", "ti", "re", "su", "mo") for b in ("la", "ne", "ri", "so", "tu", "x")]
    return " ".join(rng.choice(words) for _ in range(n))


def texts():
    """Texts with copies, near copies, shared lines, an empty one, a null, and a very long one."""
    rng = random.Random(5)
    base = [sentence(rng, rng.randrange(20, 90)) for _ in range(25)]
    near = [" ".join([*b.split()[:-1], "changed"]) for b in base[:6]]
    line = sentence(rng, 14)
    shared = [f"{line}\n{sentence(rng, 30)}\n\n{sentence(rng, 12)}" for _ in range(5)]
    long = "\n".join(sentence(rng, 400, [f"w{i}" for i in range(4000)]) for _ in range(60))
    return [*base, *near, *base[:4], base[0].upper(), *shared, "", "", None, "one two", "One two", "é ☃ ▁ <|endoftext|> \x00 x", long, "\n\n", " "]


def rows():
    """Rows with repeated ids, null ids and sources."""
    found = [(i, t) for i, t in enumerate(texts())]
    found += [(3, texts()[3]), (3, "another text with a known id"), (None, texts()[5]), (None, None), (None, texts()[5])]
    return [(i, t, None if k % 7 == 0 else f"s{k % 4}", 1, "x", "y", 2, 3, "z", 4) for k, (i, t) in enumerate(found)]


@pytest.fixture(scope="session")
def messy(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    yield spark.createDataFrame(rows(), KIND).repartition(3)
    spark.conf.set("spark.sql.caseSensitive", "false")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, source string")


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
