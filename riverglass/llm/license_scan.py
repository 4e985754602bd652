"""Operator 1, license scans: a positional index of licence wording, looked up by each template's rarest words.

All of it is DataFrame expressions. A first pass counts in how many documents each word of the templates and names
occurs. The index holds, of each template, the words of its mandatory phrases with the highest IDF, and of each
licence name its rarest word. In the second pass a document's words are looked up there; postings that agree on where
the template would start give an alignment, and at an alignment the mandatory phrases must stand word for word. A
text with all phrases in place has these words in place, so none is missed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, let, texts

#: What stands between words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Words that stand consecutively, and the label of such a place.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Label, wording, and the phrases of it that must be there.
TEMPLATES = (
    ("agpl", "licensed under the gnu affero general public license", ("gnu affero general public license",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc0", "licensed under cc0 1 0 universal", ("cc0 1 0",)),
    ("epl", "made available under the terms of the eclipse public license", ("eclipse public license",)),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", ("permission to use copy modify and or distribute this software",)),
    ("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)

#: Words of a template that the index holds, all of which must agree on an alignment.
AGREEING = 2
#: The score of a text that names a licence and has no template's phrases.
NAME_SCORE = 0.5


def vocabulary() -> list[str]:
    """The words of all templates and names."""
    return sorted({w for text in [*(t for _, t, _ in TEMPLATES), *BASE] for w in text.split()})


def document_counts(rows: DataFrame) -> dict[str, int]:
    """In how many of rows (doc_id, text) each word of the vocabulary occurs; one row a word reaches the driver."""
    terms = F.array(*map(F.lit, vocabulary()))
    found = rows.select(F.explode(F.array_intersect(terms, F.split(ascii_lower("text"), GAP))).alias("word"))
    return {r["word"]: r["count"] for r in found.groupBy("word").count().collect()}


def _words(text: str) -> Column:
    return F.array(*map(F.lit, text.split()))


def _templates() -> Column:
    """The templates as one value: an array of (label, words, phrases), a phrase being (place in the words, words)."""
    entries = []
    for label, text, phrases in TEMPLATES:
        places = [F.struct(F.lit(text[: text.index(p)].count(" ")).alias("at"), _words(p).alias("words")) for p in phrases]
        entries.append(F.struct(F.lit(label).alias("label"), _words(text).alias("words"), F.array(*places).alias("phrases")))
    return F.array(*entries)


def rarest(counts: dict[str, int]) -> dict[str, list[tuple[int, int]]]:
    """The index: word -> (template, place of the word in it), the AGREEING places with the rarest words of each template's phrases."""
    index: dict[str, list[tuple[int, int]]] = {}
    for t, (_, text, phrases) in enumerate(TEMPLATES):
        words = text.split()
        starts = [(text[: text.index(p)].count(" "), len(p.split())) for p in phrases]
        places = {k for at, n in starts for k in range(at, at + n)}
        for p in sorted(places, key=lambda k: (counts.get(words[k], 0), k))[:AGREEING]:
            index.setdefault(words[p], []).append((t, p))
    return index


def rarest_of_names(counts: dict[str, int]) -> dict[str, list[tuple[int, int]]]:
    """The index of names: word -> (name, place of the word in it), the rarest word of each."""
    index: dict[str, list[tuple[int, int]]] = {}
    for n, name in enumerate(BASE):
        words = name.split()
        p = min(range(len(words)), key=lambda k: (counts.get(words[k], 0), k))
        index.setdefault(words[p], []).append((n, p))
    return index


def _postings(index: dict[str, list[tuple[int, int]]]) -> Column:
    """The index as one value: word -> array of (template, place of the word in it)."""
    entries = {w: [F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in found] for w, found in index.items()}
    return F.create_map(*[x for w, found in entries.items() for x in (F.lit(w), F.array(*found))])


def _standing(words: Column, at: Column, phrase: Column) -> Column:
    """Whether a phrase's words stand in words from at (0-based) on."""
    return (at >= 0) & (F.slice(words, F.greatest(at, F.lit(0)) + 1, F.size(phrase)) == phrase)


def _maybe(text: Column) -> Column:
    """Whether a text has the letters of all words of some phrase; only then it can have a label."""
    needed = [p.split() for p in BASE] + [[w for p in phrases for w in p.split()] for _, _, phrases in TEMPLATES]
    needed = {tuple(dict.fromkeys(words)) for words in needed}
    needed = sorted(x for x in needed if not any(set(y) < set(x) for y in needed))  # a phrase within another decides
    every = [reduce(lambda a, b: a & b, [F.contains(text, F.lit(w)) for w in sorted(words, key=len, reverse=True)]) for words in needed]
    return reduce(lambda a, b: a | b, every)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return per row of docs: doc_id, n_words, base_places (label, start), template_scores (label, score).

    A-Z counts as a-z; start is a word number from 0; score is the share of a template's words in their places at a
    verified alignment. One row in, one row out; null ids and repeated rows are kept; a null or empty text has no
    words; texts of any length are scanned whole; an empty table gives an empty one; other columns are not read.
    """
    rows = texts(docs, id_col, text_col)
    counts = document_counts(rows)
    index, names = rarest(counts), rarest_of_names(counts)
    lowered = rows.select("doc_id", ascii_lower("text").alias("text"))
    cut = lowered.select("doc_id", _maybe(F.col("text")).alias("maybe"), F.array_remove(F.split("text", GAP), "").alias("words"))
    cut = cut.select("doc_id", F.size("words").cast("long").alias("n_words"), F.when(F.col("maybe"), F.col("words")).alias("words"))
    # where the looked-up words stand, and where each posting would have its template start
    places = F.transform("words", lambda w, i: F.when(w.isin(*sorted({*index, *names})), F.struct(w.alias("w"), i.alias("i"))))
    looked = cut.withColumn("hits", F.filter(places, lambda x: x.isNotNull()))

    def starts(index: dict[str, list[tuple[int, int]]]) -> Column:
        hits = F.filter("hits", lambda h: h["w"].isin(*sorted(index)))
        return F.flatten(F.transform(hits, lambda h: F.transform(_postings(index)[h["w"]], lambda x: F.struct(x["t"].alias("t"), (h["i"] - x["p"]).alias("o")))))

    looked = looked.withColumn("starts", F.array_sort(starts(index))).withColumn("name_starts", F.array_sort(starts(names)))
    before = AGREEING - 1
    agreed = let(F.col("starts"), lambda starts: F.filter(starts, lambda x, i: F.when(i >= before, F.get(starts, i - before) == x).otherwise(False)))
    looked = looked.withColumn("agreed", F.array_distinct(agreed))

    def template(x: Column) -> Column:
        return F.get(_templates(), x["t"])

    def share(words: Column, x: Column) -> Column:
        hits = F.filter(template(x)["words"], lambda w, k: F.when(x["o"] + k >= 0, F.get(words, F.greatest(x["o"] + k, F.lit(0))) == w).otherwise(False))
        return F.size(hits) / F.size(template(x)["words"])

    words = F.col("words")
    verified = let(words, lambda words: F.filter("agreed", lambda x: F.forall(template(x)["phrases"], lambda p: _standing(words, x["o"] + p["at"], p["words"]))))
    looked = looked.withColumn("verified", verified)
    scores = let(words, lambda words: F.transform("verified", lambda x: F.struct(template(x)["label"].alias("label"), share(words, x).alias("score"))))

    entries = F.array(*[F.struct(F.lit(label).alias("label"), _words(name).alias("words")) for name, label in BASE.items()])
    standing = let(words, lambda words: F.filter("name_starts", lambda x: _standing(words, x["o"], F.get(entries, x["t"])["words"])))
    base = F.transform(standing, lambda x: F.struct(F.get(entries, x["t"])["label"].alias("label"), x["o"].alias("start")))
    base = F.when(words.isNotNull(), base)
    none = [F.expr("cast(array() as array<struct<label:string,start:int>>)"), F.expr("cast(array() as array<struct<label:string,score:double>>)")]
    return looked.select("doc_id", "n_words", F.coalesce(base, none[0]).alias("base_places"), F.coalesce(scores, none[1]).alias("template_scores"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels and base places of every document; score is the best template's, or NAME_SCORE for a name alone."""
    found = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base, more = (F.transform(c, lambda x: x["label"]) for c in ("base_places", "template_scores"))
    starts = F.transform("base_places", lambda x: x["start"].cast("long"))
    best = F.array_max(F.transform("template_scores", lambda x: x["score"]))
    score = F.coalesce(best, F.when(F.size("base_places") > 0, F.lit(NAME_SCORE)).otherwise(F.lit(0.0)))

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size("base_places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        listed(base).alias("base_labels"),
        listed(F.concat(base, more)).alias("labels"),
        score.alias("score"),
    )
