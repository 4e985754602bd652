"""Licence scans, secret scans, media columns, exact dedup, mixing: against brute force and SQL."""

import base64
import hashlib
import json
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import fold, rows
from riverglass.llm import exact_dedup, license_scan, media_columns, secret_scan, source_mix

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _der():
    number = b"\x02\x01\x00" + b"\x02\x20" + bytes(range(32))
    return b"\x30" + bytes([len(number)]) + number


def _token(header):
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).rstrip(b"=").decode()
    return f"{part(header)}.{part({'sub': 'x'})}.c2ln"


def test_license_places_are_all_found(spark, messy):
    lines = ["Under the GNU General Public License, version 3. gnu-general\npublic  license", "mit license MIT LICENSE", "cc by cc-by-nc", "xgnu general public license", "Licensed under the Apache License, Version 2.0.", "license mit"]
    more = [(1000 + i, x) for i, x in enumerate(lines)]
    df = messy.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id bigint, text string"))
    found = Counter((r.doc_id, r.n_words, tuple(sorted((p.label, p.start) for p in r.base_places))) for r in license_scan.scan_licenses(df).collect())
    want = Counter()
    for i, t in [(r[0], r[1]) for r in rows()] + more:
        words = WORD.findall(fold(t))
        places = [(label, k) for phrase, label in license_scan.BASE.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
        want[i, len(words), tuple(sorted(places))] += 1
    assert found == want


def test_license_templates_need_their_phrases(spark):
    lines = ["licensed under the apache license version 2.0", "the apache license is version 2.0 licensed", "Permission is hereby granted, free of charge, to any person obtaining a copy", "permission is granted free of charge", "licensed under CC BY-NC 4.0"]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id int, text string")
    found = {r.doc_id: {s.label: s.score for s in r.template_scores} for r in license_scan.scan_licenses(df).collect()}
    assert found[0] == {"apache-2.0": 1.0} and not found[1] and not found[3]
    assert list(found[2]) == ["mit"] and 0.7 < found[2]["mit"] < 1 and found[4]["cc-by-nc"] == 1.0


def test_license_of_nothing(empty):
    assert license_scan.scan_licenses(empty).collect() == []


def test_base_secrets_keep_their_rules():
    spans = lambda t: secret_scan.find_secrets(t)
    assert spans("password=token:abcdef") == []  # the first match takes "token" as a value of five characters
    assert spans('API_KEY" : "abcdef"') == [("assign", 0, 18)]
    assert spans("paſſword=abcdefg") == []  # only ASCII letters in either case
    assert spans("AKIA" + "A" * 15) == [] and spans("xAKIA" + "A" * 16) == [("access", 1, 21)]
    assert spans("é" + "a1" * 12 + "g") == [("hex", 1, 25)] and spans("a" * 23) == []


def test_structure_confirms_secrets():
    der = base64.b64encode(_der()).decode()
    assert [k for k, _, _ in secret_scan.find_secrets(f"x {der} y")] == ["der"]
    assert secret_scan.find_secrets(f"x {der[:-4]} y") == []
    assert "der" in [k for k, _, _ in secret_scan.find_secrets("x " + _der().hex() + " y")]
    assert [k for k, _, _ in secret_scan.find_secrets(_token({"alg": "HS256"}))] == ["jwt"]
    assert secret_scan.find_secrets(_token({"typ": "x"})) == [] and secret_scan.find_secrets("eyJhbGciOiJ.eyJ.x") == []
    pem = f"-----BEGIN RSA PRIVATE KEY-----\n{der[:30]}\n{der[30:]}\n-----END RSA PRIVATE KEY-----"
    assert ("pem", 0, len(pem)) in secret_scan.find_secrets(pem)
    assert secret_scan.find_secrets(pem.replace(der[:8], "AAAAAAAA")) == []


def test_secrets_of_every_row(messy, empty):
    found = secret_scan.scan_secrets(messy)
    assert found.count() == len(rows()) and found.columns == ["doc_id", "spans"]
    assert secret_scan.scan_secrets(empty).collect() == []


def test_media_round_trip(messy, empty):
    media = media_columns.encode_media(messy).collect()
    payloads = Counter(media_columns.from_wav(bytes(r.media)) for r in media)
    want = Counter(media_columns.padded((r[1] or "").encode()) for r in rows())
    assert payloads == want and all(len(p) % 64 == 0 and p for p in payloads)
    found = media_columns.media_features(media_columns.encode_media(messy)).collect()
    by_text = {}
    for r in found:
        assert len(r.fp_times) == len(r.fp_hashes) and list(r.fp_times) == sorted(r.fp_times)
        assert by_text.setdefault(r.payload_sha256, r.fp_hashes) == r.fp_hashes
    tails = Counter((hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])) for p in want.elements())
    assert Counter((r.payload_sha256, r.tail_crc32) for r in found) == tails
    assert media_columns.media_features(media_columns.encode_media(empty)).collect() == []


def test_peaks_find_a_tone():
    t = np.arange(8000)
    tone = (128 + 100 * np.sin(2 * np.pi * t * 40 / 256) * (1 + np.sin(t / 300))).astype(np.uint8).tobytes()
    frames, bins = media_columns.peaks(tone)
    assert len(frames) and 40 in bins


def test_exact_dedup_equals_brute_force(messy, empty):
    for digest in (False, True):
        groups = {}
        for r in rows():
            groups.setdefault(fold(r[1]), []).append(r[0])
        want = Counter()
        for text, ids in groups.items():
            keep = max((i for i in ids if i is not None), default=None)
            kept_left = 1
            sha = hashlib.sha256(text.encode()).hexdigest() if digest or len(ids) > 1 else None
            for i in sorted(ids, key=lambda i: (i is None, i)):
                kept = i == keep and kept_left > 0
                kept_left -= kept
                want[i, keep, len(ids), kept, sha] += 1
        # without digest, a row alone in its group may or may not have needed its hash
        found = Counter((*r[:4], r[4] if digest or r.group_size > 1 else None) for r in exact_dedup.exact_dedup(messy, digest=digest).collect())
        assert found == want
    assert exact_dedup.exact_dedup(empty).collect() == []


def test_one_group_may_hold_most_rows(spark):
    df = spark.range(5000).selectExpr("id AS doc_id", "CASE WHEN id % 10 < 6 THEN 'Same' ELSE concat('t', id) END AS text")
    found = exact_dedup.exact_dedup(df)
    assert found.where("kept").count() == 2001 and found.where("group_size = 3000 and keep_id = 4995").count() == 3000


def _levels(sizes, weights):
    """Targets by resharing the excess until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mix_targets_and_thresholds(messy, empty):
    found = source_mix.mix_sources(messy).collect()
    assert len(found) == len(rows())
    size = Counter()
    for r in rows():
        size[r[2]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    want = _levels(size, source_mix.WEIGHTS)
    taken = Counter()
    for r in found:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source]) and r.taken == r.times * r.size <= 2 * r.size
        taken[r.source] += r.taken
    largest = max(r.size for r in found)
    assert all(abs(taken[s] - want[s]) <= largest for s in want)
    assert Counter(map(tuple, found)) == Counter(map(tuple, source_mix.mix_sources(messy).collect()))
    rows_out = source_mix.mixed(messy)
    assert rows_out.columns == messy.columns and rows_out.count() == sum(r.times for r in found)
    assert source_mix.mix_sources(empty).collect() == []


def test_mix_is_near_its_targets(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "repeat('w ', cast(1 + id % 9 as int)) AS text", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 5) END AS source")
    found = source_mix.mix_sources(df).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert all(abs(r["sum(taken)"] - r["max(target)"]) <= 9 for r in found)
