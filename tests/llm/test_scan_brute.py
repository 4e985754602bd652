"""Licence labels and scores, secrets and media features against plain scans of every row."""

import base64
import hashlib
import json
import random
import re
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import fold, rows
from riverglass.llm import license_scan, media_columns, secret_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# Licences: every template tried at every place of every text


def _templates_at(words):
    """(label, score) of every place where a template's phrases stand."""
    out = []
    for label, text, phrases in license_scan.TEMPLATES:
        want = text.split()
        offsets = [(text[: text.index(p)].count(" "), p.split()) for p in phrases]
        for o in range(-len(want), len(words)):
            if all(o + a >= 0 and words[o + a : o + a + len(p)] == p for a, p in offsets):
                hits = sum(0 <= o + k < len(words) and words[o + k] == w for k, w in enumerate(want))
                out.append((label, hits / len(want)))
    return out


def _license_row(doc_id, text):
    words = WORD.findall(fold(text))
    base = [(k, label) for name, label in license_scan.BASE.items() for k in range(len(words)) if words[k : k + len(name.split())] == name.split()]
    found = _templates_at(words)
    labels = {label for _, label in base}
    score = max((s for _, s in found), default=license_scan.NAME_SCORE if base else 0.0)
    first, last = (min(base)[0], max(base)[0]) if base else (None, None)
    joined = lambda x: ",".join(sorted(x))
    return doc_id, len(words), len(base), first, last, joined(labels), joined(labels | {x for x, _ in found}), round(score, 9)


def _license_texts():
    rng = random.Random(4)
    parts = [t for _, t, _ in license_scan.TEMPLATES] + list(license_scan.BASE)
    words = sorted({w for p in parts for w in p.split()})
    texts = []
    for _ in range(120):
        picked = [rng.choice(parts) for _ in range(rng.randrange(4))] + [" ".join(rng.choice(words) for _ in range(rng.randrange(30)))]
        rng.shuffle(picked)
        tokens = " ".join(picked).split()
        for _ in range(rng.randrange(3)):
            if tokens:
                tokens[rng.randrange(len(tokens))] = rng.choice(["x", "the", "license", "GPL"])
        texts.append("".join(t.upper() + rng.choice([" ", ", ", "-", "\n"]) if rng.random() < 0.1 else t + rng.choice([" ", " ", ". "]) for t in tokens))
    return texts


def test_license_query_equals_a_scan_of_every_place(spark, tmp_path):
    texts = [*_license_texts(), None, "", "mit license", *[t for _, t, *_ in rows()]]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {(*r[:7], round(r[7], 9)) for r in license_scan.op1_license_scan(spark, str(tmp_path)).collect()}
    want = {_license_row(i, t) for i, t in enumerate(texts)}
    assert found == want and len({r[6] for r in want}) > 15


def test_license_query_on_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    found = {(*r[:7], round(r[7], 9)) for r in license_scan.op1_license_scan(spark, data).collect()}
    assert found == {_license_row(r.doc_id, r.text) for r in docs}


# Secrets: characters read one at a time


def _run(text, at, allowed):
    end = at
    while end < len(text) and text[end] in allowed:
        end += 1
    return end


UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
VALUE = UPPER + LOWER + DIGITS + "+/_.=-"


def _assign(text, at):
    """(start of the value, end) of an assignment that starts here."""
    low = "".join(chr(ord(c) + 32) if c in UPPER else c for c in text[at : at + 8])
    for name in ("password", "passwd", "secret", "token", "api_key", "apikey"):
        if low.startswith(name):
            k = at + len(name)
            for quote in (1, 0):  # a quote is taken where what follows still fits
                j = k + (quote and text[k : k + 1] in ('"', "'"))
                j = _run(text, j, " ")
                if text[j : j + 1] in (":", "="):
                    j = _run(text, j + 1, " ")
                    for second in (1, 0):
                        v = j + (second and text[j : j + 1] in ('"', "'") and text[j : j + 1] != "")
                        end = _run(text, v, VALUE)
                        if end > v:
                            return v, end
    return None


def _base(text):
    out, at = [], 0
    while at < len(text):
        hit = _assign(text, at)
        if hit and hit[1] - hit[0] >= 6:
            out.append((at, 0, hit[1]))
        at = hit[1] if hit else at + 1
    for kind, start, allowed, least in ((1, "AKIA", UPPER + DIGITS, 20), (2, "", DIGITS + "abcdef", 24)):
        at = 0
        while at < len(text):
            end = _run(text, at + len(start), allowed) if text.startswith(start, at) else at
            if end > at + len(start):
                if end - at >= least:
                    out.append((at, kind, end))
                at = end
            else:
                at += 1
    return sorted(out)


def _der(n=32):
    number = b"\x02\x01\x00" + b"\x02" + bytes([n]) + bytes(range(n))
    return b"\x30" + bytes([len(number)]) + number


def _part(x):
    return base64.urlsafe_b64encode(x if isinstance(x, bytes) else json.dumps(x).encode()).rstrip(b"=").decode()


def _secret_texts():
    """(text, spans that the method adds)."""
    rng = random.Random(2)
    scraps = ["password", "Passwd", "SECRET", "token", "api_key", "apikey", "API_KEY", '"', "'", " ", "  ", ":", "=", "abcdef", "a1B2c3", "x", "AKIA", "A" * 16, "ABCD1234", "\n", "é", "0123456789abcdef", "ſ", "deadbeef" * 3, ".", "-"]
    plain = [("".join(rng.choice(scraps) for _ in range(rng.randrange(25))), []) for _ in range(400)]
    token = f"{_part({'alg': 'HS256'})}.{_part({'sub': 'x'})}.{_part(b'sig')}"
    der, hexed = base64.b64encode(_der()).decode(), _der().hex()
    body = f"{der[:20]}\n{der[20:]}"
    pem = f"-----BEGIN EC PRIVATE KEY-----\n{body}\n-----END EC PRIVATE KEY-----"
    closed = f"-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,{'0A' * 16}\n\n{base64.b64encode(bytes(range(48))).decode()}\n-----END RSA PRIVATE KEY-----"
    none = f"{_part({'alg': 'none'})}.{_part({})}."
    planted = [
        (f"é {token} end", [("jwt", 2, 2 + len(token))]),
        (f"a.{token}.{token}", [("jwt", 2, 2 + len(token)), ("jwt", 3 + len(token), 3 + 2 * len(token))]),
        (none, [("jwt", 0, len(none))]),
        (f"{_part({'alg': 'HS256'})}.{_part({})}.", []),
        (f"{_part({'alg': 'HS256'})}.{_part([1])}.c2ln", []),
        (f"{_part({'alg': 5})}.{_part({})}.c2ln", []),
        (f"k {der} k", [("der", 2, 2 + len(der))]),
        (f"k {der[:-8]} k", []),
        (pem, [("pem", 0, len(pem))]),
        (pem.replace("END EC", "END RSA"), []),
        (closed, [("pem", 0, len(closed))]),
        (closed.replace("-----END", "AAAA\n-----END"), []),
    ]
    assert secret_scan.is_key_encoding(bytes.fromhex(hexed))
    return plain + planted


def _digest(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_secret_query_equals_a_scan_of_every_character(spark, tmp_path):
    cases = [*_secret_texts(), *((t, []) for _, t, *_ in rows())]
    spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = secret_scan.op3_secret_scan(spark, str(tmp_path))
    assert found.columns[:6] == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    kinds = list(secret_scan.KINDS)
    for r in found.collect():
        text, added = cases[r.doc_id]
        base = _base(text or "")
        counts = Counter(k for _, k, _ in base)
        assert (r.n_assign, r.n_access, r.n_hex) == (counts[0], counts[1], counts[2]), text
        assert r.base_sha256 == hashlib.sha256(_digest((kinds[k], a, b) for a, k, b in base).encode()).hexdigest(), text
        both = sorted([*base, *((a, kinds.index(k), b) for k, a, b in added)])
        assert r.spans == _digest((kinds[k], a, b) for a, k, b in both), text


def test_secret_query_on_documents(spark, data):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    for r in secret_scan.op3_secret_scan(spark, data).collect():
        base = _base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(_digest((secret_scan.KINDS[k], a, b) for a, k, b in base).encode()).hexdigest()


@pytest.mark.parametrize("unit", ["eyJ", "eyJ.", "eyJa.b.", "-----BEGIN PRIVATE KEY-----\n", "a: b\n", "token ", "M", "30", "AKIA", "password=", " "])
def test_long_texts_take_time_in_proportion(unit):
    import time

    def took(n):
        text = "-----BEGIN PRIVATE KEY-----\n" + unit * (n // len(unit))
        began = time.process_time()
        secret_scan.find_secrets(text)
        return time.process_time() - began

    took(1000)
    assert took(400_000) < 40 * took(40_000) + 0.5  # ten times the text; a square would be a hundred times


# Media features: one window, one bin at a time


def _tone_peaks(payload):
    """(frame, band, bin) by a transform that is written out, for each frame and band."""
    x = np.frombuffer(payload, np.uint8).astype(float) - 128
    size, hop = media_columns.WINDOW, media_columns.HOP
    frames = 1 + max(0, -(-(len(x) - size) // hop))
    x = np.concatenate([x, np.zeros(size + (frames - 1) * hop - len(x))])
    hann = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / (size - 1))
    turn = np.exp(-2j * np.pi * np.outer(np.arange(size // 2 + 1), np.arange(size)) / size)
    power = [np.abs(turn @ (x[f * hop : f * hop + size] * hann)) for f in range(frames)]
    return power


def test_features_equal_a_transform_written_out():
    rng = np.random.default_rng(5)
    payloads = [media_columns.padded(t.encode()) for t in ["", "short", "a longer text of some words " * 20, "".join(chr(c) for c in rng.integers(32, 1000, 900))]]
    for payload in payloads:
        power = _tone_peaks(payload)
        time, bins = media_columns.peaks(payload)
        got = {}
        for t, b in zip(time.tolist(), bins.tolist(), strict=True):
            band = next(k for k, (low, high) in enumerate(media_columns.BANDS) if low <= b < high)
            assert (t, band) not in got
            got[t, band] = b
        for f in range(len(power)):
            for band, (low, high) in enumerate(media_columns.BANDS):
                top = power[f][low:high].max()
                before = power[f - 1][low:high].max() if f else -1
                after = power[f + 1][low:high].max() if f + 1 < len(power) else -1
                near = 1e-3 * (1 + top)  # single precision may part what is as good as equal
                if abs(top - before) > near and abs(top - after) > near:
                    assert ((f, band) in got) == (top > before and top > after)
                if (f, band) in got:
                    assert power[f][got[f, band]] >= top - near
        # pairs: each peak with the FAN_OUT next ones that are near enough
        order = list(zip(time.tolist(), bins.tolist(), strict=True))
        pairs = sorted((t, p << 14 | q << 6 | u - t) for k, (t, p) in enumerate(order) for u, q in order[k + 1 : k + 1 + media_columns.FAN_OUT] if u - t <= media_columns.REACH)
        times, hashes = media_columns.fingerprints(payload)
        assert list(zip(times.tolist(), hashes.tolist(), strict=True)) == pairs
