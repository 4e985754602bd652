"""Operator 2, media columns: texts kept as 8-bit WAV samples, read back by the wave module, and fingerprinted.

A fingerprint is a pair of spectral peaks of the short-time Fourier transform: the two frequencies and the time
between them, stored with the time of the first as two parallel arrays.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import texts, trimmed, tune

BLOCK, RATE = 64, 8000
WINDOW, HOP = 256, 128
#: Bands of frequency bins; a frame has one peak at most in each.
BANDS = ((1, 16), (16, 32), (32, 64), (64, 129))
#: A peak is paired with so many later ones, at most so many frames later.
FAN_OUT, REACH = 3, 63
#: Frames transformed at once, which bounds the memory of a long text.
FRAMES = 2048

_HANN = np.hanning(WINDOW).astype(np.float32)


def to_wav(payload: bytes) -> bytes:
    """A WAV file of one channel whose 8-bit samples are the payload."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    """The samples of a WAV file."""
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


def padded(data: bytes) -> bytes:
    """data and zeros up to a positive multiple of BLOCK."""
    return data + bytes(max(BLOCK, -(-len(data) // BLOCK) * BLOCK) - len(data))


def peaks(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(frames, bins) of the spectral peaks by time, then band: a band's largest bin where its magnitude tops both neighbours in time."""
    x = np.frombuffer(samples, np.uint8)
    whole = WINDOW + max(0, -(-(len(x) - WINDOW) // HOP)) * HOP  # silence fills the last window
    x = np.concatenate([x, np.full(whole - len(x), 128, np.uint8)])
    frames = np.lib.stride_tricks.sliding_window_view(x, WINDOW)[::HOP]
    best = np.empty((len(BANDS), len(frames)), np.float32)
    bins = np.empty((len(BANDS), len(frames)), np.int64)
    for a in range(0, len(frames), FRAMES):
        power = np.abs(np.fft.rfft((frames[a : a + FRAMES].astype(np.float32) - np.float32(128)) * _HANN, axis=1))
        for k, (low, high) in enumerate(BANDS):
            top = power[:, low:high].argmax(axis=1)
            bins[k, a : a + FRAMES] = top + low
            best[k, a : a + FRAMES] = power[np.arange(len(power)), top + low]
    around = np.pad(best, ((0, 0), (1, 1)), constant_values=-1)
    is_peak = (best >= around[:, :-2]) & (best > around[:, 2:]) & (best > 0)
    time, band = np.nonzero(is_peak.T)
    return time, bins[band, time]


def fingerprints(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(times, hashes), one for each pair of near peaks; a hash holds both bins and the time between."""
    time, freq = peaks(samples)
    times, hashes = [], []
    for step in range(1, FAN_OUT + 1):
        gap = time[step:] - time[:-step]
        near = gap <= REACH
        times.append(time[:-step][near])
        hashes.append((freq[:-step][near] << 14 | freq[step:][near] << 6 | gap[near]))
    times, hashes = np.concatenate(times), np.concatenate(hashes)
    order = np.lexsort((hashes, times))
    return times[order].astype(np.int32), hashes[order].astype(np.int32)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [x.as_py() for x in batch.column("text").cast(pa.binary())]
        media = [to_wav(padded(x)) for x in raw]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(len, raw), pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])


def encode_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return per row of docs: doc_id, n_bytes (of the text in UTF-8), media (the WAV file).

    One row in, one row out; null ids and repeated rows are kept; a null text counts as empty and becomes BLOCK
    zeros; texts of any length are kept whole; an empty table gives an empty one; other columns are not read.
    """
    tune(docs.sparkSession)
    rows = texts(docs, id_col, text_col)
    return rows.mapInArrow(trimmed(_encode), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, media binary")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        media = [x.as_py() for x in batch.column("media")]
        size, sha, tail, times, hashes = [], [], [], [], []
        for file in media:
            payload = from_wav(file)
            size.append(len(payload))
            sha.append(hashlib.sha256(payload).hexdigest())
            tail.append(zlib.crc32(payload[-BLOCK:]))
            time, mark = fingerprints(payload)
            times.append(time)
            hashes.append(mark)
        columns = [*(pa.array(x) for x in (size, sha, tail)), *(pa.array(x, pa.list_(pa.int32())) for x in (times, hashes))]
        columns += [pa.array([len(x) for x in media], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in media])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_bytes"), *columns],
            ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "fp_times", "fp_hashes", "media_bytes", "media_sha256"],
        )


def media_features(media: DataFrame) -> DataFrame:
    """Return per row of encode_media()'s result what is read back from its media, and the fingerprints.

    fp_times and fp_hashes are parallel, by time; both depend on the media alone. A file too short for one window
    is filled up with silence for the transform.
    """
    kind = media.schema["doc_id"].dataType.simpleString()
    return media.mapInArrow(
        trimmed(_features),
        f"doc_id {kind}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, fp_times array<int>, fp_hashes array<int>, media_bytes bigint, media_sha256 string",
    )


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through its WAV file; feature is the number and digest of its fingerprints."""
    found = media_features(encode_media(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    coded = F.sha2(F.concat_ws(";", F.array_join("fp_times", ","), F.array_join("fp_hashes", ",")), 256)
    feature = F.concat_ws(":", F.size("fp_times"), F.substring(coded, 1, 32))
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"))
