"""Operator 10, token-id output: raw id payloads in shard files, and a minimal perfect hash index over their keys.

Shard file: documents in ascending doc_id order, each a record: the letter D, flags, the key, the number of ids, and
the ids as little-endian unsigned integers (two bytes each where the vocabulary allows, else four). A byte 0x0A, which
Spark's text writer puts after each row, may stand between records. Shards hold SHARD_BYTES of text or so.

Index file: FILE_BUCKETS buckets of key hashes, with a table of where each begins. A bucket's minimal perfect hash is
a cascade of bit arrays: a key that is alone at its place in a level's array ends there, the others go on to the next
level; the rank of its bit is the key's slot. A slot holds a fingerprint of the key, the shard, the byte offset and
size of its payload there, and the number of ids before it in the whole store. So a key's ids take a read of the
table, one of the bucket, and one of the payload, however large the store is. A record's own key settles what the
fingerprint lets pass.

Files are written by Spark and read at offsets by pyarrow's file systems (local and mounted folders, HDFS, S3, GCS).
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, running_total, scratch_path, texts, trimmed, tune
from .wordhash import mix

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
#: A row of a shard is closed beyond so many bytes; a document never spans rows.
ROW_BYTES = 4 << 20
#: Text of a shard, about; and what is read at once at most, but for a larger document.
SHARD_BYTES, PIECE = 256 << 20, 8 << 20
#: Payloads with no more between them are read together.
NEAR = 1 << 16
#: Keys of an index bucket, about, and buckets of an index file.
BUCKET_KEYS, FILE_BUCKETS = 1 << 13, 64
#: Bits of a level's array for each key that is left.
GAMMA = 2.0
#: Words that an encoder remembers, some 200 bytes each; the first ones, among which are the frequent ones.
CACHE = 400_000

_RECORD = struct.Struct("<cBqI")  # D, flags, key, ids
_NULL, _WIDE = 1, 2
_FILE = struct.Struct("<4sII")  # magic, buckets of the store, buckets of the file
_INDEX = struct.Struct("<4sII")  # magic, keys, levels
#: A slot: fingerprint, shard, offset, size, ids before it, documents there, and shards that have the key.
_SLOT = ("<u4", "<u4", "<u8", "<u8", "<u8", "<u4", "<u4")
_PLACE = ("shard", "offset", "size", "start", "documents", "parts")

# Letters up to U+024F. A text of these, digits, ASCII marks and white space is cut into words here, by the pattern
# of byte-level BPE; any other text goes to the library as it is.
_L = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_PLAIN = re.compile(rf"[\t-\r -~{_L}]*")
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[0-9]+| ?[^\s0-9{_L}]+|\s+(?!\S)|\s+")
_SPACED = re.compile(rf" [{_L}]+")


def vocabulary_path(name: str = VOCABULARY) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts by the tokenizers library, which sees each distinct word of many texts once.

    Merges never cross the words that the pattern cuts, so a text's ids are its words' ids. A text with the string of
    an added token goes to the library whole, which gives the token's id, or those of ordinary text if special_as_text.
    """

    def __init__(self, path: str, special_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = special_as_text
        self.added = [x.content for x in self.library.get_added_tokens_decoder().values()]
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        single = set(ByteLevel.alphabet())
        lengths = np.zeros(self.library.get_vocab_size(), np.int64)
        for piece, i in self.library.get_vocab().items():
            lengths[i] = len(piece) if single.issuperset(piece) else 1
        self.lengths = lengths
        self.known: dict[str, bytes] = {}

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _has_added(self, text: str) -> bool:
        return any(x in text for x in self.added)

    def _learn(self, words: list[str]) -> None:
        # words that open with a space stay words when joined, so one call encodes them; byte lengths tell them apart
        joined = [w for w in words if _SPACED.fullmatch(w)]
        if self._has_added("".join(joined)):
            joined = []
        if joined:
            ids = np.array(self.library.encode_batch_fast(["".join(joined)], add_special_tokens=False)[0].ids, np.int64)
            ends = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum([len(w.encode()) for w in joined])) + 1
            raw, at = ids.astype(self.kind).tobytes(), 0
            for word, end in zip(joined, (ends * self.width).tolist(), strict=True):
                self.known[word] = raw[at:end]
                at = end
        others = [w for w in words if w not in self.known]
        for word, found in zip(others, self.library.encode_batch_fast(others, add_special_tokens=False), strict=True):
            self.known[word] = self._bytes(found.ids)

    def encode(self, batch: list[str]) -> list[bytes]:
        """The ids of each text, as bytes."""
        words = [_WORDS.findall(x) if _PLAIN.fullmatch(x) and not self._has_added(x) else None for x in batch]
        new = list(set().union(*(x for x in words if x)).difference(self.known))
        self._learn(new)
        get = self.known.__getitem__
        out = [self._bytes(self.library.encode(x, add_special_tokens=False).ids) if w is None else b"".join(map(get, w)) for x, w in zip(batch, words, strict=True)]
        if len(self.known) > CACHE:
            for w in new:
                del self.known[w]
        return out


@lru_cache(maxsize=1)
def encoder(path: str, special_as_text: bool) -> Encoder:
    """This process's encoder."""
    return Encoder(path, special_as_text)


# Files


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system's scheme, as Spark understands it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()


class Files:
    """A folder's numbered files (part-N or file=N), read at offsets; bytes_read counts what was."""

    def __init__(self, path: str):
        if path.startswith("file:") or "://" not in path:
            self.system, root = fs.LocalFileSystem(), re.sub("^file:/*", "/", path)
        else:
            self.system, root = fs.FileSystem.from_uri(path)
        listed = self.system.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True))
        named = [(re.search(r"/(?:file=(\d+)/part-|part-(\d+))", x.path[len(root) :]), x) for x in listed if x.is_file]
        self.found = {int(m[1] or m[2]): x for m, x in named if m}
        self.number, self.file, self.bytes_read = -1, None, 0

    def size(self, number: int) -> int:
        """The bytes of a file, 0 where there is none."""
        return self.found[number].size if number in self.found else 0

    def read(self, number: int, offset: int, size: int) -> bytes:
        """So many bytes of a file from an offset on."""
        if number != self.number:
            self.file, self.number = self.system.open_input_file(self.found[number].path), number
        self.bytes_read += size
        return self.file.read_at(size, offset)


@lru_cache(maxsize=4)
def files(path: str) -> Files:
    """This process's view of a folder, which doesn't change once it is written."""
    return Files(path)


# Shards


def pack(key: int | None, ids: bytes, width: int) -> bytes:
    """A document's record."""
    flags = (key is None) * _NULL | (width == 4) * _WIDE
    return _RECORD.pack(b"D", flags, key or 0, len(ids) // width) + ids


def records(read: Callable[[int, int], bytes], at: int, end: int) -> Iterator[tuple[int, int | None, int, int, int]]:
    """(offset, key, offset of the ids, number of ids, bytes of an id) of the records from at to end; read(offset, size) is asked for pieces."""
    base, data = at, b""
    while at < end:
        if at + _RECORD.size > base + len(data):
            base, data = at, read(at, min(PIECE, end - at))
        if data[at - base] == 0x0A:
            at += 1
            continue
        letter, flags, key, n = _RECORD.unpack_from(data, at - base)
        if letter != b"D":
            raise ValueError(f"no record at {at}")
        width = 4 if flags & _WIDE else 2
        yield at, None if flags & _NULL else key, at + _RECORD.size, n, width
        at += _RECORD.size + n * width


def write_shards(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", special_as_text: bool = True) -> int:
    """Encode docs and write shard files to path, in ascending order of the (integer) id; return the number of shards at most.

    Null ids come first; rows with one id are ordered by a hash of the text, then by the text, and may lie in several
    shards (rows equal in both lie in one). A null text counts as empty and has the end id only.
    """
    spark = docs.sparkSession
    tune(spark)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary, special_as_text)
        end = np.array([end_id], code.kind).tobytes()
        row: list[bytes] = []
        size = 0
        for batch in batches:
            for key, found in zip(batch.column("doc_id").to_pylist(), code.encode(batch.column("text").to_pylist()), strict=True):
                row.append(pack(key, found + end, code.width))
                size += len(row[-1])
                if size > ROW_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(row)], pa.binary())], ["records"])
                    row, size = [], 0
        if row:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(row)], pa.binary())], ["records"])

    rows = texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    held = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held // SHARD_BYTES))
    order = [F.col("doc_id").asc_nulls_first(), F.col("mark")]
    rows = rows.withColumn("mark", F.xxhash64("text")).repartitionByRange(parts, *order).sortWithinPartitions(*order, "text")
    found = rows.select("doc_id", "text").mapInArrow(trimmed(packed), "records binary")
    found.select(F.col("records").cast("string")).write.text(path)
    return parts


def marks(keys: pa.Array) -> np.ndarray:
    """A hash of each key, null too, as a long from 0 on."""
    codes = key_codes(*_known(keys), np.zeros(len(keys), np.int64))
    return (mix(codes ^ np.uint64(0x9FB21C651E98DF25)) >> np.uint64(1)).astype(np.int64)


def _known(keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, 0 for null; whether null) of a column of keys."""
    return keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), keys.is_null().to_numpy(zero_copy_only=False)


def _batched(rows: Iterator, size: int) -> Iterator[list]:
    rows = iter(rows)
    while some := list(islice(rows, size)):
        yield some


def read_runs(spark: SparkSession, path: str, parts: int) -> DataFrame:
    """Return per run of documents with one id in a shard: doc_id, mark, shard, offset, size, place (ids before it in the shard), n_tokens, documents.

    mark is a hash of the id, null too. Shards are read a piece at a time.
    """

    def runs(shard: int) -> Iterator[list]:
        held, run, place = files(path), None, 0
        for at, key, ids, n, width in records(lambda a, size: held.read(shard, a, size), 0, held.size(shard)):
            if run and run[0] == key:
                run[3], run[5], run[6] = ids + n * width - run[2], run[5] + n, run[6] + 1
            else:
                if run:
                    yield run
                run = [key, shard, at, ids + n * width - at, place, n, 1]
            place += n
        if run:
            yield run

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                for some in _batched(runs(shard), 1 << 14):
                    keys, *rest = (pa.array(x, pa.int64()) for x in zip(*some, strict=True))
                    yield pa.RecordBatch.from_arrays([keys, pa.array(marks(keys)), *rest], ["doc_id", "mark", "shard", "offset", "size", "place", "n_tokens", "documents"])

    shards = spark.range(0, parts, 1, parts)
    return shards.mapInArrow(opened, "doc_id bigint, mark bigint, shard bigint, offset bigint, size bigint, place bigint, n_tokens bigint, documents bigint")


# Index


def key_codes(keys: np.ndarray, null: np.ndarray, part: np.ndarray) -> np.ndarray:
    """What the hash is of: a key's value in its first shard, and a hash for null and for the shards after."""
    codes = np.where(null, np.uint64(0xE7037ED1A0B428DB), keys.view(np.uint64))
    more = mix(codes + part.astype(np.uint64) * np.uint64(0xA0761D6478BD642F | 1))
    return np.where(part > 0, more, codes)


def _hash(codes: np.ndarray, level: int) -> np.ndarray:
    return mix(codes ^ mix(np.uint64([level * 2 + 1])))


def fingerprint(codes: np.ndarray) -> np.ndarray:
    """32 bits of a code's hash that no level uses."""
    return (_hash(codes, 1 << 20) >> np.uint64(32)).astype(np.uint32)


def build_mph(codes: np.ndarray) -> list[np.ndarray]:
    """The bit array of each level, for distinct codes."""
    levels: list[np.ndarray] = []
    while len(codes):
        if len(levels) > 200:  # even two keys part at a level with a chance of more than a half
            raise ValueError("equal codes")
        size = max(64, int(GAMMA * len(codes)))
        at = (_hash(codes, len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        codes = codes[~alone[at]]
    return levels


def find_slots(levels: list[np.ndarray], codes: np.ndarray) -> np.ndarray:
    """The slot of each code, -1 for one that no level has."""
    slots, left, base = np.full(len(codes), -1, np.int64), np.arange(len(codes)), 0
    for level, bits in enumerate(levels):
        rank = np.cumsum(bits) - 1
        at = (_hash(codes[left], level) % np.uint64(len(bits))).astype(np.int64)
        hit = bits[at]
        slots[left[hit]] = base + rank[at[hit]]
        left, base = left[~hit], base + int(rank[-1]) + 1
    return slots


def pack_bucket(codes: np.ndarray, *places: np.ndarray) -> bytes:
    """A bucket's hash and slots; places are the columns of _PLACE."""
    levels = build_mph(codes)
    slots = find_slots(levels, codes)
    columns = []
    for values, kind in zip((fingerprint(codes), *places), _SLOT, strict=True):
        placed = np.zeros(len(codes), kind)
        placed[slots] = values
        columns.append(placed.tobytes())
    head = _INDEX.pack(b"RGMP", len(codes), len(levels)) + np.array([len(x) for x in levels], "<u4").tobytes()
    return b"".join([head, *(np.packbits(x).tobytes() for x in levels), *columns])


def pack_file(buckets: int, packed: list[bytes]) -> bytes:
    """An index file of consecutive buckets, of so many in the store; an empty one has no bytes."""
    sizes = np.array([len(x) for x in packed], np.uint64)
    offsets = np.cumsum(sizes) - sizes + np.uint64(_FILE.size + 16 * len(packed))
    return b"".join([_FILE.pack(b"RGIX", buckets, len(packed)), np.stack([offsets, sizes], axis=1).astype("<u8").tobytes(), *packed])


class Bucket:
    """A bucket, opened."""

    def __init__(self, data: bytes):
        magic, n, count = _INDEX.unpack_from(data)
        if magic != b"RGMP":
            raise ValueError("no bucket")
        at = _INDEX.size
        sizes, at = np.frombuffer(data, "<u4", count, at), at + 4 * count
        self.levels = []
        for size in sizes.tolist():
            packed = np.frombuffer(data, np.uint8, -(-size // 8), at)
            self.levels.append(np.unpackbits(packed, count=size).astype(bool))
            at += len(packed)
        self.columns = []
        for kind in _SLOT:
            self.columns.append(np.frombuffer(data, kind, n, at))
            at += self.columns[-1].nbytes

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """(whether found, the columns of _PLACE); a code that isn't there passes with a chance of 2**-32."""
        slots = find_slots(self.levels, codes)
        prints, *places = (x[slots] if len(x) else np.zeros(len(codes), x.dtype) for x in self.columns)
        return (slots >= 0) & (prints == fingerprint(codes)), {c: x.astype(np.int64) for c, x in zip(_PLACE, places, strict=True)}


class Index:
    """An index folder; the bucket that was read last is kept."""

    def __init__(self, path: str):
        self.files, self.last, self.bucket = files(path), -1, None
        first = min(self.files.found, default=None)
        self.buckets = 0 if first is None else _FILE.unpack(self.files.read(first, 0, _FILE.size))[1]

    def open(self, number: int) -> Bucket | None:
        """A bucket; None if no key is in it."""
        if number != self.last:
            self.last, self.bucket, file = number, None, number // FILE_BUCKETS
            if self.files.size(file):
                head = _FILE.size + 16 * (number % FILE_BUCKETS)
                offset, size = struct.unpack("<QQ", self.files.read(file, head, 16))
                self.bucket = Bucket(self.files.read(file, offset, size)) if size else None
        return self.bucket

    def places(self, number: int, keys: pa.Array) -> dict[str, np.ndarray]:
        """at (which of keys) and _PLACE of the shards that have keys, all of one bucket."""
        out: list[dict[str, np.ndarray]] = []
        known, null = _known(keys)
        at, part, bucket = np.arange(len(keys)), 0, self.open(number)
        while bucket and len(at):
            hit, found = bucket.find(key_codes(known[at], null[at], np.full(len(at), part)))
            found["at"] = at
            out.append({c: x[hit] for c, x in found.items()})
            part += 1
            at = out[-1]["at"][out[-1]["parts"] > part]
        return {c: np.concatenate([np.zeros(0, np.int64), *(x[c] for x in out)]) for c in ("at", *_PLACE)}


def write_index(runs: DataFrame, path: str) -> int:
    """Index read_runs()'s runs by id, null too; return the number of buckets. A group of buckets is built in one task."""
    buckets = max(1, -(-runs.count() // BUCKET_KEYS))
    shards = runs.groupBy("shard").agg(F.sum("n_tokens").alias("ids"))
    bases = running_total(shards, "shard", "ids", "base").select(F.col("shard").alias("base_shard"), "base")
    entries = runs.join(bases, F.col("shard") == F.col("base_shard")).withColumn("start", F.col("base") + F.col("place"))
    entries = entries.withColumn("bucket", F.col("mark") % buckets).withColumn("file", F.floor(F.col("bucket") / FILE_BUCKETS))

    def built(group: pa.Table) -> pa.Table:
        file = group.column("file")[0].as_py()
        keys, null = _known(group.column("doc_id").combine_chunks())
        columns = {c: group.column(c).to_numpy() for c in ("bucket", "shard", "offset", "size", "start", "documents")}
        order = np.lexsort((columns["shard"], keys, null, columns["bucket"]))
        keys, null, columns = keys[order], null[order], {c: x[order] for c, x in columns.items()}
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (null[1:] != null[:-1])
        run = np.cumsum(new) - 1
        part, columns["parts"] = np.arange(len(keys)) - np.flatnonzero(new)[run], np.bincount(run)[run]
        codes = key_codes(keys, null, part)
        many = min(FILE_BUCKETS, buckets - file * FILE_BUCKETS)
        ends = np.searchsorted(columns["bucket"], file * FILE_BUCKETS + np.arange(many + 1))
        packed = [pack_bucket(codes[a:b], *(columns[c][a:b] for c in _PLACE)) if a < b else b"" for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        return pa.table({"file": [file], "content": pa.array([pack_file(buckets, packed)], pa.binary())})

    packed = entries.select("doc_id", "file", "bucket", "shard", "offset", "size", "start", "documents").groupBy("file").applyInArrow(built, "file bigint, content binary")
    packed.select("file", F.col("content").cast("string")).write.partitionBy("file").text(path)
    return buckets


def lookup(keys: DataFrame, path: str) -> DataFrame:
    """Return doc_id and where its payloads are (_PLACE; a row for each shard that has it) for the keys of a store.

    keys has a doc_id column; a key counts once, null is the key of documents without an id, and a key that the store
    has not gives no row. A task reads the buckets of its keys only.
    """
    index = f"{qualified(keys.sparkSession, path)}/index"
    buckets = max(1, Index(index).buckets)

    def bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(marks(batch.column("doc_id")) % buckets), batch.column("doc_id")], ["bucket", "doc_id"])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = Index(index)
        for batch in batches:
            bucket = batch.column("bucket").to_numpy()
            edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)).tolist()
            for a, b in zip(edges, edges[1:], strict=False):
                asked = batch.column("doc_id").slice(a, b - a)
                places = opened.places(int(bucket[a]), asked)
                yield pa.RecordBatch.from_arrays([asked.take(pa.array(places["at"])), *(pa.array(places[c]) for c in _PLACE)], ["doc_id", *_PLACE])

    asked = keys.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    dealt = asked.mapInArrow(bucketed, "bucket bigint, doc_id bigint").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(trimmed(found), "doc_id bigint, " + ", ".join(f"{c} bigint" for c in _PLACE))


def payloads(held: Files, shard: int, places: list[tuple]) -> Iterator[tuple]:
    """(doc_id, start, ids as bytes, bytes of an id) of the documents at places (doc_id, offset, size, start) of a shard, by offset.

    Near places are read together, up to PIECE; a larger place is read a document at a time.
    """
    k = 0
    while k < len(places):
        low, high, first = places[k][1], places[k][1] + places[k][2], k
        k += 1
        while k < len(places) and places[k][1] - high <= NEAR and places[k][1] + places[k][2] - low <= PIECE:
            high, k = max(high, places[k][1] + places[k][2]), k + 1
        data = held.read(shard, low, high - low) if high - low <= PIECE else None

        def read(at: int, size: int, data=data, low=low) -> bytes:
            return held.read(shard, at, size) if data is None else data[at - low : at - low + size]

        for doc_id, offset, size, start in places[first:k]:
            for _, key, ids, n, width in records(read, offset, offset + size):
                if key != doc_id:  # a fingerprint that another key has
                    break
                yield doc_id, start, read(ids, n * width), width
                start += n


def read_tokens(keys: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Return per document of a store that a key finds: doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian
    unsigned 32-bit integers), and with_ids the ids.

    start counts the ids of all documents before it. Places come from the index, payloads are read there; all documents
    with one id come with it, and those without an id with a null key. An empty store or no keys give no rows.
    """
    path = qualified(keys.sparkSession, path)
    shards = f"{path}/shards"

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = files(shards)
        for batch in batches:
            shard, *rest = (batch.column(c).to_pylist() for c in ("shard", "doc_id", "offset", "size", "start"))
            rows = list(zip(*rest, strict=True))
            edges = [0, *(k for k in range(1, len(shard)) if shard[k] != shard[k - 1]), len(shard)]
            for a, b in zip(edges, edges[1:], strict=False):
                for some in _batched(payloads(held, shard[a], rows[a:b]) if a < b else (), 500):
                    wide = [np.frombuffer(raw, f"<u{width}").astype("<u4") for _, _, raw, width in some]
                    columns = [pa.array([x[0] for x in some], pa.int64()), pa.array([x[1] for x in some], pa.int64())]
                    columns += [pa.array([len(x) for x in wide], pa.int64()), pa.array([zlib.crc32(x) for x in wide], pa.int64())]
                    if with_ids:
                        columns.append(pa.array([x.astype(np.int64) for x in wide], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    found = lookup(keys, path).withColumn("region", F.floor(F.col("offset") / PIECE))
    dealt = found.repartition("shard", "region").sortWithinPartitions("shard", "offset")
    return dealt.mapInArrow(trimmed(fetched), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids)


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", special_as_text: bool = True) -> None:
    """Write a store: path/shards and path/index.

    A null text counts as empty; ids may be null or repeat; texts are encoded whole; other columns are not read,
    whatever their names. An empty table gives a store that finds nothing.
    """
    path = qualified(docs.sparkSession, path)
    parts = write_shards(docs, f"{path}/shards", vocabulary or vocabulary_path(), id_col=id_col, text_col=text_col, special_as_text=special_as_text)
    write_index(materialize(read_runs(docs.sparkSession, f"{path}/shards", parts), "token-runs"), f"{path}/index")


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents, index them, and read every one back by its key."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = scratch_path(spark, "token-store")
    write_tokens(docs, path, special_as_text=False)
    return read_tokens(docs.select("doc_id"), path)
