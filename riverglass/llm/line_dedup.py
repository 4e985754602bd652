"""Operator 4, line dedup: later documents are aligned with all overlapping earlier ones, and common blocks go.

A block can go only where an earlier document has one of its shortest runs of enough words. Both then have the run's
rarest line, the one that the fewest lines equal, so documents are found through the hashes of these rare lines. A
document is aligned with the first holders of its rare lines first, which settles most; where lines of a run are left,
it is aligned with every other earlier holder of the run's rare line. Documents with the same lines in the same places
count as one, and holders that are the same in the lines that matter are aligned once. A pair is aligned by patience
diff: lines that occur once in both, in the longest run that rises in both, anchor it, and the gaps between anchors
are aligned the same way; a gap without such lines is aligned by a longest common subsequence.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, join_groups, let, materialize, pick, trimmed, tune
from .exact_dedup import BITMAP_BITS, bitmap, marked

#: Words that an aligned block must have to be deleted.
MIN_WORDS = 5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Documents of a run compared by one call, about, and their bytes of lines; so for its holders. More are cut into blocks.
BLOCK, BLOCK_BYTES = 512, 4 << 20
#: Slots in which lines are counted; a line's count is the largest in its slot. Equal lines have equal counts, so a
#: shared slot can make a line look less rare, but in all documents alike.
RARITY_SLOTS = 1 << 17
#: A line that occurs again: place, raw number, words, hash, count.
_LINE = struct.Struct("<iii16si")


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by their first, whose second rises."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, y) in enumerate(pairs):
        place = bisect_left(tops, y)
        back.append(at[place - 1] if place else -1)
        if place == len(tops):
            tops.append(y)
            at.append(k)
        else:
            tops[place], at[place] = y, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _longest(a: list, b: list) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence: rows of its table are bits, a zero where a row's length grows."""
    at: dict = {}
    for k, x in enumerate(b):
        at[x] = at.get(x, 0) | 1 << k
    whole = (1 << len(b)) - 1
    row, rows = whole, []
    for x in a:
        hit = row & at.get(x, 0)
        row = (row + hit | row - hit) & whole
        rows.append(row)
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if not i or rows[i - 1] >> (j - 1) & 1:
            j -= 1
            out.append((i, j))
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Index pairs of equal items, rising in both lists."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        i, m, j, n = gaps.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        in_a, in_b = Counter(a[i:m]), Counter(b[j:n])
        place = {x: k for k, x in enumerate(b[j:n], j) if in_b[x] == 1}
        anchors = _rising([(k, place[x]) for k, x in enumerate(a[i:m], i) if in_a[x] == 1 and x in place])
        if not anchors:
            out += [(i + p, j + q) for p, q in _longest(a[i:m], b[j:n])]
            continue
        for (p, q), (r, s) in zip([(i - 1, j - 1), *anchors], [*anchors, (m, n)], strict=True):
            gaps.append((p + 1, r, q + 1, s))
        out += anchors
    return sorted(out)


def common_blocks(a: list[tuple[int, bytes]], b: list[tuple[int, bytes]]) -> list[list[tuple[int, bytes]]]:
    """Runs of lines of b, as (place, line), that follow one another in both documents and are aligned."""
    blocks: list[list[tuple[int, bytes]]] = []
    before = None
    for i, j in patience([x for _, x in a], [x for _, x in b]):
        if before == (a[i][0] - 1, b[j][0] - 1):
            blocks[-1].append(b[j])
        else:
            blocks.append([b[j]])
        before = a[i][0], b[j][0]
    return blocks


def _pack(lines: list[tuple[int, int, int, bytes, int]]) -> bytes:
    return b"".join(_LINE.pack(*x) for x in lines)


def _unpack(held: bytes) -> list[tuple[int, int, int, bytes, int]]:
    """(place, raw, words, line, count) of each line."""
    return list(_LINE.iter_unpack(held))


def deleted(a: list[tuple], b: list[tuple], min_words: int) -> set[int]:
    """The raw numbers of b's lines in aligned common blocks of min_words words or more; both as _unpack() gives them."""
    both = {x[3] for x in a} & {x[3] for x in b}
    raw, size = {x[0]: x[1] for x in b}, {x[3]: x[2] for x in b}
    gone: set[int] = set()
    for block in common_blocks([(x[0], x[3]) for x in a if x[3] in both], [(x[0], x[3]) for x in b if x[3] in both]):
        if sum(size[x] for _, x in block) >= min_words:
            gone.update(raw[p] for p, _ in block)
    return gone


def windows(lines: list[tuple], min_words: int) -> set[tuple[int, int]]:
    """First and last (inclusive) of the shortest runs of consecutive lines with min_words words, from each line on and back.

    A run with as many words is the union of those within it.
    """
    out: set[tuple[int, int]] = set()
    for step in (1, -1):
        for start in range(len(lines)):
            end, words = start, lines[start][2]
            while words < min_words:
                end += step
                if not 0 <= end < len(lines) or lines[end][0] != lines[end - step][0] + step:
                    break
                words += lines[end][2]
            else:
                out.add((min(start, end), max(start, end)))
    return out


def rare_line(lines: list[tuple]) -> int:
    """The hash of a run's rarest line, the same for equal runs."""
    line = min((x[4], x[3]) for x in lines)[1]
    return int.from_bytes(line[:8], "little", signed=True)


def _each(rows: DataFrame, found: Callable[[dict], list], schema: str, kinds: list[pa.DataType]) -> DataFrame:
    """doc_id and mark with each of found(row), a list of tuples of further columns."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = [], []
            columns = {c: batch.column(c).to_pylist() for c in batch.schema.names if c != "doc_id"}
            for n in range(batch.num_rows):
                for x in found({c: v[n] for c, v in columns.items()}):
                    at.append(n)
                    out.append(x)
            at = pa.array(at, pa.int64())
            more = [pa.array([x[k] for x in out], t) for k, t in enumerate(kinds)]
            names = ["doc_id", "mark", *(c.split()[0] for c in schema.split(", "))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("mark").take(at), *more], names)

    return rows.mapInArrow(trimmed(run), f"doc_id {kind}, mark bigint, {schema}")


def _lines(rows: DataFrame) -> DataFrame:
    """(doc_id, mark, place, raw, text) of every line that isn't blank; places leave out blank lines, raw doesn't."""
    numbered = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("raw"), F.trim(x).alias("text")))
    there = rows.select("doc_id", "mark", F.posexplode(F.filter(numbered, lambda x: x["text"] != "")).alias("place", "x"))
    return there.select("doc_id", "mark", "place", "x.raw", ascii_lower("x.text").alias("text"))


def held_lines(rows: DataFrame) -> DataFrame:
    """(doc_id, mark, held, content) of documents with lines that occur again; equal contents have the same lines in the same places."""
    lines = _lines(rows).withColumn("hash", F.xxhash64("text"))
    counts = materialize(lines.groupBy(F.col("hash").alias("key")).agg(F.count("*").alias("n")).where("n > 1"), "line-counts")
    slot = F.pmod("key", F.lit(RARITY_SLOTS)).cast("int")
    rarity = counts.groupBy(slot.alias("rarity_slot")).agg(F.least(F.max("n"), F.lit(2**31 - 1)).cast("int").alias("seen"))
    again = marked(lines, F.col("hash"), bitmap(counts), "again").where("again").withColumn("key", F.col("hash"))
    again = again.join(F.broadcast(rarity), slot == F.col("rarity_slot"), "left").withColumn("seen", F.coalesce("seen", F.lit(1)))
    again = again.select("doc_id", "mark", F.struct("place", "raw", F.regexp_count("text", F.lit(WORD)).alias("words"), F.unhex(F.md5("text")).alias("line"), "seen").alias("x"))
    held = again.groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set("x")).alias("lines"))

    def packed(row: dict) -> list[tuple]:
        lines = [(x["place"], x["raw"], x["words"], x["line"], x["seen"]) for x in row["lines"]]
        return [(_pack(lines), hashlib.md5(_pack([(x[0], 0, 0, x[3], 0) for x in lines])).digest())]

    return _each(held, packed, "held binary, content binary", [pa.binary(), pa.binary()])


def _same(a: str, b: str) -> Column:
    """Whether (doc_id, mark) of two aliased tables are equal."""
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.mark") == F.col(f"{b}.mark"))


def _is(first: str) -> Column:
    return F.col("doc_id").eqNullSafe(F.col(f"{first}.doc_id")) & (F.col("mark") == F.col(f"{first}.mark"))


def _with_held(rows: DataFrame, held: DataFrame) -> DataFrame:
    return rows.alias("a").join(held.alias("b"), _same("a", "b")).select("a.*", "b.held")


def deleted_lines(rows: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, mark, gone) of documents that lose lines, as numbers of raw lines."""
    held = materialize(held_lines(rows), "held-lines")
    one = F.min(F.struct("doc_id", "mark")).alias("first")
    contents = held.groupBy("content").agg(one, F.count("*").alias("holders"))
    held = join_groups(held, contents, ["content"], "holders", held.count())
    # a later document with the same content loses all that it could lose to any
    copies = _each(held.where(~_is("first")).select("doc_id", "mark", "held"), lambda r: [(sorted(deleted(b := _unpack(r["held"]), b, min_words)),)], "gone array<int>", [pa.list_(pa.int32())])
    held = materialize(held.where(_is("first")).select("doc_id", "mark", "held"), "first-contents")

    def cut(row: dict) -> list[tuple]:
        lines = _unpack(row["held"])
        return [(rare_line(lines[s : e + 1]), [x[1] for x in lines[s : e + 1]]) for s, e in windows(lines, min_words)]

    runs = materialize(_each(held, cut, "key bigint, raws array<int>", [pa.int64(), pa.list_(pa.int32())]), "line-runs")
    total = runs.count()
    firsts = runs.groupBy("key").agg(one, F.count("*").alias("holders")).where("holders > 1")
    later = materialize(join_groups(runs, firsts, ["key"], "holders", total).where(F.col("first").isNotNull() & ~_is("first")), "later-runs")

    def aligned(row: dict) -> list[tuple]:
        gone = deleted(_unpack(row["first_held"]), _unpack(row["held"]), min_words)
        return [(sorted(gone),)] if gone else []

    def align(pairs: DataFrame) -> DataFrame:
        return _each(pairs.select("doc_id", "mark", "held", "first_held"), aligned, "gone array<int>", [pa.list_(pa.int32())])

    # first each document with the first holders of its runs' rare lines
    pairs = later.select("doc_id", "mark", F.col("first.doc_id").alias("first_id"), F.col("first.mark").alias("first_mark")).distinct()
    pairs = materialize(pairs, "line-pairs")
    sizes = pairs.groupBy(F.col("first_id").alias("doc_id"), F.col("first_mark").alias("mark")).agg(F.count("*").alias("size"))
    groups = _with_held(sizes, held).toDF("first_id", "first_mark", "size", "first_held")
    gone = align(_with_held(join_groups(pairs, groups, ["first_id", "first_mark"], "size", pairs.count()), held))
    gone = materialize(_union(gone), "gone-lines")
    # then those with a run left with every other earlier holder of its rare line
    there = later.alias("a").join(gone.alias("b"), _same("a", "b"), "left").select("a.*", "b.gone")
    raws = F.array_except("raws", F.coalesce("gone", F.expr("cast(array() as array<int>)"))).alias("raws")
    left = materialize(there.select("doc_id", "mark", "key", raws).where(F.size("raws") > 0).distinct(), "left-runs")
    return _union(gone.unionByName(copies).unionByName(_others(left, runs, firsts, held, total, min_words)))


def _union(gone: DataFrame) -> DataFrame:
    return gone.groupBy("doc_id", "mark").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))


def _order(doc_id: object, mark: int) -> tuple:
    return (False, mark) if doc_id is None else (True, doc_id, mark)


def _settle(min_words: int):
    def settled(asking: pa.Table, forms: pa.Table) -> pa.Table:
        """The lines of each run left that go by one of the run's earlier holders, those with the fewest lines first."""
        found = [(_order(x["doc_id"], x["mark"]), _unpack(f)) for f, x in zip(forms.column("form").to_pylist(), forms.column("first").to_pylist(), strict=True)]
        found.sort(key=lambda x: len(x[1]))
        out = []
        for doc, mark, held, raws in zip(*(asking.column(c).to_pylist() for c in ("doc_id", "mark", "held", "raws")), strict=True):
            mine, own, gone = _order(doc, mark), _unpack(held), set()
            for first, lines in found:
                if first < mine:
                    gone |= deleted(lines, own, min_words)
                    if gone.issuperset(raws):
                        break
            out.append(sorted(gone))
        return pa.table({"doc_id": asking.column("doc_id"), "mark": asking.column("mark"), "gone": pa.array(out, pa.list_(pa.int32()))})

    return settled


def _others(left: DataFrame, runs: DataFrame, firsts: DataFrame, held: DataFrame, total: int, min_words: int) -> DataFrame:
    """(doc_id, mark, gone) by aligning documents of runs left with the runs' earlier holders, until a run is gone or has no more.

    Holders are cut down to the lines that documents with runs left have; of those that are the same then, the first counts.
    """
    asking = _with_held(left, held)
    slots = _each(asking, lambda r: [(s,) for s in {_slot_of(x[3]) for x in _unpack(r["held"])}], "slot int", [pa.int32()])
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, slot % 64)")).alias("bits")).collect()
    bitmap = np.zeros(BITMAP_BITS // 64, np.int64)
    for r in words:
        bitmap[r["word"]] = r["bits"]
    wanted = zlib.compress(bitmap.tobytes())

    def form(row: dict) -> list[tuple]:
        bits = _opened(wanted)
        out, place, last = [], 0, None
        for at, _, _, line, _ in _unpack(row["held"]):
            slot = _slot_of(line)
            if int(bits[slot >> 6]) >> (slot & 63) & 1:
                place += 1 if last is None or at == last + 1 else 2
                out.append((place, 0, 0, line, 0))
                last = at
        return [(_pack(out),)]

    groups = firsts.join(left.select("key").distinct(), "key").select("key", "holders")
    holders = join_groups(runs.select("doc_id", "mark", "key"), groups, ["key"], "holders", total).where("holders is not null").select("doc_id", "mark", "key").distinct()
    forms = _each(_with_held(holders.select("doc_id", "mark").distinct(), held), form, "form binary", [pa.binary()])
    forms = holders.alias("a").join(forms.alias("b"), _same("a", "b")).select("a.*", "b.form")
    forms = materialize(forms.groupBy("key", "form").agg(F.min(F.struct("doc_id", "mark")).alias("first")), "line-forms")
    asking = materialize(asking, "line-askers")
    # each block of a run's documents meets each block of its holders; most runs have one block of both
    askers, formed = _blocks(asking, "held", "ask"), _blocks(forms, "form", "form")
    counts = askers.join(formed, "key")
    asking = _dealt(asking, counts, F.xxhash64("doc_id", "mark", "raws"), "ask", "form")
    forms = _dealt(forms, counts, F.xxhash64("form"), "form", "ask")
    kind, by = left.schema["doc_id"].dataType.simpleString(), ["key", "ask_block", "form_block"]
    return asking.groupBy(*by).cogroup(forms.groupBy(*by)).applyInArrow(_settle(min_words), f"doc_id {kind}, mark bigint, gone array<int>")


def _blocks(rows: DataFrame, lines: str, side: str) -> DataFrame:
    """Per key the number of rows, side_rows, and of blocks that these are cut into, side_blocks."""
    found = rows.groupBy("key").agg(F.count("*").alias(f"{side}_rows"), F.sum(F.octet_length(lines)).alias("bytes"))
    blocks = F.greatest(F.ceil(F.col(f"{side}_rows") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES), F.lit(1))
    return found.select("key", f"{side}_rows", blocks.cast("int").alias(f"{side}_blocks"))


def _dealt(rows: DataFrame, counts: DataFrame, by: Column, side: str, other: str) -> DataFrame:
    """Rows with a block of their side, once for each block of the other one."""
    extra = [c for c in counts.columns if c != "key"]
    found = join_groups(rows, counts, ["key"], f"{side}_rows", rows.count()).where(F.col(f"{side}_blocks").isNotNull())
    found = found.withColumn(f"{side}_block", F.pmod(by, F.col(f"{side}_blocks")).cast("int"))
    return found.withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))).drop(*extra)


def _slot_of(line: bytes) -> int:
    return int.from_bytes(line[:4], "little") % BITMAP_BITS


@lru_cache(maxsize=1)
def _opened(bitmap: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(bitmap), np.int64)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, gone_col: str | None = None) -> DataFrame:
    """Return docs, all columns and rows, with aligned common blocks of min_words words or more deleted from later texts.

    The later of two documents is the one with the larger id (null ids come first, equal ids go by a hash of the
    text); rows equal in id and text are one document. Lines end at a line feed and are equal when they are after
    trimming spaces and lower-casing A-Z; blank lines are never deleted and don't part a block. What is left of a
    text keeps its lines as they are, and may be empty; a null text stays null; a text without a deleted line is
    unchanged. gone_col adds the numbers of the deleted lines. An empty table gives an empty one. Every line's first
    holder keeps it, and a line may be in any share of the documents.
    """
    tune(docs.sparkSession)
    names = docs.columns
    id_at, text_at = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    rows = pick(docs, doc_id=id_col, text=text_col).where("text is not null").select("doc_id", "text", F.xxhash64("text").alias("mark"))
    gone = materialize(deleted_lines(rows, min_words), "gone")
    # texts that lose nothing stay where they are; a bitmap of those that do tells them apart, but for false hits
    own = plain.withColumn("mark_of", F.xxhash64(text_at))
    own = marked(own, F.xxhash64(id_at, "mark_of"), bitmap(gone.select(F.xxhash64("doc_id", "mark").alias("key"))), "hit")
    none = F.expr("cast(array() as array<int>)")
    columns = [*plain.columns, "gone"]
    whole = own.where("not hit").select(*plain.columns, none.alias("gone"))
    cut = own.where("hit").join(gone, F.col(id_at).eqNullSafe(F.col("doc_id")) & (F.col("mark_of") == F.col("mark")), "left")
    text = F.when(F.col("gone").isNull() | F.col(text_at).isNull(), F.col(text_at)).otherwise(_without(F.split(text_at, "\n"), F.col("gone")))
    cut = cut.withColumn(text_at, text).withColumn("gone", F.coalesce("gone", none)).select(*columns)
    found = whole.unionByName(cut)
    return found.toDF(*names, gone_col) if gone_col else found.drop("gone").toDF(*names)


def _without(lines: Column, gone: Column) -> Column:
    def left(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    return let(lines, left)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup leaves of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = line_dedup(docs, gone_col="gone")
    return found.select("doc_id", F.size("gone").cast("long").alias("n_deleted"), F.array_join("gone", ",").alias("deleted"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
