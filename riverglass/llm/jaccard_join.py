"""Operator 6, n-gram Jaccard join: a MinHash LSH forest finds candidates, exact sets of shingles decide.

Documents with equal sets of shingles are one class of copies, and one stands for all. Its signature is cut into TREES
paths of DEPTH values, each a path of a prefix trie. A trie is the sorted order of its paths: documents that share a
prefix stand next to one another. The prefix that must match starts at DEPTH values and is shortened until the recall,
measured on planted pairs at the threshold whose sets are as large as those of a sample of the table, reaches TARGET.
Documents under one trie node of that depth are candidates. A node is never paired out: its members are linked to its
first one, components of these links are cut into blocks, and two blocks that share a node are compared by their
sets. What leaves a comparison is a count of links and one edge a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import join_groups, materialize, pick, texts, trimmed, tune
from .components import components
from .exact_dedup import BITMAP_BITS, marked, repeated
from .wordhash import chunks, cut, mix

WORDS, THRESHOLD = 5, 0.8
TREES, DEPTH, TARGET = 24, 8, 0.998
#: Classes whose numbers of shingles the planted pairs take, those with the smallest hashes, and pairs for each.
SAMPLE, PLANTED = 256, 8
#: Sets up to FEW are signed by independent permutations, larger ones by one permutation cut into bins; from the
#: threshold's share of FEW on by both. Sets at the threshold differ by that share at most, so such a pair shares one way.
FEW = 960
#: Documents in a block of a component, and shingles of a block or compared by one call, about.
BLOCK, CALL = 512, 1 << 21
#: Shingles of a block compared at once.
COLUMNS = 4096
_VALUE = 4  # bytes of a path's value


def shingle_sets(data: np.ndarray, ends: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct hashes of the shingles of each text; a text of fewer words is one shingle, of none has none."""
    starts, _, hashes, _ = cut(data, ends)
    text = np.searchsorted(ends, starts, "right")
    first = np.searchsorted(text, np.arange(len(ends) + 1))
    rng = np.random.default_rng(words)
    by = rng.integers(1, 1 << 63, words, dtype=np.uint64) | np.uint64(1)
    padded = np.concatenate([hashes, np.zeros(words, np.uint64)])
    total = sum(padded[k : len(hashes) + k] * by[k] for k in range(words))
    total = mix(total) if len(hashes) else hashes
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(total[a : b - words + 1]))
        else:
            out.append(mix(np.array([(hashes[a:b] * by[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)])) if b > a else hashes[:0])
    return out


class Forest:
    """Signs sets of shingles: for each way of signing that a set's size asks for, TREES paths of DEPTH values."""

    def __init__(self, threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH):
        self.trees, self.depth, self.many = trees, depth, int(threshold * FEW)
        size = self.trees * self.depth
        rng = np.random.default_rng(811)
        self.times = rng.integers(1, 1 << 63, size, dtype=np.uint64) | np.uint64(1)
        self.plus = rng.integers(1, 1 << 63, size, dtype=np.uint64)

    def permuted(self, shingles: np.ndarray) -> np.ndarray:
        """The smallest value of each of independent permutations."""
        best = None
        for a in range(0, len(shingles), 512):
            low = (shingles[a : a + 512, None] * self.times + self.plus >> np.uint64(32)).min(axis=0)
            best = low if best is None else np.minimum(best, low)
        return best

    def binned(self, shingles: np.ndarray) -> np.ndarray:
        """The smallest value in each bin of one permutation; an empty bin takes the next one's."""
        size = len(self.times)
        value = np.sort(mix(shingles + self.plus[0]))
        bins = (value >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)
        at = np.searchsorted(bins, np.arange(size, dtype=np.uint64))
        there = np.zeros(size, bool)
        inside = at < len(value)
        there[inside] = bins[at[inside]] == np.flatnonzero(inside).astype(np.uint64)
        full = np.flatnonzero(there)
        source = full[np.searchsorted(full, np.arange(size)) % len(full)]
        return mix(value[at[source]] + ((np.arange(size) - source) % size).astype(np.uint64)) >> np.uint64(32)

    def paths(self, shingles: np.ndarray) -> tuple[np.ndarray | None, np.ndarray | None]:
        """The paths of a set by permutations and by bins, each (TREES, DEPTH), None for a way that it isn't signed by."""
        few = self.permuted(shingles) if 0 < len(shingles) <= FEW else None
        many = self.binned(shingles) if len(shingles) >= max(1, self.many) else None
        return tuple(None if x is None else x.astype("<u4").reshape(self.trees, self.depth) for x in (few, many))

    def matched(self, a: np.ndarray, b: np.ndarray) -> int:
        """The longest prefix that two sets share in a trie."""
        ways = [(x, y) for x, y in zip(self.paths(a), self.paths(b), strict=True) if x is not None and y is not None]
        return max((int(np.cumprod(x == y, axis=1).sum(axis=1).max()) for x, y in ways), default=0)


def planted_pair(n: int, threshold: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Two sets of n shingles whose similarity is the threshold or just above."""
    same = min(n, int(np.ceil(2 * n * threshold / (1 + threshold) - 1e-9)))
    whole = rng.integers(0, 1 << 63, 2 * n - same, dtype=np.uint64)
    return np.sort(whole[:n]), np.sort(whole[n - same :])


def measured_recall(forest: Forest, sizes: list[int], threshold: float, each: int = PLANTED) -> list[float]:
    """The share of planted pairs at the threshold that share a prefix of 0, 1, ... DEPTH values in a trie.

    Sets too small for a pair within 0.03 of the threshold are left out; where all are, sets of 100 stand for them.
    """
    rng = np.random.default_rng(97)
    near = [n for n in sizes if n and (k := int(np.ceil(2 * n * threshold / (1 + threshold) - 1e-9))) <= n and k / (2 * n - k) <= threshold + 0.03]
    found = np.array([forest.matched(*planted_pair(n, threshold, rng)) for n in near or [100] * SAMPLE for _ in range(each)])
    return [float((found >= d).mean()) for d in range(forest.depth + 1)]


def fitted_depth(recalls: list[float], target: float = TARGET) -> int:
    """The longest prefix, shortened from the whole path, whose measured recall is the target; one value at least."""
    depth = len(recalls) - 1
    while depth > 1 and recalls[depth] < target:
        depth -= 1
    return depth


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    second = mix(shingles ^ np.uint64(0x5851F42D4C957F2D))
    return np.array([shingles.sum(dtype=np.uint64) + np.uint64(len(shingles)), second.sum(dtype=np.uint64)]).tobytes()


def _sketch(docs: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """(doc_id, mark, key, slot, shingles, few, many) of every document; mark is a hash of the text, few and many its paths."""
    rows = texts(docs, id_col, text_col).withColumn("mark", F.xxhash64("text"))

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest(threshold)
        for batch in batches:
            sets = [x for _, _, data, ends in chunks(batch.column("text")) for x in shingle_sets(data, ends)]
            keys = [set_key(x) for x in sets]
            slots = np.array([int.from_bytes(k[:8], "little") % BITMAP_BITS for k in keys], np.int64)
            signed = [[None if y is None else y.tobytes() for y in forest.paths(x)] for x in sets]
            columns = [pa.array(keys, pa.binary()), pa.array(slots), pa.array([len(x) for x in sets], pa.int64()), *(pa.array([x[k] for x in signed], pa.binary()) for k in (0, 1))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), *columns], ["doc_id", "mark", "key", "slot", "shingles", "few", "many"])

    return rows.mapInArrow(trimmed(sketched), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, mark bigint, key binary, slot bigint, shingles bigint, few binary, many binary")


def _sets(docs: DataFrame, text_col: str, wanted: DataFrame) -> DataFrame:
    """(key, set) of the documents whose slot is among wanted (slot): a bitmap of fixed size selects them."""
    words = wanted.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits")).collect()
    bitmap = np.zeros(BITMAP_BITS // 64, np.int64)
    for word, bits in words:
        bitmap[word] = bits
    shared = docs.sparkSession.sparkContext.broadcast(bitmap.tobytes())

    def selected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint64)
        for batch in batches:
            keys, sets = [], []
            for _, _, data, ends in chunks(batch.column("text")):
                for x in shingle_sets(data, ends):
                    key = set_key(x)
                    slot = int.from_bytes(key[:8], "little") % BITMAP_BITS
                    if int(bits[slot >> 6]) >> (slot & 63) & 1:
                        keys.append(key)
                        sets.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], ["key", "set"])

    rows = pick(docs, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    return rows.mapInArrow(trimmed(selected), "key binary, set binary").groupBy("key").agg(F.first("set").alias("set"))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of all pairs of sets."""
    size = len(sets)
    shingle = np.concatenate(sets)
    owner = np.repeat(np.arange(size), [len(x) for x in sets])
    order = np.argsort(shingle, kind="stable")
    shingle, owner = shingle[order], owner[order]
    new = np.ones(len(shingle), bool)
    new[1:] = shingle[1:] != shingle[:-1]
    number = np.cumsum(new) - 1
    often = np.bincount(number)[number] > 1  # a shingle of one set is in no intersection
    number, owner = number[often], owner[often]
    if len(number):
        number = np.cumsum(np.concatenate([[True], number[1:] != number[:-1]])) - 1
    out = np.zeros((size, size), np.float64)
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        a, b = np.searchsorted(number, [low, low + COLUMNS])
        has = np.zeros((size, COLUMNS), np.float32)
        has[owner[a:b], number[a:b] - low] = 1
        out += has @ has.T
    return out


def _roots(links: np.ndarray) -> np.ndarray:
    """The smallest index that links lead to from each index."""
    root = np.arange(len(links))
    while True:
        low = np.where(links, root, len(links)).min(axis=1, initial=len(links))
        low = np.minimum(root, low)
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _compare(threshold: float):
    def compared(group: pa.Table) -> pa.Table:
        """Links within the pairs of blocks in a group: key, weight of its links, smallest key that they lead to."""
        out_key, out_links, out_root = [], [], []
        parts: dict[tuple[bytes, int, int], list[int]] = {}
        for n, part in enumerate(zip(*(group.column(c).to_pylist() for c in ("component", "i", "j")), strict=True)):
            parts.setdefault(part, []).append(n)
        keys, raw, copies, block = (group.column(c) for c in ("key", "set", "copies", "block"))
        for (_, i, j), members in parts.items():
            members.sort(key=lambda n: keys[n].as_py())
            sets = [np.frombuffer(raw[n].as_py(), np.uint64) for n in members]
            both = overlaps(sets)
            sizes = np.array([len(x) for x in sets], np.float64)
            near = both >= threshold * (sizes[:, None] + sizes - both) - 1e-9
            np.fill_diagonal(near, False)
            if i != j:  # pairs within a block are compared once, where both blocks are that one
                side = np.array([block[n].as_py() for n in members])
                near &= side[:, None] != side
            weight = near @ np.array([copies[n].as_py() for n in members], np.float64)
            root = _roots(near)
            for k in np.flatnonzero(near.any(axis=1)).tolist():
                out_key.append(keys[members[k]].as_py())
                out_links.append(int(weight[k]))
                out_root.append(keys[members[root[k]]].as_py())
        return pa.table({"key": pa.array(out_key, pa.binary()), "links": pa.array(out_links, pa.int64()), "root": pa.array(out_root, pa.binary())})

    return compared


def _shared_paths(classes: DataFrame, depth: int) -> DataFrame:
    """(key, tree, path, node) of the paths whose prefix of depth values another class seems to have; node is its hash."""
    wide = DEPTH * _VALUE
    of = "transform(sequence(0, {last}), t -> struct(t + {first} AS tree, substring({way}, t * {wide} + 1, {wide}) AS path))"
    both = [F.expr(of.format(last=TREES - 1, first=first, way=way, wide=wide)) for first, way in ((0, "few"), (TREES, "many"))]
    paths = classes.select("key", F.explode(F.concat(*both)).alias("x")).where("x.path is not null").select("key", "x.tree", "x.path")
    paths = paths.withColumn("node", F.xxhash64("tree", F.substring("path", 1, depth * _VALUE)))
    return marked(paths, F.col("node"), repeated(paths, F.col("node")), "again").where("again").select("key", "tree", "path", "node")


def _neighbours(depth: int):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows in a trie's order, an edge from the first under a node to each other; and the task's first and last row."""
        names = ["a", "b", "part", "last", "tree", "path"]
        part, head, before = TaskContext.get().partitionId(), None, None

        def end(key: pa.Array, last: bool, tree: pa.Array, path: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([key, pa.nulls(1, pa.binary()), pa.array([part], pa.int32()), pa.array([last]), tree, path], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            tree, path, key = (batch.column(c) for c in ("tree", "path", "key"))
            if before is None:
                yield end(key.slice(0, 1), False, tree.slice(0, 1), path.slice(0, 1))
                before, head = (tree.slice(0, 1), path.slice(0, 1)), key.slice(0, 1)
            trees = np.concatenate([before[0].to_numpy(), tree.to_numpy()])
            raw = b"".join([*before[1].to_pylist(), *path.to_pylist()])
            prefix = np.frombuffer(raw, np.uint8).reshape(len(trees), -1)[:, : depth * _VALUE]
            same = (trees[1:] == trees[:-1]) & (prefix[1:] == prefix[:-1]).all(axis=1)
            # of each row, where the first under its node stands: 0 is the one carried on from before
            first = np.maximum.accumulate(np.where(same, 0, np.arange(1, len(trees))))
            heads = pa.concat_arrays([head, key])
            at = np.flatnonzero(same)
            none = [pa.nulls(len(at), t) for t in (pa.int32(), pa.bool_(), tree.type, pa.binary())]
            yield pa.RecordBatch.from_arrays([heads.take(pa.array(first[at])), key.take(pa.array(at)), *none], names)
            before, head = (tree.slice(len(tree) - 1), path.slice(len(path) - 1)), heads.slice(int(first[-1]), 1)
        if before is not None:
            yield end(head, True, *before)

    return linked


def _trie_links(shared: DataFrame, depth: int) -> DataFrame:
    """Edges (a, b) that connect the classes under each node of each trie.

    The tries are all paths in one sorted order, dealt over tasks by ranges; a node that goes on in the next task is
    linked by the tasks' last and first rows, two a task.
    """
    parts = int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["tree", "path", "key"]
    tries = shared.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    found = materialize(tries.mapInArrow(trimmed(_neighbours(depth)), "a binary, b binary, part int, last boolean, tree int, path binary"), "trie-links")
    after = Window.orderBy("part", "last")
    prefix = F.substring("path", 1, depth * _VALUE)
    ends = found.where("part is not null").select("a", "part", "last", "tree", prefix.alias("prefix"))
    ends = ends.select("a", F.lag("a").over(after).alias("b"), ((F.lag("tree").over(after) == F.col("tree")) & (F.lag("prefix").over(after) == F.col("prefix"))).alias("same"))
    return found.where("part is null").select("a", "b").unionByName(ends.where("same").select("a", "b"))


def _blocks(found: DataFrame, shared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found with block; component, block, i, j of the pairs of blocks to compare) for found (key, root, shingles, blocks).

    A class is put into a block by the smallest of its nodes, so that classes under many common nodes meet in a block;
    such a home with more than BLOCK classes is split. Two blocks are compared if a node has classes in both.
    """
    homes = shared.groupBy("key").agg(F.min("node").alias("home")).withColumnRenamed("key", "home_key")
    found = found.join(homes, F.col("key") == F.col("home_key")).drop("home_key")
    homes = found.groupBy("root", "home").agg(F.count("*").alias("home_size"))
    found = join_groups(found, homes, ["root", "home"], "home_size", found.count())
    split = F.pmod(F.xxhash64("key"), F.ceil(F.col("home_size") / BLOCK))
    found = materialize(found.withColumn("block", F.pmod(F.xxhash64("home", split), F.col("blocks")).cast("int")).drop("home", "home_size"), "blocks")
    under = shared.select(F.col("key").alias("node_key"), "node").join(found.select("key", "root", "block"), F.col("node_key") == F.col("key"))
    under = under.select("node", "root", "block").distinct().groupBy("node", "root").agg(F.array_sort(F.collect_set("block")).alias("all"))
    pairs = under.select("root", F.explode("all").alias("i"), "all").select("root", "i", F.explode(F.expr("filter(all, x -> x >= i)")).alias("j")).distinct()
    either = F.explode(F.when(F.col("i") == F.col("j"), F.array("i")).otherwise(F.array("i", "j")))
    return found, materialize(pairs.select(F.col("root").alias("component"), either.alias("of"), "i", "j"), "block-pairs")


def _compared(docs: DataFrame, text_col: str, found: DataFrame, shared: DataFrame, threshold: float) -> DataFrame:
    """(key, links, root) of candidates found (key, root, members, weight, slot, copies, shingles) by their exact sets."""
    found = found.withColumn("blocks", F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("weight") / CALL)))
    alone, cut = found.where("blocks = 1"), found.where("blocks > 1")
    one = F.lit(0).cast("int")
    parts = alone.select("key", "slot", "copies", "shingles", F.col("root").alias("component"), one.alias("block"), one.alias("i"), one.alias("j"))
    if cut.head(1):
        cut, pairs = _blocks(cut, shared)
        several = cut.join(pairs, (F.col("root") == F.col("component")) & (F.col("block") == F.col("of")))
        parts = parts.unionByName(several.select("key", "slot", "copies", "shingles", "component", "block", "i", "j"))
    parts = materialize(parts, "compare")
    calls = int(parts.agg(F.coalesce(F.sum("shingles"), F.lit(0))).first()[0]) // CALL + 1
    sets = _sets(docs, text_col, found.select("slot")).withColumnRenamed("key", "set_key")
    dealt = parts.join(sets, F.col("key") == F.col("set_key")).withColumn("call", F.pmod(F.xxhash64("component", "i", "j"), F.lit(calls)))
    dealt = dealt.select("key", "set", "copies", "block", "component", "i", "j", "call")
    return dealt.groupBy("call").applyInArrow(_compare(threshold), "key binary, links bigint, root binary")


def forest_depth(classes: DataFrame, threshold: float) -> int:
    """The depth at which the table's tries are matched, by the sizes of SAMPLE classes."""
    sizes = classes.where("shingles > 0").orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("shingles").collect()
    return fitted_depth(measured_recall(Forest(threshold), [r[0] for r in sizes], threshold))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Return per row of docs: doc_id, class_id, class_size, n_links, mark, stays.

    Two documents are linked when their sets of shingles of WORDS words (A-Z as a-z) have a Jaccard similarity of
    threshold or more; classes are what links connect, class_id is their smallest doc_id, class_size and n_links
    count documents. The document with the smallest id of a class stays, of rows with that id the one with the smallest
    mark, a hash of the text (rows that repeat both are marked alike). A text of fewer words is one shingle; texts without words (null and empty ones too) are copies
    of one another. Rows that repeat an id are documents of their own; null ids are larger than any. An empty table
    gives an empty one; other columns are not read; texts are read whole. A class may hold any share of the rows.
    """
    tune(docs.sparkSession)
    rows = materialize(_sketch(docs, id_col, text_col, threshold), "sketch")
    total = rows.count()
    one = [F.first(c).alias(c) for c in ("shingles", "few", "many")]
    classes = rows.groupBy("key", "slot").agg(*one, F.count("*").alias("copies"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("first"))
    classes = materialize(classes, "copies")
    depth = forest_depth(classes, threshold)
    shared = materialize(_shared_paths(classes, depth), "shared-paths")
    roots = components(_trie_links(shared, depth))
    members = roots.join(classes.select(F.col("key").alias("class_key"), "slot", "copies", "shingles"), F.col("key") == F.col("class_key")).drop("class_key")
    sizes = members.groupBy("root").agg(F.count("*").alias("members"), F.sum("shingles").alias("weight"))
    found = materialize(join_groups(members, sizes, ["root"], "members", classes.count()), "candidates")
    linked = _compared(docs, text_col, found, shared, threshold)
    linked = materialize(linked, "links")
    roots = components(linked.select(F.col("key").alias("a"), F.col("root").alias("b"))).withColumnRenamed("key", "linked_key")
    links = linked.groupBy(F.col("key").alias("links_key")).agg(F.sum("links").alias("links"))
    known = classes.select("key", "copies", "first").join(links, F.col("key") == F.col("links_key"), "left").join(roots, F.col("key") == F.col("linked_key"), "left")
    known = known.select("key", "copies", "first", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "key").alias("root"))
    known = materialize(known, "classes")
    groups = known.groupBy("root").agg(F.min("first").alias("head"), F.sum("copies").alias("class_size"), F.count("*").alias("keys"))
    known = join_groups(known, groups, ["root"], "keys", total)
    known = known.select("key", "copies", "head", "class_size", (F.col("copies") - 1 + F.col("links")).alias("n_links"))
    found = join_groups(rows.select("doc_id", "mark", "key"), known, ["key"], "copies", total)
    stays = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("mark") == F.col("head.mark"))
    return found.select("doc_id", F.col("head.doc_id").alias("class_id"), "class_size", "n_links", "mark", stays.alias("stays"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row of docs for each class, with all columns as they are, clashing names too; of rows equal in id and text any one.

    jaccard_join() says which documents are a class (null, empty and wordless texts are one) and which one stays; a
    null id stays only where a class has no other. Rows with one id and different texts are told apart by a 64-bit
    hash of the text. An empty table gives an empty one.
    """
    names = docs.columns
    id_at, text_at = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    kept = jaccard_join(docs, id_col, text_col, threshold).where("stays").select("doc_id", "mark").distinct()
    there = plain.withColumn("own", F.xxhash64(F.coalesce(text_at, F.lit(""))))
    there = there.join(kept, F.col(id_at).eqNullSafe(F.col("doc_id")) & (F.col("own") == F.col("mark")), "left_semi")
    return there.dropDuplicates([id_at, "own"]).select(*plain.columns).toDF(*names)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class and number of links of every document."""
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("mark", "stays")
