"""Operator 8, SentencePiece encoding and decoding: an Aho-Corasick automaton drives a single-pass Viterbi.

The automaton reads a text once. At each position the state and its output links give all pieces that end there,
and each relaxes the best score of the paths that end with it. In a unigram model every path counts. In a model of
merges a path counts only where its last two pieces are what merging their joined text leaves. One path counts at
most then, so the first that does has the best score, the links after it need not be followed, and its ids are those
of the merges.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, trimmed, tune

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
UNIGRAM, MERGES = 1, 2
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6
#: Words that a process remembers, the first ones, among which are the frequent ones; and four times as many pairs.
CACHE = 120_000
#: Rows of an Arrow batch, and characters of the texts encoded together: the more words are sorted together, the more
#: their passes share, and the more memory they take.
ROWS, GROUP = 1000, 3 << 19
_UNSEEN = -1


def model_path(name: str = MODEL) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """A SentencePiece model with an identity normaliser, as an automaton over its pieces."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as f:
            model = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models with an identity normaliser are known")
        self._setup([(p.piece, p.score, p.type) for p in model.pieces], model.trainer_spec.model_type, model.normalizer_spec.add_dummy_prefix)

    def _setup(self, pieces: list[tuple[str, float, int]], kind: int, prefix: bool) -> None:
        self.kind, self.prefix = kind, prefix
        self.texts = [p for p, _, _ in pieces]
        self.scores = [s for _, s, _ in pieces]
        self.ids = {p: i for i, (p, _, t) in enumerate(pieces) if t in (_NORMAL, _USER)}
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(pieces) if t == _BYTE}
        self.unknown = next((i for i, (_, _, t) in enumerate(pieces) if t == _UNKNOWN), 0)
        self.unseen_score = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10
        surfaces = {_NORMAL: lambda p: p.replace(SPACE, " ").encode(), _USER: lambda p: p.replace(SPACE, " ").encode(), _BYTE: lambda p: bytes([int(p[3:5], 16)]), _UNKNOWN: lambda p: " ⁇ ".encode()}
        self.surfaces = [surfaces.get(t, lambda p: b"")(p) for p, _, t in pieces]
        self._automaton()
        # words end before a space, and where letters meet others, unless some piece goes on there
        cuts = [rf"{SPACE}*(?:[^\W\d_]+|[^\w\n{SPACE}]+|\n|[\d_]+)|{SPACE}+", rf"{SPACE}*[^{SPACE}]+|{SPACE}+"]
        self.cut = next((c for c in map(re.compile, cuts) if all(len(c.findall(p)) == 1 for p in self.ids)), re.compile(r"(?s).+"))
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}

    def _automaton(self) -> None:
        self.goto: list[dict[str, int]] = [{}]
        self.piece, self.length = [-1], [0]
        for text, i in self.ids.items():
            at = 0
            for c in text:
                step = self.goto[at].get(c)
                if step is None:
                    step = self.goto[at][c] = len(self.goto)
                    self.goto.append({})
                    self.piece.append(-1)
                    self.length.append(self.length[at] + 1)
                at = step
            self.piece[at] = i
        self.fail, self.output = [0] * len(self.goto), [0] * len(self.goto)
        queue = list(self.goto[0].values())
        for at in queue:
            for c, step in self.goto[at].items():
                back = self.fail[at]
                while back and c not in self.goto[back]:
                    back = self.fail[back]
                self.fail[step] = self.goto[back].get(c, 0)
                queue.append(step)
            back = self.fail[at]
            self.output[at] = back if self.piece[back] >= 0 else self.output[back]
        # the pieces that end at a state, longest first, along its output links; steps are filled as they are met
        self.ends: list[tuple[tuple[int, int], ...]] = [()]
        for state in range(1, len(self.goto)):
            found, at = [], state if self.piece[state] >= 0 else self.output[state]
            while at:
                found.append((self.length[at], self.piece[at]))
                at = self.output[at]
            self.ends.append(tuple(found))
        self.steps: list[dict[str, int]] = [{} for _ in self.goto]

    def merged(self, text: str) -> list[str]:
        """What is left when the best pair that forms a piece is merged, the first of equals, until none does."""
        parts = list(text)
        while True:
            found = [(-self.scores[self.ids[a + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.ids]
            if not found:
                return parts
            k = min(found)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def _fits(self, pair: int) -> bool:
        """Whether merging leaves these two pieces apart and whole; _UNSEEN, a character without a piece, never merges."""
        left, right = pair >> 32, pair & 0xFFFFFFFF
        want = [self.texts[i] for i in (left, right) if i != _UNSEEN]
        fits = all(self.merged(x) == [x] for x in want) if left == _UNSEEN else self.merged("".join(want)) == want
        if len(self.pairs) > 4 * CACHE:
            self.pairs.clear()
        self.pairs[pair] = fits
        return fits

    def _step(self, state: int, c: str) -> int:
        """The state after one more character, over failure links; remembered."""
        at = state
        while at and c not in self.goto[at]:
            at = self.fail[at]
        at = self.goto[at].get(c, 0)
        if at:
            self.steps[state][c] = at
        return at

    def paths(self, words: list[str]) -> Iterator[list[int]]:
        """The ids of each word (its spaces written as SPACE), by one pass over its characters.

        What the pass knows at a character depends on what comes before it alone, so where words are sorted a word
        takes up the pass at the end of what it shares with the word before.
        """
        merges, steps, ends, scores, pairs, known = self.kind == MERGES, self.steps, self.ends, self.scores, self.pairs, self.ids
        # at each place: the automaton's state, the best path's score (None: no path), last piece and its start
        states, best, last, came = [0], [0.0], [_UNSEEN], [0]
        shown = ""
        for word in words:
            same = 0
            for a, b in zip(word, shown, strict=False):
                if a != b:
                    break
                same += 1
            del states[same + 1 :], best[same + 1 :], last[same + 1 :], came[same + 1 :]
            shown, state = word, states[same]
            for i in range(same, len(word)):
                c = word[i]
                step = steps[state].get(c)
                state = self._step(state, c) if step is None else step
                top, piece_at, from_at = None, _UNSEEN, i
                for length, piece in ends[state]:
                    start = i + 1 - length
                    total = best[start]
                    if total is None:
                        continue
                    if merges:
                        pair = last[start] << 32 | piece
                        fits = pairs.get(pair)
                        if not (fits or fits is None and self._fits(pair)):
                            continue
                    total += scores[piece]
                    if top is None or total > top:
                        top, piece_at, from_at = total, piece, start
                    if merges:
                        break  # no other path can count
                if c not in known and best[i] is not None and (top is None or not merges):
                    total = best[i] + self.unseen_score
                    if top is None or total > top:
                        top, piece_at, from_at = total, _UNSEEN, i
                states.append(state)
                best.append(top)
                last.append(piece_at)
                came.append(from_at)
            out: list[int] = []
            at = len(word)
            while at:
                if last[at] != _UNSEEN:
                    out.append(last[at])
                elif self.byte_ids:
                    out += [self.byte_ids[b] for b in reversed(word[came[at] : at].encode())]
                elif not out or out[-1] != self.unknown:
                    out.append(self.unknown)
                at = came[at]
            yield out[::-1]

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        """The ids of each text, some texts at a time."""
        out: list[np.ndarray] = []
        first, size = 0, 0
        for n, x in enumerate(batch):
            size += len(x)
            if size > GROUP or n == len(batch) - 1:
                out += self._encode(batch[first : n + 1])
                first, size = n + 1, 0
        return out

    def _encode(self, batch: list[str]) -> list[np.ndarray]:
        """The ids of each text; words that were met before are remembered."""
        words = [self.cut.findall((SPACE * self.prefix + x).replace(" ", SPACE)) if x else [] for x in batch]
        missing = sorted(set().union(*words).difference(self.known))
        for w, ids in zip(missing, self.paths(missing), strict=True):
            self.known[w] = array("I", ids).tobytes()
        out = [np.frombuffer(b"".join(map(self.known.__getitem__, x)), np.uint32) for x in words]
        if len(self.known) > CACHE:
            for w in missing:
                del self.known[w]
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are not UTF-8 become U+FFFD."""
        raw = b"".join(map(self.surfaces.__getitem__, ids))
        return (raw[1:] if self.prefix and raw[:1] == b" " else raw).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def pieces(path: str) -> Pieces:
    """This process's model."""
    return Pieces(path)


def encode_pieces(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Return per row of docs: doc_id, n_pieces, ids, ids_crc32 (of the ids as little-endian unsigned 32-bit integers),
    decoded (the text that the ids give), then the columns named by keep.

    One row in, one row out; null ids and repeated rows are kept; a null or empty text has no ids; a text of any
    length is encoded whole; an empty table gives an empty one. Other columns are not read, unless keep names them;
    they may clash with those returned.
    """
    tune(docs.sparkSession, rows=ROWS)
    path = model or model_path()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = pieces(path)
        for batch in batches:
            ids = code.encode([x or "" for x in batch.column("text").to_pylist()])
            counts = np.array([len(x) for x in ids], np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            flat = pa.array(np.concatenate([np.zeros(0, np.uint32), *ids]).astype(np.int32))
            columns = [batch.column("doc_id"), pa.array(counts), pa.ListArray.from_arrays(offsets, flat), pa.array([zlib.crc32(x) for x in ids], pa.int64())]
            columns.append(pa.array([code.decode(x.tolist()) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns + batch.columns[2:], ["doc_id", "n_pieces", "ids", "ids_crc32", "decoded", *batch.schema.names[2:]])

    kept = {f"k{i}": name for i, name in enumerate(keep)}
    rows = pick(docs, doc_id=id_col, text=text_col, **kept)
    kind = {alias: f"{alias} {rows.schema[alias].dataType.simpleString()}" for alias in ("doc_id", *kept)}
    found = rows.mapInArrow(trimmed(encoded), ", ".join([kind["doc_id"], "n_pieces bigint, ids array<int>, ids_crc32 bigint, decoded string", *(kind[k] for k in kept)]))
    return found.toDF("doc_id", "n_pieces", "ids", "ids_crc32", "decoded", *keep)


def decode_pieces(encoded: DataFrame, model: str | None = None, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """Add to each row the text of its ids; null ids give an empty text.

    One row in, one row out, all columns as they are, clashing names too; repeated rows are decoded each; an empty
    table gives an empty one; of two columns named ids_col the first counts.
    """
    path = model or model_path()
    names = encoded.columns
    place = names.index(ids_col)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = pieces(path)
        for batch in batches:
            column = batch.column(place)
            starts, flat = column.offsets.to_pylist(), column.values.to_numpy()
            texts = [code.decode(flat[a:b].tolist()) for a, b in zip(starts, starts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    plain = encoded.toDF(*[f"c{i}" for i in range(len(names))])
    kind = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(encoded.schema))
    return plain.mapInArrow(trimmed(decoded), f"{kind}, decoded string").toDF(*names, into)


def op8_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, and what decoding them gives."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = encode_pieces(docs, keep=("text",))
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return found.select("doc_id", "n_pieces", "ids_crc32", F.sha2("decoded", 256).alias("decoded_sha256"), same.alias("round_trip"))
