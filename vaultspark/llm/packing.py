"""Packing of tokenised documents into fixed windows by non-negative least squares over a length histogram."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field
from struct import pack as pack_bytes

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultspark.llm.common import map_columns, written

WINDOW = 4096
GRAIN = 16  # lengths from ``FINE`` on are rounded up to multiples of this many tokens, of which patterns are made
FINE = 256  # shorter pieces keep their exact length
DEPTH = 3  # pieces in an enumerated pattern, at most
TOKENIZER = "word_bpe_49k.json"
END = 2  # id appended to every document
CACHED = 250_000  # chunks remembered by a Python worker


# tokens

def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkIds(dict):
    """Token ids (little-endian 32-bit) of white-space-free chunks, looked up or made by the tokenizer's model.

    The tokenizer's pattern never joins across white space, so a text's ids are those of its chunks in order.
    Only texts of plain characters take this path: Latin letters up to U+024F, where NFC and the per-character
    lower case of the tokenizer equal Python's; all others are encoded whole.
    """

    plain = re.compile(r"[\t\n\r\x20-\x7e\xa1-įı-ɏ]*\Z")
    pieces = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w]|_)+")

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.model = self.whole.model
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        self.letters = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}

    def __missing__(self, chunk: str) -> bytes:
        ids: list[int] = []
        for piece in [chunk] if chunk.isalpha() else self.pieces.findall(chunk):
            if not piece.isascii():
                piece = piece.encode().decode("latin-1").translate(self.letters)
            ids += [t.id for t in self.model.tokenize(piece)]
        found = pack_bytes(f"<{len(ids)}I", *ids)
        if len(self) < CACHED:
            self[chunk] = found
        return found

    def ids(self, text: str) -> bytes:
        if self.plain.match(text) and not self.odd.search(text):
            return b"".join(map(self.__getitem__, text.lower().split()))
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    odd = re.compile("[\xaa\xb2\xb3\xb9\xba\xbc-\xbe]")  # letters and digits that Python's \w and \d sort differently


_WORKER: dict[str, ChunkIds] = {}


def token_ids(path: str) -> ChunkIds:
    """The worker process's table, kept between tasks."""
    if path not in _WORKER:
        _WORKER[path] = ChunkIds(path)
    return _WORKER[path]


def room(length: int, grain: int = GRAIN) -> int:
    """Tokens that a piece takes in the plan."""
    return length if length < FINE else -(-length // grain) * grain


def token_pieces(docs: DataFrame, path: str | None = None, window: int = WINDOW, grain: int = GRAIN) -> DataFrame:
    """Every document's ids (its tokens, then ``END``) cut every ``window`` ids, as a written table.

    Columns: doc_id, start, length, doc_tokens, ids (binary, little-endian 32-bit), and for packing bin (the
    room it takes), part (writing partition) and nr (number within part and bin).  A null text is empty: one piece
    holding ``END``.  Repeated rows are packed as often as they occur.
    """
    path = path or tokenizer_path()

    def cutter():
        table, part, seen = token_ids(path), TaskContext.get().partitionId(), {}
        end = pack_bytes("<I", END)

        def cut(docs: list, texts: list) -> list:
            rows = []
            for doc, text in zip(docs, texts):
                ids = table.ids(text) + end if text else end
                total = len(ids) // 4
                for start in range(0, total, window):
                    length = min(window, total - start)
                    b = room(length, grain)
                    nr = seen.get(b, 0)
                    seen[b] = nr + 1
                    rows.append((doc, start, length, total, ids[4 * start:4 * (start + length)], b, part, nr))
            return list(zip(*rows))

        return cut

    long, int_ = pa.int64(), pa.int32()
    schema = pa.schema([("doc_id", long), ("start", long), ("length", long), ("doc_tokens", long), ("ids", pa.binary()),
                        ("bin", int_), ("part", int_), ("nr", long)])
    return written(map_columns(
        docs.select(F.col("doc_id").cast("long"), "text"), schema,
        "doc_id long, start long, length long, doc_tokens long, ids binary, bin int, part int, nr long", cutter), "pieces")


# plan

@dataclass
class Plan:
    """Patterns as rows (bin, first rank, end rank, first sequence, pieces a sequence, first slot)."""

    rows: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0


def patterns(bins: int, present: list[int], depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All ascending combinations of at most ``depth`` present lengths that fill ``bins`` exactly."""
    have, out = set(present), []

    def extend(prefix: tuple[int, ...], left: int) -> None:
        if left in have and (not prefix or left >= prefix[-1]):
            out.append((*prefix, left))
        if len(prefix) < depth - 1:
            for p in present:
                if (not prefix or p >= prefix[-1]) and 2 * p <= left:
                    extend((*prefix, p), left - p)

    extend((), bins)
    return out


def non_negative_least_squares(a: np.ndarray, b: np.ndarray, steps: int | None = None) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by the active-set method: free the column with the steepest gain, solve
    for the free columns, and step back to the border when one turns negative."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(steps or 3 * a.shape[0]):
        gain = a.T @ (b - a @ x)
        gain[free] = -np.inf
        if not len(gain) or gain.max() <= 1e-7 * max(1.0, np.abs(b).max()):
            break
        free[gain.argmax()] = True
        while free.any():
            at = np.flatnonzero(free)
            s = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if s.min() > 1e-9:
                x[:] = 0
                x[at] = s
                break
            low = s <= 1e-9
            ratio = x[at[low]] / np.maximum(x[at[low]] - s[low], 1e-12)
            x[at] += ratio.min() * (s - x[at])
            free[at[x[at] <= 1e-9]] = False
            x[~free] = 0
    return x


def plan_packing(histogram: dict[int, int], window: int, grain: int = 1, depth: int = DEPTH) -> Plan:
    """Repeat counts of patterns that together take every piece of ``histogram`` (bin -> pieces) exactly once.

    Patterns are combinations of the lengths that are multiples of ``grain``.  Non-negative least squares gives their
    repeats; they are rounded down, and what remains, with the pieces of other lengths, is packed greedily,
    longest first, a pattern as often as the remaining counts allow.
    """
    left = {b: n for b, n in sorted(histogram.items()) if n}
    plan, taken = Plan(), dict.fromkeys(left, 0)

    def use(lengths: dict[int, int], repeats: int) -> None:
        slot = 0
        for b, each in sorted(lengths.items(), reverse=True):
            plan.rows.append((b, taken[b], taken[b] + repeats * each, plan.sequences, each, slot))
            taken[b] += repeats * each
            left[b] -= repeats * each
            slot += each
        plan.sequences += repeats

    present = [b for b in left if b % grain == 0]
    found = [tuple(grain * b for b in p) for p in patterns(window // grain, [b // grain for b in present], depth)]
    if found:
        row = {b: i for i, b in enumerate(present)}
        a = np.zeros((len(present), len(found)))
        for j, p in enumerate(found):
            for b in p:
                a[row[b], j] += 1
        total = sum(left[b] for b in present)
        x = non_negative_least_squares(a, np.array([left[b] for b in present]) / total) * total
        for j in np.argsort(-x, kind="stable"):
            lengths = {b: found[j].count(b) for b in found[j]}
            repeats = min([int(x[j] + 1e-6), *(left[b] // n for b, n in lengths.items())])
            if repeats > 0:
                use(lengths, repeats)
    while any(left.values()):
        free, lengths = window, {}
        for b in sorted((b for b, n in left.items() if n), reverse=True):
            each = min(left[b], free // b)
            if each:
                lengths[b] = each
                free -= each * b
        use(lengths, min(left[b] // n for b, n in lengths.items()))
    return plan


# placement

def place(pieces: DataFrame, window: int = WINDOW, grain: int = GRAIN, depth: int = DEPTH) -> DataFrame:
    """``pieces`` (written; with length, bin, part, nr and any further columns) plus sequence_id and offset.

    The histogram (one count a length) is all that reaches the driver, and the plan (ranges of ranks, as many as
    the window has lengths to combine) all that is broadcast.  A piece's rank among those of its bin is
    its number in its part plus the counts of earlier parts, so a bin with a third of all pieces needs no one task.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("part", "bin").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("bin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    histogram = {r["bin"]: r["n"] for r in pieces.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_packing(histogram, window, grain, depth)
    ranges = spark.createDataFrame(plan.rows, "_bin int, _lo long, _hi long, _base long, _each long, _slot0 long")
    rank = F.col("_first") + F.col("nr")
    placed = pieces.join(offsets, ["part", "bin"]).withColumn("_rank", rank).join(
        F.broadcast(ranges), (F.col("bin") == F.col("_bin")) & (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi")))
    within = F.col("_rank") - F.col("_lo")
    placed = placed.withColumn("sequence_id", F.col("_base") + F.floor(within / F.col("_each")).cast("long")).withColumn(
        "_slot", F.col("_slot0") + within % F.col("_each"))
    earlier = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop(
        "part", "bin", "nr", "_first", "_rank", "_bin", "_lo", "_hi", "_base", "_each", "_slot0", "_slot")


def pack_documents(docs: DataFrame, path: str | None = None, window: int = WINDOW) -> DataFrame:
    """Every piece with its ids, sequence_id and offset; a sequence holds at most ``window`` ids.  An empty table
    gives no rows."""
    return place(token_pieces(docs, path, window), window)
