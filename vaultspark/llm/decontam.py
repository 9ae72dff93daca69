"""Benchmark decontamination by template canonicalisation.

Words are stripped of outer punctuation and case-folded.  Windows of these words are hash-joined with those of the
benchmark as they are, so that a copy is found in whatever case and however many names and numbers it holds.  Beside
them stand templates: numbers, units after numbers and names (capitalised words, also at the start of a sentence) are replaced by typed placeholders; a
capitalised word and a unit are read both as themselves and as a placeholder.  Along an alignment of a document with an item,
a slot value stands for the value that it meets at more than half of its places, and the reverse; windows that hold to
this count, so a question with other numbers or names is caught, also with a slip, and a chance mix is not.  In windows without a lower-case word on either side capitals are no sign of a name,
so there names can't differ.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultspark.llm.common import written

WINDOW = 8
LITERALS = 4  # words of a template window that are no placeholders, at least
WINDOWS = 6  # matching windows on consistent alignments (13 words in a row), or all of a shorter item
FILTER_BITS = 24
CACHED = 200_000

# fixed values: units of measure and currencies
UNITS = frozenset("mm cm m km in ft yd mi mg g kg t oz lb lbs ml cl l gal s sec secs min mins h hr hrs hour hours minute "
                  "minutes second seconds day days week weeks month months year years meter meters metre metres mile miles inch "
                  "inches foot feet gram grams kilogram kilograms liter liters litre litres pound pounds dollar dollars "
                  "cent cents euro euros percent % $ € £ mph kmh km/h m/s hz khz mhz ghz w kw v kb mb gb tb".split())
NUMBER = re.compile(r"[-+]?[$€£]?\d[\d.,:/]*(?P<unit>[a-z%€£$/°]*)\Z")

CAPITAL, LOWER, NUMERIC, UNIT = 1, 2, 4, 8
_HASH = np.uint64(0xFFFFFFFFFFFFFFF0)
_NAME, _NUMBER, _UNIT, _MEASURE = (np.uint64(xxhash.xxh64_intdigest(x)) & _HASH for x in (b"<name>", b"<number>", b"<unit>", b"<number><unit>"))
_FACTOR = 0x9E3779B97F4A7C15
_GROUP = 20_000  # words of documents that are read together
_CHUNK = 4096  # windows whose readings are held at a time


def slot_value(word: str) -> str:
    return word.strip(".,;:!?\"'()[]{}«»“”‘’„-–—…¿¡*_").casefold()


class Words(dict):
    """A word's hash (upper 60 bits) and flags (lower four); a number with its unit has both flags."""

    def __missing__(self, raw: str) -> int:
        bare = raw.strip(".,;:!?\"'()[]{}«»“”‘’„-–—…¿¡*_")
        low, flags = bare.casefold(), 0
        if (m := NUMBER.match(low)) and (not m["unit"] or m["unit"] in UNITS):
            flags |= NUMERIC | (UNIT if m["unit"] else 0)
        elif low in UNITS:
            flags |= UNIT
        elif bare[:1].isupper():
            flags |= CAPITAL
        if bare[:1].islower():
            flags |= LOWER
        found = xxhash.xxh64_intdigest(low.encode("utf-8", "surrogatepass")) & 0xFFFFFFFFFFFFFFF0 | flags
        if len(self) < CACHED:
            self[raw] = found
        return found


_WORDS = Words()  # kept between a worker's tasks


class Text:
    """The words of texts (lists of words), one after the other, each with its text's number (``owner``): hashes as they are (``raw``) and as templates (``hashes``), ``numeric`` placeholders, ``either``:
    words that are read both as they are and as a placeholder (hash ``other``), ``name`` among them, ``lower``-case words."""

    def __init__(self, texts: list[list[str]]):
        words = [w for t in texts for w in t]
        sizes = np.array([len(t) for t in texts], np.int64)
        self.owner, self.starts = np.repeat(np.arange(len(texts)), sizes), np.cumsum(sizes) - sizes
        codes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
        has = lambda flag: codes & np.uint64(flag) > 0
        after = lambda flag: np.r_[False, has(flag)[:-1] & (self.owner[1:] == self.owner[:-1])][:len(words)]
        self.words, self.raw, self.numeric, self.lower = words, codes & _HASH, has(NUMERIC), has(LOWER)
        self.hashes = np.where(self.numeric, np.where(has(UNIT), _MEASURE, _NUMBER), self.raw)
        self.name = has(CAPITAL)
        unit = has(UNIT) & ~self.numeric & after(NUMERIC)
        self.either, self.other = self.name | unit, np.where(unit, _UNIT, _NAME)

    def count(self, flags: np.ndarray, width: int) -> np.ndarray:
        total = np.r_[0, np.cumsum(flags)]
        return total[width:] - total[:-width]

    def rows(self, keys: list, width: int, at: np.ndarray, h: np.ndarray, slots: np.ndarray) -> list[tuple]:
        """``(key, width, pos, h, slots, unsure, words)`` a window; ``unsure``: its names if it has no lower-case word."""
        return [(keys[o], width, p - s, x, m, 0 if self.lower[p:p + width].any() else m & int(self.name[p:p + width] @ _BITS[:width]),
                 [slot_value(w) for w in self.words[p:p + width]])
                for p, o, s, x, m in zip(at.tolist(), self.owner[at].tolist(), self.starts[self.owner[at]].tolist(),
                                         h.view(np.int64).tolist(), slots.tolist())]


_BITS = np.int64(1) << np.arange(63)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


def windows(text: Text, width: int, literals: int = LITERALS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Positions, hashes and placeholder bits of the windows: all as they are (no bits), then every reading
    with placeholders that leaves ``literals`` words.  Readings double with every capitalised word up to that limit."""
    n = len(text.words) - width + 1
    if n < 1:
        return
    powers = np.array([pow(_FACTOR, width - 1 - k, 1 << 64) for k in range(width)], np.uint64)
    total = lambda hashes: sum((hashes[k:k + n] * powers[k] for k in range(width)), np.zeros(n, np.uint64))
    whole = text.owner[:n] == text.owner[width - 1:]
    at = np.flatnonzero(whole)
    yield at, _mixed(total(text.raw)[at]), np.zeros(len(at), np.int64)
    free = width - min(literals, width)  # placeholders that a window can have
    left = free - text.count(text.numeric, width)
    some = text.count(text.numeric | text.either, width) > 0
    base, change = total(text.hashes), text.other - text.hashes
    slots = sum((text.numeric[k:k + n] * _BITS[k] for k in range(width)), np.zeros(n, np.int64))
    fit = np.flatnonzero((left >= 0) & some & whole) if free else np.zeros(0, np.int64)
    for first in range(0, len(fit), _CHUNK):
        at = fit[first:first + _CHUNK]
        h, m, rest = base[at], slots[at], left[at]
        for k in range(width):
            more = np.flatnonzero(text.either[at + k] & (rest > 0))
            if len(more):
                at, h = np.r_[at, at[more]], np.r_[h, h[more] + change[at[more] + k] * powers[k]]
                m, rest = np.r_[m, m[more] | _BITS[k]], np.r_[rest, rest[more] - 1]
        held = m > 0
        yield at[held], _mixed(h[held]), m[held]


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(item_id, width, item_pos, h, slots, item_unsure, item_words, item_windows, full, full_windows)``: an item shorter
    than ``window`` words is one window of all its words, one without a letter or digit none.  ``full``: the window has enough literal words even with a
    placeholder for every name that has a lower-case word beside it; a question with other values can match these."""
    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for item, text in zip(pdf["item_id"], pdf["text"]):
                words = (text or "").split()
                width = min(window, len(words))
                if any(map(slot_value, words)):
                    read = Text([words])
                    names = np.where(read.count(read.lower, width) > 0, read.count(read.name, width), 0)
                    filled = names + read.count(read.numeric | read.either & ~read.name, width)
                    full = width - filled >= min(LITERALS, width)
                    for at, h, slots in windows(read, width):
                        rows += [(*r, len(full), bool(full[r[2]]), int(full.sum())) for r in read.rows([item], width, at, h, slots)]
            yield pd.DataFrame(rows, columns=["item_id", "width", "item_pos", "h", "slots", "item_unsure", "item_words",
                                              "item_windows", "full", "full_windows"])

    return benchmark.select(F.col("item_id").cast("long"), "text").where("item_id IS NOT NULL").mapInPandas(
        scan, "item_id long, width int, item_pos int, h long, slots long, item_unsure long, item_words array<string>, "
              "item_windows int, full boolean, full_windows int")


def _groups(docs: Iterator[tuple]) -> Iterator[tuple[list, list[list[str]]]]:
    """Ids and word lists of documents, some ``_GROUP`` words at a time."""
    ids, texts, n = [], [], 0
    for doc, text in docs:
        ids.append(doc)
        texts.append(text.split())
        n += len(texts[-1])
        if n >= _GROUP:
            yield ids, texts
            ids, texts, n = [], [], 0
    if ids:
        yield ids, texts


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_windows: int = WINDOWS) -> DataFrame:
    """``(doc_id, item_id, matched, item_windows, reparameterised)``: the documents that hold a benchmark item or
    ``min_windows`` windows of it.

    ``matched`` counts the item's windows that are equal word by word or whose slots all have their alignment's values;
    ``reparameterised`` says that a slot value differs.  Of an item whose windows hold too few literal words for other
    values, the windows that hold enough decide beside all of them.
    A fixed-size bit table of the benchmark's window hashes (``2 ** FILTER_BITS`` bits, whatever the benchmark's
    size) spares the shuffle most windows of the documents; the join itself is exact.  Null and empty texts and null ids
    on either side match nothing; repeated rows count once; empty tables give no rows.
    """
    spark = docs.sparkSession
    items = written(benchmark_windows(benchmark, window), "benchmark-windows")
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # at most window
    mask = (1 << FILTER_BITS) - 1
    table = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bits = items.select(F.col("h").bitwiseAND(mask).alias("b")).groupBy(F.expr("b div 64").alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, cast(b % 64 as int)))").alias("v"))
    for w, v in bits.collect():  # one long a word of the table, at most
        table[w] = v & 0xFFFFFFFFFFFFFFFF
    shared = spark.sparkContext.broadcast(table)

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for pdf in frames:
            rows = []
            for ids, texts in _groups(zip(pdf["doc_id"].tolist(), pdf["text"])):
                read = Text(texts)
                for width in widths:
                    for at, h, slots in windows(read, width):
                        b = h & np.uint64(mask)
                        hit = np.flatnonzero((known[b >> np.uint64(6)] >> (b & np.uint64(63))) & np.uint64(1))
                        if len(hit):
                            rows += read.rows(ids, width, at[hit], h[hit], slots[hit])
            yield pd.DataFrame(rows, columns=["doc_id", "width", "pos", "h", "slots", "unsure", "words"])

    found = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL").mapInPandas(
        scan, "doc_id long, width int, pos int, h long, slots long, unsure long, words array<string>")
    pairs = found.join(items, ["h", "width", "slots"]).withColumn("differs", F.expr(
        "aggregate(sequence(0, width - 1), 0L, (a, k) -> if(words[k] <> item_words[k], a | shiftleft(1L, k), a))"))
    pairs = written(pairs.where("differs & ~slots = 0 AND differs & unsure & item_unsure = 0").distinct(), "template-matches")
    pairs = pairs.withColumn("shift", F.col("pos") - F.col("item_pos"))
    alignment, window_of = ["doc_id", "item_id", "shift"], ["item_pos", "full", "item_windows", "full_windows"]
    values = pairs.where("slots > 0").select(*alignment, *window_of, "slots", "differs", F.explode(F.expr(
        "transform(filter(sequence(0, width - 1), k -> slots & shiftleft(1L, k) > 0), "
        "k -> struct(item_pos + k AS at, item_words[k] AS item, words[k] AS doc))")).alias("s")).select(
        *alignment, *window_of, "slots", "differs", "s.at", "s.item", "s.doc")
    votes = values.select(*alignment, "at", "item", "doc").distinct().groupBy(*alignment, "item", "doc").agg(F.count(F.lit(1)).alias("n"))
    of = lambda side: F.sum("n").over(Window.partitionBy(*alignment, side))
    firm = votes.withColumn("of_item", of("item")).withColumn("of_doc", of("doc")).where(
        "2 * n > of_item AND 2 * n > of_doc").select(*alignment, "item", "doc", F.lit(1).alias("firm"))
    equal = pairs.where("differs = 0").select("doc_id", "item_id", *window_of, "differs")
    other = (values.where("differs > 0").join(firm, [*alignment, "item", "doc"], "left").groupBy(*alignment, *window_of, "slots", "differs")
             .agg(F.count("firm").alias("n"), F.count(F.lit(1)).alias("of")).where("n = of")
             .select("doc_id", "item_id", *window_of, "differs"))
    return (equal.union(other).groupBy("doc_id", "item_id")
            .agg(F.countDistinct("item_pos").alias("matched"), F.max("item_windows").alias("item_windows"),
                 F.max(F.col("differs") > 0).alias("reparameterised"),
                 F.countDistinct(F.when(F.col("full"), F.col("item_pos"))).alias("_full"), F.max("full_windows").alias("_of"))
            .where((F.col("matched") >= F.least(F.lit(min_windows), F.col("item_windows")))
                   | (F.col("_of") > 0) & (F.col("_full") >= F.least(F.lit(min_windows), F.col("_of"))))
            .drop("_full", "_of"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_windows: int = WINDOWS) -> DataFrame:
    """The rows of ``docs`` whose doc_id holds no benchmark item; all columns stay, a null doc_id always stays."""
    found = contaminated(docs, benchmark, window, min_windows).select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(found, docs["doc_id"] == found["_leak"], "left_anti")
