"""Phrase collocations by Toivonen's mining: a sample proposes, full passes count exactly until nothing is missing.

A sample of the documents proposes words and phrases.  A full pass counts, exactly and over all documents, every phrase whose
parts (without its first, without its last word) were proposed: these are the proposed phrases and their negative border, as
far as it occurs.  A border phrase that turns out frequent is a failure: it joins the proposals, and a further pass counts the phrases
that have become countable by it, until a pass brings no failure.  No frequent phrase is missed then, whatever the sample held.

The border is mostly pairs that occur once, so a pass for many proposals screens it before it counts: 40 bits of every phrase's hash are counted first, and
only phrases whose bits reach the count are counted as they are.  Phrases that share their bits are counted together there, so none
is lost.  A word is a 64-bit hash (of its lang and itself; that no two of the words counted share one is checked, else another seed is
taken), a phrase the hashes of its words.  Tasks add up the counts of their own text and send them packed, in cells by hash; Spark
deals the cells out over as many partitions as the text needs, and tasks add them up.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultspark.llm.common import shuffle_partitions, written

SEPARATORS = b".,;:!?\n\x0b\x0c\r"
TABLE = bytes.maketrans(SEPARATORS + b"\t", b"." * len(SEPARATORS) + b" ")
CHUNK = 2 << 20  # bytes of text that a task counts at a time
PART_BYTES = 32 << 20  # of text, whose counts (some 100 MB at most) one task adds up
FRACTION = 0.0625  # of the documents, in the sample
FILTER_BITS = 1 << 25  # of the proposals' Bloom filter, a broadcast of 4 MB whatever their number
SCREEN_BITS = 40  # of a phrase's hash, that the screen counts by
SCREEN_MOST = 1 << 29  # bits of the screen's Bloom filter at most, 64 MB; beyond, more phrases are counted than pass the screen
CELLS = 1024  # that a task's counts are sent in, at least
HELD = 1 << 22  # hashes that a task holds before it sends them
HELD_ROWS = 1 << 19  # counts of phrases likewise
SALTS = 4  # of the parts of phrases, of which the commonest word is one of some percent at most
UNKNOWN = "und"
LONG_WORD = 4096  # bytes beyond which a word is hashed by itself
CLASH = -1  # as k: two words share a hash


# words of a chunk

def _blocks(data: bytes, ahead: int) -> Iterator[tuple[bytes, bytes]]:
    """A long text in blocks of about ``CHUNK`` bytes, cut after a separator or, where a block has none, before a
    blank: then with the next ``ahead`` words of the same piece, at which no phrase of this block starts."""
    following, at = re.compile(rb" *+(?:[^ .]++ *+){0,%d}" % ahead), 0
    while len(data) - at > CHUNK:
        cut = data.rfind(b".", at, at + CHUNK) + 1
        if cut <= at:
            cut = data.rfind(b" ", at + 1, at + CHUNK)
        if cut <= at:  # one huge word
            m = re.compile(rb"[ .]").search(data, at + CHUNK)
            cut = m.start() if m else len(data)
        yield data[at:cut], following.match(data, cut)[0]
        at = cut
    yield data[at:], b""


def _chunks(batches: Iterator[pa.RecordBatch], ahead: int) -> Iterator[tuple[str, bytes, bytes]]:
    """(lang, text, words ahead) of documents put together by lang; separators are ".", blanks are " ", A-Z is lower-cased."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            data = (text.as_py() or b"").lower().translate(TABLE)
            if len(data) > CHUNK:
                yield from ((lang, *block) for block in _blocks(data, ahead))
                continue
            held.setdefault(lang, []).append(data)
            size += len(data)
            if size > CHUNK:
                yield from ((k, b".".join(v), b"") for k, v in held.items())
                held, size = {}, 0
    yield from ((k, b".".join(v), b"") for k, v in held.items())


def _mix(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """64-bit hashes of phrases continued by a word."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + word
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _words(data: bytes, lang: str, seeds: list[int]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """(hashes by seed, starts, ends, whether the next word is in the same piece) of the words of a chunk."""
    d = np.frombuffer(data, np.uint8)
    inside = (d != 32) & (d != 46)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return [np.zeros(0, np.uint64)] * len(seeds), starts, ends, np.zeros(0, bool)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    letters = d[inside].astype(np.uint64) + np.uint64(1)
    place = np.arange(len(letters), dtype=np.int32) - np.repeat(first.astype(np.int32), sizes)
    longest = int(sizes.max())
    if longest > LONG_WORD:
        place = np.minimum(place, LONG_WORD - 1)
    hashes = []
    for seed in seeds:
        base = np.uint64(xxhash.xxh64_intdigest(b"base", seed) | 1)
        h = np.add.reduceat(letters * np.multiply.accumulate(np.full(min(longest, LONG_WORD), base, np.uint64))[place], first)
        for i in np.flatnonzero(sizes > LONG_WORD):
            h[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]], seed)
        hashes.append(_mix(h, np.full(1, xxhash.xxh64_intdigest(lang.encode(), seed), np.uint64)))
    pieces = np.cumsum(d == 46, dtype=np.int32)[starts]
    return hashes, starts, ends, np.append(pieces[1:] == pieces[:-1], False)


def _within(bits: np.ndarray | None, h: np.ndarray) -> np.ndarray:
    """Which hashes a filter may hold (two bits a hash); no filter holds nothing."""
    if bits is None:
        return np.zeros(len(h), bool)
    mask, out = np.uint64(64 * len(bits) - 1), np.ones(len(h), bool)
    for p in (h & mask, (h >> np.uint64(32)) & mask):
        out &= (bits[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1
    return out


def _counted(h: np.ndarray, keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(one place of every distinct row of ``keys``, its number of rows or sum of ``counts``); ``h`` are hashes of the rows."""
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(h)
    sorted_h = h[order]
    equal = sorted_h[1:] == sorted_h[:-1]
    at = np.flatnonzero(equal)
    if not (keys[order[at]] == keys[order[at + 1]]).all():  # keys that share a hash may lie mixed
        order = np.lexsort((*keys.T, h))
        equal = (keys[order[1:]] == keys[order[:-1]]).all(1)
    firsts = np.flatnonzero(np.append(True, ~equal))
    if counts is not None:
        return order[firsts], np.add.reduceat(counts[order], firsts)
    return order[firsts], np.diff(np.append(firsts, len(order)))


def _columns(max_words: int) -> list[str]:
    return [f"w{j + 1}" for j in range(max_words)]


def _phrases(hashes: np.ndarray, joined: np.ndarray, limit: int, max_words: int, new: np.ndarray | None, old: np.ndarray | None,
             every: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, first words, hashes) of the phrases of two words and more that a pass counts, see ``_count``."""
    good, h = np.ones(len(hashes), bool), hashes
    in_new, in_old = _within(new, hashes), _within(old, hashes)
    for k in range(2, max_words + 1):
        if len(hashes) < k:
            return
        good = good[:-1] & joined[k - 2:len(hashes) - 1]
        h = _mix(h[:-1], hashes[k - 1:])
        if not every:
            ready, done = in_new[:-1] & in_new[1:] & good, in_old[:-1] & in_old[1:] & good
        at = np.flatnonzero((good if every else ready & ~done)[:limit])
        yield k, at, h[at]
        if k < max_words and not every:
            in_new, in_old = np.zeros(len(good), bool), np.zeros(len(good), bool)
            for flags, ok, bits in ((in_new, ready, new), (in_old, done, old)):
                some = np.flatnonzero(ok)
                flags[some] = _within(bits, h[some])


def _count(lang: str, data: bytes, ahead: bytes, max_words: int, seed: int, new: np.ndarray | None, old: np.ndarray | None,
           every: bool, screen: tuple | None = None) -> Iterator[pa.RecordBatch]:
    """Counts of a chunk: phrases whose parts lie in ``new`` and not all in ``old`` (``every``: phrases of any parts);
    where ``old`` is None words are counted too, with their letters, and their number, as the phrase of no words.
    Words and phrases that ``screen`` doesn't hold are left out."""
    text = data + ahead
    (hashes, *other), begins, ends, joined = _words(text, lang, [seed, seed + 1_000_003][:1 if old is not None else 2])
    limit = int(np.searchsorted(begins, len(data)))

    def rows(k: int, keys: np.ndarray, counts: np.ndarray, words: list[bytes] | None = None) -> pa.RecordBatch:
        n = len(counts)
        w = [np.ascontiguousarray(keys[:, j]).view(np.int64) if j < max(k, 1) else np.zeros(n, np.int64) for j in range(max_words)]
        named = k < 2
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, k, np.int32)), *map(pa.array, w), pa.array([lang] * n, pa.string()) if named else pa.nulls(n, pa.string()),
             pa.array(words, pa.binary()).cast(pa.string()) if words else pa.nulls(n, pa.string()), pa.array(counts.astype(np.int64))],
            names=["k", *_columns(max_words), "lang", "word", "a"])

    if old is None:
        yield rows(0, np.append(hashes, np.uint64(0))[:1, None], np.array([limit]))  # dealt out by the chunk's first word
        at = np.flatnonzero(_passed(screen, hashes[:limit]))
        twice = np.stack([hashes[at], other[0][at]], axis=1)  # words are told apart by 128 bits here, by letters in the sum
        place, counts = _counted(hashes[at], twice)
        at = at[place]
        yield rows(1, hashes[at, None], counts, [text[begins[i]:ends[i]] for i in at.tolist()])
    for k, at, h in _phrases(hashes, joined, limit, max_words, new, old, every):
        passed = _passed(screen, h)
        at, h = at[passed], h[passed]
        keys = np.stack([hashes[at + j] for j in range(k)], axis=1)
        place, counts = _counted(h, keys)
        yield rows(k, keys[place], counts)


# the screen

def _packed(values: np.ndarray) -> bytes:
    """Numbers as planes of their bytes, each compressed by itself."""
    width = (int(values.max(initial=0)).bit_length() + 7) // 8
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T[:width]
    frames = [pa.compress(np.ascontiguousarray(p), "zstd", asbytes=True) for p in planes]
    return np.array([len(values), width, *map(len, frames)], "<u4").tobytes() + b"".join(frames)


def _unpacked(data: bytes) -> np.ndarray:
    n, width = np.frombuffer(data, "<u4", 2).tolist()
    out, at = np.zeros((n, 8), np.uint8), 8 + 4 * width
    for j, size in enumerate(np.frombuffer(data, "<u4", width, 8).tolist()):
        out[:, j] = np.frombuffer(pa.decompress(data[at:at + size], n, "zstd", asbytes=True), np.uint8)
        at += size
    return out.view("<u8")[:, 0]


def _bits(v: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places that the screen's filter has for the bits that are counted by."""
    q = v * np.uint64(0x9E3779B97F4A7C15)
    q ^= q >> np.uint64(32)
    return q & mask, (q >> np.uint64(32)) & mask


def _passed(screen: tuple | None, h: np.ndarray) -> np.ndarray:
    """Which phrases of hashes ``h`` the screen may hold; no screen holds all."""
    if screen is None:
        return np.ones(len(h), bool)
    words, firsts, masks = screen
    v = h >> np.uint64(64 - SCREEN_BITS)
    cell = (v >> np.uint64(SCREEN_BITS + 1 - len(masks).bit_length())).astype(np.int64)
    first, out = firsts[cell], np.ones(len(h), bool)
    for p in _bits(v, masks[cell]):
        out &= (words[first + (p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
    return out


def _send_hashes(held: list[np.ndarray], least: int, cells: int) -> Iterator[pa.RecordBatch]:
    """The counts of hashes, up to ``least``, in cells: differences between sorted hashes take few bytes."""
    v, shift = np.concatenate(held), SCREEN_BITS + 1 - cells.bit_length()
    held.clear()
    v.sort()
    firsts = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
    counts = np.minimum(np.diff(firsts, append=len(v)), least)
    v = v[firsts]
    cuts = np.searchsorted(v >> np.uint64(shift), np.arange(cells + 1, dtype=np.uint64))
    some = np.flatnonzero(np.diff(cuts)).tolist()
    parts = [(v[cuts[c]:cuts[c + 1]], counts[cuts[c]:cuts[c + 1]]) for c in some]
    yield pa.RecordBatch.from_arrays(
        [pa.array(some, pa.int32()), pa.array([_packed(np.diff(x, prepend=np.uint64(c << shift))) for c, (x, _) in zip(some, parts)], pa.binary()),
         pa.array([_packed(n) for _, n in parts], pa.binary())], names=["cell", "v", "a"])


def _screened(batches: Iterator[pa.RecordBatch], least: int, cells: int) -> Iterator[pa.RecordBatch]:
    """Bloom filters, a cell each, of the hashes of a partition with ``least`` occurrences and more; eight bits a hash at least."""
    shift, v, counts = SCREEN_BITS + 1 - cells.bit_length(), [], []
    for batch in batches:
        for cell, packed, a in zip(*(c.to_pylist() for c in batch.columns)):
            v.append(np.cumsum(_unpacked(packed), dtype=np.uint64) + np.uint64(cell << shift))
            counts.append(_unpacked(a).astype(np.int64))
    if not v:
        return
    v, counts = np.concatenate(v), np.concatenate(counts)
    order = np.argsort(v)
    v, counts = v[order], counts[order]
    firsts = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
    v = v[firsts][np.add.reduceat(counts, firsts) >= least]
    of = (v >> np.uint64(shift)).astype(np.int64)
    cuts = np.append(np.flatnonzero(np.diff(of, prepend=-1)), len(of)).tolist()
    found, filters = [], []
    for lo, hi in zip(cuts, cuts[1:]):
        flags = np.zeros(max(64, min(1 << (8 * (hi - lo) - 1).bit_length(), SCREEN_MOST // cells)), bool)
        for p in _bits(v[lo:hi], np.uint64(len(flags) - 1)):
            flags[p] = True
        found.append(int(of[lo]))
        filters.append(np.packbits(flags, bitorder="little").tobytes())
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(filters, pa.binary())], names=["cell", "bits"])


def screen_of(docs: DataFrame, max_words: int, least: int, parts: int, seed: int, new: np.ndarray | None,
              old: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(Bloom filters of all cells, where each begins, its mask) of the words and phrases that a pass must count: at least those
    with ``least`` and more occurrences in all of ``docs(lang, text)``.  Some two bytes a phrase of them reach the driver."""
    filters, cells = docs.sparkSession.sparkContext.broadcast((new, old)), _cells(parts)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, (new, old) = [], 0, filters.value
        for lang, data, ahead in _chunks(batches, max_words - 1):
            (hashes,), begins, _, joined = _words(data + ahead, lang, [seed])
            limit = int(np.searchsorted(begins, len(data)))
            found = [hashes[:limit]] if old is None else []
            found += [h for _, _, h in _phrases(hashes, joined, limit, max_words, new, old, False)]
            held += [h >> np.uint64(64 - SCREEN_BITS) for h in found]
            size += sum(map(len, found))
            if size > HELD:
                yield from _send_hashes(held, least, cells)
                held, size = [], 0
        if size:
            yield from _send_hashes(held, least, cells)

    sent = docs.select("lang", "text").mapInArrow(scan, "cell int, v binary, a binary").repartition(parts, "cell")
    got = sent.mapInArrow(lambda batches: _screened(batches, least, cells), "cell int, bits binary").toArrow()
    bits = {c: np.frombuffer(b.as_py(), "<u8") for c, b in zip(got["cell"].to_pylist(), got["bits"])}
    each = [bits.get(c, np.zeros(1, np.uint64)) for c in range(cells)]
    sizes = np.array([len(b) for b in each], np.int64)
    return np.concatenate(each), np.cumsum(sizes) - sizes, (64 * sizes - 1).astype(np.uint64)


# counts

def _cells(parts: int) -> int:
    return max(CELLS, 1 << (4 * parts - 1).bit_length())


def _send(batch: pa.RecordBatch, max_words: int, cells: int) -> pa.RecordBatch:
    """Counts that a task has added up, in cells by their words' hashes."""
    k, lang, word = batch.column(0).to_numpy(), batch.column(max_words + 1), batch.column(max_words + 2)
    w, a = [np.asarray(batch.column(j + 1), np.int64).view(np.uint64) for j in range(max_words)], np.asarray(batch.column(max_words + 3), np.uint64)
    h = w[0]
    for j in range(1, max_words):
        h = _mix(h, w[j])
    cell = (h >> np.uint64(65 - cells.bit_length())).astype(np.int32)
    order = np.lexsort((w[0], k, cell))
    group = cell[order].astype(np.int64) * (max_words + 1) + k[order]
    cuts = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group)).tolist()
    rows = []
    for lo, hi in zip(cuts, cuts[1:]):
        at, size = order[lo:hi], int(k[order[lo]])
        keys = [pa.compress(w[0][at], "zstd", asbytes=True), *[x[at].tobytes() if j < size else None for j, x in enumerate(w[1:], 1)]]
        langs = code = words = None
        if size < 2:
            taken = lang.take(pa.array(at)).dictionary_encode()
            langs, code = taken.dictionary.to_pylist(), _packed(taken.indices.to_numpy())
        if size == 1:
            words = " ".join(word.take(pa.array(at)).to_pylist())
        rows.append((int(cell[at[0]]), size, *keys, langs, code, words, _packed(a[at])))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _sent(max_words))], schema=_sent(max_words)) if rows else \
        pa.RecordBatch.from_pylist([], schema=_sent(max_words))


def _sent(max_words: int) -> pa.Schema:
    return pa.schema([("cell", pa.int32()), ("k", pa.int32()), *[(c, pa.binary()) for c in _columns(max_words)],
                      ("langs", pa.list_(pa.string())), ("lang", pa.binary()), ("words", pa.string()), ("a", pa.binary())])


def _received(batches: Iterator[pa.RecordBatch], max_words: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``_count`` again."""
    for batch in batches:
        cells = batch.to_pylist()
        for size in sorted({c["k"] for c in cells}):
            some = [c for c in cells if c["k"] == size]
            a = np.concatenate([_unpacked(c["a"]) for c in some]).view(np.int64)
            sizes = [8 * int(np.frombuffer(c["a"], "<u4", 1)[0]) for c in some]
            w = [np.frombuffer(b"".join(pa.decompress(c["w1"], n, "zstd", asbytes=True) for c, n in zip(some, sizes)), "<u8")]
            w += [np.frombuffer(b"".join(c[x] for c in some), "<u8") if j < size else np.zeros(len(a), np.uint64)
                  for j, x in enumerate(_columns(max_words)[1:], 1)]
            lang = word = pa.nulls(len(a), pa.string())
            if size < 2:
                lang = pa.chunked_array([pa.DictionaryArray.from_arrays(pa.array(_unpacked(c["lang"]).astype(np.int32)), pa.array(c["langs"], pa.string()))
                                         .cast(pa.string()) for c in some]).combine_chunks()
            if size == 1:
                word = pa.array([x for c in some for x in c["words"].split(" ")], pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(a), size, np.int32)), *[pa.array(x.view(np.int64)) for x in w], lang, word, pa.array(a)],
                names=["k", *_columns(max_words), "lang", "word", "a"])


def _add_up(batches: Iterator[pa.RecordBatch], max_words: int, least: int) -> Iterator[pa.RecordBatch]:
    """The counts of a partition added up, phrases of fewer than ``least`` left out (not the numbers of all words)."""
    columns, parts, named, schema = _columns(max_words), [], [], None
    for batch in batches:
        schema = batch.schema
        k = batch.column(0).to_numpy()
        if (k < 2).any():
            named.append(batch.filter(pa.array(k < 2)))
        phrase = np.flatnonzero(k > 1)
        parts.append(np.stack([np.asarray(batch.column(i), dtype=np.int64)[phrase] for i in (0, *range(1, max_words + 1), batch.num_columns - 1)]))
    if schema is None:
        return
    if named:
        words = pa.Table.from_batches(named).group_by(["k", "w1", "lang", "word"]).aggregate([("a", "sum")])
        ones = words.filter(pc.equal(words["k"], 1))
        clash = len(ones) - len(pc.unique(ones["w1"]))
        words = words.filter(pc.or_(pc.equal(words["k"], 0), pc.greater_equal(words["a_sum"], least)))
        n = len(words)
        zeros = [pa.array(np.zeros(n, np.int64))] * (max_words - 1)
        yield pa.Table.from_arrays([words["k"], words["w1"], *zeros, words["lang"], words["word"], words["a_sum"]], schema=schema
                                   ).combine_chunks().to_batches()[0] if n else batch.slice(0, 0)
        if clash:
            yield pa.RecordBatch.from_arrays([pa.array([CLASH], pa.int32()), *[pa.array([0])] * max_words, pa.nulls(1, pa.string()),
                                              pa.nulls(1, pa.string()), pa.array([clash])], schema=schema)
    rows = np.concatenate(parts, axis=1)
    parts.clear()
    keys, counts = rows[:-1].T.view(np.uint64), rows[-1]
    h = np.zeros(rows.shape[1], np.uint64)
    for j in range(max_words + 1):
        h = _mix(h, keys[:, j])
    place, total = _counted(h, keys, counts)
    place, total = place[total >= least], total[total >= least]
    yield pa.RecordBatch.from_arrays(
        [pa.array(rows[0][place].astype(np.int32)), *[pa.array(rows[j + 1][place]) for j in range(len(columns))],
         pa.nulls(len(place), pa.string()), pa.nulls(len(place), pa.string()), pa.array(total)], schema=schema)


def count_phrases(docs: DataFrame, max_words: int, least: int, parts: int, seed: int = 0, new: np.ndarray | None = None,
                  old: np.ndarray | None = None, every: bool = False) -> DataFrame:
    """``(k, w1 .., lang, word, a)``: phrases with ``least`` and more occurrences in all of ``docs(lang, text)``, see ``_count``;
    a row of k ``CLASH`` where words share a hash."""
    cells, columns = _cells(parts), _columns(max_words)
    few = every or old is not None and 2 * np.bitwise_count(new & ~old).sum() < np.bitwise_count(new).sum()  # a sample, or a pass for few proposals
    screen = None if few else screen_of(docs, max_words, least, parts, seed, new, old)
    shared = docs.sparkSession.sparkContext.broadcast((new, old, every, screen))

    def added(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _add_up(iter(held), max_words, 0):
            yield _send(batch.filter(pc.greater_equal(batch.column(0), 0)), max_words, cells)  # clashes show again in the sum

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for chunk in _chunks(batches, max_words - 1):
            for part in _count(*chunk, max_words, seed, *shared.value):
                held.append(part)
                size += part.num_rows
            if size > HELD_ROWS:
                yield from added(held)
                held, size = [], 0
        yield from added(held)

    sent = f"cell int, k int, {', '.join(f'{c} binary' for c in columns)}, langs array<string>, lang binary, words string, a binary"
    counted = docs.select("lang", "text").mapInArrow(scan, sent).repartition(parts, "cell")
    ddl = f"k int, {', '.join(f'{c} long' for c in columns)}, lang string, word string, a long"
    return counted.mapInArrow(lambda batches: _add_up(_received(batches, max_words), max_words, least), ddl)


def filter_of(phrases: DataFrame, bits: int) -> np.ndarray:
    """Bloom filter of phrases ``w``: set bits are gathered by 64-bit word, so that at most ``bits / 64`` rows reach the driver."""
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, sizes = batch.column(0).flatten().to_numpy().view(np.uint64), np.diff(batch.column(0).offsets.to_numpy())
            first = np.cumsum(sizes) - sizes
            h = w[first] if len(first) else w
            for j in range(1, int(sizes.max(initial=0))):
                longer = np.flatnonzero(sizes > j)
                h[longer] = _mix(h[longer], w[first[longer] + j])
            p = np.concatenate([h & np.uint64(bits - 1), (h >> np.uint64(32)) & np.uint64(bits - 1)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(p)], names=["p"])

    words = phrases.select("w").mapInArrow(places, "p long").groupBy(F.shiftright("p", 6).alias("i")).agg(
        F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("b")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[words["i"].to_numpy()] = words["b"].to_numpy().view(np.uint64)
    return out


def frequent_phrases(docs: DataFrame, max_words: int = 3, min_count: int = 10, fraction: float = FRACTION,
                     filter_bits: int = FILTER_BITS, seed: int = 0) -> tuple[DataFrame, int]:
    """``(k, w, lang, word, a)`` of every phrase of at most ``max_words`` words with a count ``a`` of ``min_count`` or
    more (``w``: its words' hashes; ``lang`` and ``word`` where it is one word), and per lang the phrase of no words with the
    number of all words; and the number of full passes.

    ``docs(lang, text)``.  The sample's threshold is lowered to 0.8 of its share of ``min_count`` (2 at least).  The proposals
    reach the tasks as a Bloom filter of fixed size: what it holds beside them is counted too, which costs time and changes no
    result; a phrase's parts decide alone in which pass it is counted, so it is counted once.
    """
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(shuffle_partitions(docs.sparkSession), -(-size // PART_BYTES))
    w = F.slice(F.array(*_columns(max_words)), F.lit(1), F.greatest("k", F.lit(0))).alias("w")
    least = max(2, int(0.8 * fraction * min_count))
    chosen = docs.where(F.abs(F.xxhash64("lang", "text") % 1_000_003) < int(fraction * 1_000_003))
    shorter = F.slice(F.array(*_columns(max_words - 1)), F.lit(1), F.col("k")).alias("w")
    proposed = written(count_phrases(chosen, max_words - 1, least, parts, seed, every=True).where("k > 0").select(shorter), "phrases-proposed")
    new, old, passes, found = filter_of(proposed, filter_bits), None, 0, None
    while True:
        part = written(count_phrases(docs, max_words, min_count, parts, seed, new, old).select("k", w, "lang", "word", "a"), f"phrases-{passes}")
        if not part.where(F.col("k") == CLASH).isEmpty():
            return frequent_phrases(docs, max_words, min_count, fraction, filter_bits, seed + 1)
        found, passes = part if found is None else found.union(part), passes + 1
        more = new | filter_of(part.where(F.col("k").between(1, max_words - 1)), filter_bits)  # the failures alone add to it
        if np.array_equal(more, new):
            return found, passes
        new, old = more, new


# scores
# Joins with what was found are merge joins by hint: rows that explode or come from compressed files are many times larger than Spark takes
# them to be, and a side that it broadcasts for that is put together in the driver.

def scored(found: DataFrame) -> DataFrame:
    """``(k, w, a, l, r, score)`` of phrases of two words and more, by the cut with the lowest score."""
    cuts = found.where("k >= 2").select("w", "k", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    salt = F.pmod(F.xxhash64("w"), F.lit(SALTS)).cast("int")  # a very common word is a part of many phrases
    left, right = F.slice("w", F.lit(1), F.col("cut")), F.slice("w", F.col("cut") + 1, F.col("k"))
    sides = cuts.select("w", "k", "a", "cut", salt.alias("salt"), F.explode(F.array(
        F.struct(F.lit(True).alias("first"), left.alias("part")), F.struct(F.lit(False).alias("first"), right.alias("part")))).alias("s"))
    counts = found.where("k >= 1").select(F.col("w").alias("_part"), F.col("a").alias("count"),
                                          F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    both = sides.join(counts.hint("merge"), (F.col("s.part") == F.col("_part")) & (F.col("salt") == F.col("_salt")))
    cut = both.groupBy("w", "k", "a", "cut").agg(
        F.max(F.when(F.col("s.first"), F.col("count"))).alias("l"), F.max(F.when(~F.col("s.first"), F.col("count"))).alias("r"))

    def wide(c: str) -> Column:
        return F.col(c).cast("decimal(38,0)")

    cut = cut.withColumn("_up", F.lit(1000000).cast("decimal(38,0)") * wide("a") * wide("a")).withColumn("_down", wide("l") * wide("r"))
    cut = cut.withColumn("score", F.expr("cast(_up div _down as long)"))
    best = cut.groupBy("w", "k", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    return best.select("k", "w", "a", "b.l", "b.r", "b.score")


def standing(found: DataFrame, max_words: int, overlap: int = 50) -> DataFrame:
    """``w`` of the phrases that no longer one contains with ``overlap`` percent of their count."""
    phrases = found.where("k >= 2").select("w", "k", "a")
    if max_words < 3:
        return phrases.select("w")
    places = F.expr("flatten(transform(sequence(2, k - 1), j -> transform(sequence(1, k - j + 1), i -> slice(w, i, j))))")
    inside = phrases.where("k >= 3").select(F.col("a").alias("longer"), F.explode(places).alias("w"))
    most = inside.groupBy("w").agg(F.max("longer").alias("longer"))
    known = phrases.join(most.hint("merge"), "w", "left")
    return known.where(F.coalesce(100 * F.col("longer") < overlap * F.col("a"), F.lit(True))).select("w")


def spelled(phrases: DataFrame, found: DataFrame) -> DataFrame:
    """``phrases`` with ``phrase``, the words of ``w`` joined by blanks."""
    names = found.where("k = 1").select(F.element_at("w", 1).alias("_h"), "word")
    each = phrases.select("w", F.posexplode("w").alias("_i", "_h")).join(names.hint("merge"), "_h")
    texts = each.groupBy("w").agg(F.array_sort(F.collect_list(F.struct("_i", "word"))).alias("_t"))  # max_words each
    return phrases.join(texts.select("w", F.array_join(F.col("_t.word"), " ").alias("phrase")), "w")


def with_lang(phrases: DataFrame, found: DataFrame) -> DataFrame:
    """``phrases`` with the lang of their first word."""
    names = found.where("k = 1").select(F.element_at("w", 1).alias("_first"), "lang", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salt = F.pmod(F.xxhash64("w"), F.lit(SALTS)).cast("int")
    return phrases.withColumns({"_first": F.element_at("w", 1), "_salt": salt}).join(names.hint("merge"), ["_first", "_salt"]).drop("_first", "_salt")


def mine_phrases(docs: DataFrame, max_words: int = 3, min_count: int = 10, overlap: int = 50, top: int = 2000,
                 fraction: float = FRACTION, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each lang's ``top`` phrases by score, count and phrase.

    Texts are lower-cased (A-Z) and cut into pieces at ``.,;:!?`` and line ends, pieces into words at blanks and tabs.  A
    phrase of 2 to ``max_words`` words with ``a`` >= ``min_count`` occurrences inside pieces is cut in two parts with ``l`` and
    ``r`` occurrences; its score is floor(10^6 a^2 / (l r)) at the cut where that is lowest (then the first such cut).
    Phrases contained in a longer one with at least ``overlap`` percent of their count are dropped.  ``n`` counts the lang's
    words.  Arithmetic is exact (decimals of 38 digits; an overflow is an error in ANSI mode, never a wrong number).

    A null text is empty, a null lang is ``und``; repeated rows count as often as they stand there; an empty table, and a lang
    without such phrases, give no rows; other columns are not read.  Texts of any length are counted whole, in blocks.
    """
    rows = docs.select(F.coalesce(F.col("lang"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found, _ = frequent_phrases(rows, max_words, min_count, fraction, filter_bits)
    kept = with_lang(scored(found).join(standing(found, max_words, overlap).hint("merge"), "w"), found)
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))  # ties need the words
    best = written(kept.withColumn("rank", F.rank().over(first)).where(F.col("rank") <= top).drop("rank"), "phrases-best")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = spelled(best, found).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    words = found.where("k = 0").groupBy("lang").agg(F.sum("a").alias("n"))
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
