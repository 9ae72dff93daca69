"""SimHash near-duplicates found through the binary (23, 12) Golay code.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits (the last padded with zeros).  Every segment is
decoded to the indices of all Golay codewords within four bits: one index, or six for a word three bits from its
codeword.  Two words at most two bits apart always share an index.  Of at most four differing bits over three
segments, either one segment has none (then another has at most two), or all three have one or two.  So the keys
``(segment i exactly, an index of segment j)`` for the six ordered pairs and ``(an index of each segment)`` meet
for every pair of fingerprints within four bits; each meeting is verified by its exact bit distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultspark.llm.common import join_per_key, map_columns, shuffle_partitions, written
from vaultspark.llm.components import connected_components

SEGMENTS = ((0, 23), (23, 23), (46, 18))
GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
MAX_BITS = 4
GROUP_ROWS = 2048  # a larger group of one key is cut into pairs of blocks


# fingerprints

def fingerprint(text: str | None, width: int = 4) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(shingles), 65536):
        hashes = np.array([digest(s, 42) for s in shingles[at:at + 65536]], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(shingles), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """``(doc_id, fp)`` for every row; a null or blank text has fingerprint zero."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
    return map_columns(docs.select(F.col("doc_id").cast("long"), "text"), schema, "doc_id long, fp long",
                       lambda: lambda ids, texts: (ids, [fingerprint(t, width) for t in texts]))


# Golay keys

@lru_cache(maxsize=1)
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits, and for every syndrome its error patterns of up to four bits."""
    def remainder(v: int) -> int:
        for bit in range(22, 10, -1):
            if v >> bit & 1:
                v ^= GENERATOR << (bit - 11)
        return v

    unit = [remainder(1 << i) for i in range(23)]

    def table(first: int, bits: int) -> np.ndarray:
        out = np.zeros(1 << bits, np.int32)
        for i in range(bits):
            out[1 << i:2 << i] = out[:1 << i] ^ unit[first + i]
        return out

    errors = np.full((2048, 6), -1, np.int64)
    filled = np.zeros(2048, int)
    for weight in range(5):
        for places in combinations(range(23), weight):
            s = 0
            for p in places:
                s ^= unit[p]
            errors[s, filled[s]] = sum(1 << p for p in places)
            filled[s] += 1
    return table(0, 12), table(12, 11), errors


def codeword_indices(words: np.ndarray) -> np.ndarray:
    """For 23-bit words: the 12-bit indices of all codewords within four bits, six columns, -1 for none."""
    low, high, errors = _golay()
    words = words.astype(np.int64)
    found = errors[low[words & 0xFFF] ^ high[words >> 12]]
    return np.where(found < 0, -1, (words[:, None] ^ found) >> 11)


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (key, position in fps) pairs."""
    u = fps.astype(np.uint64)
    exact = [((u >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
    near = [codeword_indices(x) for x in exact]
    keys, rows = [], []

    def add(kind: int, value: np.ndarray, valid: np.ndarray) -> None:
        keep = valid.reshape(len(fps), -1)
        keys.append((value.reshape(len(fps), -1)[keep]) | (kind << 36))
        rows.append(np.nonzero(keep)[0])

    kind = 0
    for i in range(3):
        for j in range(3):
            if i != j:
                add(kind, (exact[i][:, None] << 12) | np.maximum(near[j], 0), near[j] >= 0)
                kind += 1
    a, b, c = near[0][:, :, None, None], near[1][:, None, :, None], near[2][:, None, None, :]
    add(kind, (np.maximum(a, 0) << 24) | (np.maximum(b, 0) << 12) | np.maximum(c, 0), (a >= 0) & (b >= 0) & (c >= 0))
    return np.concatenate(keys), np.concatenate(rows)


# verified links within the groups of a key

def _forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the fingerprints within ``max_bits`` of each other: at most one per row."""
    near = np.empty((len(fps), len(fps)), bool)
    for at in range(0, len(fps), 256):
        near[at:at + 256] = np.bitwise_count(fps[at:at + 256, None] ^ fps[None, :]) <= max_bits
    label = np.arange(len(fps))
    while True:
        new = np.array([label[row].min() for row in near])
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    linked = label != np.arange(len(fps))
    return fps[linked], fps[label[linked]]


def _linker(max_bits: int, limit: int | None):
    """Per partition sorted by key: forest links of every key's group; a group over ``limit`` rows is handed on row
    by row (``u`` the key, ``v`` the fingerprint, ``rest`` true) for the exact block-pair step."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("rest", pa.bool_())])

    def out(u: list[np.ndarray], v: list[np.ndarray], rest: bool) -> pa.RecordBatch:
        a = np.concatenate(u).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(np.concatenate(v).view(np.int64)),
                                           pa.array(np.full(len(a), rest))], schema=schema)

    def groups(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        two = starts[sizes == 2]
        two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= max_bits]
        us, vs = [fp[two]], [fp[two + 1]]
        for s, n in zip(starts[sizes > 2], sizes[sizes > 2]):
            u, v = _forest(fp[s:s + n], max_bits)
            us.append(u)
            vs.append(v)
        if sum(map(len, us)):
            yield out(us, vs, False)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp, handed = np.empty(0, np.int64), np.empty(0, np.uint64), None
        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False)
            f = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if handed is not None:
                n = np.searchsorted(k, handed, side="right")
                if n:
                    yield out([k[:n]], [f[:n]], True)
                k, f = k[n:], f[n:]
            if not len(k):
                continue
            handed = None
            key, fp = np.concatenate([key, k]), np.concatenate([fp, f])
            start = np.searchsorted(key, key[-1], side="left")
            yield from groups(key[:start], fp[:start]) if start else ()
            key, fp = key[start:], fp[start:]
            if limit and len(key) > limit:
                handed = key[0]
                yield out([key], [fp], True)
                key, fp = key[:0], fp[:0]
        if len(key):
            yield from groups(key, fp)

    return scan


def _links_of(keyed: DataFrame, max_bits: int, limit: int | None, name: str) -> DataFrame:
    dealt = keyed.repartition("key").sortWithinPartitions("key", "fp")
    return written(dealt.mapInArrow(_linker(max_bits, limit), "u long, v long, rest boolean"), name)


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links ``(u, v)`` between different fingerprints whose connected components are those of all pairs within
    ``max_bits`` (at most 4).  A group never yields more links than rows."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("the Golay keys are exact for up to 4 differing bits")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fp), 2000):
                part = fp[at:at + 2000]
                key, row = golay_keys(part)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row])], names=["key", "fp"])

    distinct = fps.select("fp").distinct().repartition(shuffle_partitions(fps.sparkSession))
    found = _links_of(distinct.mapInArrow(keyed, "key long, fp long"), max_bits, group_rows, "links")
    links = found.where("NOT rest").select("u", "v")
    rest = found.where("rest").select(F.col("u").alias("key"), F.col("v").alias("fp"))
    if not rest.isEmpty():  # groups over the limit, exactly: every pair of blocks is one group
        blocks = rest.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / (group_rows // 2)).alias("n"))
        block = rest.join(blocks, "key").withColumn("b", F.pmod(F.xxhash64("fp"), F.col("n")))
        pairs = block.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select(
            F.xxhash64("key", F.least("b", "o"), F.greatest("b", "o")).alias("key"), "fp")
        links = links.union(_links_of(pairs, max_bits, None, "block-links").select("u", "v"))
    return links.distinct()


def near_duplicates(docs: DataFrame, width: int = 4, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs(doc_id, text)``.

    component_id is the smallest doc_id among the rows reachable through links of at most ``max_bits`` bits.
    Rows with equal fingerprints (copies, all blank texts) are one node; repeated rows stay repeated; a null doc_id
    is kept and never is a component's id unless its component has no other.  An empty table gives no rows.
    """
    fps = written(fingerprints(docs, width), "fingerprints")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("held"))
    parts = written(connected_components(fingerprint_links(nodes, max_bits)), "components")
    lows = (parts.join(nodes, parts["node"] == nodes["fp"]).groupBy("root").agg(F.min("low").alias("component_id")))
    linked = parts.join(lows, "root").select(F.col("node").alias("fp"), "component_id")
    class_of = written(nodes.join(linked, "fp", "left").select(
        "fp", "held", F.coalesce("component_id", "low").alias("component_id")), "classes")
    return join_per_key(fps, class_of, ["fp"], "held").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, width: int = 4, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` whose doc_id is their component's smallest; all columns stay.

    A null doc_id stays only if its component has no other id; of repeated rows with one doc_id all stay or go."""
    classes = near_duplicates(docs, width, max_bits)
    gone = classes.where("doc_id <> component_id OR (doc_id IS NULL AND component_id IS NOT NULL)").select(
        F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_gone"]), "left_anti")
