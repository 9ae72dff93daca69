"""Exact line dedup across documents that returns per-document bitmaps instead of text (native columns only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultspark.llm.common import shuffle_partitions, text_or_empty, written

BLANK = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_ID = -(2 ** 63)  # stands for a null doc_id


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z lower-cased (``lower`` does that where every character is one byte)."""
    bare = F.btrim(line, F.lit(BLANK))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


HOT_SAMPLE = 64  # rows a shuffle partition in the sample that finds the hot lines
HOT_SEEN = 8  # rows of a line in that sample that make it hot


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """``(h1, h2, _id, _text_hash, pos)``: the 128-bit key hash of every line with a key of at least ``min_chars``."""
    rows = docs.select(  # rows that share doc_id and text are interchangeable: (_id, _text_hash) names them
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64(text_or_empty()).alias("_text_hash"),
        F.posexplode(_lines(text_or_empty())).alias("pos", "line"))
    key = rows.where(F.char_length("line") >= min_chars).withColumn("key", line_key(F.col("line")))
    return key.where(F.char_length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "_id", "_text_hash", "pos")


def hot_lines(hashes: DataFrame, partitions: int) -> DataFrame:
    """``(h1, h2, docs, keeper)`` of lines with more rows than about a quarter of a range partition, each over all its rows.

    They are found in a sample of ``HOT_SAMPLE`` rows a partition, so there are at most ``HOT_SAMPLE / HOT_SEEN`` times the
    partitions of them; which lines the sample finds changes the work's spread, not the result.
    """
    share = min(1.0, HOT_SAMPLE * partitions / max(1, hashes.count()))  # the count comes from the files' footers
    seen = hashes.sample(share, seed=11).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("_n"))
    names = seen.where(F.col("_n") >= HOT_SEEN).select("h1", "h2")
    rows = hashes.select("h1", "h2", "_id").join(F.broadcast(names), ["h1", "h2"], "left_semi").distinct()
    return rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("_id").alias("keeper"))


def line_drops(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``(_id, _text_hash, n_dropped, kept)``: the documents that lose lines.

    ``kept`` is a compressed bitmap ``array<struct<word int, bits long>>``: bit ``i % 64`` of word ``i div 64`` is set if line
    ``i`` stays; words that keep all their 64 lines are left out, as are documents that lose nothing.

    Line hashes are range-partitioned and sorted by (hash, document, position), largest document first.  A stream over each
    sorted run tells the first document of a line from the later ones and counts them; a range never splits a run.  The few
    lines with more rows than that would balance (``hot_lines``, a bounded number) don't take part in the shuffle: what is
    kept of them is found by a distinct count, broadcast, and applied where their rows are.  Documents are told apart by doc_id.
    """
    parts = shuffle_partitions(docs.sparkSession)
    hashes = written(line_hashes(docs, min_chars), "line-hashes")
    hot = written(hot_lines(hashes, parts), "hot-lines").withColumnsRenamed({"h1": "_h1", "h2": "_h2"})
    marked = hashes.join(F.broadcast(hot), (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left")
    known = marked.where(F.col("_h1").isNotNull() & (F.col("docs") >= min_docs) & (F.col("_id") != F.col("keeper")))

    run = Window.partitionBy("h1", "h2")  # satisfied by the range partitioning: no further shuffle
    stream = marked.where(F.col("_h1").isNull()).select(*hashes.columns).repartitionByRange(parts, "h1", "h2")
    order = run.orderBy(F.desc("_id"), "pos")
    first = F.coalesce(F.lag("_id").over(order) != F.col("_id"), F.lit(True))  # a line's first place in a document
    ranked = stream.withColumn("first", first).withColumn("nr", F.sum(F.col("first").cast("long")).over(
        order.rowsBetween(Window.unboundedPreceding, 0)))
    found = ranked.withColumn("docs", F.max("nr").over(run)).where((F.col("docs") >= min_docs) & (F.col("nr") > 1))

    drops = known.select("_id", "_text_hash", "pos").union(found.select("_id", "_text_hash", "pos"))
    words = drops.groupBy("_id", "_text_hash", F.expr("pos div 64").cast("int").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, pos % 64))").alias("gone"))
    return words.groupBy("_id", "_text_hash").agg(
        F.sum(F.bit_count("gone")).cast("long").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("kept"))


def kept_text(text: Column, kept: Column) -> Column:
    """The lines whose bit is set, joined by a line feed."""
    words = F.map_from_entries(kept)
    last = F.try_element_at(kept, F.lit(-1))["word"]
    dense = F.transform(F.sequence(F.lit(0), last), lambda w: F.coalesce(F.try_element_at(words, w), F.lit(-1).cast("long")))

    def stays(_, i):
        word = F.try_element_at(dense, F.expr("1") + F.floor(i / 64).cast("int"))
        return F.coalesce(F.getbit(word, F.pmod(i, F.lit(64))), F.lit(1)) == 1

    return F.array_join(F.filter(_lines(text), stays), "\n")


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, counts: bool = True) -> DataFrame:
    """``docs`` with ``n_lines`` (before), ``n_dropped`` and ``text`` without the dropped lines; without ``counts`` only the
    columns of ``docs``, in their order.

    A line's key of at least ``min_chars`` code points found in at least ``min_docs`` documents stays only in the
    largest doc_id that holds it (there, in all its places).  A null or empty text is one empty line; a null text
    stays null; a null doc_id counts as one document below all others; repeated rows are treated alike; other
    columns pass through (with ``counts``, columns of these names give way).  An empty table gives no rows.
    """
    drops = line_drops(docs, min_chars, min_docs)
    doc_id = F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID))
    text = F.coalesce(docs["text"], F.lit(""))
    joined = docs.join(drops, (doc_id == drops["_id"]) & (F.xxhash64(text) == drops["_text_hash"]), "left")
    left = F.when(drops["kept"].isNull(), docs["text"]).otherwise(kept_text(docs["text"], drops["kept"])).alias("text")
    if not counts:
        return joined.select(*[left if c == "text" else docs[c] for c in docs.columns])
    cols = [docs[c] for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    return joined.select(*cols, F.size(_lines(text)).cast("long").alias("n_lines"),
                         F.coalesce(drops["n_dropped"], F.lit(0)).cast("long").alias("n_dropped"), left)
