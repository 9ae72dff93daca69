"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultspark.llm.common import shuffle_partitions, written

WEIGHTS = (5, 2, 1)  # by a source's place in code-point order, repeating
CAP = 3  # copies of a source at most
SEED = "mix"
POSITION_BITS = 33  # monotonically_increasing_id(): partition index << 33 | row position
OWN = ("size", "source_size", "target", "copies")


def word_count(text: Column) -> Column:
    """Number of runs of characters other than blanks; one mark a word is counted, no array of words is built."""
    marks = F.regexp_replace(F.regexp_replace(text, r"[^\x20\x09-\x0D]++", "x"), r"[\x20\x09-\x0D]++", "")
    return F.octet_length(marks).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sources(source, source_size, source_rows)`` plus ``target`` and ``rate`` (copies of each of its documents).

    Sources share the sum of all sizes by weight; a target stops at ``cap`` times its source's size and the excess is
    shared again by weight, until none is above.  Resharing raises all open targets by one factor, so sources stop in
    the order of size to weight: a source is stopped if, all before it being stopped, its share reaches its cap.  One row
    a source; targets are quotients of exact whole numbers.
    """
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.col("_nr"), F.lit(len(weights))) + 1).cast("int"))
    one = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sources.withColumn("_nr", F.row_number().over(one) - 1).withColumn("_w", w.cast("decimal(10,0)"))
    size = F.col("source_size").cast("decimal(19,0)")
    stops = Window.orderBy(F.col("source_size") / F.col("_w"), "_nr")
    before, everything = stops.rowsBetween(Window.unboundedPreceding, -1), Window.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (rows.withColumn("_left", F.sum(size).over(everything) - cap * F.coalesce(F.sum(size).over(before), F.lit(0)))
            .withColumn("_open", F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0)))
            .withColumn("_stopped", F.col("_left") * F.col("_w") >= cap * size * F.col("_open")))
    first = F.min(F.when(~F.col("_stopped"), F.struct(F.col("source_size") / F.col("_w"), "_nr", "_left", "_open"))).over(everything)
    share = (first["_left"] * F.col("_w")).cast("double") / first["_open"].cast("double")
    rows = rows.withColumn("target", F.when(F.col("_stopped"), (cap * size).cast("double")).otherwise(share))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return rows.withColumn("rate", rate).select("source", "source_size", "source_rows", "target", "rate")


def start(source: Column, seed: str) -> Column:
    """The random offset of a source: 52 bits of an MD5 of the seed and the source, as a share of 1."""
    name = F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED,
                carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` and, for every row of ``docs``, ``size`` (words), ``source_size``, ``target`` (words its source is to
    give) and ``copies`` (how often the mix takes the document).

    A source's documents lie in order of size, doc_id and text hash; each counts for target / source size copies, and it
    is taken once per whole number that the running sum, started at the source's random offset, crosses in it.  In order
    of size the words taken differ from the target by less than the source's longest document.  The same rows
    and seed give the same copies.

    Documents are range-partitioned by (source, size, ..), so that a source that holds a third of all rows spreads over
    many partitions; a row's place in its source is its place in the partition plus the rows of the partitions before.
    The tables joined back have one row a source and one a partition and source; nothing is broadcast by hint.

    A null text has size 0; a null source is a source of its own, after all others; a null doc_id is sorted first.  A
    source without words has target 0 and no copies.  Rows equal in source, size, doc_id and text are interchangeable.  An
    empty table gives no rows.  Carried columns named like one of the results are left out.
    """
    spark = docs.sparkSession
    kept = [c for c in carry if c not in OWN]
    sized = docs.select(F.struct(*[F.col(c) for c in kept]).alias("_row"), F.col("source").alias("_source"),
                        F.coalesce(word_count(F.col("text")), F.lit(0)).alias("size"), F.col("doc_id").alias("_id"),
                        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_hash"),
                        F.monotonically_increasing_id().alias("_tie"))  # spreads repeated rows
    order = ("_source", "size", "_id", "_hash", "_tie")
    ranged = (sized.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
              .withColumn("_at", F.monotonically_increasing_id()))
    ranged = written(ranged.drop("_id", "_hash", "_tie"), "mix-ranges").withColumn("_part", F.shiftright("_at", POSITION_BITS))
    parts = written(ranged.groupBy("_source", "_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("size").alias("_size"), F.min("_at").alias("_first")), "mix-parts")
    sources = parts.groupBy(F.col("_source").alias("source")).agg(
        F.sum("_size").alias("source_size"), F.sum("_rows").alias("source_rows"))
    before = Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    places = parts.select("_source", "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    targets = source_targets(sources, weights, cap)
    places = written(places.join(targets, F.col("_source").eqNullSafe(F.col("source"))).select(
        F.col("_source").alias("_s"), F.col("_part").alias("_p"), "_first", "_before", "source_size", "target", "rate",
        start(F.col("source"), seed).alias("_offset")), "mix-places")
    rows = ranged.join(places, (F.col("_part") == F.col("_p")) & F.col("_source").eqNullSafe(F.col("_s")))
    nr = F.col("_before") + F.col("_at") - F.col("_first")  # from 0 in the source
    whole, part = F.floor("rate"), F.col("rate") - F.floor("rate")  # whole copies need no running sum
    crossed = F.floor(F.col("_offset") + part * (nr + 1)) - F.floor(F.col("_offset") + part * nr)
    return rows.select(*[F.col("_row")[c].alias(c) for c in kept], "size", "source_size", "target",
                       (whole + F.least(crossed, F.lit(1))).cast("long").alias("copies"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every column of ``docs``, each row as often as it is taken, numbered by ``copy`` from 1."""
    columns = [c for c in docs.columns if c not in (*OWN, "copy")]
    taken = mix_sources(docs, carry=tuple(columns), **options).where(F.col("copies") > 0)
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*columns, "copy")
