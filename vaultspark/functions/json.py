"""JSON text <-> columns.

Documents are staged as JSON text, as the source system delivers them.  They
are parsed with an explicit minimal schema (only the fields a load reads) and
string leaves; values are then cast with ANSI casts, so text that does not fit
the target type fails the load instead of becoming NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# to_json options: keep NULL fields (the source prints them) and write
# zone-less times as 'yyyy-MM-dd HH:mm:ss.SSSSSS' (no 'T', no precision lost).
WRITE_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}
# Malformed JSON stops the load, like the source's json.loads would.
READ_OPTIONS = {"mode": "FAILFAST"}


def to_document(df: DataFrame, key: str = "_id", ts: str = "update_ts",
                extra: dict[str, Column] | None = None) -> DataFrame:
    """Source objects -> staging rows ``(object_id, object_value, update_ts, <extra>)``.

    ``object_value`` is the whole object as JSON text.  ``extra`` adds typed
    columns derived from the object (e.g. the business date of an order), so
    that day slices filter and prune on a column instead of parsing every text.
    """
    cols = [
        F.col(key).cast("string").alias("object_id"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns]), WRITE_OPTIONS).alias("object_value"),
        F.col(ts).cast("timestamp_ntz").alias("update_ts"),
    ]
    cols += [c.alias(n) for n, c in (extra or {}).items()]
    return df.select(*cols)


def to_order_document(df: DataFrame) -> DataFrame:
    """Order objects -> staged orders, with the business date as a typed column."""
    return to_document(df, extra={"order_date": F.col("date").cast("date")})


def string_schema(spec: dict) -> T.DataType:
    """Nested ``{"field": None | [ {...} ] | {...}}`` spec -> schema with string leaves."""
    if isinstance(spec, list):
        return T.ArrayType(string_schema(spec[0]))
    if isinstance(spec, dict):
        return T.StructType([T.StructField(k, string_schema(v)) for k, v in spec.items()])
    return T.StringType()


def parse(col: Column | str, spec: dict, mode: str = "FAILFAST") -> Column:
    """Parse JSON text once into a struct holding only the fields in ``spec``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, string_schema(spec), {"mode": mode})


def to_outbox(events: DataFrame, event_type: str = "bonus_transaction") -> DataFrame:
    """Outbox events with the business date of bonus transactions as a typed column (NULL for other events).

    A malformed transaction fails the staging, as it would fail the load that reads it.
    """
    date = parse("event_value", {"order_date": None})["order_date"].cast("date")
    return events.withColumn("order_date", F.when(F.col("event_type") == event_type, date))


def json_field(col: Column | str, path: str) -> Column:
    """``v::JSON->>'a'`` / ``(v::JSON->>'a')::JSON->>'b'`` as ``$.a.b`` text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.get_json_object(c, path)
