"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_key(col: Column | str) -> Column:
    """Order-free, restart-safe surrogate key: hex SHA-256 of the business key."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sha2(c.cast("string"), 256)


def packed_keys(df: DataFrame, *columns: str) -> DataFrame:
    """String columns as bytes for a shuffle: lower-case hex in half its length, anything else as it is, told apart by the first byte.
    Columns of other types stay."""
    def packed(c: Column) -> Column:
        raw = F.unhex(c)
        return F.when(F.lower(F.hex(raw)) == c, F.concat(F.lit(b"\x01"), raw)).otherwise(F.concat(F.lit(b"\x00"), c.cast("binary")))

    types = dict(df.dtypes)
    return df.withColumns({c: packed(F.col(c)) for c in columns if types[c] == "string"})


def unpacked_keys(df: DataFrame, *columns: str) -> DataFrame:
    """``packed_keys`` undone."""
    def unpacked(c: Column) -> Column:
        rest = F.substring(c, F.lit(2), F.length(c))
        return F.when(F.substring(c, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))

    types = dict(df.dtypes)
    return df.withColumns({c: unpacked(F.col(c)) for c in columns if types[c] == "binary"})
