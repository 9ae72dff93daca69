"""Column-level helpers: time, JSON, keys and change predicates."""

from vaultspark.functions.keys import hash_key
from vaultspark.functions.predicates import changed, new_or_changed
from vaultspark.functions.time import (
    LOW_WATERMARK,
    OPEN_TO,
    day_lit,
    in_days,
    local_day,
    minus_one_ms,
    on_day,
    ts_lit,
)

__all__ = [
    "LOW_WATERMARK", "OPEN_TO", "changed", "day_lit", "hash_key", "in_days",
    "local_day", "minus_one_ms", "new_or_changed", "on_day", "ts_lit",
]
