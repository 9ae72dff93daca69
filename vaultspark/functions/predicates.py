"""Change predicates used by the versioned (SCD2) satellites."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column


def changed(new: list[Column], old: list[Column], null_safe: bool = False) -> Column:
    """``new1 != old1 OR new2 != old2 ...``.

    Default is SQL three-valued logic: a NULL on either side is not a change
    (NULL != 'a' is NULL).  ``null_safe=True`` treats NULL as a value.
    """
    if null_safe:
        parts = [~n.eqNullSafe(o) for n, o in zip(new, old)]
    else:
        parts = [n != o for n, o in zip(new, old)]
    return reduce(lambda a, b: a | b, parts)


def new_or_changed(new: list[Column], old: list[Column], old_marker: Column, null_safe: bool = False) -> Column:
    """``changed(...) OR old_marker IS NULL`` -- key has no version yet or it differs."""
    return changed(new, old, null_safe) | old_marker.isNull()
