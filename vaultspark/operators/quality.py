"""Declared constraints as data-quality operators.

Plain parquet enforces no NOT NULL / UNIQUE / FOREIGN KEY / CHECK, so the
rules of the declared tables are applied as DataFrame operators.  ``check``
adds a ``rule`` column (the first violated rule, NULL for a valid row);
``split_valid`` returns ``(valid, rejected)``; ``on_violation="fail"`` raises
like the database statement would.  ``validate`` and ``enforce`` are the forms for
loads: the input is evaluated once, and all rules that a row breaks are named.

Row rules are plain expressions.  UNIQUE and FOREIGN KEY need a join: the
duplicate keys / referenced keys are first reduced to one row per key (partial
aggregation before the shuffle), so a hot key does not grow the join.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultspark.schemas import DEFAULTS, FOREIGN_KEYS, RULES, TABLES
from vaultspark.session import shared_dir


class RuleViolation(Exception):
    pass


@dataclass(frozen=True)
class Rule:
    name: str

    def prepare(self, df: DataFrame, i: int) -> tuple[DataFrame, Column]:
        """Return ``df`` (possibly with helper columns) and a violation flag."""
        raise NotImplementedError


@dataclass(frozen=True)
class NotNull(Rule):
    column: str = ""

    def prepare(self, df, i):
        return df, F.col(self.column).isNull()


@dataclass(frozen=True)
class Unique(Rule):
    columns: tuple[str, ...] = ()

    def prepare(self, df, i, rows=None):
        """``rows``: where the keys are counted, if not in ``df`` itself."""
        cols = list(self.columns)
        flag = f"_dup{i}"
        complete = (df if rows is None else rows).where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
        dups = complete.groupBy(*cols).count().where(F.col("count") > 1).select(*cols, F.lit(True).alias(flag))
        return df.join(dups, cols, "left"), F.coalesce(F.col(flag), F.lit(False))


@dataclass(frozen=True)
class ForeignKey(Rule):
    column: str = ""
    ref: DataFrame | None = field(default=None, compare=False)
    ref_column: str = ""

    def prepare(self, df, i):
        flag = f"_fk{i}"
        # Referenced keys cut to the keys present in df first (small side on the right of each join).
        wanted = df.select(self.column).where(F.col(self.column).isNotNull()).dropDuplicates([self.column])
        keys = self.ref.select(F.col(self.ref_column).alias(self.column)).join(wanted, self.column, "left_semi")
        keys = keys.dropDuplicates([self.column]).select(self.column, F.lit(True).alias(flag))
        joined = df.join(keys, self.column, "left")
        return joined, F.col(self.column).isNotNull() & F.col(flag).isNull()

    def orphans(self, df, i, rows):
        """Like ``prepare``, with the keys of ``rows`` that the reference lacks on the joined side (none, as a rule)."""
        flag = f"_fk{i}"
        wanted = rows.select(self.column).where(F.col(self.column).isNotNull()).dropDuplicates([self.column])
        known = self.ref.select(F.col(self.ref_column).alias(self.column)).join(wanted, self.column, "left_semi")
        lost = wanted.join(known, self.column, "left_anti").select(self.column, F.lit(True).alias(flag))
        return df.join(lost, self.column, "left"), F.coalesce(F.col(flag), F.lit(False))


@dataclass(frozen=True)
class LowerBound(Rule):
    column: str = ""
    bound: object = 0
    inclusive: bool = True

    def prepare(self, df, i):
        c, b = F.col(self.column), F.lit(self.bound)
        ok = (c >= b) if self.inclusive else (c > b)
        return df, ~F.coalesce(ok, F.lit(True))  # a CHECK passes on NULL


@dataclass(frozen=True)
class InRange(Rule):
    column: str = ""
    lo: object = None
    hi: object = None

    def prepare(self, df, i):
        ok = F.col(self.column).between(F.lit(self.lo), F.lit(self.hi))
        return df, ~F.coalesce(ok, F.lit(True))


@dataclass(frozen=True)
class MaxLength(Rule):
    column: str = ""
    length: int = 0

    def prepare(self, df, i):
        return df, F.coalesce(F.length(self.column) > self.length, F.lit(False))


@dataclass(frozen=True)
class Ordered(Rule):
    """``lo <= hi`` when both are set (a version must not end before it starts)."""
    lo: str = ""
    hi: str = ""

    def prepare(self, df, i):
        return df, F.coalesce(F.col(self.hi) < F.col(self.lo), F.lit(False))


@dataclass(frozen=True)
class Conforms(Rule):
    """Value (often JSON text) fits the declared type: a non-NULL that the cast cannot take."""
    column: str = ""
    type: str = "string"

    def prepare(self, df, i):
        c = F.col(self.column)
        return df, c.isNotNull() & c.try_cast(self.type).isNull()


def not_null(*cols: str) -> list[Rule]:
    return [NotNull(f"not_null:{c}", c) for c in cols]


def unique(*cols: str) -> Rule:
    return Unique(f"unique:{','.join(cols)}", tuple(cols))


def foreign_key(col: str, ref: DataFrame, ref_col: str) -> Rule:
    return ForeignKey(f"foreign_key:{col}", col, ref, ref_col)


def lower_bound(col: str, bound, inclusive: bool = True) -> Rule:
    return LowerBound(f"lower_bound:{col}", col, bound, inclusive)


def in_range(col: str, lo, hi) -> Rule:
    return InRange(f"range:{col}", col, lo, hi)


def max_length(col: str, n: int) -> Rule:
    return MaxLength(f"max_length:{col}", col, n)


def ordered(lo: str, hi: str) -> Rule:
    return Ordered(f"ordered:{lo},{hi}", lo, hi)


def conforms(col: str, type_: str) -> Rule:
    return Conforms(f"type:{col}", col, type_)


def declared_rules(table: str, refs: dict[str, tuple[DataFrame, str]] | None = None) -> list[Rule]:
    """Rules declared for ``table`` (``schemas.RULES``), plus foreign keys given in ``refs``
    (``column -> (referenced table, referenced column)``)."""
    out: list[Rule] = []
    for spec in RULES.get(table, []):
        kind = spec[0]
        if kind == "not_null":
            out += not_null(*spec[1])
        elif kind == "unique":
            out.append(unique(*spec[1]))
        elif kind == "lower_bound":
            out.append(lower_bound(spec[1], spec[2], spec[3]))
        elif kind == "range":
            out.append(in_range(spec[1], spec[2], spec[3]))
        elif kind == "max_length":
            out.append(max_length(spec[1], spec[2]))
    for col, (ref, ref_col) in (refs or {}).items():
        out.append(foreign_key(col, ref, ref_col))
    return out


def rules_of(df: DataFrame, table: str, hubs: dict[str, DataFrame] | None = None, keys: bool = True) -> list[Rule]:
    """The declared rules of ``table`` whose columns ``df`` holds (a load's batch lacks the columns the load fills), with its
    references to ``hubs`` (table name -> hub).  ``keys=False`` leaves uniqueness out, for batches that are yet to be upserted."""
    def columns(rule: Rule) -> tuple[str, ...]:
        return rule.columns if isinstance(rule, Unique) else (rule.column,)

    refs = {c: (hubs[h], c) for c, h in FOREIGN_KEYS.get(table, {}).items() if hubs and h in hubs}
    return [r for r in declared_rules(table, refs) if set(columns(r)) <= set(df.columns) and (keys or not isinstance(r, Unique))]


def check(df: DataFrame, rules: list[Rule], rule_col: str = "rule") -> DataFrame:
    """``df`` plus ``rule``: name of the first violated rule, NULL when the row is valid."""
    cols = df.columns
    flags = []
    cur = df
    for i, r in enumerate(rules):
        cur, flag = r.prepare(cur, i)
        flags.append(F.when(flag, F.lit(r.name)))
    verdict = F.coalesce(*flags) if flags else F.lit(None).cast("string")
    return cur.select(*cols, verdict.cast("string").alias(rule_col))


def split_valid(df: DataFrame, rules: list[Rule], on_violation: str = "split",
                rule_col: str = "rule") -> tuple[DataFrame, DataFrame]:
    """``(valid rows, rejected rows with rule)``; ``on_violation="fail"`` raises on any rejected row."""
    checked = check(df, rules, rule_col)
    valid = checked.where(F.col(rule_col).isNull()).drop(rule_col)
    rejected = checked.where(F.col(rule_col).isNotNull())
    if on_violation == "fail":
        bad = rejected.select(rule_col).limit(1).collect()
        if bad:
            raise RuleViolation(f"rule violated: {bad[0][0]}")
    elif on_violation != "split":
        raise ValueError(on_violation)
    return valid, rejected


def validate(df: DataFrame, rules: list[Rule], name: str = "rules") -> DataFrame:
    """``df`` plus the names of all rules a row breaks, in the order of ``rules`` (an empty array for a valid row).

    Rules over several rows read the input again, so with one of them it is first written once (a reliable checkpoint): the
    plan behind it runs once whatever the number of rules.  What is joined back has one row per bad key: keys held more
    than once, and keys of a reference that lacks them, found from the distinct keys of the input.
    """
    shared = any(isinstance(r, Unique | ForeignKey) for r in rules)
    if shared:
        shared_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    out, flags = df, []
    for i, r in enumerate(rules):
        if isinstance(r, Unique):
            out, flag = r.prepare(out, i, df)
        elif isinstance(r, ForeignKey):
            out, flag = r.orphans(out, i, df)
        else:
            out, flag = r.prepare(out, i)
        flags.append(F.when(flag, F.lit(r.name)))
    broken = F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")
    return out.select(*df.columns, broken.alias(name))


def enforce(df: DataFrame, rules: list[Rule], on_violation: str = "split", name: str = "rules") -> tuple[DataFrame, DataFrame]:
    """``(valid rows, rejected rows with the array of rules they break)``; ``on_violation="fail"`` raises on any rejected row."""
    if on_violation not in ("split", "fail"):
        raise ValueError(on_violation)
    checked = validate(df, rules, name)
    rejected = checked.where(F.size(name) > 0)
    if on_violation == "fail" and (bad := rejected.select(name).limit(1).collect()):
        raise RuleViolation(f"rules violated: {', '.join(bad[0][0])}")
    return checked.where(F.size(name) == 0).drop(name), rejected


def apply_defaults(df: DataFrame, defaults: dict[str, object] | str) -> DataFrame:
    """Fill NULLs with the declared column defaults (``coalesce``); opt-in."""
    if isinstance(defaults, str):
        defaults = DEFAULTS[defaults]
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in defaults.items()})


def conform_types(df: DataFrame, table: str) -> list[Rule]:
    """Type rules for the columns of ``df`` against declared table ``table``."""
    decl = {f.name: f.dataType for f in TABLES[table].fields}
    return [conforms(c, decl[c].simpleString()) for c in df.columns
            if c in decl and not isinstance(decl[c], T.StringType)]
