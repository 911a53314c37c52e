"""Declarative data-quality checks with severities, a one-pass report and
source freshness.

Each ``check_*`` returns the *failing rows* relation (lazy). ``quality_report``
evaluates many checks and returns one row per check:
``(relation, check, columns, severity, n_failed, status)``. All checks of one
relation are folded into a **single** aggregation: conditional counts for
row-level checks, grouping sets for uniqueness and accepted values. A
relationship check counts rows per key beside it. ``key_counts``,
``merge_counts`` and ``broken_by`` keep a uniqueness check over loads: counts
per key that add up, so that a load checks only the keys that it brings.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from dataclasses import field as dc_field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def _cols(c) -> list[str]:
    return [c] if isinstance(c, str) else list(c)


# ---- failing-row relations ------------------------------------------------

def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """One row per duplicated non-null value with its count."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def check_unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per repeated combination; null combinations group too."""
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def _not_accepted(col: str, values: Sequence) -> Column:
    # null is accepted: ~isin(...) is null for a null input, so it never fails
    return ~F.col(col).isin(list(values))


def check_accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """One row per distinct unexpected value with its count (null passes)."""
    return (df.where(_not_accepted(col, values)).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")))


def check_relationships(df: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-null ``col`` has no ``parent.field`` (anti-join)."""
    p = parent.select(F.col(field).alias(col))
    return df.where(F.col(col).isNotNull()).join(p, col, "left_anti")


def check_expression(df: DataFrame, expr: str) -> DataFrame:
    """Rows where the SQL ``expr`` is false (null is not a failure)."""
    return df.where(~F.expr(expr))


def check_range(df: DataFrame, col: str, low, high) -> DataFrame:
    """Rows outside ``[low, high]`` (null is not a failure)."""
    return df.where(~F.col(col).between(low, high))


def check_positive(df: DataFrame, col: str) -> DataFrame:
    """Rows with ``col <= 0`` (null is not a failure)."""
    return df.where(F.col(col) <= 0)


# ---- freshness --------------------------------------------------------------

def freshness(df: DataFrame, loaded_at: str, as_of=None, warn_hours: float = 24,
              error_hours: float = 48, relation: str | None = None) -> DataFrame:
    """One row: ``max_loaded_at``, ``age_hours`` (vs ``as_of``, default now)
    and ``status`` pass/warn/error. An empty table is ``error``."""
    now = (F.current_timestamp().cast("timestamp_ntz") if as_of is None
           else F.lit(str(as_of)).cast("timestamp_ntz"))
    agg = df.agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("max_loaded_at"))
    # wall-clock difference of two timestamp_ntz values: independent of the
    # session time zone (a cast to timestamp would shift by an hour over DST)
    age = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), now) / F.lit(3600e6)
    status = (F.when(F.col("max_loaded_at").isNull(), "error")
              .when(F.col("age_hours") > error_hours, "error")
              .when(F.col("age_hours") > warn_hours, "warn").otherwise("pass"))
    out = agg.select("max_loaded_at", age.alias("age_hours"))
    out = out.select("*", status.alias("status"))
    if relation is not None:
        out = out.select(F.lit(relation).alias("relation"), "*")
    return out


def freshness_report(sources: dict[str, tuple[DataFrame, str | None]], as_of=None, warn_hours: float = 24,
                     error_hours: float = 48) -> DataFrame:
    """``freshness`` of many sources in one report: one row per source, by its
    name. ``sources`` gives each table and its load column, or None for one
    that has none: the newest modification time of its files counts then
    (``_metadata.file_modification_time``, in UTC; no column is read)."""
    parts = []
    for name, (df, loaded_at) in sources.items():
        if loaded_at is None:
            df = df.select(F.to_utc_timestamp(F.col("_metadata.file_modification_time"), F.current_timezone()).cast("timestamp_ntz").alias("__t"))
        parts.append(freshness(df, loaded_at or "__t", as_of, warn_hours, error_hours, relation=name))
    if not parts:
        raise ValueError("no sources")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- uniqueness kept over loads --------------------------------------------------

def key_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mergeable state of a uniqueness check: rows per key."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))


def merge_counts(state: DataFrame, load: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The state after a load: both sides' counts added up, null keys too."""
    return state.unionByName(load).groupBy(*cols).agg(F.sum("n_records").alias("n_records"))


def broken_by(state: DataFrame, load: DataFrame, cols: Sequence[str], nulls_repeat: bool = True) -> DataFrame:
    """Keys of ``load`` (``key_counts``) that repeat within it or with
    ``state``, with their total count. Only the load's keys are looked up: the
    state is semi-joined, its other keys are never grouped. Without
    ``nulls_repeat`` a null key breaks nothing (as in ``unique``)."""
    same = reduce(and_, (F.col(f"s.{c}").eqNullSafe(F.col(f"l.{c}")) for c in cols))
    touched = state.alias("s").join(load.alias("l"), same, "left_semi")
    out = merge_counts(touched, load, cols).where(F.col("n_records") > 1)
    return out if nulls_repeat else out.dropna(subset=list(cols))


# ---- report -------------------------------------------------------------------

ROW_LEVEL = ("not_null", "expression", "range", "positive")


@dataclass
class Check:
    """One declared check. ``kind`` is one of not_null, unique,
    unique_combination, accepted_values, relationships, expression, range,
    positive. ``severity`` is ``error`` (default) or ``warn``."""
    relation: str
    kind: str
    columns: object = None
    severity: str = "error"
    values: Sequence = ()
    expr: str | None = None
    low: object = None
    high: object = None
    parent: DataFrame | None = dc_field(default=None, repr=False)
    field: str | None = None
    name: str | None = None
    parent_unique: bool = False   # the parent's field can't repeat (said for the reader; the anti-join needs no telling)

    @property
    def label(self) -> str:
        return self.name or f"{self.kind}:{','.join(_cols(self.columns)) if self.columns else self.expr}"


def _row_condition(c: Check) -> Column:
    col = _cols(c.columns)[0] if c.columns else None
    if c.kind == "not_null":
        return F.col(col).isNull()
    if c.kind == "expression":
        return ~F.expr(c.expr)
    if c.kind == "range":
        return ~F.col(col).between(c.low, c.high)
    if c.kind == "positive":
        return F.col(col) <= 0
    raise ValueError(c.kind)


def _meta(c: Check, n: Column) -> Column:
    return F.struct(F.lit(c.relation).alias("relation"), F.lit(c.label).alias("check"),
                    F.lit(",".join(_cols(c.columns)) if c.columns else (c.expr or "")).alias("columns"),
                    F.lit(c.severity).alias("severity"), n.cast("bigint").alias("n_failed"))


def _orphans(df: DataFrame, c: Check) -> DataFrame:
    """A relationship check on its own: rows per key, then the keys that the
    parent doesn't have. Only keys and their counts move, no rows, and a hot key
    moves once per task; AQE broadcasts small parents."""
    col = _cols(c.columns)[0]
    keys = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    bad = keys.join(c.parent.select(F.col(c.field).alias("__k")), "__k", "left_anti")
    return bad.agg(F.array(_meta(c, F.coalesce(F.sum("__n"), F.lit(0)))).alias("rs")).select(F.inline("rs"))


def _one_pass(df: DataFrame, rows: list[Check], keyed: list[Check]) -> DataFrame:
    """All checks of a relation from one scan and one shuffle: a grouping set
    per uniqueness check and per accepted-values column, of which the first
    carries the conditional counts of the row-level checks; then one row of
    sums. Without any set the counts are a plain aggregation."""
    sets: list[list[str]] = []
    for c in keyed:
        if (cols := _cols(c.columns)) not in sets:
            sets.append(cols)
    conds = {id(c): _row_condition(c) for c in rows}
    if not sets:
        return df.agg(F.array(*[_meta(c, F.count_if(F.coalesce(conds[id(c)], F.lit(False)))) for c in rows]).alias("rs")).select(F.inline("rs"))
    cols = list(dict.fromkeys(x for s in sets for x in s))
    # the position of a set, told by which columns it leaves out
    gid = {i: sum((x not in s) << (len(cols) - 1 - j) for j, x in enumerate(cols)) for i, s in enumerate(sets)}
    # a row-level condition may read a grouped column, which another set blanks out: count on a copy
    df = df.select("*", *[F.coalesce(conds[id(c)], F.lit(False)).alias(f"__c{i}") for i, c in enumerate(rows)])
    aggs = [F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__g"), *[F.count_if(f"__c{i}").alias(f"__r{i}") for i in range(len(rows))]]
    per = (df.groupingSets([[F.col(x) for x in s] for s in sets], *cols) if len(sets) > 1 else df.groupBy(*cols)).agg(
        *[a for a in aggs if len(sets) > 1 or a is not aggs[1]])
    in_set = (lambda i: F.col("__g") == gid[i]) if len(sets) > 1 else (lambda i: F.lit(True))
    metas = [_meta(c, F.coalesce(F.sum(F.when(in_set(0), F.col(f"__r{i}"))), F.lit(0))) for i, c in enumerate(rows)]
    for c in keyed:
        at = in_set(sets.index(_cols(c.columns)))
        first = F.col(_cols(c.columns)[0])
        if c.kind == "accepted_values":   # a group is a value
            bad = _not_accepted(_cols(c.columns)[0], c.values)
        elif c.kind == "unique":          # null keys are not duplicates
            bad = (F.col("__n") > 1) & first.isNotNull()
        else:
            bad = F.col("__n") > 1
        metas.append(_meta(c, F.count_if(at & F.coalesce(bad, F.lit(False)))))
    return per.agg(F.array(*metas).alias("rs")).select(F.inline("rs"))


def quality_report(relations: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Evaluate ``checks`` over ``relations`` (name -> DataFrame) into one
    report frame; ``status`` is pass, warn (failures at severity warn) or
    fail.

    Every relation is read once and shuffled once for all its row-level,
    uniqueness and accepted-values checks: conditional counts, and grouping sets
    of the same aggregation. A relationship check counts rows per key and looks
    these keys up in the parent: it reads the relation's key again, but sends no
    rows. Stage relations that several others come from.
    """
    parts: list[DataFrame] = []
    by_rel: dict[str, tuple[list[Check], list[Check]]] = {}
    for c in checks:
        if c.severity not in ("error", "warn"):
            raise ValueError(f"severity must be error or warn, got {c.severity!r}")
        if c.kind in ("unique", "unique_combination", "accepted_values"):
            by_rel.setdefault(c.relation, ([], []))[1].append(c)
        elif c.kind == "relationships":
            parts.append(_orphans(relations[c.relation], c))
        elif c.kind in ROW_LEVEL:
            by_rel.setdefault(c.relation, ([], []))[0].append(c)
        else:
            raise ValueError(f"unknown check kind {c.kind!r}")
    for rel, (rows, keyed) in by_rel.items():
        parts.append(_one_pass(relations[rel], rows, keyed))
    if not parts:
        raise ValueError("no checks")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    status = (F.when(F.col("n_failed") == 0, "pass")
              .when(F.col("severity") == "warn", "warn").otherwise("fail"))
    return out.select("*", status.alias("status"))


class QualityError(RuntimeError):
    pass


def enforce(report: DataFrame) -> list[dict]:
    """Collect the (small: one row per check) report and raise if any
    ``error``-severity check failed. Returns the rows."""
    rows = [r.asDict() for r in report.collect()]
    bad = [r for r in rows if r["status"] == "fail"]
    if bad:
        raise QualityError("; ".join(f"{r['relation']}.{r['check']}: {r['n_failed']}" for r in bad))
    return rows
