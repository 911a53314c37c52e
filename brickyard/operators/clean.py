"""Silver cleaning: rename, typed casts, key filters and latest-row dedupe."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rename_select(df: DataFrame, mapping: Mapping[str, object]) -> DataFrame:
    """Project ``{new_name: old_name_or_Column}`` in the given order."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in mapping.items()])


def cast_columns(df: DataFrame, spec: Mapping[str, str], trim: bool = True,
                 keep_others: bool = True) -> DataFrame:
    """Cast each column in ``spec`` to its type; string targets are trimmed
    first (spaces only -- tabs and newlines stay, as ``trim`` does in SQL).

    Casts are ANSI: bad input raises rather than turning into null.
    """
    out = []
    for name in df.columns:
        if name in spec:
            c = F.col(name)
            if trim and spec[name].lower() in ("string", "varchar"):
                c = F.trim(c.cast("string"))
            out.append(c.cast(spec[name]).alias(name))
        elif keep_others:
            out.append(F.col(name))
    missing = set(spec) - set(df.columns)
    if missing:
        raise ValueError(f"cast_columns: unknown columns {sorted(missing)}")
    return df.select(*out)


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows whose key columns are null (pushed down to the scan)."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond) if cond is not None else df


def _order(spec) -> Column:
    return F.col(spec) if isinstance(spec, str) else spec


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence,
                  tie_breakers: Sequence, nulls_first: bool = True) -> DataFrame:
    """Keep the latest row per key: ``row_number() over (partition by keys
    order by <order_by> desc, <tie_breakers>) = 1``.

    ``order_by`` columns sort descending with nulls first (the warehouse
    default this mirrors); tie-breakers sort ascending and are what makes the
    winner deterministic when one load stamps many rows with one timestamp.

    Plan: Spark inserts a *partial* WindowGroupLimit before the shuffle, so
    each map task forwards at most one row per key -- a hot key with a third
    of the input arrives at its reducer as one row per map task.
    """
    if not keys:
        raise ValueError("dedupe_latest needs keys")
    if all(isinstance(c, str) and c in keys for c in tie_breakers):
        raise ValueError("dedupe_latest needs tie_breakers beyond the keys: equal rows of a key differ in nothing else")
    orders = [(_order(c).desc_nulls_first() if nulls_first else _order(c).desc_nulls_last())
              for c in order_by]
    orders += [_order(c).asc_nulls_first() if isinstance(c, str) else c for c in tie_breakers]
    w = Window.partitionBy(*keys).orderBy(*orders)
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)


def silver_clean(bronze: DataFrame, columns: Mapping[str, tuple[object, str]],
                 keys: Sequence[str], tie_breakers: Sequence = (),
                 order_by: Sequence = ("src_upd_ts",), trim: bool = True, keep_order: bool = False) -> DataFrame:
    """Bronze -> silver: rename + typed cast (``{new: (old_or_Column, type)}``),
    carry ``src_sys`` and the bronze load stamps as ``src_crt_ts``/``src_upd_ts``,
    drop null keys, keep the latest row per *cleaned* key.

    ``order_by`` (descending) and ``tie_breakers`` (ascending) may name silver
    or raw bronze columns; raw ones ride along only until the dedupe.
    Deduping on the cleaned key means ``'a'`` and ``'a '`` collapse into one
    row, as the grain requires. ``keep_order`` keeps the raw columns that order
    a key's rows (``order_columns`` names them), so that later rows can be
    measured against the winners.
    """
    helpers, ob, tb = order_columns(columns, order_by, tie_breakers)
    sel = []
    for new, (old, typ) in columns.items():
        c = F.col(old) if isinstance(old, str) else old
        if trim and typ.lower() in ("string", "varchar"):
            c = F.trim(c.cast("string"))
        sel.append(c.cast(typ).alias(new))
    sel += [F.col("src_sys"), F.col("crt_ts").alias("src_crt_ts"), F.col("upd_ts").alias("src_upd_ts")]
    out = require_keys(bronze.select(*sel, *[F.col(c).alias(name) for name, c in helpers.items()]), keys)
    out = dedupe_latest(out, keys, ob, tb)
    return out if keep_order else out.drop(*helpers)


def order_columns(columns: Mapping[str, tuple[object, str]], order_by: Sequence, tie_breakers: Sequence) -> tuple[dict[str, str], list, list]:
    """Of a ``silver_clean``: the helper columns that carry raw order columns
    (name -> raw column), and the order and tie-breakers over its rows."""
    out_names = set(columns) | {"src_sys", "src_crt_ts", "src_upd_ts"}
    helpers, ob, tb = {}, [], []
    for i, c in enumerate(list(order_by) + list(tie_breakers)):
        name = c
        if isinstance(c, str) and c not in out_names:
            name = f"__o{i}"
            helpers[name] = c
        (ob if i < len(order_by) else tb).append(name)
    return helpers, ob, tb
