"""Audit columns stamped on every layer."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def run_timestamp(run_ts=None) -> Column:
    """A timestamp_ntz literal for ``run_ts`` (str/datetime), else now().

    ``current_timestamp()`` is evaluated once per query, so every row of one
    load shares it; pass ``run_ts`` to make builds reproducible.
    """
    if run_ts is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(run_ts, Column):
        return run_ts.cast("timestamp_ntz")
    if isinstance(run_ts, (_dt.datetime, _dt.date)):
        run_ts = run_ts.isoformat(sep=" ") if isinstance(run_ts, _dt.datetime) else run_ts.isoformat()
    return F.lit(str(run_ts)).cast("timestamp_ntz")


def audit_columns(src_sys: str | None = "raw", run_ts=None,
                  names: tuple[str, ...] = ("crt_ts", "upd_ts")) -> list[Column]:
    """``[src_sys, <names...>]`` -- the source-system tag plus load timestamps.

    ``src_sys=None`` leaves the tag out (for the inline timestamp pair).
    """
    ts = run_timestamp(run_ts)
    cols = [] if src_sys is None else [F.lit(src_sys).alias("src_sys")]
    return cols + [ts.alias(n) for n in names]
