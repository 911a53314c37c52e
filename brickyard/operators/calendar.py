"""Date spine and calendar dimension."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brickyard.functions.audit import audit_columns
from brickyard.functions.columns import boundary_diff
from brickyard.functions.keys import surrogate_key


def _date(v) -> Column:
    if isinstance(v, Column):
        return v.cast("date")
    if isinstance(v, (_dt.date, _dt.datetime)):
        v = v.isoformat()[:10]
    return F.lit(str(v)).cast("date")


def date_spine(spark: SparkSession | None = None, start=None, end=None,
               bounds: DataFrame | None = None, name: str = "calendar_date") -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive, with no gaps.

    Either give literal ``start``/``end`` or a one-row ``bounds`` DataFrame
    with columns ``start``/``end`` (e.g. derived from a fact table's min/max,
    so the spine follows the data). The day count is bounded by the range
    (36.5k rows per century), so a single generator row is fine.
    """
    if bounds is None:
        if spark is None:
            raise ValueError("date_spine needs spark when no bounds frame is given")
        bounds = spark.range(1).select(_date(start).alias("start"), _date(end).alias("end"))
    return bounds.select(
        F.explode(F.sequence(F.col("start").cast("date"), F.col("end").cast("date"),
                             F.expr("interval 1 day"))).alias(name))


def fiscal_columns(d: Column, start_month: int = 2) -> list[Column]:
    """Fiscal year/month/quarter for a year starting on ``start_month``/1;
    the fiscal year is named after the calendar year it starts in."""
    if not 1 <= start_month <= 12:
        raise ValueError("start_month must be 1..12")
    m, y = F.month(d), F.year(d)
    in_year = m >= F.lit(start_month)
    fmonth = F.when(in_year, m - (start_month - 1)).otherwise(m + (13 - start_month))
    return [
        F.when(in_year, y).otherwise(y - 1).alias("fiscal_year"),
        fmonth.alias("fiscal_month"),
        F.ceil(fmonth / F.lit(3.0)).cast("int").alias("fiscal_quarter"),
    ]


def date_dim(spine: DataFrame, as_of=None, fiscal_start_month: int = 2, run_ts=None,
             src_sys: str = "date_generator", date_col: str = "calendar_date") -> DataFrame:
    """Calendar dimension over a spine: key, calendar, descriptive, relative
    (day/week/month/quarter/year boundaries from ``as_of``), fiscal and audit
    columns. ``day_of_week`` is 0 = Sunday. Names are 3-letter abbreviations.

    ``as_of`` defaults to ``current_date()``; pass it to make the relative
    columns reproducible (they freeze at build time in a stored table).
    """
    d = F.col(date_col)
    ref = F.current_date() if as_of is None else _date(as_of)
    dow = F.dayofweek(d) - 1
    return spine.select(
        surrogate_key(d).alias("date_sk"),
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d.alias("calendar_date"),
        dow.alias("day_of_week"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_number"),
        F.quarter(d).alias("quarter_number"),
        F.year(d).alias("year_number"),
        F.date_format(d, "EEE").alias("day_name"),
        F.date_format(d, "MMM").alias("month_name"),
        F.left(F.date_format(d, "MMM"), F.lit(3)).alias("month_name_short"),
        dow.isin(0, 6).alias("is_weekend"),
        (~dow.isin(0, 6)).alias("is_weekday"),
        boundary_diff("day", ref, d).alias("rltv_day"),
        boundary_diff("week", ref, d).alias("rltv_week"),
        boundary_diff("month", ref, d).alias("rltv_month"),
        boundary_diff("quarter", ref, d).alias("rltv_quarter"),
        boundary_diff("year", ref, d).alias("rltv_year"),
        *fiscal_columns(d, fiscal_start_month),
        *audit_columns(src_sys, run_ts),
    )
