"""Scalar column builders: banding, nullify, value maps, literal splits and
calendar boundary differences."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(col, bands: Iterable[tuple[object, str]], else_: str | None = None) -> Column:
    """Label a number by exclusive upper bounds: first ``col < upper`` wins.

    Null input falls through every bound and gets ``else_``.
    """
    col = _c(col)
    expr = None
    for upper, label in bands:
        expr = (F.when(col < F.lit(upper), F.lit(label)) if expr is None
                else expr.when(col < F.lit(upper), F.lit(label)))
    if expr is None:
        return F.lit(else_)
    return expr.otherwise(F.lit(else_))


def nullify_if(col, predicate: Column) -> Column:
    """``col`` unless ``predicate`` holds, then null (null stays null)."""
    return F.when(predicate, F.lit(None)).otherwise(_c(col))


def value_map(col, mapping: Mapping[str, str], default=None, keep_unmatched: bool = True) -> Column:
    """Simple CASE value map via a literal map; unmatched keeps the input by default."""
    col = _c(col)
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    fallback = col if (default is None and keep_unmatched) else F.lit(default)
    return F.coalesce(F.try_element_at(m, col), fallback)


def split_list(col, delim: str = ",") -> Column:
    """Split on a *literal* delimiter (Spark's split takes a regex), keeping
    trailing empty elements; ``''`` gives ``['']``, null gives null."""
    return F.split(_c(col), re.escape(delim), -1)


def list_size(col, delim: str = ",") -> Column:
    """Element count of a delimited string; null in, null out."""
    return F.array_size(split_list(col, delim))


def boundary_diff(unit: str, start, end) -> Column:
    """Number of ``unit`` boundaries crossed going from ``start`` to ``end``.

    day: days; week: Monday boundaries; month/quarter/year: calendar
    boundaries (01-31 -> 02-01 is one month), unlike ``datediff(MONTH, ...)``.
    """
    a, b = _c(start).cast("date"), _c(end).cast("date")
    unit = unit.lower()
    if unit == "day":
        return F.datediff(b, a)
    if unit == "week":
        return (F.datediff(F.trunc(b, "week"), F.trunc(a, "week")) / 7).cast("int")
    if unit == "month":
        return (F.year(b) * 12 + F.month(b)) - (F.year(a) * 12 + F.month(a))
    if unit == "quarter":
        return (F.year(b) * 4 + F.quarter(b)) - (F.year(a) * 4 + F.quarter(a))
    if unit == "year":
        return F.year(b) - F.year(a)
    raise ValueError(f"unknown unit {unit!r}")


def time_of_day(ts) -> tuple[Column, Column]:
    """(``HH:mm:ss`` string, hour as int) of a timestamp; null gives nulls."""
    c = _c(ts)
    return F.date_format(c, "HH:mm:ss"), F.hour(c)
