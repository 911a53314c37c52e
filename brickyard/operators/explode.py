"""Delimited-string explode with positions (lateral flatten of a split)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickyard.functions.columns import split_list


def split_explode(df: DataFrame, col: str, delim: str = ",", value_name: str = "value",
                  pos_name: str = "position", keep: Sequence[str] | None = None,
                  trim: bool = True) -> DataFrame:
    """One row per element of ``split(col, delim)`` with a 1-based position.

    A null list yields no rows, ``''`` yields one empty element, trailing
    empties are kept and duplicates are not removed. ``keep`` lists the
    columns carried along (default: all but ``col``). Runs map-side: no
    shuffle, and ``explode`` is a generator inside whole-stage codegen.
    """
    keep = [c for c in df.columns if c != col] if keep is None else list(keep)
    exploded = df.select(*keep, F.posexplode(split_list(col, delim)).alias("__pos", "__val"))
    val = F.trim(F.col("__val")) if trim else F.col("__val")
    return exploded.select(*keep, val.alias(value_name), (F.col("__pos") + 1).alias(pos_name))
