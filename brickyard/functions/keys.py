"""Hash surrogate keys (deterministic, join-free dimension keys)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must match the widely used warehouse-package key recipe so
# that keys agree with tables built elsewhere.
#   null stand-in token: _dbt_utils_surrogate_key_null_
#   separator between parts: -
#   digest: md5, lower-case hex
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols) -> Column:
    """md5 of the string forms of ``cols`` joined by ``-``; nulls become a token.

    Cast inputs to one canonical type before hashing on every side that must
    agree (``1`` and ``1.0`` hash differently; so do a date and a timestamp).
    A null input still yields a non-null key. Parts are not escaped, so
    ``('a-b','c')`` and ``('a','b-c')`` collide -- a property of the recipe.
    """
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    parts = [F.coalesce(_as_col(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
