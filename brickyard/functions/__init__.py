"""Column-level helpers: every function returns a ``Column`` built from Spark
built-ins, so it stays inside whole-stage codegen."""

from brickyard.functions.audit import audit_columns
from brickyard.functions.columns import (band, boundary_diff, list_size, nullify_if,
                                         split_list, value_map)
from brickyard.functions.keys import surrogate_key

__all__ = ["audit_columns", "band", "boundary_diff", "list_size", "nullify_if",
           "split_list", "surrogate_key", "value_map"]
