"""Gold star-schema builders: bronze capture, product dimension, distinct
dimension, bridge table and line-grain fact with hash keys."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickyard.functions.audit import audit_columns, run_timestamp
from brickyard.functions.columns import band, list_size, nullify_if
from brickyard.functions.keys import surrogate_key

AUDIT_IN = ["src_sys", "src_crt_ts", "src_upd_ts"]

# Default price tiers (exclusive upper bounds, then the rest).
DEFAULT_PRICE_BANDS = [(10, "Budget"), (15, "Standard"), (20, "Premium")]
DEFAULT_TOP_TIER = "Luxury"


def bronze_capture(raw: DataFrame, src_sys: str = "raw", run_ts=None) -> DataFrame:
    """Raw columns as-is plus load stamps: ``src_crt_ts``, ``src_upd_ts``,
    ``src_sys``, ``crt_ts``, ``upd_ts`` (all one timestamp per load)."""
    ts = run_timestamp(run_ts)
    return raw.select("*", ts.alias("src_crt_ts"), ts.alias("src_upd_ts"),
                      *audit_columns(src_sys, run_ts))


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast-hint ``df`` only after proving it has at most ``max_rows`` rows
    (reads at most ``max_rows + 1`` rows); otherwise leave the choice to AQE,
    which re-checks the runtime size before picking a broadcast."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def product_dim(items: DataFrame, types: DataFrame | None, labels: DataFrame | None = None,
                price_bands=DEFAULT_PRICE_BANDS, top_tier: str = DEFAULT_TOP_TIER,
                list_delim: str = ",", run_ts=None, labels_max_rows: int | None = 10_000) -> DataFrame:
    """SKU-grain dimension: items ⟕ types (on ``product_type_id``) ⟕ size labels.

    items: product_id, product_type_id, size_code, price, src_sys, src_crt_ts, src_upd_ts
    types: product_type_id, product_name, product_category, component_list
    labels: size_code, size_label, size_description, serves_min, serves_max
    An unmatched size code gets a null label. Audit columns come from items.
    ``types=None`` means the items already carry the type columns (a
    denormalised source): no join, one pass.
    """
    if types is None:
        j = items
    else:
        t = types.select("product_type_id", "product_name", "product_category", "component_list")
        j = items.join(t, "product_type_id", "left")
    label_cols = ["size_label", "size_description", "serves_min", "serves_max"]
    if labels is not None:
        lab = labels.select("size_code", *label_cols)
        # a fixed seed needs no count: labels_max_rows=None
        lab = F.broadcast(lab) if labels_max_rows is None else broadcast_if_small(lab, labels_max_rows)
        j = j.join(lab, "size_code", "left")
    else:
        j = j.select("*", *[F.lit(None).cast("string").alias(c) for c in label_cols])
    return j.select(
        surrogate_key("product_id").alias("product_sk"),
        surrogate_key("product_type_id").alias("product_type_sk"),
        "product_id", "product_type_id", "product_name", "product_category", "component_list",
        list_size("component_list", list_delim).alias("component_count"),
        "size_code", *label_cols,
        "price",
        band("price", price_bands, top_tier).alias("price_tier"),
        *AUDIT_IN,
        *audit_columns(None, run_ts),
    )


def distinct_dim(values: DataFrame, col: str, sk_name: str, run_ts=None) -> DataFrame:
    """Dimension of distinct trimmed values of ``col``, keyed by its hash.

    The distinct runs over (value, src_sys, src_crt_ts, src_upd_ts), so one
    value loaded at two times gives two rows sharing one key -- kept as is.
    Map-side partial distinct keeps the shuffle to distinct tuples per task.
    """
    d = values.select(F.trim(F.col(col)).alias(col), *AUDIT_IN).distinct()
    return d.select(surrogate_key(col).alias(sk_name), col, *AUDIT_IN,
                    *audit_columns(None, run_ts))


def bridge(exploded: DataFrame, dim: DataFrame, parent: DataFrame | None = None,
           strict: bool = False, type_col: str = "product_type_id", value_col: str = "component",
           pos_col: str = "component_position", run_ts=None,
           sk_names=("product_component_sk", "product_type_sk", "component_sk")) -> DataFrame:
    """Many-to-many bridge: exploded (type, value, position) ⟕ dim on trimmed value.

    The trimmed key is projected once on each side so the join stays a plain
    equi-join (hash/sort-merge, or broadcast when AQE sees a small dim).
    The ``value_col`` output is the *dimension's* value (null if unmatched),
    while the value key hashes the exploded value. ``strict=True`` keeps
    only types present in ``parent`` (a left-semi join); without it the
    parent join would add nothing and is omitted.
    """
    e = exploded.select(type_col, F.col(value_col).alias("__v"), pos_col, *AUDIT_IN,
                        F.trim(F.col(value_col)).alias("__k"))
    d = dim.select(F.trim(F.col(value_col)).alias("__k"), F.col(value_col).alias("__dv"))
    j = e.join(d, "__k", "left")
    if strict and parent is not None:
        j = j.join(parent.select(type_col).distinct(), type_col, "left_semi")
    pair_sk, type_sk, value_sk = sk_names
    return j.select(
        surrogate_key(type_col, "__dv").alias(pair_sk),
        surrogate_key(type_col).alias(type_sk),
        surrogate_key("__v").alias(value_sk),
        type_col,
        F.col("__dv").alias(value_col),
        pos_col,
        *audit_columns(None, run_ts),
        *AUDIT_IN,
    )


def line_fact(lines: DataFrame, headers: DataFrame, run_ts=None,
              invalid_if=lambda q: q <= 0, stamps: str = "header") -> DataFrame:
    """Line-grain fact: lines ⟕ headers on ``order_id``; dimension keys are
    hashed from business keys (no dimension joins), ``quantity_valid``
    nulls non-positive quantities. Audit columns come from the header, so a
    line without its order gets null ``src_*`` stamps and a null date.

    lines: order_detail_id, order_id, product_id, quantity
    headers: order_id, order_date, src_sys, src_crt_ts, src_upd_ts

    ``stamps="header"`` keeps that parity: a line arriving after its order
    carries the order's (old) load time and an incremental load by
    ``src_crt_ts`` never picks it up. ``stamps="latest"`` uses the later of
    the line's and the header's load times (lines must carry ``src_crt_ts``
    and ``src_upd_ts``), so late lines load too.

    Scale: one shuffle join on order_id (AQE splits a skewed hot order on
    the line side; the header side is unique per key).
    """
    return line_keys(line_rows(lines, headers, invalid_if, stamps), run_ts)


def line_rows(lines: DataFrame, headers: DataFrame, invalid_if=lambda q: q <= 0, stamps: str = "header") -> DataFrame:
    """The rows of ``line_fact`` before their hash keys, which ``line_keys`` adds.
    Keys are functions of a row's other columns, 32 characters each: what sends
    rows around between the two sends a fraction of the bytes."""
    if stamps not in ("header", "latest"):
        raise ValueError("stamps must be 'header' or 'latest'")
    lcols = ["order_detail_id", "order_id", "product_id", "quantity"]
    if stamps == "latest":
        lcols += [F.col("src_crt_ts").alias("__l_crt"), F.col("src_upd_ts").alias("__l_upd")]
    l = lines.select(*lcols)
    h = headers.select("order_id", "order_date", *AUDIT_IN)
    j = l.join(h, "order_id", "left")
    if stamps == "latest":
        j = j.withColumn("src_crt_ts", F.greatest("src_crt_ts", "__l_crt")).withColumn(
            "src_upd_ts", F.greatest("src_upd_ts", "__l_upd"))
    return j.select("order_detail_id", "order_id", "product_id", "order_date", "quantity",
                    nullify_if("quantity", invalid_if(F.col("quantity"))).alias("quantity_valid"), *AUDIT_IN)


LINE_KEYS = {"order_detail_sk": "order_detail_id", "product_sk": "product_id", "date_sk": "order_date", "order_sk": "order_id"}


def line_key(name: str):
    """A hash key of ``line_fact`` from its row."""
    c = F.col(LINE_KEYS[name])
    return surrogate_key(c.cast("date") if name == "date_sk" else c)


def line_keys(rows: DataFrame, run_ts=None) -> DataFrame:
    """``line_fact`` from ``line_rows``; load stamps that the rows have already stay."""
    stamps = ["crt_ts", "upd_ts"] if "crt_ts" in rows.columns else audit_columns(None, run_ts)
    return rows.select(
        *[line_key(k).alias(k) for k in LINE_KEYS],
        "order_detail_id", "order_id", "product_id", "order_date", "quantity", "quantity_valid",
        *AUDIT_IN,
        *stamps,
    )
