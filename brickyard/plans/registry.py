"""Registry of runnable queries: key -> ``fn(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (whole tables, whole texts) through
``SalesStar``. Keys follow SURVEY §2. Computed columns carry the same names
as the oracle SQL in ``brickyard.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brickyard.functions.audit import audit_columns
from brickyard.functions.columns import band, list_size, time_of_day, value_map
from brickyard.functions.keys import surrogate_key
from brickyard.operators import metrics, quality, retrieve, versioned
from brickyard.operators.calendar import date_spine
from brickyard.operators.clean import dedupe_latest
from brickyard.operators.explode import split_explode
from brickyard.operators.load import incremental_filter, load_incremental, upsert
from brickyard.operators.quality import Check
from brickyard.operators.star import line_key, line_keys, line_rows
from brickyard.plans.sales_star import (PRICE_BANDS, PRICE_TOP, RUN_TS, RUN_TS_2,
                                        SalesStar, silver_lines_spec)
from brickyard.session import checkpoint_dir, staged, staged_together
from brickyard.sources.seed import SIZE_LABEL_SCHEMA, packaged_seed, size_labels

# Fixed values of the registered queries (mirrored in the oracle SQL).
DATE_CUT = "1998-01-01 00:00:00"      # first load of orders by date
SILVER_CUT = "1998-06-01 00:00:00"    # the later lines come first, the earlier ones late
SHIP_CUT = "1999-01-01 00:00:00"      # previous load of lineitem by ship date
PARENT_DATE_CUT = "1998-01-01 00:00:00"  # parents kept for the orphan checks
PRIORITIES_ACCEPTED = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
SIZE_CODE_NAMES = {"S": "Small", "M": "Medium", "L": "Large", "XL": "X-Large"}
FRESHNESS_AS_OF = "2024-02-01 00:00:00"
TOP_PRODUCTS = 10
VECTOR_K = 5
VECTOR_RECALL = 0.97  # of the k best, asked of the inverted lists
KEYWORD_K = 5
CONTEXT_K = 3
HISTORY_N = 5
FISCAL_START_ALT = 7
QUANTITY_SHIFT = 5
QUESTION_ID_SCALE = 1_000_000  # query_id = conv_id * scale + turn


def _star(spark, sf_dir) -> SalesStar:
    return SalesStar(spark, sf_dir)


def _half_key(o: DataFrame, num: int = 1, den: int = 2):
    """Cut point of the key range (a scalar subquery over the whole table).

    The incremental queries use it to *simulate the previous load*: the
    target is the part of the table loaded earlier, the source is the whole
    table (or its later part), and every result covers the whole table --
    the split models history, it does not shrink the work.
    """
    return o.agg(F.floor(F.max("o_orderkey") * num / den)).scalar()


# ---- sources / loads ---------------------------------------------------------

def bronze_orders(spark, d):
    return _star(spark, d).bronze("orders")


def bronze_incremental_key(spark, d):
    s = _star(spark, d)
    o = s.raw("orders")
    target = s.bronze("orders", o.where(F.col("o_orderkey") <= _half_key(o)), RUN_TS)
    source = s.bronze("orders", o, RUN_TS_2)
    return load_incremental(source, target, "o_orderkey", "o_orderkey")


def bronze_incremental_date(spark, d):
    s = _star(spark, d)
    o = s.raw("orders")
    target = s.bronze("orders", o.where(F.col("o_orderdate") < F.lit(DATE_CUT).cast("timestamp_ntz")), RUN_TS)
    source = s.bronze("orders", o, RUN_TS_2)
    return load_incremental(source, target, "o_orderkey", "o_orderdate")


def watermark_filter(spark, d):
    s = _star(spark, d)
    li = s.raw("lineitem")
    prev = li.where(F.col("l_shipdate") < F.lit(SHIP_CUT).cast("timestamp_ntz"))
    return incremental_filter(li, prev, "l_shipdate")


def upsert_query(spark, d):
    s = _star(spark, d)
    o = s.raw("orders")
    target = s.bronze("orders", o.where(F.col("o_orderkey") <= _half_key(o, 2, 3)), RUN_TS)
    changed = o.where(F.col("o_orderkey") > _half_key(o, 1, 3)).withColumn(
        "o_totalprice", F.col("o_totalprice") * 2)
    return upsert(target, s.bronze("orders", changed, RUN_TS_2), "o_orderkey")


def versioned_merge(spark, d):
    """Two loads into a table partitioned by year, the second of which doubles
    prices and moves every third order to the next year."""
    o = _star(spark, d).raw("orders")
    root = f"{checkpoint_dir(spark).rstrip('/')}/orders-{uuid.uuid4().hex}"
    key, price, year = F.col("o_orderkey"), F.col("o_totalprice"), F.year("o_orderdate")
    first = o.where(key <= _half_key(o, 2, 3)).select(key, "o_custkey", price, year.alias("order_year"))
    second = o.where(key > _half_key(o, 1, 3)).select(
        key, "o_custkey", (price * 2).alias("o_totalprice"), F.when(key % 3 == 0, year + 1).otherwise(year).alias("order_year"))
    versioned.merge(first, root, "o_orderkey", ["order_year"], load="first")
    versioned.merge(second, root, "o_orderkey", ["order_year"], load="second")
    return versioned.read_current(spark, root)


def silver_incremental(spark, d):
    """Silver order lines kept up to date from two bronze batches, the second
    with the older half of the ship dates."""
    s = _star(spark, d)
    li = s.raw("lineitem")
    root = f"{checkpoint_dir(spark).rstrip('/')}/silver-{uuid.uuid4().hex}"
    cut = F.lit(SILVER_CUT).cast("timestamp_ntz")
    for n, batch in enumerate((li.where(F.col("l_shipdate") >= cut), li.where(F.col("l_shipdate") < cut))):
        versioned.merge_silver(s.bronze("lineitem", batch), root, **silver_lines_spec(), load=str(n), buckets=16)
    return versioned.read_silver(spark, root)


def schema_sync(spark, d):
    s = _star(spark, d)
    o = s.raw("orders")
    target = s.bronze("orders", o.where(F.col("o_orderkey") <= _half_key(o)), RUN_TS)
    incoming = s.bronze("orders", o.drop("o_orderpriority").withColumn(
        "o_custref", F.col("o_custkey") * 10), RUN_TS_2)
    return load_incremental(incoming, target, "o_orderkey", "o_orderkey")


def fact_incremental_merge(spark, d):
    s = _star(spark, d)
    o = s.raw("orders")
    half = _half_key(o)
    b1 = s.bronze("orders", o.where(F.col("o_orderkey") <= half), RUN_TS)
    b2 = b1.unionByName(s.bronze("orders", o.where(F.col("o_orderkey") > half), RUN_TS_2))
    # both loads come from the same silver lines, a stored table as it would be
    lines = staged(s.silver_order_details(), "lines")

    def load(bronze, run_ts):
        rows = line_rows(lines, s.silver_orders(bronze))
        return rows.select(line_key("order_detail_sk").alias("order_detail_sk"), *rows.columns, *audit_columns(None, run_ts))
    # so is the first load: its mark, its kept rows and the join read that. Of the hash keys rows carry
    # the merge key only through the merge; all keys are functions of the row and follow it
    f1 = staged(load(b1, RUN_TS), "fact")
    return line_keys(load_incremental(load(b2, RUN_TS_2), f1, "order_detail_sk", "src_crt_ts"))


# ---- silver ------------------------------------------------------------------

def silver_orders(spark, d):
    return _star(spark, d).silver_orders()


def silver_order_details(spark, d):
    return _star(spark, d).silver_order_details()


def silver_products_query(spark, d):
    return _star(spark, d).silver_products()


def dedupe_latest_query(spark, d):
    li = _star(spark, d).raw("lineitem")
    return dedupe_latest(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"],
                         ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])


# ---- keys, calendar, explode ---------------------------------------------------

def surrogate_key_query(spark, d):
    p = _star(spark, d).raw("part")
    return p.select("p_partkey", surrogate_key("p_partkey").alias("part_sk"))


def surrogate_key_multi(spark, d):
    li = _star(spark, d).raw("lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     surrogate_key("l_orderkey", F.nullif(F.col("l_linenumber"), F.lit(1)),
                                   F.col("l_shipdate").cast("date")).alias("line_sk"))


def date_spine_query(spark, d):
    return date_spine(bounds=_star(spark, d).date_bounds())


def dim_date(spark, d):
    return _star(spark, d).dim_date()


def dim_date_fiscal(spark, d):
    dd = _star(spark, d).dim_date(FISCAL_START_ALT)
    return dd.select("calendar_date", "fiscal_year", "fiscal_month", "fiscal_quarter")


def dim_date_relative(spark, d):
    dd = _star(spark, d).dim_date()
    return dd.select("calendar_date", "rltv_day", "rltv_week", "rltv_month", "rltv_quarter", "rltv_year")


def split_explode_query(spark, d):
    p = _star(spark, d).raw("part").select("p_partkey", "p_name")
    return split_explode(p, "p_name", " ", "component", "component_position")


def ingredient_count(spark, d):
    p = _star(spark, d).raw("part")
    return p.select("p_partkey", list_size("p_name", " ").alias("component_count"))


def dim_ingredients(spark, d):
    return _star(spark, d).dim_components()


def bridge_ingredients(spark, d):
    return _star(spark, d).bridge_components()


def bridge_strict_semi(spark, d):
    s = _star(spark, d)
    parent = s.dim_product.where(F.col("price_tier") != PRICE_TOP)
    return s.bridge_components(strict=True, parent=parent)


# ---- product dimension pieces ------------------------------------------------------

def seed_join(spark, d):
    s = _star(spark, d)
    lab = size_labels(spark).select("size_code", "size_label", "size_description", "serves_min", "serves_max")
    return s.silver_products().select("product_id", "size_code").join(F.broadcast(lab), "size_code", "left")


def seed_csv_join(spark, d):
    lab = packaged_seed(spark, "size_labels.csv", SIZE_LABEL_SCHEMA)
    return _star(spark, d).silver_products().select("product_id", "size_code").join(F.broadcast(lab), "size_code", "left")


def price_tier(spark, d):
    p = _star(spark, d).raw("part")
    return p.select("p_partkey", "p_retailprice",
                    band("p_retailprice", PRICE_BANDS, PRICE_TOP).alias("price_tier"))


def value_map_query(spark, d):
    s = _star(spark, d)
    return s.silver_products().select("product_id", "size_code",
                                      value_map("size_code", SIZE_CODE_NAMES).alias("size_name"))


def dim_product(spark, d):
    return _star(spark, d).dim_product


def dim_product_join(spark, d):
    return _star(spark, d).dim_product_join()


# ---- fact -----------------------------------------------------------------------

def fact_orders(spark, d):
    return _star(spark, d).fact_orders()


def quantity_valid(spark, d):
    s = _star(spark, d)
    lines = s.silver_order_details().withColumn("quantity", F.col("quantity") - QUANTITY_SHIFT)
    f = s.fact_orders(lines)
    return f.select("order_detail_id", "quantity", "quantity_valid")


def gross_amount(spark, d):
    s = _star(spark, d)
    return metrics.gross_amount(s.fact_orders(), s.dim_product)


# ---- quality ------------------------------------------------------------------------

def _lines_key(li):
    return li.select("*", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_detail_id"))


def check_not_null(spark, d):
    li = _star(spark, d).raw("lineitem")
    return quality.check_not_null(li.withColumn("l_discount", F.nullif(F.col("l_discount"), F.lit(0.0))),
                                  "l_discount")


def check_unique(spark, d):
    return quality.check_unique(_lines_key(_star(spark, d).raw("lineitem")), "order_detail_id")


def check_accepted_values(spark, d):
    return quality.check_accepted_values(_star(spark, d).raw("orders"), "o_orderpriority",
                                         PRIORITIES_ACCEPTED)


def _old_orders(s):
    return s.raw("orders").where(F.col("o_orderdate") < F.lit(PARENT_DATE_CUT).cast("timestamp_ntz"))


def check_relationships(spark, d):
    s = _star(spark, d)
    return quality.check_relationships(s.raw("lineitem"), "l_orderkey", _old_orders(s), "o_orderkey")


def check_unique_combination(spark, d):
    return quality.check_unique_combination(_star(spark, d).raw("lineitem"), ["l_orderkey", "l_linenumber"])


def check_expression(spark, d):
    return quality.check_expression(_star(spark, d).raw("lineitem"), "l_discount <= 0.08")


def check_range(spark, d):
    return quality.check_range(_star(spark, d).raw("lineitem"), "l_quantity", 0, 40)


def check_positive(spark, d):
    li = _star(spark, d).raw("lineitem")
    return quality.check_positive(li.withColumn("l_quantity", F.col("l_quantity") - 25), "l_quantity")


def orphan_antijoin(spark, d):
    s = _star(spark, d)
    parent = s.dim_product.where(F.col("price_tier") != PRICE_TOP)
    # a line's product key is known before its order is: orphans are told among the lines, and become facts with their keys then
    lines = s.silver_order_details().withColumn("product_sk", line_key("product_sk"))
    fact = s.fact_orders(quality.check_relationships(lines, "product_sk", parent, "product_sk"))
    return fact.select("product_sk", *[c for c in fact.columns if c != "product_sk"])


def freshness(spark, d):
    ev = _star(spark, d).raw("events")
    return quality.freshness(ev, "ts", FRESHNESS_AS_OF, 24, 48, relation="events")


def freshness_sources(spark, d):
    """All sources in one report: three by a column of their own, ``part`` by its bronze load stamp."""
    s = _star(spark, d)
    return quality.freshness_report({"orders": (s.raw("orders"), "o_orderdate"), "lineitem": (s.raw("lineitem"), "l_shipdate"),
                                     "events": (s.raw("events"), "ts"), "part": (s.bronze("part"), "crt_ts")}, FRESHNESS_AS_OF, 24, 48)


def report_checks(s: SalesStar) -> tuple[dict, list[Check]]:
    # tables that others come from are stored ones, as they would be: each is built once
    stored = staged_together(orders=s.silver_orders(), lines=s.silver_order_details(), part=s.silver_part, components=s.dim_components())
    orders, lines, s.silver_part, components = (stored[n] for n in ("orders", "lines", "part", "components"))
    rel = {"silver_orders": orders, "silver_order_details": lines,
           "silver_products": s.silver_products(), "fact_orders": s.fact_orders(lines, orders),
           "dim_product": s.dim_product, "dim_date": s.dim_date(), "dim_components": components,
           "bridge_components": s.bridge_components(components=components)}
    checks = [
        Check("silver_orders", "unique", "order_id", severity="warn"),
        Check("silver_orders", "not_null", "order_date"),
        Check("silver_order_details", "unique", "order_detail_id"),
        Check("silver_order_details", "not_null", "order_id"),
        Check("silver_order_details", "relationships", "order_id", parent=rel["silver_orders"], field="order_id", parent_unique=True),
        Check("silver_order_details", "relationships", "product_id", parent=rel["silver_products"],
              field="product_id", parent_unique=True),
        Check("fact_orders", "not_null", "order_detail_sk"),
        Check("fact_orders", "unique_combination", ["order_id", "order_detail_id"]),
        Check("fact_orders", "expression", "quantity_valid", expr="quantity_valid > 0"),
        Check("fact_orders", "range", "quantity", low=0, high=40, severity="warn"),
        Check("fact_orders", "relationships", "product_sk", parent=rel["dim_product"], field="product_sk", parent_unique=True),
        Check("fact_orders", "relationships", "date_sk", parent=rel["dim_date"], field="date_sk", parent_unique=True),
        Check("fact_orders", "unique", "order_detail_sk"),
        Check("fact_orders", "unique_combination", ["order_detail_id", "product_sk"]),
        Check("bridge_components", "unique_combination", ["product_type_sk", "component_sk"], severity="warn"),
        Check("bridge_components", "not_null", "product_component_sk"),
        Check("bridge_components", "relationships", "product_type_sk", parent=rel["dim_product"], field="product_type_sk"),
        Check("bridge_components", "relationships", "component_sk", parent=rel["dim_components"], field="component_sk", parent_unique=True),
        Check("dim_components", "unique", "component_sk"),
        Check("dim_components", "not_null", "component_sk"),
        Check("dim_product", "unique", "product_sk"),
        Check("dim_product", "accepted_values", "price_tier", values=["Budget", "Standard", "Premium", "Luxury"]),
        Check("dim_product", "accepted_values", "size_label",
              values=["Small", "Medium", "Large", "X-Large"], severity="warn"),
        Check("dim_product", "positive", "price"),
        Check("dim_date", "accepted_values", "month_number", values=list(range(1, 13))),
        Check("dim_date", "expression", "calendar_date", expr="year(calendar_date) <= 2000", severity="warn"),
    ]
    return rel, checks


def quality_report(spark, d):
    rel, checks = report_checks(_star(spark, d))
    return quality.quality_report(rel, checks)


# ---- reporting metrics ----------------------------------------------------------------

def q_revenue_by_product(spark, d):
    s = _star(spark, d)
    return metrics.revenue_by_product(s.fact_orders(), s.dim_product, TOP_PRODUCTS)


def q_busiest_day(spark, d):
    s = _star(spark, d)
    return metrics.busiest_day(s.fact_orders(), s.dim_date())


def q_busiest_hour(spark, d):
    return metrics.busiest_hour(_star(spark, d).raw("events"))


def time_of_day_query(spark, d):
    at, hour = time_of_day("ts")
    return _star(spark, d).raw("events").select("event_id", at.alias("order_time"), hour.alias("order_hour"))


def q_ingredient_frequency(spark, d):
    s = _star(spark, d)
    return metrics.component_frequency(s.fact_orders(), s.dim_product, s.bridge_components())


def q_revenue_by_quarter(spark, d):
    s = _star(spark, d)
    return metrics.revenue_by_quarter(s.fact_orders(), s.dim_product, s.dim_date())


def q_avg_order_value(spark, d):
    s = _star(spark, d)
    return metrics.avg_order_value(s.fact_orders(), s.dim_product)


# ---- retrieval and conversations ----------------------------------------------------------

def vector_topk(spark, d):
    e = _star(spark, d).raw("embeddings")
    return retrieve.vector_topk(e, e, VECTOR_K, "vec_id", "vec_id", "embedding", exclude_self=True)


def keyword_topk(spark, d):
    s = _star(spark, d)
    return retrieve.keyword_topk(s.raw("benchmark"), s.raw("documents"), KEYWORD_K)


def vector_topk_lists(spark, d):
    e = _star(spark, d).raw("embeddings")
    return retrieve.vector_topk_lists(e, e, VECTOR_K, "vec_id", "vec_id", "embedding", exclude_self=True, recall=VECTOR_RECALL)


def term_index(spark, d):
    """What the index of all documents says of every term."""
    return retrieve.term_index(_star(spark, d).raw("documents")).terms().select("term", "df", "cf", "max_tf", "min_len")


def context_assembly(spark, d):
    s = _star(spark, d)
    docs = s.raw("documents")
    ranked = retrieve.keyword_topk(s.raw("benchmark"), docs, CONTEXT_K)
    return retrieve.assemble_context(ranked, docs)


def chat_history(spark, d):
    h = retrieve.chat_history(_star(spark, d).raw("conversations"), HISTORY_N)
    return h.select("conv_id", "turn", "role", "text", "n_history",
                    retrieve.history_text(F.col("history")).alias("history_text"))


def user_questions(conv: DataFrame) -> DataFrame:
    return conv.where(F.col("role") == "user").select(
        "conv_id", "turn",
        (F.col("conv_id") * QUESTION_ID_SCALE + F.col("turn")).alias("query_id"),
        retrieve.strip_quotes("text").alias("question"))


def prompt_assembly(spark, d):
    s = _star(spark, d)
    conv, docs = s.raw("conversations"), s.raw("documents")
    qs = retrieve.search_questions(user_questions(conv))
    ranked = retrieve.keyword_topk(qs, docs, CONTEXT_K, query_id="query_id", query_text="search_question")
    ctx = retrieve.assemble_context(ranked, docs)
    hist = retrieve.chat_history(conv, HISTORY_N)
    return retrieve.assemble_prompt(qs, hist, ctx)


def rewrite_prompt(spark, d):
    conv = _star(spark, d).raw("conversations")
    return retrieve.rewrite_prompt(user_questions(conv), retrieve.chat_history(conv, HISTORY_N))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_orders": bronze_orders,
    "bronze_incremental_key": bronze_incremental_key,
    "bronze_incremental_date": bronze_incremental_date,
    "watermark_filter": watermark_filter,
    "upsert": upsert_query,
    "schema_sync": schema_sync,
    "versioned_merge": versioned_merge,
    "silver_incremental": silver_incremental,
    "fact_incremental_merge": fact_incremental_merge,
    "silver_orders": silver_orders,
    "silver_order_details": silver_order_details,
    "silver_pizza": silver_products_query,
    "dedupe_latest": dedupe_latest_query,
    "surrogate_key": surrogate_key_query,
    "surrogate_key_multi": surrogate_key_multi,
    "date_spine": date_spine_query,
    "dim_date": dim_date,
    "dim_date_fiscal": dim_date_fiscal,
    "dim_date_relative": dim_date_relative,
    "split_explode": split_explode_query,
    "ingredient_count": ingredient_count,
    "dim_ingredients": dim_ingredients,
    "bridge_ingredients": bridge_ingredients,
    "bridge_strict_semi": bridge_strict_semi,
    "seed_join": seed_join,
    "price_tier": price_tier,
    "value_map": value_map_query,
    "dim_product": dim_product,
    "dim_product_join": dim_product_join,
    "seed_csv_join": seed_csv_join,
    "time_of_day": time_of_day_query,
    "fact_orders": fact_orders,
    "quantity_valid": quantity_valid,
    "gross_amount": gross_amount,
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "check_accepted_values": check_accepted_values,
    "check_relationships": check_relationships,
    "check_unique_combination": check_unique_combination,
    "check_expression": check_expression,
    "check_range": check_range,
    "check_positive": check_positive,
    "orphan_antijoin": orphan_antijoin,
    "freshness": freshness,
    "freshness_sources": freshness_sources,
    "quality_report": quality_report,
    "q_revenue_by_product": q_revenue_by_product,
    "q_busiest_day": q_busiest_day,
    "q_busiest_hour": q_busiest_hour,
    "q_ingredient_frequency": q_ingredient_frequency,
    "q_revenue_by_quarter": q_revenue_by_quarter,
    "q_avg_order_value": q_avg_order_value,
    "vector_topk": vector_topk,
    "vector_topk_lists": vector_topk_lists,
    "keyword_topk": keyword_topk,
    "term_index": term_index,
    "context_assembly": context_assembly,
    "chat_history": chat_history,
    "prompt_assembly": prompt_assembly,
    "rewrite_prompt": rewrite_prompt,
}

