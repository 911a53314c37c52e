"""Star-schema metrics: line gross amount and the reporting questions
(top products by revenue, busiest day / hour, component frequency through
the bridge, quarterly revenue trend, average order value by category).

Money is summed exactly as DECIMAL and only cast to double at the end.
Where a measure is a per-product constant (price), the fact is aggregated
*before* the dimension join, so the big side shuffles once on a narrow key
with map-side partial aggregation (hot keys collapse before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


MONEY = "decimal(18,2)"


def _price(col: str = "price"):
    return F.col(col).cast(MONEY)


def gross_amount(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Fact lines with ``unit_price`` and ``gross_amount = quantity_valid × price``
    from the product dimension (joined on ``product_sk`` at query time)."""
    d = dim.select("product_sk", _price().alias("__price"))
    j = fact.join(d, "product_sk", "left")
    return j.select(
        "order_detail_sk", "order_detail_id", "order_id", "product_id", "order_date",
        "quantity_valid",
        F.col("__price").cast("double").alias("unit_price"),
        (F.col("quantity_valid") * F.col("__price")).cast("double").alias("gross_amount"),
    )


def _product_totals(fact: DataFrame, dim: DataFrame) -> DataFrame:
    q = fact.groupBy("product_sk").agg(F.sum("quantity_valid").alias("quantity"),
                                       F.count(F.lit(1)).alias("n_lines"))
    return q.join(dim, "product_sk", "inner").select(
        "*", (F.col("quantity") * _price()).alias("__revenue"))


def revenue_by_product(fact: DataFrame, dim: DataFrame, k: int | None = 10) -> DataFrame:
    """Top ``k`` products by revenue (ties by product_id); ``k=None`` keeps all."""
    t = _product_totals(fact, dim).select(
        "product_id", "product_name", "product_category",
        F.col("quantity").cast("bigint").alias("quantity"),
        F.col("__revenue").cast("double").alias("revenue"))
    t = t.orderBy(F.col("revenue").desc_nulls_last(), "product_id")
    return t.limit(k) if k else t


def busiest_day(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Orders, lines and quantity per weekday. An order has one date, so
    distinct orders are counted per date first (shuffle on (date, order)),
    then summed per weekday after joining the small calendar."""
    per_date = fact.groupBy("date_sk").agg(
        F.count_distinct("order_id").alias("n_orders"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("quantity_valid").alias("quantity"))
    # the calendar is small, but its size is checked by AQE at runtime
    # (adaptive autoBroadcastJoinThreshold), not by an extra job here
    cal = dates.select("date_sk", "day_of_week", "day_name")
    return (per_date.join(cal, "date_sk", "inner")
            .groupBy("day_of_week", "day_name")
            .agg(F.sum("n_orders").cast("bigint").alias("n_orders"),
                 F.sum("n_lines").cast("bigint").alias("n_lines"),
                 F.sum("quantity").cast("bigint").alias("total_quantity")))


def busiest_hour(events: DataFrame, ts: str = "ts", who: str = "user_id") -> DataFrame:
    """Events and distinct actors per hour of day."""
    return (events.select(F.hour(ts).alias("hour_of_day"), who)
            .groupBy("hour_of_day")
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.count_distinct(who).alias("n_users")))


def component_frequency(fact: DataFrame, dim: DataFrame, bridge: DataFrame) -> DataFrame:
    """Per component: distinct orders containing it and quantity of the
    lines whose product contains it (each product counted once per
    component, so repeated list entries do not double count).

    Plan: the small product -> component map is built first (dimension ⋈
    distinct bridge pairs; bounded by products x components per product),
    so the fact joins it directly -- AQE broadcasts it when it is small and
    the fact then streams without a shuffle. Then a (component, order)
    aggregation with map-side partial sums, then one row per component.
    No revenue is summed past the many-to-many fan-out.
    """
    pairs = bridge.where(F.col("component").isNotNull()).select("product_type_sk", "component")
    product_components = (dim.select("product_sk", "product_type_sk").join(pairs, "product_type_sk", "inner")
                          .select("product_sk", "component").distinct())
    lines = fact.select("order_id", "product_sk", "quantity_valid").join(product_components, "product_sk", "inner")
    per_order = lines.groupBy("component", "order_id").agg(F.sum("quantity_valid").alias("q"))
    return per_order.groupBy("component").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("q").cast("bigint").alias("total_quantity"))


def revenue_by_quarter(fact: DataFrame, dim: DataFrame, dates: DataFrame) -> DataFrame:
    """Revenue per (year, quarter) with the previous calendar quarter's
    revenue and the change. Quarters are few, so the previous-quarter
    lookup is a self-join on a quarter index (no unpartitioned window)."""
    per = fact.groupBy("product_sk", "date_sk").agg(F.sum("quantity_valid").alias("q"))
    amt = per.join(dim.select("product_sk", _price().alias("__price")), "product_sk", "inner")
    cal = dates.select("date_sk", "year_number", "quarter_number")
    q = (amt.join(cal, "date_sk", "inner")
         .groupBy("year_number", "quarter_number")
         .agg(F.sum(F.col("q") * F.col("__price")).alias("__rev")))
    q = q.select("year_number", "quarter_number",
                 (F.col("year_number") * 4 + F.col("quarter_number")).alias("__qi"),
                 F.col("__rev").cast("double").alias("revenue"))
    prev = q.select((F.col("__qi") + 1).alias("__qi"), F.col("revenue").alias("prev_revenue"))
    out = q.join(prev, "__qi", "left")
    return out.select(
        "year_number", "quarter_number", "revenue", "prev_revenue",
        (F.col("revenue") - F.col("prev_revenue")).alias("revenue_change"),
        ((F.col("revenue") - F.col("prev_revenue")) / F.col("prev_revenue") * 100).alias("pct_change"))


def avg_order_value(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Average order value per product category: amount per (order,
    category) first, then the mean over orders."""
    d = dim.select("product_sk", "product_category", _price().alias("__price"))
    lines = fact.select("order_id", "product_sk", "quantity_valid").join(d, "product_sk", "inner")
    per_order = lines.groupBy("product_category", "order_id").agg(
        F.sum(F.col("quantity_valid") * F.col("__price")).alias("amount"))
    return per_order.groupBy("product_category").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("amount").cast("double").alias("total_revenue"),
    ).select("product_category", "n_orders", "total_revenue",
             (F.col("total_revenue") / F.col("n_orders")).alias("avg_order_value"))
