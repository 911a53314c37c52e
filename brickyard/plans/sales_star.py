"""The driver's TPC-H-style tables mapped onto the sales star.

orders -> order headers (order_id = o_orderkey, order_date = o_orderdate as date)
lineitem -> order lines (order_detail_id = l_orderkey*10 + l_linenumber; not
    unique, so silver dedupes: latest l_shipdate, ties by part/supplier/qty/price)
part -> products *and* product types (id = p_partkey as string, category =
    p_type, component list = the words of p_name, size code banded from p_size,
    price = p_retailprice)
Size labels come from the built-in seed. Load stamps are pinned literals so
every build (and the SQL oracle) is reproducible.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brickyard.functions.columns import band
from brickyard.operators.calendar import date_dim, date_spine
from brickyard.operators.clean import silver_clean
from brickyard.operators.explode import split_explode
from brickyard.operators.star import (bridge, bronze_capture, distinct_dim, line_fact,
                                      product_dim)
from brickyard.sources.io import read_source
from brickyard.sources.seed import size_labels

# Fixed values of this mapping (shared with the SQL oracle).
SRC_SYS = "tpch"
RUN_TS = "2024-02-01 00:00:00"      # first load
RUN_TS_2 = "2024-02-02 00:00:00"    # second (incremental) load
AS_OF = "2000-06-15"                # reference date for relative calendar columns
COMPONENT_DELIM = " "
SIZE_BANDS = [(11, "S"), (21, "M"), (31, "L"), (41, "XL")]
SIZE_TOP = "XXL"
PRICE_BANDS = [(925, "Budget"), (950, "Standard"), (975, "Premium")]
PRICE_TOP = "Luxury"


def line_key():
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def silver_lines_spec() -> dict:
    """``silver_clean`` of the order lines."""
    return {"columns": {"order_detail_id": (line_key(), "bigint"), "order_id": ("l_orderkey", "bigint"), "product_id": ("l_partkey", "string"),
                        "quantity": (F.round("l_quantity"), "bigint")},  # half away from zero, not truncated
            "keys": ["order_detail_id"], "order_by": ["src_upd_ts", "l_shipdate"],
            "tie_breakers": ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]}


class SalesStar:
    """Lazily built layers of the star over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, run_ts: str = RUN_TS):
        self.spark, self.sf_dir, self.run_ts = spark, sf_dir, run_ts

    def raw(self, name: str) -> DataFrame:
        return read_source(self.spark, self.sf_dir, name)

    # ---- bronze ----
    def bronze(self, name: str, raw: DataFrame | None = None, run_ts: str | None = None) -> DataFrame:
        return bronze_capture(self.raw(name) if raw is None else raw, SRC_SYS, run_ts or self.run_ts)

    # ---- silver ----
    def silver_orders(self, bronze: DataFrame | None = None) -> DataFrame:
        b = self.bronze("orders") if bronze is None else bronze
        return silver_clean(b, {"order_id": ("o_orderkey", "bigint"),
                                "order_date": ("o_orderdate", "date")},
                            keys=["order_id"], tie_breakers=["order_date"])

    def silver_order_details(self, bronze: DataFrame | None = None) -> DataFrame:
        b = self.bronze("lineitem") if bronze is None else bronze
        return silver_clean(b, **silver_lines_spec())

    @cached_property
    def silver_part(self) -> DataFrame:
        """One silver pass over ``part``: products and product types both come
        from it in this mapping, so they share a single dedupe shuffle."""
        return silver_clean(self.bronze("part"),
                            {"product_id": ("p_partkey", "string"),
                             "product_type_id": ("p_partkey", "string"),
                             "size_code": (band("p_size", SIZE_BANDS, SIZE_TOP), "string"),
                             "price": ("p_retailprice", "double"),
                             "product_name": ("p_name", "string"),
                             "product_category": ("p_type", "string"),
                             "component_list": ("p_name", "string")},
                            keys=["product_id"], tie_breakers=["price", "product_name", "product_category", "size_code"])

    def silver_products(self) -> DataFrame:
        return self.silver_part.select("product_id", "product_type_id", "size_code", "price",
                                       "src_sys", "src_crt_ts", "src_upd_ts")

    def silver_product_types(self) -> DataFrame:
        return self.silver_part.select("product_type_id", "product_name", "product_category",
                                       "component_list", "src_sys", "src_crt_ts", "src_upd_ts")

    def silver_components(self) -> DataFrame:
        """Exploded component list per product type (from bronze, trimmed)."""
        b = self.bronze("part").select(
            F.trim(F.col("p_partkey").cast("string")).alias("product_type_id"),
            F.trim(F.col("p_type")).alias("product_category"),
            F.col("p_name").alias("component_list"),
            "src_sys", F.col("crt_ts").alias("src_crt_ts"), F.col("upd_ts").alias("src_upd_ts"))
        return split_explode(b, "component_list", COMPONENT_DELIM, "component", "component_position")

    # ---- gold ----
    @cached_property
    def dim_product(self) -> DataFrame:
        # items and types are the same silver pass over part here, so the
        # type columns ride along and no self-join is planned
        return product_dim(self.silver_part, None, size_labels(self.spark), PRICE_BANDS, PRICE_TOP,
                           COMPONENT_DELIM, self.run_ts, labels_max_rows=None)

    def dim_product_join(self) -> DataFrame:
        """The same dimension from items and types as two relations."""
        return product_dim(self.silver_products(), self.silver_product_types(), size_labels(self.spark), PRICE_BANDS, PRICE_TOP,
                           COMPONENT_DELIM, self.run_ts, labels_max_rows=None)

    def dim_components(self) -> DataFrame:
        return distinct_dim(self.silver_components(), "component", "component_sk", self.run_ts)

    def bridge_components(self, strict: bool = False, parent: DataFrame | None = None, components: DataFrame | None = None) -> DataFrame:
        return bridge(self.silver_components(), self.dim_components() if components is None else components, parent=parent,
                      strict=strict, run_ts=self.run_ts)

    def date_bounds(self) -> DataFrame:
        """Whole years covering the order dates (derived from the data)."""
        o = self.raw("orders").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
        return o.select(F.trunc(F.col("lo").cast("date"), "year").alias("start"),
                        F.last_day(F.add_months(F.trunc(F.col("hi").cast("date"), "year"), 11)).alias("end"))

    def dim_date(self, fiscal_start_month: int = 2) -> DataFrame:
        return date_dim(date_spine(bounds=self.date_bounds()), AS_OF, fiscal_start_month, self.run_ts)

    def fact_orders(self, lines: DataFrame | None = None, headers: DataFrame | None = None,
                    run_ts: str | None = None) -> DataFrame:
        return line_fact(self.silver_order_details() if lines is None else lines,
                         self.silver_orders() if headers is None else headers,
                         run_ts or self.run_ts)

    def publish(self) -> list[str]:
        """Register every layer as a temp view so the star can be queried
        with ``spark.sql`` (views are inlined by Catalyst; nothing runs)."""
        views = {
            "bronze_orders": self.bronze("orders"), "bronze_lineitem": self.bronze("lineitem"),
            "bronze_part": self.bronze("part"),
            "silver_orders": self.silver_orders(), "silver_order_details": self.silver_order_details(),
            "silver_products": self.silver_products(), "silver_product_types": self.silver_product_types(),
            "silver_components": self.silver_components(),
            "dim_product": self.dim_product, "dim_components": self.dim_components(),
            "bridge_components": self.bridge_components(), "dim_date": self.dim_date(),
            "fact_orders": self.fact_orders(),
        }
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return list(views)
