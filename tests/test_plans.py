"""Plan-shape checks for the scale properties the operators rely on."""

from pyspark.sql import functions as F

from brickyard.operators import retrieve as R
from brickyard.operators.clean import dedupe_latest
from brickyard.operators.star import line_fact


def _final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_prelimits_before_shuffle(spark, sf_small):
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    plan = dedupe_latest(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"], ["l_partkey"]) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_order_is_split_by_aqe(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30000
        lines = spark.range(n).select(
            F.col("id").alias("order_detail_id"),
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("order_id"),  # a third on order 7
            F.lit("p").alias("product_id"), F.lit(1).cast("bigint").alias("quantity"))
        headers = spark.range(n).select(F.col("id").alias("order_id"), F.current_date().alias("order_date"),
                                        F.lit("s").alias("src_sys"), F.lit(None).cast("timestamp_ntz").alias("src_crt_ts"),
                                        F.lit(None).cast("timestamp_ntz").alias("src_upd_ts"))
        plan = _final_plan(line_fact(lines, headers, "2024-01-01 00:00:00"))
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_history_windows_are_buckets(spark):
    """Windows over messages are partitioned by (conversation, bucket), never by the conversation alone."""
    conv = spark.createDataFrame([(1, 0, "user", "x")], "conv_id bigint, turn bigint, role string, text string")
    plan = R.chat_history(conv, 4)._jdf.queryExecution().optimizedPlan().toString()
    over_messages = [x for x in plan.splitlines() if "Window [" in x and ("collect_list" in x or "row_number" in x)]
    assert len(over_messages) == 2
    for line in over_messages:
        keys = line.rsplit("], [", 2)[-2]
        assert len(keys.split(", ")) == 2


def test_retrieval_has_no_pair_join(spark, sf_small):
    e = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    qs = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    for df in (R.vector_topk(e, e, 3), R.keyword_topk(qs, docs, 3)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
        assert "FlatMapCoGroupsInArrow" in plan and "WindowGroupLimit" in plan


def test_queries_load_without_a_session():
    """The driver imports the entry before it makes a session."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0 and int(out.stdout.split()[0]) >= 60, out.stderr


def test_orphans_are_found_before_lines_get_their_keys(spark, sf_small):
    """The anti-join sends lines with one hash key, not facts with four."""
    from brickyard.plans.registry import QUERIES
    plan = QUERIES["orphan_antijoin"](spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("LeftAnti", 1)
    assert "AS order_sk" in above and "AS order_sk" not in below and "AS date_sk" not in below


def test_merge_carries_its_key_only(spark, sf_small):
    """The stored first load has the merge key; the other hash keys follow the merge."""
    from brickyard.plans.registry import QUERIES
    out = QUERIES["fact_incremental_merge"](spark, sf_small)
    stored = [f for f in out.inputFiles() if "/fact-" in f]
    assert stored
    held = set(spark.read.parquet(*stored).columns)
    assert "order_detail_sk" in held and not held & {"product_sk", "date_sk", "order_sk"} and held < set(out.columns)


def test_line_keys_after_line_rows(spark):
    from brickyard.operators.star import line_fact, line_keys, line_rows
    lines = spark.createDataFrame([(1, 10, "a", 3), (2, 10, None, 0), (3, None, "b", None)], "order_detail_id long, order_id long, product_id string, quantity long")
    heads = spark.sql("select 10L order_id, date'2024-01-02' order_date, 's' src_sys, timestamp_ntz'2024-01-01' src_crt_ts, timestamp_ntz'2024-01-01' src_upd_ts")
    a, b = line_fact(lines, heads, "2024-02-01 00:00:00"), line_keys(line_rows(lines, heads), "2024-02-01 00:00:00")
    assert a.schema == b.schema and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert a.columns[:4] == ["order_detail_sk", "product_sk", "date_sk", "order_sk"]
