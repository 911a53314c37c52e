from importlib.resources import files

from pyspark.sql import functions as F

import pytest

from brickyard.operators.clean import rename_select
from brickyard.sources.io import publish_view, read_seed, read_source, write_table
from brickyard.sources.seed import SIZE_LABEL_SCHEMA, SIZE_LABELS, packaged_seed, size_labels


def test_read_seed_typed(spark, tmp_path):
    p = tmp_path / "sizes.csv"
    p.write_text(files("brickyard.sources").joinpath("size_labels.csv").read_text())
    df = read_seed(spark, str(p), SIZE_LABEL_SCHEMA)
    assert df.schema == size_labels(spark).schema
    assert sorted(tuple(r) for r in df.collect()) == sorted(SIZE_LABELS)


def test_read_source_prunes_columns(spark, sf_small):
    df = read_source(spark, sf_small, "orders").select("o_orderkey").where(F.col("o_orderkey") > 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
    assert "GreaterThan(o_orderkey,5)" in plan


def test_write_table_catalog_with_properties(spark, tmp_path):
    df = spark.range(4).withColumn("d", F.col("id") % 2)
    write_table(df, path=str(tmp_path / "tbl"), name="by_test_tbl", partition_by=["d"],
                properties={"tags": "dimension,date"})
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES by_test_tbl").collect()}
    assert props.get("tags") == "dimension,date"
    assert spark.table("by_test_tbl").count() == 4
    spark.sql("DROP TABLE by_test_tbl")


def test_view_sink_and_rename(spark):
    df = rename_select(spark.range(3), {"key": "id", "twice": F.col("id") * 2})
    publish_view(df, "by_test_view")
    assert spark.sql("SELECT sum(twice) AS s FROM by_test_view").first().s == 6
    assert df.columns == ["key", "twice"]


def test_bucketed_tables_join_without_shuffle(spark):
    left = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("a"))
    right = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("b"))
    write_table(left, name="by_bucket_l", bucket_by=(8, ["k"]))
    write_table(right, name="by_bucket_r", bucket_by=(8, ["k"]))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("by_bucket_l").join(spark.table("by_bucket_r"), "k")
        assert j.count() == 2000
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE by_bucket_l")
        spark.sql("DROP TABLE by_bucket_r")


def test_packaged_seed(spark):
    got = packaged_seed(spark, "size_labels.csv", SIZE_LABEL_SCHEMA)
    assert [tuple(r) for r in got.collect()] == SIZE_LABELS and got.schema == size_labels(spark).schema
    with pytest.raises(ValueError):
        packaged_seed(spark, "size_labels.csv", "size_code string, other string")
