import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from brickyard.operators.load import incremental_filter, load_incremental, sync_schema, upsert
from brickyard.operators.star import line_fact
from brickyard.sources.io import write_table

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
D1, D2 = dt.date(2015, 1, 1), dt.date(2015, 1, 2)


def test_empty_target_parity_and_all(spark):
    src = spark.createDataFrame([(1,), (2,)], "k int")
    empty = spark.createDataFrame([], "k int")
    assert incremental_filter(src, empty, "k").count() == 0
    assert incremental_filter(src, empty, "k", on_empty="all").count() == 2
    assert incremental_filter(src, None, "k").count() == 2  # first run


def test_same_date_late_row(spark):
    tgt = spark.createDataFrame([(1, D2)], "id int, d date")
    src = spark.createDataFrame([(1, D2), (2, D2), (3, D1)], "id int, d date")
    assert incremental_filter(src, tgt, "d").count() == 0              # parity: skipped
    out = load_incremental(src, tgt, "id", "d", inclusive=True)
    assert sorted(r.id for r in out.collect()) == [1, 2]                  # safe with the upsert


def test_watermark_pushed_to_scan(spark, sf_small):
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    plan = incremental_filter(li, li.limit(10), "l_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_orderkey,ScalarSubquery" in plan


def _lines(spark, rows):
    return spark.createDataFrame(rows, "order_detail_id bigint, order_id bigint, product_id string, quantity bigint, "
                                       "src_crt_ts timestamp_ntz, src_upd_ts timestamp_ntz")


def _headers(spark, rows):
    return spark.createDataFrame(rows, "order_id bigint, order_date date, src_sys string, src_crt_ts timestamp_ntz, "
                                       "src_upd_ts timestamp_ntz")


def test_line_after_its_order(spark):
    h = _headers(spark, [(10, D1, "s", T1, T1)])
    run1 = line_fact(_lines(spark, [(1, 99, "p", 1, T1, T1)]), h, T1)      # no line for order 10 yet
    lines2 = _lines(spark, [(1, 99, "p", 1, T1, T1), (2, 10, "p", 1, T2, T2)])
    parity = load_incremental(line_fact(lines2, h, T2), run1, "order_detail_sk", "src_crt_ts")
    assert 2 not in [r.order_detail_id for r in parity.collect()]           # lost: header stamp is old
    safe = load_incremental(line_fact(lines2, h, T2, stamps="latest"),
                            line_fact(_lines(spark, [(1, 99, "p", 1, T1, T1)]), h, T1, stamps="latest"),
                            "order_detail_sk", "src_crt_ts")
    assert sorted(r.order_detail_id for r in safe.collect()) == [1, 2]


def test_line_before_its_order(spark):
    lines = _lines(spark, [(1, 10, "p", 3, T1, T1), (2, 11, "p", 1, T1, T1)])
    run1 = line_fact(lines, _headers(spark, [(11, D1, "s", T1, T1)]), T1)
    r1 = run1.where("order_detail_id = 1").first()
    assert r1.order_date is None and r1.src_crt_ts is None
    h2 = _headers(spark, [(11, D1, "s", T1, T1), (10, D2, "s", T2, T2)])
    out = {r.order_detail_id: r for r in
           load_incremental(line_fact(lines, h2, T2), run1, "order_detail_sk", "src_crt_ts").collect()}
    assert len(out) == 2 and out[1].order_date == D2 and out[2].order_date == D1


def test_upsert_semantics(spark):
    tgt = spark.createDataFrame([(1, "old", T1), (2, "old", T1), (None, "nullkey", T1)], "k int, v string, crt_ts timestamp_ntz")
    src = spark.createDataFrame([(2, "new", T2), (3, "new", T2), (None, "nullsrc", T2)], "k int, v string, crt_ts timestamp_ntz")
    out = {(r.k, r.v) for r in upsert(tgt, src, "k").collect()}
    assert out == {(1, "old"), (2, "new"), (3, "new"), (None, "nullkey"), (None, "nullsrc")}
    kept = {r.k: r.crt_ts for r in upsert(tgt, src, "k", preserve=["crt_ts"]).collect() if r.k is not None}
    assert kept == {1: T1, 2: T1, 3: T2}


def test_upsert_duplicate_source_key_raises(spark):
    tgt = spark.createDataFrame([(1, "a")], "k int, v string")
    src = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(ValueError):
        upsert(tgt, src, "k")
    with pytest.raises(ValueError):
        load_incremental(src, None, "k", None)
    assert upsert(tgt, src.limit(1), "k").count() == 1


def test_schema_change(spark):
    tgt = spark.createDataFrame([(1, "x", 5)], "k int, gone string, v int")
    inc = spark.createDataFrame([(2, 7, "n")], "k int, v bigint, added string")
    s = sync_schema(tgt, inc)
    assert s.columns == ["k", "v", "added"] and s.first().added is None
    out = load_incremental(inc, tgt, "k", "k").orderBy("k").collect()
    assert [(r.k, r.v, r.added) for r in out] == [(1, 5, None), (2, 7, "n")]


def test_write_refuses_to_overwrite_its_input(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.range(3).write.parquet(p)
    df = spark.read.parquet(p).withColumn("x", F.lit(1))
    with pytest.raises(ValueError):
        write_table(df, p)
    write_table(df, str(tmp_path / "t2"))
    assert spark.read.parquet(str(tmp_path / "t2")).count() == 3


def test_merge_partitions_rewrites_only_touched(spark, tmp_path):
    from brickyard.operators.load import merge_partitions
    path = str(tmp_path / "fact")
    schema = "k int, v string, d date"
    first = spark.createDataFrame([(1, "a", D1), (2, "b", D1), (3, "c", None), (4, "z", D2)], schema)
    merge_partitions(first, path, "k", ["d"])
    untouched = sorted(os.listdir(os.path.join(path, "d=2015-01-02")))
    # run 2: key 2 updated in place, key 3 moves out of the null partition, key 5 new
    second = spark.createDataFrame([(2, "B", D1), (3, "C", D1), (5, "e", D1)], schema)
    touched = merge_partitions(second, path, "k", ["d"], track_moves=True)
    assert set(touched) == {(D1,), (None,)}
    rows = sorted((r.k, r.v, r.d) for r in spark.read.parquet(path).collect())
    assert rows == [(1, "a", D1), (2, "B", D1), (3, "C", D1), (4, "z", D2), (5, "e", D1)]
    assert not os.path.exists(os.path.join(path, "d=__HIVE_DEFAULT_PARTITION__"))   # emptied partition removed
    assert sorted(os.listdir(os.path.join(path, "d=2015-01-02"))) == untouched       # not rewritten


def test_merge_partitions_escaped_values_and_two_columns(spark, tmp_path):
    from brickyard.operators.load import merge_partitions
    path = str(tmp_path / "t2")
    schema = "k int, v string, region string, d date"
    odd = "a/b:c=d"
    merge_partitions(spark.createDataFrame([(1, "x", odd, D1), (2, "y", "plain", D1)], schema), path, "k", ["region", "d"])
    assert any("%2F" in n for n in os.listdir(path))              # Spark escaped the value on disk
    # key 1 moves out of the oddly named partition, which becomes empty and must disappear
    merge_partitions(spark.createDataFrame([(1, "x2", "plain", D2)], schema), path, "k", ["region", "d"], track_moves=True)
    rows = sorted((r.k, r.v, r.region, r.d) for r in spark.read.parquet(path).collect())
    assert rows == [(1, "x2", "plain", D2), (2, "y", "plain", D1)]
    assert not any("%2F" in n for n in os.listdir(path))


def test_preserve_keeps_null_target_value(spark):
    tgt = spark.createDataFrame([(1, None), (2, T1)], "k int, crt_ts timestamp_ntz")
    src = spark.createDataFrame([(1, T2), (2, T2), (3, T2)], "k int, crt_ts timestamp_ntz")
    got = {r.k: r.crt_ts for r in upsert(tgt, src, "k", preserve=["crt_ts"]).collect()}
    assert got == {1: None, 2: T1, 3: T2}


def test_merge_partitions_string_values_keep_their_type(spark, tmp_path):
    from brickyard.operators.load import merge_partitions
    schema = "k int, v string, p string"
    for values in (["01", "02"], ["2015-01-01", "2015-01-02"], ["1.50", "2.0"], ["1e3", " x"]):
        path = str(tmp_path / values[0].replace(" ", "_"))
        merge_partitions(spark.createDataFrame([(1, "a", values[0]), (2, "b", values[1])], schema), path, "k", ["p"])
        before = sorted(n for n in os.listdir(path) if n.startswith("p="))
        for _ in range(2):   # a rerun converges
            merge_partitions(spark.createDataFrame([(2, "B", values[1])], schema), path, "k", ["p"])
            rows = sorted((r.k, r.v, r.p) for r in spark.read.schema(schema).parquet(path).collect())
            assert rows == [(1, "a", values[0]), (2, "B", values[1])]
            assert sorted(n for n in os.listdir(path) if n.startswith("p=")) == before


def test_merge_partitions_duplicates_raise_and_moves_converge(spark, tmp_path):
    from brickyard.operators.load import merge_partitions
    path, schema = str(tmp_path / "t"), "k int, v string, p string"
    with pytest.raises(ValueError):
        merge_partitions(spark.createDataFrame([(1, "a", "x"), (1, "b", "y")], schema), path, "k", ["p"])
    assert not os.path.exists(path)
    merge_partitions(spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "y")], schema), path, "k", ["p"])
    # as after a crash between the overwrite and the deletion: key 2 in both partitions
    spark.createDataFrame([(2, "B")], "k int, v string").write.mode("append").parquet(path + "/p=x")
    for _ in range(2):
        merge_partitions(spark.createDataFrame([(2, "B", "x")], schema), path, "k", ["p"], track_moves=True)
        assert sorted((r.k, r.v, r.p) for r in spark.read.schema(schema).parquet(path).collect()) == [(1, "a", "x"), (2, "B", "x"), (3, "c", "y")]


def test_merge_without_moves_reads_touched_partitions_only(spark, tmp_path):
    from brickyard.operators.load import _any_of
    path = str(tmp_path / "t")
    spark.createDataFrame([(i, f"p{i % 5}") for i in range(20)], "k int, p string").write.partitionBy("p").parquet(path)
    plan = spark.read.parquet(path).where(_any_of(["p"], [("p1",), ("p3",)]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [p#" in plan and "p1" in plan.split("PartitionFilters")[1]


def test_shared_folder_is_required_on_a_cluster(spark):
    from brickyard import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())


def test_moved_keys_leave_their_old_partition_by_default(spark, tmp_path):
    from brickyard.operators.load import merge_partitions
    path, schema = str(tmp_path / "t"), "k int, v string, p string"
    merge_partitions(spark.createDataFrame([(1, "old", "p1"), (2, "b", "p1")], schema), path, "k", ["p"])
    merge_partitions(spark.createDataFrame([(1, "new", "p2")], schema), path, "k", ["p"])
    assert sorted(tuple(r) for r in spark.read.schema(schema).parquet(path).collect()) == [(1, "new", "p2"), (2, "b", "p1")]


@pytest.mark.parametrize("where", ["before", "between"])
def test_merge_partitions_replay(spark, tmp_path, monkeypatch, where):
    """A load that dies while it is written back is finished by a rerun; one that is through changes nothing; null keys stand once."""
    from brickyard.operators import load as L
    path, schema = str(tmp_path / "t"), "k int, v string, p string"
    L.merge_partitions(spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (None, "n0", "x")], schema), path, "k", ["p"], load="one")
    batch = spark.createDataFrame([(2, "B", "x"), (None, "n1", "x")], schema)
    real = L._publish

    def die(spark_, merged, touched, target, cols):
        if where == "between":   # written over, nothing deleted yet
            merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(target)
        raise KeyboardInterrupt

    monkeypatch.setattr(L, "_publish", die)
    with pytest.raises(KeyboardInterrupt):
        L.merge_partitions(batch, path, "k", ["p"], load="two")
    monkeypatch.setattr(L, "_publish", real)
    want = sorted([(1, "a", "x"), (2, "B", "x"), (None, "n0", "x"), (None, "n1", "x")], key=str)
    for _ in range(3):
        L.merge_partitions(batch, path, "k", ["p"], load="two")
        assert sorted((tuple(r) for r in spark.read.schema(schema).parquet(path).collect()), key=str) == want
    L.merge_partitions(spark.createDataFrame([(2, "C", "y")], schema), path, "k", ["p"], load="three")
    L.merge_partitions(batch, path, "k", ["p"], load="two")     # an old load does not come back
    assert {r.v for r in spark.read.schema(schema).parquet(path).where("k = 2").collect()} == {"C"}


def test_late_rows_replace_nothing(spark):
    schema = "k int, v string, t int"
    tgt = spark.createDataFrame([(1, "new", 5), (2, "b", 1), (None, "n", 0)], schema)
    src = spark.createDataFrame([(1, "late", 3), (2, "B", 2), (3, "c", 0), (None, "m", 9)], schema)
    out = sorted((tuple(r) for r in upsert(tgt, src, "k", latest_by=["t"]).collect()), key=str)
    assert out == sorted([(1, "new", 5), (2, "B", 2), (3, "c", 0), (None, "n", 0), (None, "m", 9)], key=str)


def test_first_load_plans_its_source_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        runs.add(1)
        yield from batches

    src = spark.range(10, numPartitions=1).mapInArrow(count, "id long")
    assert load_incremental(src, None, "id", None).count() == 10 and runs.value == 1


def test_nested_schema_sync(spark):
    """Fields by name at every depth; whole numbers, decimals, floats and dates widen."""
    tgt = spark.createDataFrame([(1, (1, "gone", (2, "x")), [(1, 2)], {"a": (1,)}, 5, 1.5, D1), (2, None, None, None, None, None, None)],
                                "k int, s struct<a: int, b: string, n: struct<c: int, d: string>>, l array<struct<x: int, y: int>>, m map<string, struct<z: int>>, "
                                "w int, f float, d date")
    inc = spark.createDataFrame([], "k bigint, s struct<n: struct<c: bigint, e: string>, a: int, new: string>, l array<struct<y: bigint, q: string>>, "
                                    "m map<string, struct<z: bigint, t: string>>, w decimal(12, 2), f double, d timestamp_ntz, extra int")
    out = sync_schema(tgt, inc)
    assert out.schema.simpleString() == inc.schema.simpleString().replace("w:decimal(12,2)", "w:decimal(12,2)")
    row, empty = out.orderBy("k").collect()
    assert row.s.asDict(recursive=True) == {"n": {"c": 2, "e": None}, "a": 1, "new": None}
    assert [x.asDict() for x in row.l] == [{"y": 2, "q": None}] and row.m["a"].asDict() == {"z": 1, "t": None}
    assert (str(row.w), row.f, row.d, row.extra) == ("5.00", 1.5, T1.replace(year=2015), None)
    assert empty.s is None and empty.l is None and empty.m is None


def test_type_lattice(spark):
    from pyspark.sql import types as T

    from brickyard.operators.load import SchemaChange, merged_type, synced_schema
    i, l, s = T.IntegerType(), T.LongType(), T.StringType()
    for a, b, want in ((i, l, l), (l, i, l), (T.ByteType(), T.ShortType(), T.ShortType()), (i, T.DecimalType(5, 2), T.DecimalType(12, 2)),
                       (l, T.DecimalType(10, 2), T.DecimalType(22, 2)), (T.DecimalType(10, 4), T.DecimalType(12, 2), T.DecimalType(14, 4)),
                       (T.DoubleType(), T.FloatType(), T.DoubleType()), (T.NullType(), s, s), (T.ArrayType(i), T.ArrayType(l), T.ArrayType(l))):
        assert merged_type(a, b, "c") == want
    for a, b in ((s, i), (i, s), (T.DecimalType(38, 0), T.DecimalType(20, 10)), (T.ArrayType(i), i), (T.TimestampType(), T.DateType()), (l, T.DoubleType())):
        with pytest.raises(SchemaChange, match="a.b"):
            merged_type(a, b, "a.b")
    wide = synced_schema(T.StructType([T.StructField("v", l)]), T.StructType([T.StructField("V", i)]))
    assert wide.simpleString() == "struct<V:bigint>"
    tgt, inc = spark.createDataFrame([(1, 2**40)], "k int, v bigint"), spark.createDataFrame([(2, 7)], "k int, v int")
    assert sorted(tuple(r) for r in load_incremental(inc, tgt, "k", "k").collect()) == [(1, 2**40), (2, 7)]   # a narrower batch is widened
    with pytest.raises(SchemaChange, match="s.x"):
        sync_schema(spark.createDataFrame([], "s struct<x: string>"), spark.createDataFrame([], "s struct<x: int>"))


def test_footer_mark(spark, tmp_path):
    from brickyard.operators.load import _footer_plan, footer_mark
    path = str(tmp_path / "t")
    spark.createDataFrame([(i, float(i), D1 if i % 2 else D2, f"s{i}") for i in range(100)], "k int, f double, d date, s string").repartition(3).write.parquet(path)
    assert (footer_mark(spark, path, "k"), footer_mark(spark, path, "d"), footer_mark(spark, path, "f")) == (99, D2, 99.0)
    plan = _footer_plan(spark, path, "k", lambda df: df._jdf.queryExecution().executedPlan().toString())
    assert "PushedAggregation: [MAX(k)]" in plan and "max(k)" in plan.lower() and "ReadSchema: struct<max(k):int>" in plan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""
    src = spark.range(95, 105).selectExpr("cast(id as int) AS k")
    assert sorted(r.k for r in incremental_filter(src, path, "k").collect()) == [100, 101, 102, 103, 104]
    spark.createDataFrame([], "k int").write.parquet(str(tmp_path / "e"))
    assert incremental_filter(src, str(tmp_path / "e"), "k").count() == 0
    assert incremental_filter(src, str(tmp_path / "e"), "k", on_empty="all").count() == 10
