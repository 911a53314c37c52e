import os

from brickyard.streaming import ingest_available


def test_available_now_ingest_upserts_new_files(spark, tmp_path):
    src, tgt = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k bigint, v string"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).coalesce(1).write.parquet(os.path.join(src, "f1"))
    v0 = ingest_available(spark, src + "/*", schema, tgt, "k", run_ts="2024-01-01 00:00:00", name="t1")
    assert sorted((r.k, r.v) for r in spark.read.parquet(v0).collect()) == [(1, "a"), (2, "b")]
    spark.createDataFrame([(2, "B"), (3, "c")], schema).coalesce(1).write.parquet(os.path.join(src, "f2"))
    v1 = ingest_available(spark, src + "/*", schema, tgt, "k", run_ts="2024-01-02 00:00:00", name="t1")
    assert v1 != v0
    assert sorted((r.k, r.v) for r in spark.read.parquet(v1).collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_available_now_ingest_into_partitions(spark, tmp_path):
    src, tgt = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k bigint, v string, p string"
    spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], schema).coalesce(1).write.parquet(os.path.join(src, "f1"))
    ingest_available(spark, src + "/*", schema, tgt, "k", run_ts="2024-01-01 00:00:00", name="t2",
                     partition_cols=["p"])
    spark.createDataFrame([(2, "B", "y"), (3, "c", "x")], schema).coalesce(1).write.parquet(os.path.join(src, "f2"))
    out = ingest_available(spark, src + "/*", schema, tgt, "k", run_ts="2024-01-02 00:00:00", name="t2",
                           partition_cols=["p"])
    assert sorted((r.k, r.v, r.p) for r in spark.read.parquet(out).collect()) == [(1, "a", "x"), (2, "B", "y"), (3, "c", "x")]


def test_one_row_a_key_from_two_files_of_one_drop(spark, tmp_path):
    schema = "k bigint, v string, p string, n int"
    for form, parts in (("v", None), ("p", ["p"])):
        src, tgt = str(tmp_path / f"in{form}"), str(tmp_path / f"out{form}")
        spark.createDataFrame([(1, "a", "x", 1), (2, "old", "x", 1), (None, "n1", "x", 1)], schema).coalesce(1).write.parquet(os.path.join(src, "f1"))
        spark.createDataFrame([(2, "new", "y", 2), (3, "c", "y", 2), (None, "n2", "x", 2)], schema).coalesce(1).write.parquet(os.path.join(src, "f2"))
        out = ingest_available(spark, src + "/*", schema, tgt, "k", run_ts="2024-01-01 00:00:00", name=f"dup{form}", partition_cols=parts,
                               order_by=["n"])
        rows = sorted((r.k or 0, r.v, r.p) for r in spark.read.parquet(out).collect())
        assert rows == [(0, "n1", "x"), (0, "n2", "x"), (1, "a", "x"), (2, "new", "y"), (3, "c", "y")]


def drop(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(folder)


def test_targets_of_one_name_have_their_own_checkpoint(spark, tmp_path):
    src = str(tmp_path / "in")
    drop(spark, src + "/f1", [(1, "a")], "k bigint, v string")
    for t in ("one", "two"):
        out = ingest_available(spark, src + "/*", "k bigint, v string", str(tmp_path / t), "k", run_ts="2024-01-01 00:00:00")
        assert spark.read.parquet(out).count() == 1


def test_the_same_epoch_twice_changes_nothing(spark, tmp_path):
    """Also with null keys, into versions and into partitions; the next epoch loads."""
    from pyspark.sql import functions as F

    from brickyard.streaming import ingest
    schema = "k bigint, v string, p string"

    def files(rows):
        return spark.createDataFrame(rows, schema).withColumns({"__time": F.lit("2024-01-01 00:00:00").cast("timestamp"), "__path": F.lit("f")})

    for parts in (None, ["p"]):
        root = str(tmp_path / f"t{bool(parts)}")

        def load(rows, epoch, parts=parts, root=root):
            ingest.merge_batch(spark, files(rows), f"id:{epoch}", ["k", "v", "p"], root, "k", "s", "2024-01-01 00:00:00", parts, None, True)

        def now(parts=parts, root=root):
            path = root if parts else ingest._latest_version(spark, root)
            return sorted(((r.k, r.v, r.p) for r in spark.read.parquet(path).collect()), key=str)

        load([(1, "a", "x"), (None, "n", "x")], 0)
        load([(1, "b", "y"), (None, "m", "x")], 1)
        want = sorted([(1, "b", "y"), (None, "n", "x"), (None, "m", "x")], key=str)
        for _ in range(2):
            assert now() == want
            load([(1, "b", "y"), (None, "m", "x")], 1)
        if parts is None:   # as after a crash before the version was complete
            os.remove(ingest._latest_version(spark, root) + "/_SUCCESS")
            load([(1, "b", "y"), (None, "m", "x")], 1)
            assert now() == want and sorted(n for n in os.listdir(root) if n.startswith("v=")) == ["v=0", "v=1"]
        load([(2, "c", "x")], 2)
        assert now() == sorted([*want, (2, "c", "x")], key=str)


def test_an_older_row_in_a_later_drop_loses(spark, tmp_path):
    schema = "k bigint, v string, p string, t int"
    for parts in (None, ["p"]):
        src, tgt = str(tmp_path / f"in{bool(parts)}"), str(tmp_path / f"out{bool(parts)}")
        drop(spark, src + "/f1", [(1, "new", "x", 5), (2, "b", "x", 1)], schema)
        args = {"run_ts": "2024-01-01 00:00:00", "partition_cols": parts, "order_by": ["t"]}
        ingest_available(spark, src + "/*", schema, tgt, "k", **args)
        drop(spark, src + "/f2", [(1, "late", "y", 3), (2, "B", "x", 2)], schema)
        out = ingest_available(spark, src + "/*", schema, tgt, "k", **args)
        assert sorted((r.k, r.v, r.p) for r in spark.read.parquet(out).collect()) == [(1, "new", "x"), (2, "B", "x")]


def test_latest_by_key_as_stream_state(spark, tmp_path):
    """State over batches: each gives its keys' latest rows so far, by the rows' own time."""
    from brickyard.streaming import latest_by_key
    src, schema = str(tmp_path / "in"), "k bigint, v string, t int"
    rows = [[(1, "a", 5), (2, "b", 1), (2, "b2", 1)], [(1, "late", 3), (2, "c", 2)], [(3, "d", None), (3, "e", 9), (1, "z", 5)]]
    seen = []
    for n, batch in enumerate(rows):
        drop(spark, f"{src}/f{n}", batch, schema)
        q = (latest_by_key(spark.readStream.schema(schema).parquet(src + "/*"), ["k"], ["t"]).writeStream.outputMode("update")
             .foreachBatch(lambda df, _: seen.append({r.k: (r.v, r.t) for r in df.collect()}) if not df.isEmpty() else None)
             .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
        q.awaitTermination()
    assert seen[1][1] == ("a", 5) and seen[1][2] == ("c", 2) and seen[2][3] == ("d", None)
    state = {}
    for s in seen:
        state |= s
    flat = spark.createDataFrame([r for b in rows for r in b], schema)
    assert state == {r.k: (r.v, r.t) for r in latest_by_key(flat, ["k"], ["t"]).collect()}
