import datetime as dt

import pytest

from brickyard.operators import quality as Q
from brickyard.operators.quality import Check


def test_nulls_pass_checks(spark):
    child = spark.createDataFrame([(None, None, None), (1, "a", 5)], "k int, c string, q int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert Q.check_relationships(child, "k", parent, "k").count() == 0
    assert Q.check_accepted_values(child, "c", ["a"]).count() == 0
    assert Q.check_expression(child, "q > 0").count() == 0
    assert Q.check_range(child, "q", 0, 100).count() == 0
    assert Q.check_positive(child, "q").count() == 0
    assert Q.check_not_null(child, "k").count() == 1


def test_unique_checks(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y"), (None, "y")], "k int, v string")
    assert [r.k for r in Q.check_unique(df, "k").collect()] == [1]          # nulls ignored
    assert Q.check_unique_combination(df, ["k", "v"]).count() == 2         # null combos group


def test_report_and_enforce(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, "z", 5), (2, None, 3)], "k int, c string, q int")
    parent = spark.createDataFrame([(1,)], "k int")
    checks = [Check("t", "unique", "k", severity="warn"), Check("t", "accepted_values", "c", values=["a"]),
              Check("t", "positive", "q"), Check("t", "not_null", "k"),
              Check("t", "relationships", "k", parent=parent, field="k"),
              Check("t", "expression", "q", expr="q < 10")]
    rep = {r.check: r for r in Q.quality_report({"t": df}, checks).collect()}
    assert (rep["unique:k"].n_failed, rep["unique:k"].status) == (1, "warn")
    assert (rep["accepted_values:c"].n_failed, rep["accepted_values:c"].status) == (1, "fail")
    assert rep["positive:q"].n_failed == 1 and rep["not_null:k"].status == "pass"
    assert rep["relationships:k"].n_failed == 1 and rep["expression:q"].n_failed == 0
    with pytest.raises(Q.QualityError):
        Q.enforce(Q.quality_report({"t": df}, checks))
    assert len(Q.enforce(Q.quality_report({"t": df}, checks[:1]))) == 1


def test_freshness_levels(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "ts timestamp_ntz")
    st = lambda as_of: Q.freshness(df, "ts", as_of).first().status
    assert st("2024-01-01 12:00:00") == "pass"
    assert st("2024-01-02 06:00:00") == "warn"
    assert st("2024-01-03 06:00:00") == "error"
    assert Q.freshness(df.limit(0), "ts", "2024-01-01 00:00:00").first().status == "error"


def test_freshness_ignores_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(dt.datetime(2024, 3, 9, 12),)], "ts timestamp_ntz")
        assert Q.freshness(df, "ts", "2024-03-10 12:00:00").first().age_hours == 24.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_fused_uniqueness_and_row_checks(spark):
    df = spark.createDataFrame([(1, 5), (1, -1), (None, 3), (None, None), (2, None)], "k int, q int")
    checks = [Check("t", "unique", "k"), Check("t", "not_null", "q"), Check("t", "positive", "q"),
              Check("t", "unique_combination", ["k", "q"])]
    rep = {r.check: r.n_failed for r in Q.quality_report({"t": df}, checks).collect()}
    assert rep == {"unique:k": 1, "not_null:q": 2, "positive:q": 1, "unique_combination:k,q": 0}
    for some in (checks[:3], checks):
        plan = Q.quality_report({"t": df}, some)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Aggregate") == 2          # one grouped pass + its final sum, whatever the number of checks
    empty = Q.quality_report({"t": df.limit(0)}, checks[:3]).collect()
    assert {r.n_failed for r in empty} == {0}


def test_one_pass_agrees_with_each_check(spark):
    """Random tables: every check of the report counts what its own relation of failing rows holds."""
    import random
    r = random.Random(1)
    for _ in range(3):
        rows = [tuple(r.choice([None, 0, 1, 2, 3]) for _ in range(3)) + (r.choice([None, "a", "b", "c"]),) for _ in range(60)]
        df = spark.createDataFrame(rows, "x int, y int, z int, s string")
        parent = spark.createDataFrame([(1,), (2,)], "k int")
        checks = [Check("t", "unique", "x"), Check("t", "unique_combination", ["x", "y"]), Check("t", "unique_combination", ["z", "s", "x"]),
                  Check("t", "accepted_values", "s", values=["a"]), Check("t", "accepted_values", "x", values=[1, 2]),
                  Check("t", "not_null", "x"), Check("t", "range", "y", low=1, high=2), Check("t", "positive", "z"),
                  Check("t", "expression", expr="x + y < 4", name="sum"), Check("t", "relationships", "x", parent=parent, field="k"),
                  Check("t", "relationships", "y", parent=parent, field="k", parent_unique=True)]
        want = [Q.check_unique(df, "x"), Q.check_unique_combination(df, ["x", "y"]), Q.check_unique_combination(df, ["z", "s", "x"]),
                Q.check_accepted_values(df, "s", ["a"]), Q.check_accepted_values(df, "x", [1, 2]), Q.check_not_null(df, "x"),
                Q.check_range(df, "y", 1, 2), Q.check_positive(df, "z"), Q.check_expression(df, "x + y < 4"),
                Q.check_relationships(df, "x", parent, "k"), Q.check_relationships(df, "y", parent, "k")]
        got = {x.check: x.n_failed for x in Q.quality_report({"t": df}, checks).collect()}
        assert got == {c.label: w.count() for c, w in zip(checks, want, strict=True)}


def test_uniqueness_over_loads(spark):
    """Counts per key add up over loads, and a load is told which of its keys repeat."""
    loads = [[(1, "a"), (2, "b"), (None, "c")], [(3, "d"), (2, "b")], [(4, "e"), (4, "e"), (None, "c")], [(5, "f")]]
    cols, state, seen, broken = ["k", "v"], None, [], []
    for rows in loads:
        counts = Q.key_counts(spark.createDataFrame(rows, "k int, v string"), cols)
        seen += rows
        if state is None:
            state = counts
            continue
        broken.append(sorted((tuple(x) for x in Q.broken_by(state, counts, cols).collect()), key=str))
        assert Q.broken_by(state, counts, cols, nulls_repeat=False).where("k is null").count() == 0
        state = Q.merge_counts(state, counts, cols)
    assert broken == [[(2, "b", 2)], [(4, "e", 2), (None, "c", 2)], []]
    full = Q.check_unique_combination(spark.createDataFrame(seen, "k int, v string"), cols)
    assert {tuple(x) for x in full.collect()} == {tuple(x) for x in state.where("n_records > 1").collect()}


def test_freshness_of_all_sources(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1,)], "k int").write.parquet(path)
    import os
    import time
    for f in os.listdir(path):
        os.utime(f"{path}/{f}", (1704106800, 1704106800))   # 2024-01-01 11:00 UTC
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 2, 6),)], "ts timestamp_ntz")
    spark.catalog.clearCache()
    assert time.time() > 1704106800
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in (old, "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            rep = Q.freshness_report({"own": (ts, "ts"), "files": (spark.read.parquet(path), None), "none": (ts.limit(0), "ts")}, "2024-01-02 12:00:00")
            got = {r.relation: (r.age_hours, r.status) for r in rep.collect()}
            assert got == {"own": (6.0, "pass"), "files": (25.0, "warn"), "none": (None, "error")}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    with pytest.raises(ValueError):
        Q.freshness_report({})


def test_relationships_send_keys_not_rows(spark):
    """A hot key and a key without a parent are counted before they meet it; nulls pass, a repeated parent counts once."""
    df = spark.createDataFrame([(i, 1 if i % 2 else 2 + i % 7, "x" * 50) for i in range(200)] + [(500, None, "y")], "i long, k long, wide string")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    rep = Q.quality_report({"t": df}, [Q.Check("t", "relationships", "k", parent=parent, field="k"), Q.Check("t", "not_null", "wide"), Q.Check("t", "unique", "i")])
    got = {r.check: r.n_failed for r in rep.collect()}
    assert got == {"relationships:k": sum(1 for i in range(200) if i % 2 == 0 and i % 7), "not_null:wide": 0, "unique:i": 0}
    join = rep._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in join and "LeftOuter" not in join
