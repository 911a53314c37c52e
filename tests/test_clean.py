import datetime as dt

import pytest

from brickyard.operators.clean import cast_columns, dedupe_latest, require_keys, silver_clean
from brickyard.operators.explode import split_explode

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def test_null_key_dropped_and_padded_key_collapses(spark):
    b = spark.createDataFrame([("a", 1, "s", T1, T1), ("a ", 2, "s", T1, T2), (None, 3, "s", T1, T1)],
                              "k string, v int, src_sys string, crt_ts timestamp_ntz, upd_ts timestamp_ntz")
    out = silver_clean(b, {"key": ("k", "string"), "val": ("v", "int")}, keys=["key"], tie_breakers=["val"]).collect()
    assert [(r.key, r.val) for r in out] == [("a", 2)]


def test_trim_keeps_tabs(spark):
    df = spark.createDataFrame([("\tx ",)], "s string")
    assert cast_columns(df, {"s": "string"}).first().s == "\tx"


def test_ties_are_deterministic(spark):
    rows = [(1, T1, "b"), (1, T1, "a"), (1, T1, "c")]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, p string")
    winners = {dedupe_latest(df.repartition(3), ["k"], ["ts"], ["p"]).first().p for _ in range(3)}
    assert winners == {"a"}


def test_null_timestamp_wins_for_parity(spark):
    df = spark.createDataFrame([(1, None, "null"), (1, T2, "set")], "k int, ts timestamp_ntz, p string")
    assert dedupe_latest(df, ["k"], ["ts"], ["p"]).first().p == "null"
    assert dedupe_latest(df, ["k"], ["ts"], ["p"], nulls_first=False).first().p == "set"


def test_dedupe_requires_order(spark):
    df = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        dedupe_latest(df, ["k"], ["k"], ["k"])


def test_require_keys(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    assert require_keys(df, ["a", "b"]).count() == 1


def test_split_explode_cases(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a,b,"), (4, "a, a")], "id int, s string")
    out = sorted((r.id, r.value, r.position) for r in split_explode(df, "s").collect())
    assert out == [(2, "", 1), (3, "", 3), (3, "a", 1), (3, "b", 2), (4, "a", 1), (4, "a", 2)]
