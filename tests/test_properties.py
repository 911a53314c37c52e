"""Property tests: each example is a batch of random rows checked against a
plain-Python model in one Spark job."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from brickyard.functions.columns import boundary_diff, split_list
from brickyard.operators.clean import dedupe_latest
from brickyard.operators.load import upsert

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
DELIMS = [",", "|", ".", " ", "*", "\\", "$", "ab"]


@SETTINGS
@given(st.lists(st.tuples(st.text(alphabet="ab,|. *\\$x", max_size=12), st.sampled_from(DELIMS)),
                min_size=1, max_size=40))
def test_split_is_literal(spark, rows):
    df = spark.createDataFrame([(i, s, d) for i, (s, d) in enumerate(rows)], "i int, s string, d string")
    got = {}
    for d in set(x[1] for x in rows):
        for r in df.where(df.d == d).select("i", split_list("s", d).alias("v")).collect():
            got[r.i] = r.v
    assert all(got[i] == s.split(d) for i, (s, d) in enumerate(rows))


dates = st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2030, 12, 31))


def _model(unit, a, b):
    if unit == "day":
        return (b - a).days
    if unit == "week":
        return ((b - dt.timedelta(days=b.weekday())) - (a - dt.timedelta(days=a.weekday()))).days // 7
    if unit == "month":
        return (b.year * 12 + b.month) - (a.year * 12 + a.month)
    if unit == "quarter":
        return (b.year * 4 + (b.month - 1) // 3) - (a.year * 4 + (a.month - 1) // 3)
    return b.year - a.year


@SETTINGS
@given(st.lists(st.tuples(dates, dates), min_size=1, max_size=60))
def test_boundary_diff_model(spark, pairs):
    df = spark.createDataFrame(pairs, "a date, b date")
    units = ["day", "week", "month", "quarter", "year"]
    rows = df.select("a", "b", *[boundary_diff(u, "a", "b").alias(u) for u in units]).collect()
    for r in rows:
        assert [r[u] for u in units] == [_model(u, r.a, r.b) for u in units]


keys = st.one_of(st.none(), st.integers(0, 15))


@SETTINGS
@given(st.lists(st.tuples(keys, st.integers(0, 9)), max_size=30),
       st.dictionaries(st.integers(0, 15), st.integers(10, 19), max_size=12))
def test_upsert_invariants(spark, target, source):
    t = spark.createDataFrame(target, "k int, v int") if target else spark.createDataFrame([], "k int, v int")
    s = spark.createDataFrame(list(source.items()), "k int, v int") if source else spark.createDataFrame([], "k int, v int")
    got = sorted((r.k is None, r.k or 0, r.v) for r in upsert(t, s, "k").collect())
    want = [(k, v) for k, v in target if k is None or k not in source] + list(source.items())
    assert got == sorted((k is None, k or 0, v) for k, v in want)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 50)),
                min_size=1, max_size=40))
def test_dedupe_latest_model(spark, rows):
    df = spark.createDataFrame(rows, "k int, ts int, p int")
    got = {r.k: (r.ts, r.p) for r in dedupe_latest(df, ["k"], ["ts"], ["p"]).collect()}
    want = {}
    for k, ts, p in rows:
        key = (ts is None, ts if ts is not None else 0, -p)   # null first, then latest, then smallest p
        if k not in want or key > want[k][0]:
            want[k] = (key, (ts, p))
    assert got == {k: v for k, (_, v) in want.items()}
