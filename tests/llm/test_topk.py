import math
import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brickyard.llm import topk
from brickyard.llm.oracle import ORACLE


def brute(rows, k, scale):
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    q = [[math.floor(x * scale) for x in v] for _, v in ok]
    out = []
    for a, (i, _) in enumerate(ok):
        if i % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(q[a], q[b], strict=True)), ok[b][0]) for b in range(len(ok)) if b != a and len(q[b]) == len(q[a]))[:k]
            out += [(i, r + 1, v, -s) for r, (s, v) in enumerate(best)]
    return sorted(out)


@pytest.fixture(scope="module")
def vectors():
    r = random.Random(5)
    rows = [(i, [r.uniform(-1, 1) for _ in range(6)]) for i in range(260)]
    same = rows[10][1]
    rows += [(300 + i, same) for i in range(80)]  # ties
    rows += [(50, rows[50][1]), (50, rows[50][1]), (50, rows[7][1]),  # repeated ids
             (None, same), (400, None), (401, [None] * 6), (402, [math.nan] * 6), (403, [math.inf] + [0.0] * 5), (404, [1.0, 2.0]), (405, [])]
    rows += [(450 + i, [r.uniform(-1, 1) for _ in range(r.choice((2, 3, 9)))]) for i in range(150)]  # other lengths
    return rows


@pytest.mark.parametrize("shard,block,fan", [(8192, 48, 16), (40, 2, 3), (7, 3, 2)])
def test_against_all_pairs(spark, vectors, monkeypatch, shard, block, fan):
    for name, v in (("SHARD", shard), ("BLOCK", block), ("FAN_IN", fan)):
        monkeypatch.setattr(topk, name, v)
    df = spark.createDataFrame([(*v, "x") for v in vectors], "vec_id long, embedding array<double>, score string")
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, k=5)
    assert sorted(tuple(r) for r in got.collect()) == brute(vectors, 5, 256)


def test_large_values_stay_exact(spark):
    rows = [(0, [3e6, 1.0]), (1, [3e6, 1.0]), (2, [3e6, 1.0 + 1 / 256]), (3, [-3e6, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect()) == brute(rows, 5, 256)


def test_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    one = spark.createDataFrame([(0, [1.0, 2.0])], schema)
    assert topk.top_k(one, F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(one.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    no_query = spark.createDataFrame([(1, [1.0]), (2, [2.0])], schema)
    assert topk.top_k(no_query, F.col("vec_id") % 50 == 0).count() == 0


def test_every_length_meets_its_own(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (50, [1.0, 2.0, 3.0]), (100, [4.0]), (1, [1.0, 1.0]), (2, [2.0]), (3, [1.0, 0.0, 0.0])],
                               "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in topk.top_k(df, F.col("vec_id") % 50 == 0, scale=1).collect()}
    assert got == {(0, 1): 3, (50, 3): 1, (100, 2): 8}


def test_sql_on_mixed_lengths(spark, vectors):
    """The query's SQL and the operator agree where lengths are mixed."""
    con = duckdb.connect()
    table = pa.table({"vec_id": pa.array([v[0] for v in vectors], pa.int64()), "embedding": pa.array([v[1] for v in vectors], pa.list_(pa.float64()))})
    con.register("embeddings", table)
    want = sorted(con.execute(ORACLE["op4_topk"]).fetchall())
    assert want == brute(vectors, 5, 256)
