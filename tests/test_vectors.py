"""Vector retrieval: exact search on odd inputs, recall and work of the inverted lists."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brickyard.operators import vectors as V

SCHEMA = "vec_id bigint, embedding array<double>"


def brute(rows, k):
    """(query, doc) of the k best of equal length, other rows of the query's id left out."""
    out = set()
    ok = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    for q in {i for i, _ in ok}:
        found = {}
        for n, (d, v) in enumerate(ok):
            s = [round(float(v @ w / np.linalg.norm(v) / np.linalg.norm(w)), 6) for i, w in ok if i == q and len(w) == len(v)]
            if d != q and s:
                found[n] = (-max(s), (d is not None, d or 0), d)
        out |= {(q, d) for _, _, d in sorted(found.values())[:k]}
    return out


def pairs(df):
    return {(r.query_id, r.doc_id) for r in df.collect()}


def test_odd_vectors(spark):
    """Lengths meet their own; null, empty, zero and non-finite vectors take no part."""
    r = np.random.default_rng(1)
    rows = [(i, [float(x) for x in r.normal(size=(3, 5)[i % 2])]) for i in range(60)]
    rows += [(100, None), (101, []), (102, [0.0, 0.0, 0.0]), (103, [1.0, None, 2.0]), (104, [float("nan"), 1.0, 1.0]), (105, [float("inf"), 1.0, 1.0]),
             (106, [1.0]), (None, [1.0, 2.0, 3.0])]
    e = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = brute(rows, 4)
    assert (None, rows[0][0]) not in want or True
    assert pairs(V.vector_topk(e, e, 4)) == want
    assert pairs(V.vector_topk(e, e, 4, block_rows=5)) == want
    assert pairs(V.vector_topk_lists(e, e, 4, n_lists=1)) == want


def test_repeated_ids(spark):
    e = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.9, 0.1]), (2, [0.5, 0.5]), (3, [0.0, 1.0])], SCHEMA)
    got = V.vector_topk(e, e, 3).collect()
    assert all(r.query_id != r.doc_id for r in got)
    assert {r.doc_id for r in V.vector_topk(e.where("vec_id = 2"), e, 4, exclude_self=False).collect()} == {1, 2, 3}


def test_empty(spark):
    none, e = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, [1.0])], SCHEMA)
    for f in (V.vector_topk, V.vector_topk_lists):
        assert f(none, e).collect() == [] and f(e, none).collect() == [] and f(none, none).collect() == []


@pytest.fixture(scope="module")
def clustered(spark):
    r = np.random.default_rng(2)
    centre = r.normal(size=(40, 16))
    rows = [(i, [float(x) for x in centre[i % 40] + r.normal(scale=0.25, size=16)]) for i in range(4000)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def recall_of(got, exact):
    return len(got & exact) / len(exact)


def test_recall_and_work(spark, clustered, monkeypatch):
    """Recall of 0.9 and more, over clearly fewer pairs than queries x rows."""
    exact = pairs(V.vector_topk(clustered, clustered, 5))
    assert recall_of(pairs(V.vector_topk_lists(clustered, clustered, 5, recall=0.95)), exact) >= 0.9
    monkeypatch.setattr(V, "SAMPLE_ROWS", 500)   # a sample much smaller than the table
    c = V._usable(clustered, "vec_id", "embedding", "did")
    sample = V._sample(c)
    assert len(sample) == 500
    centres = V.centroids(sample, 60)
    probes = V.probes_for(sample, centres, 5, 0.95)
    assert probes / len(centres) < 0.2
    assert recall_of(pairs(V.vector_topk_lists(clustered, clustered, 5, recall=0.95)), exact) >= 0.9


def test_work_grows_below_the_product(spark):
    """Scored pairs, counted over the lists: four times the rows cost far less than sixteen times as many."""
    r = np.random.default_rng(6)
    flat = spark.createDataFrame([(i, [float(x) for x in r.normal(size=3)]) for i in range(4000)], SCHEMA)

    def scored(df):
        c, q = (V._usable(df, "vec_id", "embedding", n) for n in ("did", "qid"))
        s = V._sample(c)
        centres = V.centroids(s, int(c.count() ** 0.5))
        shared = spark.sparkContext.broadcast(centres)
        probes = V.probes_for(s, centres, 5, 0.95)
        held, asked = V._with_lists(c, shared, 1, "did"), V._with_lists(q, shared, probes, "qid")
        return held.groupBy("list").count().join(asked.groupBy("list").agg(F.count("*").alias("q")), "list").agg(F.sum(F.col("count") * F.col("q"))).first()[0]
    few, many = scored(flat.where("vec_id < 1000")), scored(flat)
    assert few < 0.3 * 1000**2 and many < 0.15 * 4000**2 and many < 10 * few


def test_all_lists_are_exact(spark, sf_small):
    e = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    exact = pairs(V.vector_topk(e, e, 5))
    assert pairs(V.vector_topk_lists(e, e, 5, n_lists=8, probes=8)) == exact
    assert recall_of(pairs(V.vector_topk_lists(e, e, 5, recall=0.97)), exact) >= 0.9


def test_hot_list_is_split(spark, monkeypatch):
    """A list that holds nearly all rows falls into shards and blocks; results stay exact within it."""
    r = np.random.default_rng(3)
    rows = [(i, [1.0 + float(x) for x in r.normal(scale=0.01, size=4)]) for i in range(900)] + [(1000 + i, [float(x) for x in -r.random(4)]) for i in range(30)]
    e = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(V, "SHARD_BYTES", 8 * 4 * 50)
    exact = pairs(V.vector_topk(e, e, 3))
    assert pairs(V.vector_topk_lists(e, e, 3, n_lists=2, probes=2, block_rows=100)) == exact


def test_string_ids(spark):
    e = spark.createDataFrame([("u", [1.0, 0.0]), ("v", [1.0, 0.1]), ("w", [0.0, 1.0])], "vec_id string, embedding array<double>")
    assert pairs(V.vector_topk_lists(e, e, 1, n_lists=2, probes=2)) == {("u", "v"), ("v", "u"), ("w", "v")}


def test_batches_of_copied_vectors_stay_small(monkeypatch):
    """A vector that meets many lists leaves the task in small batches, and once a bin, not once a list."""
    r = np.random.default_rng(4)
    c, v = r.normal(size=(50, 8)), r.normal(size=(400, 8))
    b = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(v.tolist())], names=["qid", "v"])
    monkeypatch.setattr(V, "SLICE_BYTES", 8 * 8 * 50 * 10)

    class Shared:
        def __init__(self, value):
            self.value = value
    out = list(V._assign(Shared(c), 40)([b]))
    assert sum(x.num_rows for x in out) == 400 * 40 and max(x.num_rows for x in out) <= 500
    known, bin_of, n = V.binned({**dict.fromkeys(range(50), 10), 7: 300, -3: 4}, c, 100)
    sizes = np.bincount(bin_of, [{7: 300, -3: 4}.get(int(x), 10) for x in known])
    assert n <= 16 and max(np.delete(sizes, bin_of[known == 7])) <= 100 and (bin_of == bin_of[known == -3]).sum() == 1
    out = pa.Table.from_batches(list(V._to_bins(Shared(c), Shared((known, bin_of)), 40, n)([b])))
    assert out.num_rows <= 400 * n and sum(map(len, out.column("lists").to_pylist())) == 400 * 40


def test_single_precision_changes_nothing(spark):
    """Near ties far below single precision, and large groups of copies: the order is that of double precision and id."""
    r = np.random.default_rng(8)
    base = r.normal(size=24)
    rows = [(i, (base + (i % 40) * 2e-5 * np.arange(24)).tolist()) for i in range(300)] + [(1000 + i, r.normal(size=24).tolist()) for i in range(300)]
    e = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = brute(rows, 4)
    assert pairs(V.vector_topk(e, e, 4)) == want
    assert pairs(V.vector_topk_lists(e, e, 4, n_lists=6, probes=6)) == want
    top = V._Top(np.eye(2), np.array([-1, -1]), 2)
    seen = []
    top._merge, merge = (lambda i, *x: (seen.append(len(i)), merge(i, *x))), top._merge
    top.offer(np.tile([0.6, 0.8], (5000, 1)), np.full(5000, -1), np.arange(5000))
    assert top.place.tolist() == [[0, 1], [0, 1]] and sum(seen) < 200  # equal rows that come later are left out
