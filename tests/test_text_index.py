"""The inverted index and the search over it against plain Python."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex

from brickyard.operators import text_index as X


def toks(s):
    return [t for t in regex.split(r"[^\p{L}\p{N}]+", (s or "").lower()) if t]


def corpus(seed=1, n=400):
    r = random.Random(seed)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}é" for i in range(300)]
    docs = [(i, " ".join(r.choices(common, k=r.randint(0, 60)) + r.choices(rare, k=r.randint(0, 8)))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "c1 " * 5000), (None, "c1 r3é"), (7, "c1 c2 r5é"), (7, "c1 c2 r5é")]
    queries = [(q, " ".join(r.choices(common, k=3) + r.choices(rare, k=3))) for q in range(40)]
    return docs, queries + [(100, "nothing here"), (101, None), (102, ""), (None, "c1 r5é"), (103, "c1 c1 c1")]


def brute(queries, docs, k, k1=1.2, b=0.75):
    held = [(d, toks(t)) for d, t in docs]
    n, avgdl = len(held), sum(len(t) for _, t in held) / len(held)
    df = Counter(t for _, ts in held for t in set(ts))
    counts = [(d, len(ts), Counter(ts)) for d, ts in held]
    out = []
    for q, text in queries:
        found = []
        for d, size, tf in counts:
            s = sum(c * math.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * (k1 + 1) / (tf[t] + k1 * (1 - b + b * size / avgdl))
                    for t, c in Counter(toks(text)).items() if tf[t])
            if s > 0:
                found.append((round(s, 6), d))
        found.sort(key=lambda x: (-x[0], *X.nulls_first(x[1])))
        out += [(q, i + 1, d, s) for i, (s, d) in enumerate(found[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.query_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def same(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=2e-6)


@pytest.fixture(scope="module")
def data(spark):
    docs, queries = corpus()
    return (docs, queries, spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3),
            spark.createDataFrame(queries, "item_id bigint, text string"))


@pytest.mark.parametrize("block_docs,block_tokens,block_rows", [(2048, 10**6, 5000), (7, 10**6, 3), (1, 1, 1000), (50, 200, 10)])
def test_search_matches_brute_force(data, monkeypatch, block_docs, block_tokens, block_rows):
    """Null and repeated ids, null and empty texts and queries, a long text; index blocks and query blocks of any size."""
    monkeypatch.setattr(X, "BLOCK_DOCS", block_docs)
    monkeypatch.setattr(X, "BLOCK_TOKENS", block_tokens)
    docs, queries, d, q = data
    same(rows(X.keyword_topk(q, d, 4, block_rows=block_rows)), brute(queries, docs, 4))


def test_postings_move_once_for_many_blocks_of_queries(data, monkeypatch):
    """A cell takes its queries in blocks; only groups beyond a cell's bound send postings again. Results stay exact."""
    docs, queries, d, q = data
    ran, cells = X._query_blocks, []
    monkeypatch.setattr(X, "best_k", lambda found, k, final=X.best_k: (cells.append(found), final(found, k))[1])

    def plan():
        return cells[-1]._jdf.queryExecution().analyzed().toString()
    same(rows(X.keyword_topk(q, d, 4, block_rows=3)), brute(queries, docs, 4))
    assert "sequence(0, 0" in plan()  # one group, though there are many blocks of three queries
    monkeypatch.setattr(X, "GROUP_PAIRS", 50)
    same(rows(X.keyword_topk(q, d, 4, block_rows=3)), brute(queries, docs, 4))
    assert "sequence(0, 0" not in plan()
    w = pa.table({"qid": [1, None, 1, 2, 3, 3, 3], "term": list("abcdefg"), "w": [1.0] * 7})
    assert sorted(sorted(map(str, set(b.column("qid").to_pylist()))) for b in ran(w, 2, 100)) == [["1", "None"], ["2", "3"]]
    assert [b.num_rows for b in ran(w, 100, 2)] == [2, 2, 3]


def test_small_score_chunks(data, monkeypatch):
    monkeypatch.setattr(X, "SCORE_CELLS", 100)
    monkeypatch.setattr(X, "DENSE_CELLS", 90)
    docs, queries, d, q = data
    same(rows(X.keyword_topk(q, d, 3)), brute(queries, docs, 3))


def test_stored_index(spark, data, tmp_path):
    """A full index, written as a table and opened again, answers any query set, and says what each term's postings hold."""
    docs, queries, d, q = data
    X.term_index(d).rows.write.parquet(str(tmp_path / "index"))
    index = X.open_index(spark.read.parquet(str(tmp_path / "index")))
    assert (index.n_docs, index.n_tokens) == (len(docs), sum(len(toks(t)) for _, t in docs))
    same(rows(X.keyword_topk(q, None, 4, index=index)), brute(queries, docs, 4))
    other = spark.createDataFrame([(1, "c5 r7é")], "item_id bigint, text string")
    same(rows(X.keyword_topk(other, None, 4, index=index)), brute([(1, "c5 r7é")], docs, 4))
    held = [Counter(toks(t)) for _, t in docs]
    want = {t: (sum(t in h for h in held), sum(h[t] for h in held), max(h[t] for h in held), min(sum(h.values()) for h in held if h[t]))
            for t in set().union(*held)}
    assert {r.term: (r.df, r.cf, r.max_tf, r.min_len) for r in index.terms().collect()} == want


def test_rows_of_a_block():
    """Postings of a block by hand: places and frequencies by term, then the documents."""
    ids, t = pa.array([5, 3, 9]), pa.array([["b", "a", "b"], None, ["a"]])
    b = X._block_rows(4, ids, t).to_pydict()
    assert b["term"] == ["a", "b", None] and b["df"] == [2, 1, 3] and b["cf"] == [2, 2, 4]
    assert b["places"] == [[0, 2], [0], None] and b["tfs"] == [[1, 1], [2], None]
    assert b["max_tf"] == [1, 2, None] and b["min_len"] == [1, 3, None]
    assert b["ids"] == [None, None, [5, 3, 9]] and b["lens"] == [None, None, [3, 0, 1]]


def test_only_matching_postings_are_kept(spark, data):
    _, _, d, _ = data
    index = X.term_index(d, terms=spark.createDataFrame([("r5é",), ("zz",), (None,)], "term string"))
    assert {r.term for r in index.rows.select("term").distinct().collect()} == {"r5é", None}
    assert index.n_docs == 406


def cell(docs, queries, k):
    """A cell over index blocks of one document each."""
    n = len(docs)
    df = Counter(t for _, x in docs for t in set(toks(x)))
    w = [(q, t, c * math.log1p((n - df[t] + 0.5) / (df[t] + 0.5))) for q, x in queries for t, c in Counter(toks(x)).items() if df[t]]
    weights = pa.table({"qid": [x[0] for x in w], "term": [x[1] for x in w], "w": [x[2] for x in w]})
    batches = [X._block_rows(i, pa.array([d], pa.int64()), pa.array([toks(x)], pa.list_(pa.string()))) for i, (d, x) in enumerate(docs)]
    c = X._Cell(weights, sum(len(toks(x)) for _, x in docs) / n, X.BM25_K1, X.BM25_B, k)
    return c, c.run(pa.Table.from_batches(batches))


def test_blocks_below_the_kth_score_are_skipped():
    docs = [(i, "common " * 3 + f"pad{i} " * 30) for i in range(200)] + [(1000 + i, "common special word") for i in range(5)]
    c, best = cell(docs, [(1, "common special")], 3)
    assert [d for _, d in best.rows[0]] == [1000, 1001, 1002]
    assert c.skipped >= 200   # all blocks of plain documents


def test_skipping_loses_nothing():
    r = random.Random(4)
    for _ in range(20):
        docs = [(i, " ".join(r.choices([f"t{j}" for j in range(15)], k=r.randint(1, 12)))) for i in range(60)]
        queries = [(q, " ".join(r.choices([f"t{j}" for j in range(15)], k=2))) for q in range(8)]
        _, best = cell(docs, queries, 3)
        got = sorted(((best.qids[j], i + 1, d, -s) for j, found in enumerate(best.rows) for i, (s, d) in enumerate(found)), key=str)
        same(got, brute(queries, docs, 3))


@pytest.mark.parametrize("dense,scores", [(256, 4_000_000), (5, 4_000_000), (1, 2_000)])
def test_segments_lose_nothing(monkeypatch, dense, scores):
    """Many documents in segments, with equal scores across them; common terms as a matrix, others as lists; queries in rounds."""
    for name, value in (("SMALL_DOCS", 0), ("SEGMENT_DOCS", 16), ("BOUND_DOCS", 4), ("DENSE_TERMS", dense), ("SCORE_CELLS", scores)):
        monkeypatch.setattr(X, name, value)
    docs, queries = corpus(7, 900)
    docs = [(i, t or "") for i, (_, t) in enumerate(docs)] + [(2000 - i, "c1 r3é c2") for i in range(40)]
    queries = [(q, t or "") for q, t in queries]
    scored, real = [], X._Cell._values
    monkeypatch.setattr(X._Cell, "_values", lambda self, t, at: (scored.append(len(at)), real(self, t, at))[1])
    c, best = cell(docs, queries, 3)
    got = sorted(((best.qids[j], i + 1, d, -s) for j, found in enumerate(best.rows) for i, (s, d) in enumerate(found)), key=str)
    same(got, brute(queries, docs, 3))
    assert c.skipped and sum(scored) < 100 * len(queries)   # a few documents' terms a query in double precision


def test_many_queries_move_the_index_as_parcels(spark, data, monkeypatch):
    """Beyond FEW_PAIRS no index row is joined or sorted for the search: a block moves as one value."""
    docs, queries, d, q = data
    monkeypatch.setattr(X, "BLOCK_DOCS", 50)
    few = rows(X.keyword_topk(q, d, 4))
    monkeypatch.setattr(X, "FEW_PAIRS", 0)
    made, real = [], X.term_index
    monkeypatch.setattr(X, "term_index", lambda *a, **b: made.append(real(*a, **b)) or made[-1])
    got = rows(X.keyword_topk(q, d, 4, block_rows=7))
    same(got, brute(queries, docs, 4))
    same(got, few)
    blocks = made[0].rows.where("term is null").count()
    assert made[0].parcels.count() == blocks >= len(docs) // 50
    index = X.open_index(made[0].rows)
    assert (index.n_docs, index.n_tokens) == made[0][1:3] and index.parcels is None
    same(rows(X.keyword_topk(q, None, 4, index=index)), brute(queries, docs, 4))
    assert sorted(map(str, index.terms().collect())) == sorted(map(str, made[0].terms().collect()))


def test_impact_without_k1(spark):
    """Terms that a document does not hold add nothing, whatever the parameters."""
    docs = [(1, "a b"), (2, "a"), (3, ""), (4, "c")]
    got = rows(X.keyword_topk(spark.createDataFrame([(1, "a b")], "item_id bigint, text string"), spark.createDataFrame(docs, "doc_id bigint, text string"), 3, k1=0.0, b=1.0))
    same(got, brute([(1, "a b")], docs, 3, k1=0.0, b=1.0))


def test_best_offers_some_queries():
    b = X.Best(["p", "q"], 2)
    b.offer(np.array([[3.0], [1.0]]), [1, 2], np.array([[True], [True]]), np.array([1]))
    b.offer(np.array([[2.0, 2.0]]), [9], np.array([[True, True]]))
    assert b.rows == [[(-2.0, 9)], [(-3.0, 1), (-2.0, 9)]] and b.kth.tolist() == [-np.inf, 2.0]


def test_empty_sides(spark, data):
    _, _, d, q = data
    assert X.keyword_topk(q.limit(0), d, 3).collect() == []
    assert X.keyword_topk(q, d.limit(0), 3).collect() == []


def test_one_tokenisation_and_no_text_shuffle(spark, data, monkeypatch):
    """The corpus is read and tokenised once, and its postings are joined by term."""
    _, _, d, q = data
    calls = []
    real = X.tokens
    monkeypatch.setattr(X, "tokens", lambda t: (calls.append(t), real(t))[1])
    out = X.keyword_topk(q, d, 3)
    assert calls == ["text", "text"]   # the queries, the documents
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "Cartesian" not in plan


def test_tasks_follow_the_text(spark, tmp_path, monkeypatch):
    """One file of much text is indexed by many tasks, each of which sorts its own share."""
    docs = [(i, " ".join(f"w{(i * 7 + j) % 500}" for j in range(100))) for i in range(600)]
    spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1).write.parquet(str(tmp_path / "docs"))
    d = spark.read.parquet(str(tmp_path / "docs"))
    chars, cores = sum(len(t) for _, t in docs), spark.sparkContext.defaultParallelism
    monkeypatch.setattr(X, "PART_CHARS", chars // (5 * cores))
    index = X.term_index(d)
    assert len(index.rows.inputFiles()) >= 5 * cores
    assert (index.n_docs, index.n_tokens) == (600, 60_000) and index.terms().agg({"cf": "sum"}).first()[0] == 60_000
