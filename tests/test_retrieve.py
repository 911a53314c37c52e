import math
import re
from collections import Counter

import numpy as np
import regex
from pyspark.sql import functions as F

from brickyard.operators import retrieve as R
from brickyard.operators import text_index as X
from brickyard.operators import vectors as V


def test_history_window(spark):
    conv = spark.createDataFrame([(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(5)],
                                 "conv_id bigint, turn bigint, role string, text string")
    h1 = {r.turn: r.n_history for r in R.chat_history(conv, 1).collect()}
    assert set(h1.values()) == {0}
    h3 = {r.turn: [m.text for m in r.history] for r in R.chat_history(conv, 3).collect()}
    assert h3 == {0: [], 1: ["m0"], 2: ["m0", "m1"], 3: ["m1", "m2"], 4: ["m2", "m3"]}


def _brute_vectors(rows, k):
    ids = np.array([r[0] for r in rows])
    m = np.array([r[1] for r in rows], dtype=np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    s = m @ m.T
    out = {}
    for i, q in enumerate(ids):
        cand = sorted(((round(float(s[i, j]), 6), int(ids[j])) for j in range(len(ids)) if ids[j] != q),
                      key=lambda x: (-x[0], x[1]))[:k]
        out[int(q)] = [d for _, d in cand]
    return out


def test_vector_topk_matches_brute_force_and_blocks(spark, sf_small):
    e = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in e.collect()]
    want = _brute_vectors(rows, 4)
    for block in (10_000, 37):   # one block, then many hash blocks
        got = {}
        for r in R.vector_topk(e, e, 4, block_rows=block).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.doc_id)
        assert got == want


def _brute_bm25(queries, docs, k, k1=1.2, b=0.75):
    tok = lambda s: [t for t in regex.split(r"[^\p{L}\p{N}]+", s.lower()) if t]
    dt = {d: tok(t) for d, t in docs}
    n, avgdl = len(dt), sum(map(len, dt.values())) / len(dt)
    df = Counter(t for ts in dt.values() for t in set(ts))
    out = {}
    for qid, qt in queries:
        qc = Counter(tok(qt))
        scores = []
        for d, ts in dt.items():
            tf = Counter(ts)
            s = sum(c * math.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * (k1 + 1)
                    / (tf[t] + k1 * (1 - b + b * len(ts) / avgdl)) for t, c in qc.items() if tf[t])
            if s > 0:
                scores.append((round(s, 6), d))
        out[qid] = [d for _, d in sorted(scores, key=lambda x: (-x[0], x[1]))[:k]]
    return out


def test_keyword_topk_matches_brute_force(spark):
    docs = [(1, "The quick brown fox."), (2, "Quick, quick! The fox jumps."), (3, "Le renard brun été"),
            (4, "lazy dog sleeps"), (5, "The quick brown fox."), (6, "été été brun")]
    queries = [(10, "quick fox"), (11, "brun été"), (12, "nothing matches"), (13, "dog")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    q = spark.createDataFrame(queries, "item_id bigint, text string")
    want = _brute_bm25(queries, docs, 3)
    for block in (100, 1):   # one block of queries, then many
        got = {}
        for r in R.keyword_topk(q, d, 3, block_rows=block).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.doc_id)
        assert got == {k: v for k, v in want.items() if v}


def test_keyword_tokenizer_agrees_with_python_regex(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    spark_toks = {r.doc_id: r.t for r in docs.select("doc_id", R.tokens("text").alias("t")).collect()}
    for did, text in [(r.doc_id, r.text) for r in docs.limit(50).collect()]:
        assert spark_toks[did] == [t for t in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if t]


def test_context_and_prompt(spark):
    ranked = spark.createDataFrame([(1, 2, 20), (1, 1, 10)], "query_id bigint, rank int, doc_id bigint")
    texts = spark.createDataFrame([(10, "A"), (20, "B")], "doc_id bigint, text string")
    ctx = R.assemble_context(ranked, texts).first()
    assert ctx.context == "Context document 1: A \n\nContext document 2: B \n\n"
    q = spark.createDataFrame([(1, 0, 1, "what's up"), (1, 2, 2, "and then")], "conv_id bigint, turn bigint, query_id bigint, question string")
    q = q.withColumn("question", R.strip_quotes("question"))
    hist = R.chat_history(spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "ho"), (1, 2, "user", "and then")],
                                                "conv_id bigint, turn bigint, role string, text string"), 5)
    p = {r.turn: r for r in R.assemble_prompt(q, hist, R.assemble_context(ranked, texts)).collect()}
    assert not p[0].has_history and p[2].has_history
    assert "Question: whats up\n" in p[0].prompt and "Context document 2: B" in p[0].prompt
    assert "Earlier messages:\n\n" in p[0].prompt and "Earlier messages:\nuser: hi\nassistant: ho\n" in p[2].prompt
    off = R.assemble_prompt(q, hist, R.assemble_context(ranked, texts), use_history=False).where("turn = 2").first()
    assert not off.has_history and "user: hi" not in off.prompt


def test_texts_stay_where_they_are_for_few_hits(spark, monkeypatch):
    ranked = spark.createDataFrame([(1, 2, 20), (1, 1, 10), (2, 1, 20), (2, 2, None), (3, 1, 99)], "query_id bigint, rank int, doc_id bigint")
    texts = spark.createDataFrame([(10, "A"), (20, "B"), (None, "C"), (30, "D")], "doc_id bigint, text string")
    want = [(1, 2, "Context document 1: A \n\nContext document 2: B \n\n"), (2, 1, "Context document 1: B \n\n")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, join in ((5, "BroadcastHashJoin"), (4, "SortMergeJoin")):
            monkeypatch.setattr(R, "BROADCAST_HITS", most)
            out = R.assemble_context(ranked, texts)
            assert join in out._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(tuple, out.collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rewrite_prompt_and_search_question(spark):
    q = spark.createDataFrame([(1, 0, 1, "first"), (1, 2, 2, "and it?")], "conv_id bigint, turn bigint, query_id bigint, question string")
    hist = R.chat_history(spark.createDataFrame([(1, 0, "user", "first"), (1, 1, "assistant", "ho"), (1, 2, "user", "and it?")],
                                                "conv_id bigint, turn bigint, role string, text string"), 5)
    got = {r.turn: r for r in R.rewrite_prompt(q, hist).collect()}
    assert not got[0].rewrite and got[0].rewrite_prompt is None
    assert got[2].rewrite and "assistant: ho" in got[2].rewrite_prompt and got[2].rewrite_prompt.endswith("Last question: and it?\n")
    answers = spark.createDataFrame([(1, 2, "what about first?")], "conv_id bigint, turn bigint, search_question string")
    found = {r.turn: r.search_question for r in R.search_questions(q, answers).collect()}
    assert found == {0: "first", 2: "what about first?"}
    assert {r.search_question for r in R.search_questions(q, answers, use_history=False).collect()} == {"first", "and it?"}


def test_tokens_drop_empty(spark):
    r = spark.createDataFrame([("  Hello, WORLD!! 42 ",)], "t string").select(R.tokens("t").alias("x")).first()
    assert r.x == ["hello", "world", "42"]
    assert spark.range(1).select(F.lit(1)).count() == 1


def test_copy_cluster_emits_only_k_per_task(spark):
    # a third of the corpus is one repeated text: each task still forwards k rows per query
    docs = [(i, "alpha beta gamma") for i in range(60)] + [(100 + i, f"alpha word{i}") for i in range(120)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    q = spark.createDataFrame([(1, "alpha beta")], "item_id bigint, text string")
    out = R.keyword_topk(q, d, 3).orderBy("rank").collect()
    assert [r.doc_id for r in out] == [0, 1, 2]          # ties broken by smallest id
    best = X.Best([1], 3)
    for lo in (5, 0):
        best.offer(np.ones((5, 1)), list(range(lo, lo + 5)), np.ones((5, 1), bool))
    assert best.rows[0] == [(-1.0, 0), (-1.0, 1), (-1.0, 2)]


def test_candidates_are_k_a_query_and_cell(spark, monkeypatch):
    monkeypatch.setattr(V, "MAX_CELLS", 500)   # many chunks in a cell
    r = np.random.default_rng(3)
    e = spark.createDataFrame([(i, [float(x) for x in r.normal(size=8)]) for i in range(600)], "vec_id bigint, embedding array<double>")
    seen = []
    final = V.best_k
    monkeypatch.setattr(V, "best_k", lambda c, k: (seen.append(c), final(c, k))[1])
    R.vector_topk(e.where("vec_id < 50"), e, 4)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert seen[0].count() <= 4 * 50 * parts


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), ("c", "z")], "doc_id string, text string")
    q = spark.createDataFrame([("q1", "x"), ("q2", "z")], "item_id string, text string")
    assert [tuple(r)[:3] for r in R.keyword_topk(q, docs, 2).orderBy("query_id", "rank").collect()] == [
        ("q1", 1, "a"), ("q1", 2, "b"), ("q2", 1, "c")]
    e = spark.createDataFrame([("u", [1.0, 0.0]), ("v", [1.0, 0.1]), ("w", [0.0, 1.0]), ("n", None), ("0", [0.0, 0.0])],
                              "vec_id string, embedding array<double>")
    got = R.vector_topk(e, e, 1).orderBy("query_id").collect()
    assert [(r.query_id, r.doc_id) for r in got] == [("u", "v"), ("v", "u"), ("w", "v")]


def test_common_terms_count_at_any_corpus_size(spark):
    """A term in every one of many documents has a tiny weight, but still matches."""
    docs = spark.range(3_000_000).selectExpr("id AS doc_id", "'common' AS text")
    q = spark.createDataFrame([(1, "common")], "item_id bigint, text string")
    got = R.keyword_topk(q, docs, 3).orderBy("rank").collect()
    assert [(r.doc_id, r.score) for r in got] == [(0, 0.0), (1, 0.0), (2, 0.0)]


def test_history_by_position(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    rows = [(1, t, "user", f"m{t}") for t in (0, 2, 5, 9)] + [(2, t, "user", f"k{t}") for t in (7, 8, 5000)] + [(None, 3, "user", "z")]
    got = {(r.conv_id, r.turn): [m.text for m in r.history] for r in R.chat_history(spark.createDataFrame(rows, schema), 3).collect()}
    assert got == {(1, 0): [], (1, 2): ["m0"], (1, 5): ["m0", "m2"], (1, 9): ["m2", "m5"], (2, 7): [], (2, 8): ["k7"],
                   (2, 5000): ["k7", "k8"], (None, 3): []}


def test_history_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(R, "HISTORY_BUCKET", 7)
    schema = "conv_id bigint, turn bigint, role string, text string"
    turns = [t * 3 for t in range(60)]
    got = {r.turn: [m.turn for m in r.history] for r in
           R.chat_history(spark.createDataFrame([(1, t, "user", str(t)) for t in turns], schema), 5).collect()}
    assert got == {t: turns[max(0, i - 4):i] for i, t in enumerate(turns)}
