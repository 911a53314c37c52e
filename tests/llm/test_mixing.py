import duckdb
import pytest

from brickyard.llm.mixing import mix, repeat_rows
from brickyard.llm.oracle import ORACLE


def sizes(text):
    return len((text or "").encode().split())


def targets(total, weights, cap):
    """Water-filling by bisection on the level."""
    budget, lo, hi = sum(total.values()), 0.0, 1e12
    for _ in range(300):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(cap * s, mid * weights[k]) for k, s in total.items()) < budget else (lo, mid)
    return {k: min(cap * s, lo * weights[k]) for k, s in total.items()}


def check(rows, corpus, weights=(5, 2, 1)):
    total = {}
    for r in corpus:
        total[r[3]] = total.get(r[3], 0) + sizes(r[1])
    order = sorted(total, key=lambda s: (s is None, s or ""))
    want = targets(total, {s: weights[i % len(weights)] for i, s in enumerate(order)}, 3)
    source_of = {total[s]: s for s in total}
    taken = {}
    for r in rows:
        s = source_of[r.source_size]
        assert r.target == pytest.approx(want[s], rel=1e-9, abs=1e-6)
        assert 0 <= r.taken <= 3 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 3


def test_targets_and_rows(docs, corpus):
    rows = mix(docs).collect()
    assert sorted(((r.doc_id, r.size) for r in rows), key=str) == sorted(((r[0], sizes(r[1])) for r in corpus), key=str)
    check(rows, corpus)
    assert sorted(map(str, rows)) == sorted(map(str, mix(docs.repartition(3)).collect()))


def test_clamped_sources(spark):
    corpus = [(i, " ".join(["w"] * n), "xx", s, 0, 0) for i, (s, n) in enumerate(
        [("a", 10), ("b", 1000), ("b", 700), ("c", 5), (None, 40), ("d", 0), ("a", 3)])]
    df = spark.createDataFrame([(r[0], r[1], r[3]) for r in corpus], "doc_id long, text string, source string")
    rows = mix(df).collect()
    assert max(r.target / r.source_size for r in rows if r.source_size) == 3.0
    by = {r.doc_id: r for r in rows}
    assert by[0].taken == 30 and by[5].taken == 0 and by[5].target == 0.0
    assert sum(r.taken for r in rows if r.source_size == 1700) == int(by[1].target)


def test_no_words_and_empty(spark, no_docs):
    df = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert {(r.target, r.taken) for r in mix(df).collect()} == {(0.0, 0)}
    assert mix(no_docs).count() == 0 and repeat_rows(no_docs).count() == 0


def test_repeated_rows_reach_the_targets(docs, corpus):
    out = repeat_rows(docs)
    assert out.columns == docs.columns
    want = {(r.doc_id, r.size): r for r in mix(docs).collect()}
    seen = {}
    for r in out.collect():
        seen[r.doc_id, sizes(r.text)] = seen.get((r.doc_id, sizes(r.text)), 0) + 1
    for key, r in want.items():
        if key[0] not in (3, None):
            assert abs(seen.get(key, 0) - (r.taken / r.size if r.size else 0)) <= 0.5


def test_sql(spark, sf_small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_small}/documents.parquet')")
    want = sorted(con.execute(ORACLE["op2_mixing"]).fetchall())
    assert sorted(tuple(r) for r in mix(spark.read.parquet(f"{sf_small}/documents.parquet")).collect()) == want


def test_null_and_repeated_ids_keep_to_their_source(spark):
    """Rows of one id in several sources are repeated as their own source asks."""
    rows = [(None, " ".join(["w"] * 9 + [f"{s}{i}"]), s, "k") for s in "abc" for i in range(200)]
    rows += [(7, "one two three", "d", "k"), (7, "four " * 400, "b", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, key string").repartition(3)
    target = {r.source_size: r.target for r in mix(df).collect()}
    got = {}
    for r in repeat_rows(df).collect():
        assert r.key == "k"
        got[r.source] = got.get(r.source, 0) + sizes(r.text)
    for s, size in (("a", 2000), ("b", 2400), ("c", 2000)):
        want = mix(df.filter(f"source = '{s}'")).first().source_size
        assert want == size
    weights = targets({"a": 2000, "b": 2400, "c": 2000, "d": 3}, {"a": 5, "b": 2, "c": 1, "d": 5}, 3)
    assert target[2400] == pytest.approx(weights["b"]) and got["d"] == 9
    assert all(abs(got[s] - weights[s]) <= 250 for s in "abc"), (got, weights)


@pytest.mark.parametrize("ids,texts", [("null", "equal"), ("null", "different"), ("one", "equal"), ("one", "different"), ("one", "long")])
def test_ties_meet_their_target(spark, ids, texts):
    """A whole source under one id, or under none: the remainder is dealt row by row, as the SQL does."""
    word = {"equal": lambda i: "w", "different": lambda i: f"w{i}", "long": lambda i: "a b c d e f g"}[texts]
    rows = [(None if ids == "null" else 7, word(i), "a", None, 0) for i in range(1000)] + [(i, "x " * 20, "b", None, 0) for i in range(150)]
    schema = "doc_id long, text string, source string, lang string, n_chars long"
    df = spark.createDataFrame(rows, schema).repartition(4)
    got = mix(df).collect()
    for size in {r.source_size for r in got}:
        mine = [r for r in got if r.source_size == size]
        assert sum(r.taken for r in mine) == int(mine[0].target)
        assert all(0 <= r.taken <= 3 * r.size for r in mine)
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, con.execute(ORACLE["op2_mixing"]).fetchall()))
    out = repeat_rows(df).collect()
    target = {r.source_size: r.target for r in got}
    for source, size in (("a", sum(sizes(r[1]) for r in rows if r[2] == "a")), ("b", 3000)):
        taken = sum(sizes(r.text) for r in out if r.source == source)
        # equal rows at the cut are drawn one by one
        assert abs(taken - target[size]) <= (0.1 * size if source == "a" else 20)


def test_long_text_and_clashing_names(spark):
    rows = [(1, "w " * 300_000, "a", 1, 2, 3), (2, "v", "a", 1, 2, 3), (3, "u " * 1000, "b", 1, 2, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, h int, cut_h int, size int")
    got = {r.doc_id: r for r in mix(df).collect()}
    assert got[1].size == 300_000 and got[1].taken + got[2].taken == int(got[1].target)
    assert repeat_rows(df).columns == df.columns
