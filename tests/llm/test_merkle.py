"""The manifest against a tree built in plain Python."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from brickyard.llm import merkle

COLS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(parts):
    return sha256("".join(parts).encode()).hexdigest()


def lower(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def leaf(row, changed=False):
    i, text, lang, source, n = row[:5]
    values = (i, source, lang, n, lower(text) if changed else text)
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tower(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def brute(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for rs in trees.values():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    towers = [tower([leaf(r) for r in trees[x]]) for x in order]
    top = tower([t[-1][0] for t in towers])
    out = []
    for k, x in enumerate(order):
        for i, r in enumerate(trees[x]):
            proof, d = [], leaf(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0)
            for levels, p in ((towers[k], i), (top, k)):
                for nodes in levels[:-1]:
                    run = list(nodes[p // 8 * 8:p // 8 * 8 + 8])
                    proof += run[:p % 8] + run[p % 8 + 1:]
                    run[p % 8] = d
                    d, p = digest(run), p // 8
            out.append((r[0], leaf(r), towers[k][-1][0], top[-1][0], digest(proof), d, d == top[-1][0]))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=str)


def test_against_brute_force(docs, corpus):
    """Nulls, blanks, repeated ids and rows, a very long text, an extra column."""
    assert rows_of(merkle.manifest(docs)) == brute(corpus)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 600, 5000])
def test_sizes(spark, n):
    """Lone leaves, full and short runs, trees of one and of several partitions, many trees."""
    r = random.Random(n)
    rows = [(i, f"Text {r.random()}", None if i % 5 == 0 else f"l{r.randrange(n // 40 + 1)}", "s", i) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert rows_of(merkle.manifest(df)) == brute(rows)


def test_equal_rows(spark):
    rows = [(7, "Same text", "en", "s", 9)] * 700 + [(3, "other", "en", None, 5)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    assert rows_of(merkle.manifest(df)) == brute(rows)


def test_empty(no_docs):
    df = merkle.manifest(no_docs)
    assert df.columns == COLS and df.collect() == []


def test_clashing_names(docs, corpus):
    more = docs
    for c in ("tree", "leaf", "rank", "place", "_lang", "_tie", "digest"):
        more = more.withColumn(c, F.lit("x"))
    assert rows_of(merkle.manifest(more)) == brute(corpus)


def test_proofs_of_some_rows(spark):
    """Partitions that hold a part of their leaves fetch the others; proofs stay the same."""
    r = random.Random(3)
    rows = [(i, f"Text {r.random()}", f"l{i % 3}", "s", i) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    m = merkle.build(df, F.when(merkle.is_tampered(), F.lower("text")).otherwise(F.col("text")))
    some = rows_of(merkle.prove(m, m.leaves.filter("doc_id % 37 = 0 or doc_id between 900 and 930")))
    assert some == [x for x in brute(rows) if x[0] % 37 == 0 or 900 <= x[0] <= 930]


def test_stored_nodes_are_used(spark):
    """A forged interior node makes every proof that needs it fail, and no other."""
    rows = [(i, f"t{i}", "l", "s", i) for i in range(1200)]
    m = merkle.build(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    forged = m._replace(nodes=m.nodes.withColumn("digest", F.when((F.col("tree") == 0) & (F.col("level") == 3) & (F.col("place") == 1), F.lit("0" * 64)).otherwise(F.col("digest"))))
    bad = {x.doc_id for x in merkle.prove(forged, m.leaves).filter("not verified").collect()}
    place = {x.doc_id: x.place for x in m.leaves.collect()}
    assert bad == {i for i, p in place.items() if p >> 9 != 1}


@pytest.mark.parametrize("n,n_trees", [(1, 1), (5, 1), (8, 3), (77, 9), (600, 2)])
def test_multiproof_is_minimal(n, n_trees):
    """Exactly the siblings on the paths that no row of the partition stands under."""
    r = random.Random(n)
    for _ in range(20):
        places = set(r.sample(range(n), r.randint(1, n)))
        tree = r.randrange(n_trees)
        want = set()
        for p in places:
            for at in range(merkle.height(n)):
                up = p >> 3 * at
                for q in range(up // 8 * 8, min(up // 8 * 8 + 8, -(-n // 8**at))):
                    if not any(x >> 3 * at == q for x in places):
                        want.add((tree, at, q))
        for at in range(merkle.height(n_trees)):
            up = tree >> 3 * at
            want |= {(merkle.TOP, at, q) for q in range(up // 8 * 8, min(up // 8 * 8 + 8, -(-n_trees // 8**at))) if q != up}
        got = list(merkle.missing(tree, places, n, n_trees))
        assert len(got) == len(set(got)) and set(got) == want


def test_height_column(spark):
    ns = [1, 2, 8, 9, 64, 65, 512, 513, 10**12]
    got = spark.createDataFrame([(n,) for n in ns], "n long").select("n", merkle._height(F.col("n"))).collect()
    assert {r[0]: r[1] for r in got} == {n: merkle.height(n) for n in ns}
