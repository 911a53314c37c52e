import random

import numpy as np
import pytest

from brickyard.llm import vertical_join as V
from brickyard.llm.common import connected_components, global_rank
from brickyard.llm.vertical_join import keep_one, ngram_jaccard_join

WS = " \t\n\x0b\x0c\r"


def shingles(text, k):
    raw = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in WS:
        raw = raw.replace(c, " ")
    w = [x for x in raw.split(" ") if x]
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80), (1, 50)])
def test_against_all_pairs(docs, corpus, k, percent):
    got = ngram_jaccard_join(docs, k, percent).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute([(r[0], r[1]) for r in corpus], k, percent)


def test_small_chunks_and_flushes_change_nothing(docs, corpus, monkeypatch):
    monkeypatch.setattr(V, "CHUNK_SETS", 3)
    monkeypatch.setattr(V, "RANGE_KEYS", 3000)
    monkeypatch.setattr(V, "FRAGMENT", 16)
    for group, flush in ((2, 50), (3, 3000), (100, 50)):
        monkeypatch.setattr(V, "GROUP", group)
        monkeypatch.setattr(V, "FLUSH_KEYS", flush)
        k, percent = (3, 60) if group == 3 else (4, 85)
        got = ngram_jaccard_join(docs, k, percent).select("doc_id", "n_shingles", "component_id").collect()
        assert sorted((tuple(r) for r in got), key=str) == brute([(r[0], r[1]) for r in corpus], k, percent)


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_sets_that_link_share_a_key(percent):
    r = random.Random(percent)
    hits = 0
    for _ in range(1500):
        n = r.choice([6, 7, 12, 13, 30, 100, 400])
        a = {r.getrandbits(64) for _ in range(n)}
        b = set(a)
        for x in r.sample(sorted(a), min(n - 1, r.randint(0, max(1, n // 5)))):
            b.discard(x)
        b |= {r.getrandbits(64) for _ in range(r.randint(0, max(1, n // 8)))}
        if a == b or 100 * len(a & b) < percent * len(a | b):
            continue
        hits += 1
        ka, kb = ({w: (need, set(k.tolist())) for w, need, k in V.keys_of(np.array(sorted(s), dtype=np.uint64), percent)} for s in (a, b))
        assert any(len(ka[w][1] & kb[w][1]) >= max(ka[w][0], kb[w][0]) for w in ka.keys() & kb.keys())
    assert hits > 20


def test_empty_table(no_docs):
    assert ngram_jaccard_join(no_docs, 4, 85).count() == 0
    assert keep_one(no_docs).columns == no_docs.columns


def test_keep_one(docs, corpus):
    kept = keep_one(docs, 5, 80)
    assert kept.columns == docs.columns
    rows = [tuple(r) for r in kept.collect()]
    assert set(rows) <= set(corpus)
    by_row = {}
    for (d, _, c), (i, t) in zip(brute_rows(corpus, 5, 80), [(r[0], r[1]) for r in corpus], strict=True):
        by_row.setdefault((i, t), c)
    groups = [by_row[(r[0], r[1])] for r in rows if shingles(r[1], 5)]
    assert len(groups) == len(set(groups)) == len({c for (i, t), c in by_row.items() if shingles(t, 5)})
    assert sum(1 for r in rows if not shingles(r[1], 5)) == sum(1 for r in corpus if not shingles(r[1], 5))


def brute_rows(corpus, k, percent):
    """As brute, in row order, with a component's index as its id."""
    rows = [(i, t) for i, (_, t, *_x) in enumerate(corpus)]
    found = {d: c for d, _, c in brute(rows, k, percent)}
    return [(i, None, found[i]) for i in range(len(rows))]


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(50)] + [(5, 5)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def test_global_rank(spark):
    df = spark.createDataFrame([(x % 7, x) for x in range(200)], "k int, v int").repartition(6)
    got = sorted((r["rank"], r.k, r.v) for r in global_rank(df, [df.k, df.v], "t").collect())
    assert [g[0] for g in got] == list(range(200)) and [g[1:] for g in got] == sorted((x % 7, x) for x in range(200))


def near_copies(n, words=60, edits=2, seed=3, tail=0):
    r = random.Random(seed)
    base = [f"w{r.randrange(10**6)}" for _ in range(words)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(words)] = f"e{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    for j in range(tail):   # chains that leave the copies step by step
        for at in range(0, words // 2, 3):
            base[at] = f"c{j}"
            rows.append((n + len(rows), " ".join(base)))
    return rows


@pytest.mark.parametrize("chunk,centres", [(8, 1), (8, 4), (40, 3)])
def test_star_rounds_change_nothing(spark, monkeypatch, chunk, centres):
    """Large clusters, with sets that link to no centre and chains of links, end as all pairs say."""
    monkeypatch.setattr(V, "CHUNK_SETS", chunk)
    monkeypatch.setattr(V, "CENTRES", centres)
    rows = near_copies(150, edits=4, tail=2) + [(5000 + i, t) for i, t in near_copies(60, seed=9, edits=6)]
    rows += [(8000 + i, t + " extra" * i) for i, t in near_copies(30, seed=11)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = ngram_jaccard_join(df, 4, 70).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 4, 70)


def test_tiles_grow_with_the_cluster(spark, monkeypatch):
    """One cluster of different near copies: four times the sets make about four times the tiles, not sixteen."""
    monkeypatch.setattr(V, "CHUNK_SETS", 32)
    real, count = V._linked, []

    def counted(sets, placed, percent):
        count.append(placed.select("tile").distinct().count())
        return real(sets, placed, percent)

    monkeypatch.setattr(V, "_linked", counted)
    made = {}
    for n in (1000, 4000):
        count.clear()
        df = spark.createDataFrame(near_copies(n, words=80, edits=2), "doc_id long, text string").repartition(4)
        out = ngram_jaccard_join(df, 4, 70)
        assert {r[0] for r in out.select("component_id").distinct().collect()} == {0}
        made[n] = sum(count)
    assert made[4000] < 6 * made[1000] and made[4000] < 4 * 4000 / 32, made
