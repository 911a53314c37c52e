"""Resampling against plain Python."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from brickyard.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, order):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return [" ".join(w[i:i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)], len(w)


def brute(docs, target, order=1, buckets=10_000, percent=10, least=20, seed=2024):
    made = [features(t, order) for _, t in docs]
    place = [[zlib.crc32(x.encode()) % buckets for x in f] for f, _ in made]
    s, t = Counter(b for p in place for b in p), Counter(zlib.crc32(x.encode()) % buckets for x in (y for z in target for y in features(z, order)[0]))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    rows = []
    for (i, _), p, (f, n) in zip(docs, place, made, strict=True):
        h = int(sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in p)
        rows.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def got(df):
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def target(spark, corpus):
    texts = [r[1] for r in corpus[5:20]] + [None, "", "Only here, 9 words; of the target's é own É kind"]
    return texts, spark.createDataFrame([(t, 1) for t in texts], "text string, doc_id int")


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_brute_force(docs, corpus, target, order):
    """Nulls, blanks, repeated ids and rows, a very long text, an extra column."""
    assert got(importance.resample(docs, target[1], order=order)) == brute([r[:2] for r in corpus], target[0], order)


def test_many_buckets_and_parameters(docs, corpus, target):
    args = {"buckets": 200_000, "percent": 35, "least_words": 3, "seed": 9}
    assert got(importance.resample(docs, target[1], order=2, **args)) == brute([r[:2] for r in corpus], target[0], 2, 200_000, 35, 3, 9)


@pytest.mark.parametrize("head", [0, 5])
def test_head_only_saves_work(docs, corpus, target, monkeypatch, head):
    monkeypatch.setattr(importance, "HEAD", head)
    assert got(importance.resample(docs, target[1], order=2)) == brute([r[:2] for r in corpus], target[0], 2)


def test_hasher_head_and_tail_agree():
    r = random.Random(1)
    words = [f"w{r.randrange(60)}é" for _ in range(500)]
    raw = [w.encode() for w in words]
    pairs = {b" ".join(p) for p in zip(raw[::3], raw[1::3], strict=False)}
    for order in (1, 2, 3, 4):
        want = [zlib.crc32(" ".join(words[i:i + n]).encode()) % 997 for n in range(1, order + 1) for i in range(len(words) - n + 1)]
        for vocabulary in ([set()], [set(raw[:40])], [set(raw[:40]), pairs], [set(raw), set(map(b" ".join, zip(raw, raw[1:], strict=False)))]):
            assert importance.Hasher(vocabulary, order, 997)(raw).tolist() == want
    assert importance.Hasher([set(), set()], 2, 997)([]).tolist() == []


def test_head_holds_the_frequent_ones(spark):
    df = spark.createDataFrame([("common pair here",)] * 50 + [(f"rare{i} word{i}",) for i in range(50)], "text string")
    words, pairs = importance.head(df, 2)
    assert {b"common", b"pair", b"here"} <= words and {b"common pair", b"pair here"} <= pairs and b"rare1" not in words


def test_empty(no_docs, docs, corpus, spark):
    none = spark.createDataFrame([], "text string")
    assert got(importance.resample(no_docs, none)) == []
    assert got(importance.resample(docs, none)) == brute([r[:2] for r in corpus], [])


def test_equal_rows_are_ranked_each(spark):
    rows = [(4, " ".join(f"a{i}" for i in range(30)))] * 400
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = importance.resample(df, df, percent=50).collect()
    assert sorted(r["rank"] for r in out if r["rank"]) == list(range(1, 201)) and len(out) == 400


def test_clashing_names(docs, corpus, target):
    more = docs.withColumn("rank", F.lit(1)).withColumn("buckets", F.lit("x")).withColumn("_row", F.lit(2)).withColumn("score", F.lit(0))
    assert got(importance.resample(more, target[1])) == brute([r[:2] for r in corpus], target[0])
