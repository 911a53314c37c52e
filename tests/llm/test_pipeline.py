"""The pipeline's stages against plain-Python versions on a small corpus."""

import random
from collections import Counter

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from brickyard.llm import langid, packing

SYLLABLES = {"aa": ["tha", "ing", "er", "ou", "st"], "bb": ["qué", "los", "ción", "ar", "ie"]}


def text(lang, seed, n):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    out = [(i, text(("aa", "bb")[i % 2], i, 10 + i % 50), ("aa", "bb")[i % 2], f"s{i % 4}", 0) for i in range(300)]
    for i in range(300, 320):  # near copies of document 10 and exact ones of 20
        w = out[10][1].split()
        w[i % len(w)] = "edited"
        out.append((i, " ".join(w) if i < 310 else out[20][1], "aa", "s1", 0))
    long = text("aa", 77, 200)
    out += [(320 + i, long + f" tail{i}", "aa", "s0", 0) for i in range(8)]
    out += [(400, None, "aa", "s0", 0), (401, "", "bb", None, 0), (402, "12 34 !!", None, "s2", 0), (403, "zzxq wvkj xqz " * 60, None, "s3", 0),
            (404, text("bb", 5, 20), None, None, 0), (5, out[5][1], "bb", "s1", 0)]
    return out


@pytest.fixture(scope="module")
def stages(spark, rows, tmp_path_factory):
    """Input and output of every stage, written and read as the driver does."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    df = spark.createDataFrame([(*r, r[0]) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, id long").withColumns({"Copies": F.lit(1), "node": F.lit("x")})
    df.repartition(4).write.parquet(f"{folder}/documents.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in P.STAGES:
        stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
        out[name] = (docs, docs := spark.read.parquet(f"{folder}/{name}"))
    return folder, out


def test_columns_and_run(spark, stages):
    folder, out = stages
    for name, (before, after) in out.items():
        assert name == "packing" or after.columns == before.columns
    assert P.run(spark, folder).count() == out["packing"][1].count()


def test_language_stage_keeps_clean_documents(stages):
    before, after = stages[1]["language_id"]
    kept = Counter(r.doc_id for r in after.collect())
    assert not {400, 401, 402, 403} & set(kept)
    assert kept == Counter(r.doc_id for r in before.collect() if r.doc_id not in (400, 401, 402, 403))


def test_near_duplicates_leave_one(stages):
    before, after = stages[1]["near_duplicates"]

    def sh(t):
        w = t.lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}

    src, kept = [(r.doc_id, sh(r.text)) for r in before.collect()], [(r.doc_id, sh(r.text)) for r in after.collect()]
    up = list(range(len(src)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (_, a) in enumerate(src):
        for j in range(i):
            if len(a & src[j][1]) >= 0.8 * len(a | src[j][1]):
                up[root(i)] = root(j)
    want = sorted(min(src[i][0] for i in range(len(src)) if root(i) == r) for r in {root(i) for i in range(len(src))})
    assert sorted(d for d, _ in kept) == want


def test_mixture_meets_targets(stages):
    before, after = stages[1]["mixture"]
    size = F.size(F.split(F.trim(F.col("text")), r"\s+"))
    have = {r[0]: r[1] for r in before.groupBy("source").agg(F.sum(size)).collect()}
    got = {r[0]: r[1] for r in after.groupBy("source").agg(F.sum(size)).collect()}
    order = sorted(have, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    lo, hi, total = 0.0, 1e9, sum(have.values())
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(3 * have[s], mid * weight[s]) for s in have) < total else (lo, mid)
    longest = before.agg(F.max(size)).first()[0]
    for s in have:
        assert abs(got.get(s, 0) - min(3 * have[s], lo * weight[s])) <= longest


def test_packing_holds_every_token(stages):
    before, after = stages[1]["packing"]
    encode = packing.encoder(packing.tokenizer_path())
    want = Counter((r.doc_id, len(encode(r.text)) + 1) for r in before.collect())
    got = Counter()
    for r in after.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n")).collect():
        got[r.doc_id, r.doc_tokens] = r.n // r.doc_tokens
    assert got == want


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0
    assert langid.UND == "und"
