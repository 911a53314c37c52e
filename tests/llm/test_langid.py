import random

import numpy as np
import pandas as pd
import pytest

from brickyard.llm import langid


def text(lang, seed, n):
    r = random.Random(f"{lang}{seed}")
    syl = {"aa": ["tha", "ing", "er", "ou", "st"], "bb": ["qué", "los", "ción", "ar", "ie"]}[lang]
    return " ".join("".join(r.choice(syl) for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, text(("aa", "bb")[i % 2], i, 3 + i % 60), ("aa", "bb")[i % 2]) for i in range(400)]
    rows += [(400, None, "aa"), (401, "123 !!", "bb"), (402, "", None), (403, text("aa", 9, 30), None), (None, text("bb", 1, 20), "bb"),
             (404, text("aa", 4, 40000), "aa"), (5, rows[5][1], "bb"), (405, "zzxq wvkj xqz " * 60, None), (406, "A", "aa")]
    return spark.createDataFrame([(*r, "s", 0) for r in rows], "doc_id long, text string, lang string, source string, score int")


@pytest.fixture(scope="module")
def model(labelled):
    return langid.fit(labelled)


def test_predictions(labelled):
    df = labelled.withColumn("held_out", langid.held_out())
    rows = langid.identify(df, ["doc_id", "held_out", "lang"]).collect()
    assert len(rows) == 409
    ok = [r.lang_pred == r.lang for r in rows if r.held_out and r.lang and r.doc_id not in (400, 401, 406)]
    assert np.mean(ok) > 0.97 and len(ok) > 60
    by = {r.doc_id: r for r in rows}
    for i in (400, 401, 402):
        assert (by[i].lang_pred, by[i].score, by[i].rejected) == (langid.UND, 0.0, True)
    assert by[403].lang_pred == "aa" and by[404].lang_pred == "aa" and not by[404].rejected
    assert by[405].rejected and by[406].lang_pred in ("aa", "bb")
    assert all(0 <= r.score <= 1 for r in rows)


def test_probabilities_sum_to_one(model):
    """Interpolated probabilities over all continuations of a seen context."""
    chars = sorted({c for i in range(40) for c in text("aa", i * 2, 50) + text("bb", i * 2 + 1, 50)})
    for context in ("tha", " ou", "los", "iel"):
        codes = np.array([[*map(ord, context), ord(c)] for c in chars], dtype=np.uint32)
        total = np.zeros(2)
        for row in codes:
            h = [x[-1:] for x in langid.gram_hashes(row, model.order)]
            prior = [x[-2:-1] for x in langid.gram_hashes(row, model.order)]
            total += np.exp(model._logp(h, prior)[0])
        assert (total > 0.97).all() and (total < 1.001).all()


def test_whole_text_counts_and_slices_agree(model, monkeypatch):
    t = [text("aa", 1, 500) + " " + text("bb", 2, 900), "x", text("bb", 7, 50)]
    whole = model.entropies(t)
    monkeypatch.setattr(langid, "SLICE", 37)
    part = model.entropies(t)
    assert np.allclose(whole[0], part[0], rtol=1e-5) and (whole[1] == part[1]).all()
    again = langid.Model.of(model.state()).entropies(t)
    assert np.allclose(whole[0], again[0], rtol=1e-5)


def test_hash_table():
    r = np.random.default_rng(1)
    keys = np.unique(r.integers(0, 2**64 - 1, 5000, dtype=np.uint64))
    t = langid.HashTable(keys)
    assert (t.find(keys) == np.arange(len(keys))).all()
    other = np.setdiff1d(r.integers(0, 2**64 - 1, 5000, dtype=np.uint64), keys)
    assert (t.find(np.concatenate((other, [np.uint64(0), np.uint64(2**64 - 1)]))) == -1).all()
    assert (langid.HashTable(keys[:0]).find(other) == -1).all()


def test_kneser_ney_by_hand(spark):
    """Bigrams of one language: continuation counts, one discount, uniform floor."""
    rows = spark.createDataFrame([("x", "abab ac")], "lang string, text string")
    got = rows.mapInArrow(langid._count_grams(2), "lang string, n int, gram long, ctx long, suffix long, count long").toPandas()
    types = {}
    for n in (1, 2):
        one = got[got["n"] == n]
        g = one["gram"].to_numpy().view(np.uint64)
        o = np.argsort(g)
        types["x", n] = (g[o], one["ctx"].to_numpy().view(np.uint64)[o], one["suffix"].to_numpy().view(np.uint64)[o], one["count"].to_numpy()[o].astype(float))
    m = langid.kneser_ney(["x"], 2, types, langid.letter_table())
    # bigrams: (pad a) ab*2 ba (b space) (space a) ac; n1 = 5, n2 = 1
    d2 = 5 / 7
    # continuations: a <- pad, b, space; b <- a; space <- b; c <- a: n1 = 3, n2 = 0, so d = 0.5
    cont = {"a": 3, "b": 1, " ": 1, "c": 1}
    p1 = {c: (n - 0.5) / 6 + 0.5 * 4 / 6 / 5 for c, n in cont.items()}
    want = {"ab": (2 - d2) / 3 + d2 * 2 / 3 * p1["b"], "ac": (1 - d2) / 3 + d2 * 2 / 3 * p1["c"], "aa": d2 * 2 / 3 * p1["a"]}
    for gram, p in want.items():
        codes = np.array([*map(ord, gram)], np.uint32)
        h = [x[-1:] for x in langid.gram_hashes(codes, 2)]
        prior = [x[-2:-1] for x in langid.gram_hashes(codes, 2)]
        assert np.exp(m._logp(h, prior)[0, 0]) == pytest.approx(p, rel=1e-5)


def test_nothing_labelled(spark, no_docs, docs):
    assert langid.identify(no_docs, ["doc_id"]).count() == 0
    none = docs.withColumn("lang", docs.lang.substr(9, 1).cast("int").cast("string"))
    assert {r.lang_pred for r in langid.identify(none.selectExpr("doc_id", "text", "cast(null as string) lang"), ["doc_id"]).collect()} == {langid.UND}


def test_reject_keeps_columns(labelled, model):
    kept = langid.reject(labelled, model)
    assert kept.columns == labelled.columns
    assert {400, 401, 402, 405} & {r.doc_id for r in kept.collect()} == set()
    assert isinstance(kept.toPandas(), pd.DataFrame) and kept.count() == 405


def test_giant_text_neither_empties_nor_bursts_the_sample(spark):
    """Short texts stay beside a giant one, ids play no part, and every language is learned."""
    rows = [(None, text("aa", i, 30), "aa") for i in range(100)]
    rows += [(1, text("aa", 500, 60_000), "aa"), (None, rows[0][1], "aa")]
    rows += [(2 + i, text("bb", i, 30_000), "bb") for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = langid.sample(df, 40_000, 42).collect()
    aa, bb = ([r.text for r in got if r.lang == x] for x in ("aa", "bb"))
    assert {r[1] for r in rows[:100]} <= set(aa) and len(aa) == len(set(aa)) and sum(map(len, aa)) <= 40_000
    assert len(bb) == 2 and sum(map(len, bb)) <= 80_000
    assert langid.fit(df, sample_chars=40_000).langs == ["aa", "bb"]
    # the bound holds where there is more text than it, and about fills up
    small = [r.text for r in langid.sample(df.filter("lang = 'aa'"), 5_000, 42).collect()]
    assert 4_000 <= sum(map(len, small)) <= 5_000 and set(small) <= {r[1] for r in rows}
