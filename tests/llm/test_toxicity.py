"""The classifier: its arithmetic against plain loops, its results on planted words."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from brickyard.llm import toxicity as T

BAD = {"aa": ["grubnak", "skorvel"], "bb": ["zimpatt", "holdrek"]}


def text_of(r, lang, toxic, n=40):
    w = [f"{lang}{r.randrange(400)}x" for _ in range(n)]
    if toxic:
        w.insert(r.randrange(n), r.choice(BAD[lang]) + r.choice(("", "en", "ist", ",")))
    return " ".join(w)


@pytest.fixture(scope="module")
def labelled():
    r = random.Random(5)
    return [(i, text_of(r, lang := r.choice(("aa", "bb")), y := int(r.random() < 0.2)), lang, y) for i in range(1500)]


def test_word_ids():
    a, b = T.word_ids("Idiot, idiots! é-x 9".encode()), T.word_ids("zz idiot IDIOTS É".encode())
    assert a.shape == (3, 5) and a[0, 0] == b[0, 1] and a[0, 1] == b[0, 2] and a[0, 0] != a[0, 1]
    assert a[1, 0] == a[1, 1]  # same first four bytes
    assert T.word_ids(None).shape == T.word_ids(b" .,;").shape == (3, 0)


def slow_pooled(net, ids):
    n = ids.shape[1]
    x = [np.concatenate([net.tables[k][T._row_of(ids[:, i:i + 1], k)][0] for k in range(T.TABLES)]) for i in range(n)]
    x += [np.zeros(T.TABLES * T.ROW, np.float32)] * T.WIDTHS[-1]
    out = []
    for w, f, b in zip(T.WIDTHS, net.filters, net.biases, strict=True):
        at = [b + sum(x[i + j] @ f[j] for j in range(w)) for i in range(max(n - w + 1, 1))]
        out += list(np.maximum(np.max(at, axis=0), 0))
    return out


def random_net(seed=0):
    rng = np.random.default_rng(seed)
    net = T.Net(rng)
    net.tables[:] = rng.normal(size=net.tables.shape)
    net.biases = [rng.normal(size=T.FILTERS).astype(np.float32) for _ in T.WIDTHS]
    return net


@pytest.mark.parametrize("block", [3, 7, 1 << 16])
def test_pooling_against_loops(monkeypatch, block):
    """Whole texts in blocks of any size, short and empty ones included."""
    monkeypatch.setattr(T, "BLOCK", block)
    net, r = random_net(), random.Random(2)
    texts = [T.word_ids(" ".join(f"w{r.randrange(50)}" for _ in range(n)).encode()) for n in (0, 1, 2, 3, 4, 20, 0, 9, 41)]
    got = net.pooled(texts)
    for g, t in zip(got, texts, strict=True):
        assert g == pytest.approx(slow_pooled(net, t), abs=1e-4)


def test_gradients_against_differences(monkeypatch):
    """One plain gradient step: the loss falls as finite differences say."""
    net, r = random_net(1), random.Random(3)
    texts = [T.word_ids(" ".join(f"w{r.randrange(30)}" for _ in range(n)).encode()) for n in (1, 5, 12, 30)]
    y, weight = np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 1, 0.5])

    def loss(at):
        z = at.pooled(texts) @ at.out + at.bias
        return float((weight * np.where(y == 1, np.logaddexp(0, -z), np.logaddexp(0, z))).mean())

    got = {}
    monkeypatch.setattr(T.Net, "_update", lambda self, name, g, grads: got.__setitem__(name, np.array(g)))
    monkeypatch.setattr(T, "RATE", 0.0)
    live = np.ones((T.TABLES, 1 << T.TABLE_BITS), bool)
    grads = {}
    net.step(texts, y, weight, live, grads)
    for name, get in ((("filters", 1), lambda n: n.filters[1]), (("biases", 2), lambda n: n.biases[2]), ("out", lambda n: n.out)):
        rng = np.random.default_rng(4)
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in get(net).shape)
            old, eps = get(net)[at], 1e-2
            get(net)[at] = old + eps
            up = loss(net)
            get(net)[at] = old - eps
            down = loss(net)
            get(net)[at] = old
            assert got[name][at] == pytest.approx((up - down) / (2 * eps), abs=2e-2)
    squares = grads["table", 0] - 1e-6
    row = np.argwhere(squares > 1e-4)[0]
    old = net.tables[0][tuple(row)]
    net.tables[0][tuple(row)] = old + 1e-2
    up = loss(net)
    net.tables[0][tuple(row)] = old - 1e-2
    down = loss(net)
    assert np.sqrt(squares[tuple(row)]) == pytest.approx(abs(up - down) / 2e-2, abs=2e-2)


def test_best_cut():
    assert T.best_cut(np.array([0.0, 1, 5, 6]), np.array([0, 0, 1, 1])) == 3
    assert T.best_cut(np.array([0.0, 4, 1, 6, 7]), np.array([0, 0, 0, 1, 1])) == 5
    assert T.best_cut(np.array([2.0, 2]), np.array([0, 0])) > 2


def test_calibration_by_language():
    """Languages whose logits stand apart get cuts of their own, at the score 0.7."""
    r = np.random.default_rng(0)
    y = np.tile([0, 1], 200)
    lang = np.repeat([0, 1], 200)
    z = y * 2.0 + lang * 5 + r.normal(0, 0.1, 400)
    cuts, steep = T.calibrate(z, y, lang, 2)
    for k, c in ((0, 1.0), (1, 6.0)):
        assert cuts[k] == pytest.approx(c, abs=0.6)
        p = T.probability(z - cuts[lang], steep)
        assert ((p >= T.CUT) == (y == 1))[lang == k].mean() > 0.99


def test_state_round_trip(labelled):
    c = T.fit([(t.encode(), y, lang, i % 5 == 0) for i, t, lang, y in labelled[:600]])
    again = T.Classifier.of(c.state())
    ids = [T.word_ids(t.encode()) for _, t, _, _ in labelled[600:700]] + [T.word_ids(b"")]
    assert (c.scores(ids) == again.scores(ids)).all() and len(c.guess.langs) == 2


def frames(spark, rows, labels=None):
    docs = spark.createDataFrame([(i, t, lang, "s", "x") for i, t, lang, _ in rows], "doc_id long, text string, lang string, source string, score string")
    return docs, spark.createDataFrame(labels if labels is not None else [(i, y, 0) for i, _, _, y in rows], "doc_id long, toxic int, quality int")


def test_held_out_accuracy_and_columns(spark, labelled):
    docs, labels = frames(spark, labelled)
    out = T.classify(docs, labels).collect()
    y = {i: k for i, _, _, k in labelled}
    assert sorted(r.doc_id for r in out) == sorted(y)
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in out if r.held_out]
    right = [r.predicted == y[r.doc_id] for r in held]
    assert len(held) > 400 and np.mean(right) > 0.95
    assert np.mean([r.predicted for r in held if y[r.doc_id]]) > 0.9


def test_scores_come_from_text_alone(spark, labelled):
    """Held-out labels, and lang, source and id of scored rows, change nothing."""
    docs, labels = frames(spark, labelled[:500])
    model = T.fitted(docs, labels)
    flipped = labels.withColumn("toxic", F.when(T.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert T.fitted(docs, flipped) == model
    a = {r.doc_id: r.score for r in T.score(docs, model).collect()}
    moved = docs.select((F.col("doc_id") + 10_000).alias("doc_id"), "text", F.lit("zz").alias("lang"), F.lit(None).alias("source"))
    assert {r.doc_id - 10_000: r.score for r in T.score(moved, model).collect()} == a


def test_nulls_ties_and_odd_texts(spark, labelled):
    rows = labelled[:300] + [(5000, None, None, 1), (5001, "", "aa", 0), (5002, " .,", None, 0), (None, "grubnak here", "aa", 1),
                             (7, "another text of id seven", "aa", 0), (5003, "holdrek " + "bb1x " * 200_000, "bb", 1)]
    labels = [(i, y, 0) for i, _, _, y in rows] + [(3, None, 0), (None, 1, 0), (4, 1, 0), (4, 0, 1), (99_999, 1, 0)]
    out = T.classify(*frames(spark, rows, labels)).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert by[5000].score == by[5001].score == by[5002].score and not by[None].held_out
    assert all(r.score is not None and 0 <= r.score <= 1 for r in out)


@pytest.mark.parametrize("labels,want", [([], 0.0), ([(0, 1, 0), (2, 1, 0), (4, 1, 0), (5, 1, 0)], 1.0)])
def test_without_both_kinds(spark, labelled, labels, want):
    docs, lab = frames(spark, labelled[:20], labels)
    assert {r.score for r in T.classify(docs, lab).collect()} == {want}


def test_empty(spark, no_docs):
    lab = spark.createDataFrame([], "doc_id long, toxic int")
    df = T.classify(no_docs, lab)
    assert df.columns == ["doc_id", "held_out", "score", "predicted"] and df.collect() == []


def test_sample_is_bounded(spark, labelled, monkeypatch):
    monkeypatch.setattr(T, "TOXIC", 10)
    monkeypatch.setattr(T, "OTHER", 30)
    rows = labelled + [(0, labelled[0][1], "aa", 0)] * 50  # a repeated id
    got = T.sample(*frames(spark, rows, [(i, y, 0) for i, _, _, y in labelled]), seed=1).collect()
    assert sum(r.toxic for r in got) == 10 and len(got) == 40


def test_every_labelled_text_is_learned(spark, labelled, monkeypatch):
    """Several packs: a word of a few late texts only, long ones too, counts; results hold however many packs there are."""
    monkeypatch.setattr(T, "PACK_TEXTS", 300)
    monkeypatch.setattr(T, "TOXIC", 5)
    monkeypatch.setattr(T, "OTHER", 5)
    monkeypatch.setattr(T, "SAMPLE_CHARS", 50)
    docs, labels = frames(spark, labelled)
    packs, many = T.packs(docs, labels, T.SEED)
    kept = [r.doc_id for r in docs.filter(~T.held_out()).collect()]
    assert many > 2 and packs.selectExpr("sum(size(rows))").first()[0] == len(kept)
    model = T.fitted(docs, labels)
    assert T.fitted(docs.repartition(5), labels) == model
    y = {i: k for i, _, _, k in labelled}
    held = [r for r in T.score(docs, model).collect() if r.held_out]
    assert np.mean([r.predicted == y[r.doc_id] for r in held]) > 0.95
    counts, words = T._counted(packs, ["aa", "bb"], lambda r: True)
    texts = {i: T.word_ids(t.encode()) for i, t, _, _ in labelled}
    toxic, every = T.seen_rows([texts[i] for i in kept], np.array([y[i] for i in kept]), 1)
    assert (counts[1][0] == toxic).all() and (counts[1][1] == every).all()
    assert words.sum() == sum(texts[i].shape[1] for i in kept)
