"""Toxicity: a convolutional text classifier, trained in numpy.

A word (digits, letters and characters beyond ASCII, A-Z lower-cased) is
hashed whole into ``WHOLE`` tables, and by its first bytes into one more for
each length in ``PREFIXES``; its vector is one row of each, side by side, so
that inflections share a part and two words are alike only if they meet in
every table. Filters of each
width in ``WIDTHS`` run over the word vectors; the greatest activation of each
filter over the whole text feeds a logistic output. Rows are learned
that ``LEAST_TEXTS`` training texts or more meet, others are zero; the first
number of a learned row starts at the word's shrunk log ratio of toxic to
other texts. Training is Adagrad on whole texts; since pooling passes a
gradient to one place a filter, a step touches few rows.

Thresholds are calibrated by language on a fifth of those texts: for each
language, as guessed from the text's words alone, the cut of least balanced
error, shrunk to the cut of all languages by the number of toxic texts. Scores
are shifted so that every language's cut is ``CUT``.

Fitting reads every labelled text that is not held out, whole. The texts are
dealt by hash into packs of about ``PACK_TEXTS`` texts or ``PACK_CHARS``
characters. Counts of words, by kind and by language, are summed over the packs.
In each of ``EPOCHS`` rounds every pack goes through its texts once from the
common state, and the changes are averaged: those of a table row over the packs
that changed it, filters and output over all. A single pack makes its rounds at
once. Calibration sums up the logits of all texts set apart, to 1 / ``STEPS``.
The driver holds the model (bounded by the tables) and those sums, no texts.

Defined results: null and empty texts, and texts without a word, are scored as
a text of no words. Of several labels of an id the mean decides (half counts as
toxic); of several texts of a labelled id the one with the least hash is
trained on; null labels and labels of a null id are left out. Repeated rows are
scored each; a null id is not held out. Without labels of both kinds every
score is the toxic share of the training texts (0 if there is none). An empty table
gives no rows. Columns beyond doc_id, text, lang (of training texts only) and the
labels' doc_id and toxic are ignored.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, mix64, powers, small_or_shuffled, text_batches, written

WHOLE, PREFIXES, TABLE_BITS, ROW = 2, (4, 6), 18, 4
TABLES = WHOLE + len(PREFIXES)
WIDTHS, FILTERS = (1, 2, 3), 8
LEAST_TEXTS, EPOCHS, BATCH, RATE, SEED = 5, 8, 32, 0.05, 42
#: Bounds of ``sample``.
TOXIC, OTHER, SAMPLE_CHARS = 1_400, 5_600, 100_000
#: Bounds of a pack of training texts; pieces that each table's rows are merged in; steps of a logit's unit and greatest logit told apart.
PACK_TEXTS, PACK_CHARS, PIECES, STEPS, FARTHEST = 2_048, 8_000_000, 16, 128, 32
#: Share of the training texts that calibrates (one in so many); toxic texts at which a language's own cut counts half; score of the cut.
CALIBRATE, SHRINK, CUT = 5, 10.0, 0.7
#: Buckets of the language guess, languages it tells apart at most (the most frequent of the training texts).
GUESS_BITS, LANGUAGES = 14, 64
#: Words convolved at once.
BLOCK = 1 << 16

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def word_ids(raw: bytes | None) -> np.ndarray:
    """64-bit hashes of the words of UTF-8 text, in order: a row of the whole
    words' hashes, then one of the hashes of their first bytes for each length."""
    if not raw:
        return np.empty((1 + len(PREFIXES), 0), np.uint64)
    b = np.frombuffer(raw.lower(), np.uint8)
    inside = (b >= 128) | ((b >= 97) & (b <= 122)) | ((b >= 48) & (b <= 57))
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    start, end = edge[::2], edge[1::2]
    upto = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(b)), out=upto[1:])
    back = powers(_INVERSE, max(1, len(b)))[start]
    ends = np.stack([end, *(np.minimum(end, start + n) for n in PREFIXES)])
    return mix64((upto[ends] - upto[start]) * back ^ ((ends - start).astype(np.uint64) << np.uint64(48)))


def _row_of(ids: np.ndarray, table: int) -> np.ndarray:
    """Row of each word in a table; whole words take other bits for each."""
    row, at = (ids[0], table) if table < WHOLE else (ids[1 + table - WHOLE], 0)
    return ((row >> np.uint64(at * TABLE_BITS)) & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)


class Net:
    """Tables, filters (width, table numbers, filter), biases and output weights."""

    def __init__(self, rng: np.random.Generator):
        self.tables = np.zeros((TABLES, 1 << TABLE_BITS, ROW), np.float32)
        dim = TABLES * ROW
        self.filters = [rng.normal(0, dim**-0.5, (w, dim, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.biases = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = np.abs(rng.normal(0.5, 0.2, len(WIDTHS) * FILTERS)).astype(np.float32)
        self.bias = np.float32(-1)

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        return np.concatenate([self.tables[k][_row_of(ids, k)] for k in range(TABLES)], axis=1)

    def _activations(self, x: np.ndarray) -> list[np.ndarray]:
        """Per width, the filters at every place of ``x`` that has room for them."""
        return [b + sum(x[j:len(x) - w + 1 + j] @ f[j] for j in range(w)) for w, f, b in zip(WIDTHS, self.filters, self.biases, strict=True)]

    def pooled(self, texts: list[np.ndarray]) -> np.ndarray:
        """Greatest activation (0 at least) of each filter over each whole text."""
        best = np.zeros((len(texts), len(WIDTHS) * FILTERS), np.float32)
        gap, held, at = WIDTHS[-1] - 1, [], 0
        for i, ids in enumerate(texts):
            for s in range(0, max(1, ids.shape[1] - gap), BLOCK):
                piece = ids[:, s:s + BLOCK + gap]  # places that span two blocks belong to the first
                held.append((i, piece))
                at += piece.shape[1]
                if at >= BLOCK:
                    self._pool(held, best)
                    held, at = [], 0
        if held:
            self._pool(held, best)
        return best

    def _pool(self, pieces: list[tuple[int, np.ndarray]], best: np.ndarray) -> None:
        gap = WIDTHS[-1] - 1
        size = np.array([p.shape[1] for _, p in pieces])
        start = np.concatenate(([0], np.cumsum(np.maximum(size, 1) + gap)[:-1]))
        x = np.zeros((int(start[-1] + max(size[-1], 1) + gap + 1), TABLES * ROW), np.float32)
        place = np.repeat(start - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        x[place] = self.vectors(np.concatenate([p for _, p in pieces], axis=1))
        owner = np.array([i for i, _ in pieces])
        for k, (w, a) in enumerate(zip(WIDTHS, self._activations(x), strict=True)):
            ends = np.column_stack((start, start + np.maximum(size - w + 1, 1))).ravel()
            top = np.maximum.reduceat(a, ends)[::2]  # a text shorter than the width has one place, filled up with zeros
            np.maximum.at(best[:, k * FILTERS:(k + 1) * FILTERS], owner, top)

    def logits(self, texts: list[np.ndarray]) -> np.ndarray:
        return (self.pooled(texts) @ self.out + self.bias).astype(np.float64)

    def step(self, texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray, live: np.ndarray, grads: dict) -> None:
        """One Adagrad step on a batch. ``live``: table rows that learn."""
        dim, n = TABLES * ROW, len(texts)
        xs = [np.concatenate((self.vectors(t), np.zeros((WIDTHS[-1], dim), np.float32))) for t in texts]
        places = np.zeros((n, len(WIDTHS) * FILTERS), np.int64)
        value = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
        for i, (t, x) in enumerate(zip(texts, xs, strict=True)):
            for k, (w, a) in enumerate(zip(WIDTHS, self._activations(x), strict=True)):
                a = a[:max(t.shape[1] - w + 1, 1)]
                p = a.argmax(axis=0)
                places[i, k * FILTERS:(k + 1) * FILTERS], value[i, k * FILTERS:(k + 1) * FILTERS] = p, a[p, np.arange(FILTERS)]
        pool = np.maximum(value, 0)
        z = pool @ self.out + self.bias
        d = (weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n).astype(np.float32)
        back = d[:, None] * self.out * (value > 0)
        self._update("out", d @ pool, grads)
        self._update("bias", d.sum(), grads)
        start = np.cumsum([0] + [len(x) for x in xs])
        x, ids = np.concatenate(xs), np.concatenate([np.pad(t, ((0, 0), (0, WIDTHS[-1]))) for t in texts], axis=1)
        real = np.concatenate([np.arange(len(x)) < t.shape[1] for t, x in zip(texts, xs, strict=True)])
        rows, into = [], []
        for k, w in enumerate(WIDTHS):
            g, at = back[:, k * FILTERS:(k + 1) * FILTERS], places[:, k * FILTERS:(k + 1) * FILTERS] + start[:-1, None]
            f, df = self.filters[k], np.zeros_like(self.filters[k])
            for j in range(w):
                df[j] = np.einsum("nf,nfd->df", g, x[at + j])
                rows.append((at + j).ravel())
                into.append((g[:, :, None] * f[j].T).reshape(-1, dim))
            self._update(("filters", k), df, grads)
            self._update(("biases", k), g.sum(axis=0), grads)
        rows, into = np.concatenate(rows), np.concatenate(into)
        used = real[rows] & (np.abs(into).max(axis=1) > 0)
        rows, into = rows[used], into[used]
        for k in range(TABLES):
            r = _row_of(ids[:, rows], k)
            r, part = r[live[k, r]], into[live[k, r], k * ROW:(k + 1) * ROW]
            u, at = np.unique(r, return_inverse=True)
            g = np.zeros((len(u), ROW), np.float32)
            np.add.at(g, at, part)
            seen = grads.setdefault(("table", k), np.full(self.tables[k].shape, 1e-6, np.float32))
            seen[u] += g * g
            self.tables[k][u] -= RATE * g / np.sqrt(seen[u])

    def _update(self, name, g, grads: dict) -> None:
        seen = grads[name] = grads.get(name, 1e-6) + g * g
        change = RATE * g / np.sqrt(seen)
        if isinstance(name, tuple):
            getattr(self, name[0])[name[1]] -= change
        else:
            setattr(self, name, getattr(self, name) - change)

    def state(self) -> bytes:
        """Filters and the table rows that are not zero."""
        at = [np.flatnonzero(t.any(axis=1)) for t in self.tables]
        return pickle.dumps(([(a.astype(np.int32), t[a]) for a, t in zip(at, self.tables, strict=True)], self.filters, self.biases, self.out, self.bias))

    @classmethod
    def of(cls, state: bytes) -> Net:
        net = cls(np.random.default_rng(0))
        rows, net.filters, net.biases, net.out, net.bias = pickle.loads(state)
        for k, (at, values) in enumerate(rows):
            net.tables[k][at] = values
        return net


def seen_rows(texts: list[np.ndarray], y: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row of a table, the toxic texts and all texts that meet it."""
    held = [np.unique(_row_of(t, table)) for t in texts]
    at, label = np.concatenate(held), np.repeat(y, [len(h) for h in held])
    return np.bincount(at, label, 1 << TABLE_BITS), np.bincount(at, minlength=1 << TABLE_BITS)


def started(counts: list[tuple[np.ndarray, np.ndarray]], toxic_texts: float, others: float, rng: np.random.Generator) -> tuple[Net, np.ndarray]:
    """A net before its first step, and the table rows that learn, from ``seen_rows`` of all training texts."""
    net, live = Net(rng), np.zeros((TABLES, 1 << TABLE_BITS), bool)
    base = toxic_texts / max(1, others)
    for k, (toxic, every) in enumerate(counts):
        rows = np.flatnonzero(every >= LEAST_TEXTS)
        live[k, rows] = True
        net.tables[k][rows] = rng.normal(0, 0.1, (len(rows), ROW))
        net.tables[k][rows, 0] = np.log((toxic + 2) / ((every - toxic) * base + 2))[rows]
    return net, live


def weights(y: np.ndarray, toxic_texts: float, others: float) -> np.ndarray:
    """Both kinds of all training texts weigh the same."""
    n = toxic_texts + others
    return np.where(y == 1, n / (2 * toxic_texts), n / (2 * others))


def epoch(net: Net, texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray, live: np.ndarray, grads: dict, rng: np.random.Generator) -> None:
    order = rng.permutation(len(texts))
    at = 0
    while at < len(order):
        # BATCH texts, fewer where they are very long
        words = np.cumsum([texts[i].shape[1] for i in order[at:at + BATCH]])
        pick = order[at:at + max(1, int(np.searchsorted(words, 4 * BLOCK, "right")))]
        net.step([texts[i] for i in pick], y[pick], weight[pick], live, grads)
        at += len(pick)


def train(texts: list[np.ndarray], y: np.ndarray, seed: int = SEED) -> Net:
    rng = np.random.default_rng(seed)
    net, live = started([seen_rows(texts, y, k) for k in range(TABLES)], y.sum(), (1 - y).sum(), rng)
    grads: dict = {}
    for _ in range(EPOCHS):
        epoch(net, texts, y, weights(y, y.sum(), (1 - y).sum()), live, grads, rng)
    return net


class Guess:
    """Language of a text from its words: naive Bayes over hashed words."""

    def __init__(self, texts: list[np.ndarray], langs: list[str | None]):
        seen: dict[str, int] = {}
        for lang in langs:
            if lang is not None:
                seen[lang] = seen.get(lang, 0) + 1
        self.langs = sorted(sorted(seen, key=lambda x: (-seen[x], x))[:LANGUAGES])
        self._learn(self.words(self.langs, texts, langs))

    @classmethod
    def of_counts(cls, langs: list[str], count: np.ndarray) -> Guess:
        guess = cls([], [])
        guess.langs = langs
        guess._learn(count)
        return guess

    @classmethod
    def words(cls, known: list[str], texts: list[np.ndarray], langs: list[str | None]) -> np.ndarray:
        """Words by language and bucket."""
        count = np.zeros((len(known), 1 << GUESS_BITS))
        for ids, lang in zip(texts, langs, strict=True):
            if lang in known:
                count[known.index(lang)] += np.bincount(cls._bucket(ids[0]), minlength=1 << GUESS_BITS)
        return count

    def _learn(self, count: np.ndarray) -> None:
        count = count + 0.1
        self.logp = np.ascontiguousarray(np.log(count / count.sum(axis=1, keepdims=True)).T.astype(np.float32))

    @staticmethod
    def _bucket(ids: np.ndarray) -> np.ndarray:
        return (ids >> np.uint64(64 - GUESS_BITS)).astype(np.int64)

    def __call__(self, ids: np.ndarray) -> int:
        """Index into ``langs``, -1 for a text without words."""
        if not self.langs or not ids.shape[1]:
            return -1
        total = np.zeros(len(self.langs))
        for s in range(0, ids.shape[1], BLOCK):
            total += self.logp[self._bucket(ids[0, s:s + BLOCK])].sum(axis=0)
        return int(total.argmax())


def best_cut(z: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> float:
    """The cut with the least sum of both kinds' error rates; of equal ones the
    middle of the widest gap. ``n``: how often each pair of ``z`` and ``y`` is there."""
    n = np.ones(len(z)) if n is None else n
    v, at = np.unique(z, return_inverse=True)
    if len(v) < 2 or y.min() == y.max():
        return float(v.mean()) + (0.0 if len(v) > 1 and y.any() else 1.0)
    cuts = (v[1:] + v[:-1]) / 2
    toxic, other = np.bincount(at, n * (y == 1)), np.bincount(at, n * (y == 0))
    error = np.cumsum(toxic)[:-1] / toxic.sum() + 1 - np.cumsum(other)[:-1] / other.sum()
    least = np.flatnonzero(error <= error.min() + 1e-12)
    return float(cuts[least[np.argmax((v[1:] - v[:-1])[least])]])


def calibrate(z: np.ndarray, y: np.ndarray, lang: np.ndarray, n_langs: int, n: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """(cut of each language, then of texts without one; steepness of the score)."""
    n = np.ones(len(z)) if n is None else n
    whole = best_cut(z, y, n)
    cuts = np.full(n_langs + 1, whole)
    for k in range(n_langs):
        mine = lang == k
        toxic = (n * y)[mine].sum()
        if 0 < toxic < n[mine].sum():
            cuts[k] = (toxic * best_cut(z[mine], y[mine], n[mine]) + SHRINK * whole) / (toxic + SHRINK)
    shifted = z - cuts[lang]

    def loss(s):
        p = np.clip(probability(shifted, s), 1e-9, 1 - 1e-9)
        return -np.average(np.where(y == 1, np.log(p), np.log(1 - p)), weights=n)

    return cuts, float(min((0.25, 0.5, 1.0, 2.0, 4.0), key=loss))


def probability(shifted: np.ndarray, steep: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(steep * shifted + np.log(CUT / (1 - CUT)), -30, 30)))


class Classifier:
    """Net, language guess and calibration; or a constant score."""

    def __init__(self, constant: float = 0.0):
        self.net, self.guess, self.cuts, self.steep, self.constant = None, None, np.zeros(1), 1.0, constant

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        if self.net is None:
            return np.full(len(texts), self.constant)
        lang = np.array([self.guess(t) for t in texts], np.int64)
        return probability(self.net.logits(texts) - self.cuts[lang], self.steep)

    def state(self) -> bytes:
        return pickle.dumps((self.net and self.net.state(), self.guess and (self.guess.langs, self.guess.logp), self.cuts, self.steep, self.constant))

    @classmethod
    def of(cls, state: bytes) -> Classifier:
        c = cls()
        net, guess, c.cuts, c.steep, c.constant = pickle.loads(state)
        if net is not None:
            c.net, c.guess = Net.of(net), Guess([], [])
            c.guess.langs, c.guess.logp = guess
        return c


def fit(rows: list[tuple[bytes, int, str | None, bool]], seed: int = SEED) -> Classifier:
    """From rows (text, toxic, lang, whether it calibrates) in memory; ``fitted`` does the same over a table."""
    texts = [word_ids(r[0]) for r in rows]
    y = np.array([r[1] for r in rows], np.int64)
    held = np.array([r[3] for r in rows], bool)
    if len(set(y[held])) < 2:  # too few to set apart: calibrate on the texts trained on
        held[:] = False
    own = np.flatnonzero(~held)
    if len(set(y[own])) < 2:
        return Classifier(float(y.mean()) if len(y) else 0.0)
    c = Classifier()
    c.net = train([texts[i] for i in own], y[own].astype(np.float64), seed)
    c.guess = Guess([texts[i] for i in own], [rows[i][2] for i in own])
    at = np.flatnonzero(held) if held.any() else own
    lang = np.array([c.guess(texts[i]) for i in at], np.int64)
    c.cuts, c.steep = calibrate(c.net.logits([texts[i] for i in at]), y[at], lang, len(c.guess.langs))
    return c


def held_out() -> Column:
    """Rows whose labels are not learned: crc32 of the id as text, modulo 3, is 1 (false for a null id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, seed: int) -> DataFrame:
    """(h, toxic, lang, text) of ``TOXIC`` and ``OTHER`` training texts at most, none above ``SAMPLE_CHARS``,
    for a look or a trial with ``fit``; ``fitted`` doesn't use it."""
    short = F.col("text").isNotNull() & (F.length("text") <= SAMPLE_CHARS)
    ids = docs.filter(short & ~held_out()).select("doc_id")
    label = (labels.filter("doc_id is not null and toxic is not null").filter(~held_out())
             .groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
             .join(ids, "doc_id", "left_semi").withColumn("h", F.xxhash64(F.lit(seed), "doc_id")))
    label = written(label, "labels")
    n = {r[0]: r[1] for r in label.groupBy("toxic").count().collect()}  # two rows
    drawn = None
    for kind, most in ((1, TOXIC), (0, OTHER)):
        rows = label.filter(F.col("toxic") == kind)
        share = 2 * most / max(1, n.get(kind, 0))
        if share < 1:  # leaves about twice the bound to the sort
            rows = rows.filter(F.col("h") / F.lit(2.0**64) + 0.5 <= share)
        rows = rows.orderBy("h", "doc_id").limit(most)
        drawn = rows if drawn is None else drawn.unionByName(rows)
    drawn = written(drawn, "drawn")  # TOXIC + OTHER rows at most
    return (docs.filter(short).select("doc_id", "text", "lang").join(F.broadcast(drawn), "doc_id")
            .groupBy("doc_id", "toxic", "h").agg(F.min_by(F.struct("text", "lang"), F.struct(F.xxhash64("text"), "lang")).alias("row"))
            .select("h", "toxic", "row.lang", "row.text"))


def packs(docs: DataFrame, labels: DataFrame, seed: int) -> tuple[DataFrame, int]:
    """(pack, rows) and their number: all texts with a label that are not held out, as arrays of
    (h, toxic, lang, calibrates, text), written."""
    label = (labels.filter("doc_id is not null and toxic is not null").filter(~held_out())
             .groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic")))
    label = written(label, "labels")
    own = docs.filter(F.col("text").isNotNull() & ~held_out()).select("doc_id", "text", "lang").join(small_or_shuffled(label, label.count()), "doc_id")
    n, chars = own.agg(F.count(F.lit(1)), F.sum(F.length("text").cast("long"))).first()
    many = max(1, math.ceil(n / PACK_TEXTS), math.ceil((chars or 0) / PACK_CHARS))
    h = F.xxhash64(F.lit(seed), "doc_id")
    dealt = own.select("*", h.alias("h"), F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(many)).cast("int").alias("pack"),
                       (F.pmod(F.xxhash64(F.lit(seed + 2), "doc_id"), F.lit(CALIBRATE)) == 0).alias("calibrates"))
    # one shuffle: rows of an id, and ids of a pack, are together already
    one = dealt.repartition(many, "pack").groupBy("pack", "doc_id", "toxic", "h", "calibrates").agg(
        F.min_by(F.struct("text", "lang"), F.struct(F.xxhash64("text"), "lang")).alias("row"))
    rows = F.collect_list(F.struct("h", "toxic", "row.lang", "calibrates", "row.text")).alias("rows")
    return written(one.groupBy("pack").agg(rows), "packs"), many


def _each_pack(of: DataFrame, kernel, schema: str) -> DataFrame:
    """``kernel(pack, rows)`` over every pack, its rows in order of hash and text; it yields tuples of ``schema``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for pack, rows in zip(b.column("pack").to_pylist(), b.column("rows"), strict=True):
                held = sorted(((r["h"], r["text"], r["toxic"], r["lang"], r["calibrates"]) for r in rows.as_py()), key=lambda r: r[:2])
                out = list(zip(*kernel(pack, held), strict=True))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=names)
    names = [x.split()[0] for x in schema.split(", ")]
    return of.mapInArrow(lean(run), schema)


def _texts(rows: list[tuple]) -> tuple[list[np.ndarray], np.ndarray, list]:
    return [word_ids(r[1].encode()) for r in rows], np.array([r[2] for r in rows], np.int64), [r[3] for r in rows]


def _merged(parts: DataFrame, how) -> dict[int, object]:
    """``parts`` (piece, pack, state) by piece, merged by ``how`` in order of pack: a row a piece reaches the driver."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("pack")
        state = pickle.dumps(how(pickle.loads(x) for x in t.column("state").to_pylist()))
        return pa.table([t.column("piece").slice(0, 1), pa.array([state], pa.binary())], names=["piece", "state"])
    found = written(parts.groupBy("piece").applyInArrow(run, "piece long, state binary"), "merged").collect()
    return {r.piece: pickle.loads(bytes(r.state)) for r in found}


_PART = "piece long, pack long, state binary"
_DENSE = TABLES * PIECES  # the piece of filters, biases and output


def _added(states: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sparse rows (numbers, values) added up."""
    total = np.zeros((0, 0))
    used = np.zeros(0, bool)
    for at, values in states:
        top = int(at.max()) + 1 if len(at) else 0
        if top > len(total):
            total = np.concatenate((total.reshape(len(total), values.shape[1]), np.zeros((top - len(total), values.shape[1]))))
            used = np.concatenate((used, np.zeros(top - len(used), bool)))
        if len(at):
            total[at] += values
            used[at] = True
    at = np.flatnonzero(used)
    return at, total[at]


def _pieces(table: int, at: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
    """A table's sparse rows by piece, numbered from the piece's first row; empty ones are left out."""
    size = (1 << TABLE_BITS) // PIECES
    edge = np.searchsorted(at, np.arange(PIECES + 1) * size)
    for p in range(PIECES):
        if edge[p] < edge[p + 1]:
            part = slice(edge[p], edge[p + 1])
            yield table * PIECES + p, ((at[part] - p * size).astype(np.int32), values[part])


def _whole(merged: dict[int, tuple], table: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A table's sparse rows from its pieces."""
    size = (1 << TABLE_BITS) // PIECES
    have = [(p, *merged[table * PIECES + p]) for p in range(PIECES) if table * PIECES + p in merged]
    if not have:
        return np.empty(0, np.int64), np.empty((0, width))
    return np.concatenate([at + p * size for p, at, _ in have]), np.concatenate([v for _, _, v in have])


def _counted(of: DataFrame, langs: list[str], own) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """``seen_rows`` of every table and ``Guess.words``, over all packs."""
    def kernel(pack, rows):
        texts, y, lang = _texts([r for r in rows if own(r)])
        if not texts:
            return
        for k in range(TABLES):
            toxic, every = seen_rows(texts, y, k)
            at = np.flatnonzero(every)
            for piece, part in _pieces(k, at, np.column_stack((toxic, every))[at]):
                yield piece, pack, pickle.dumps(part)
        for i, row in enumerate(Guess.words(langs, texts, lang)):
            at = np.flatnonzero(row)
            yield _DENSE + i, pack, pickle.dumps((at, row[at, None]))

    merged = _merged(_each_pack(of, kernel, _PART), _added)
    counts = []
    for k in range(TABLES):
        at, v = _whole(merged, k, 2)
        full = np.zeros((2, 1 << TABLE_BITS))
        full[:, at] = v.T
        counts.append((full[0], full[1]))
    words = np.zeros((len(langs), 1 << GUESS_BITS))
    for i in range(len(langs)):
        at, v = merged.get(_DENSE + i, (np.empty(0, np.int64), np.empty((0, 1))))
        words[i, at] = v[:, 0]
    return counts, words


_NAMES = [*(("filters", k) for k in range(len(WIDTHS))), *(("biases", k) for k in range(len(WIDTHS))), "out", "bias"]


def _value(net: Net, name):
    return getattr(net, name[0])[name[1]] if isinstance(name, tuple) else getattr(net, name)


def _round(of: DataFrame, net: Net, live: np.ndarray, grads: dict, kinds: tuple[int, int], own, seed: int, number: int, passes: int) -> None:
    """Every pack's ``passes`` over its texts from ``net`` and ``grads``; both take the averaged changes."""
    rows = [np.flatnonzero(x) for x in live]
    first = np.float32(1e-6)
    state = (net.state(), rows, [grads[("table", k)][rows[k]] if ("table", k) in grads else None for k in range(TABLES)],
             {n: g for n, g in grads.items() if n in _NAMES})
    shared = of.sparkSession.sparkContext.broadcast(state)

    def kernel(pack, held):
        texts, y, _ = _texts([r for r in held if own(r)])
        if not texts:
            return
        net_state, at, table_seen, seen = shared.value
        n, on, g = Net.of(net_state), np.zeros((TABLES, 1 << TABLE_BITS), bool), dict(seen)
        for k in range(TABLES):
            on[k, at[k]] = True
            g["table", k] = np.full(n.tables[k].shape, first)
            if table_seen[k] is not None:
                g["table", k][at[k]] = table_seen[k]
        before = [(n.tables[k][at[k]], g["table", k][at[k]]) for k in range(TABLES)]
        dense = [np.array(_value(n, name)) for name in _NAMES]
        rng = np.random.default_rng([seed, number, pack])
        for _ in range(passes):
            epoch(n, texts, y.astype(np.float64), weights(y, *kinds), on, g, rng)
        for k in range(TABLES):
            value, gone = n.tables[k][at[k]], g["table", k][at[k]]
            moved = (gone != before[k][1]).any(axis=1)
            change = np.column_stack((value - before[k][0], gone - before[k][1], np.ones(len(value), np.float32)))[moved]
            for piece, part in _pieces(k, at[k][moved], change):
                yield piece, pack, pickle.dumps(part)
        change = [(np.array(_value(n, name)) - d, g[name] - seen.get(name, first)) for name, d in zip(_NAMES, dense, strict=True)]
        yield _DENSE, pack, pickle.dumps(change)

    def how(states):
        states = iter(states)
        one = next(states)
        if isinstance(one, tuple):
            return _added(s for part in ([one], states) for s in part)
        total, n = [list(map(np.float64, x)) for x in one], 1
        for s in states:
            total, n = [[a + b for a, b in zip(x, y, strict=True)] for x, y in zip(total, s, strict=True)], n + 1
        return [[a / n for a in x] for x in total]

    merged = _merged(_each_pack(of, kernel, _PART), how)
    shared.destroy()  # the next round has a state of its own
    for k in range(TABLES):
        at, v = _whole(merged, k, 2 * ROW + 1)
        seen = grads.setdefault(("table", k), np.full(net.tables[k].shape, first))
        net.tables[k][at] += (v[:, :ROW] / v[:, -1:]).astype(np.float32)
        seen[at] += (v[:, ROW:-1] / v[:, -1:]).astype(np.float32)
    for name, (change, gone) in zip(_NAMES, merged.get(_DENSE, []), strict=False):
        value = (_value(net, name) + change).astype(np.float32)
        if isinstance(name, tuple):
            getattr(net, name[0])[name[1]] = value
        else:
            setattr(net, name, value)
        grads[name] = grads.get(name, first) + np.float32(gone)


def _calibrated(of: DataFrame, c: Classifier, apart) -> tuple[np.ndarray, float]:
    """``calibrate`` over the texts set apart, from their number by language, kind and step of the logit."""
    shared = of.sparkSession.sparkContext.broadcast(c.state())

    def kernel(pack, held):
        texts, y, _ = _texts([r for r in held if apart(r)])
        if not texts:
            return
        m = Classifier.of(shared.value)
        z = np.clip(np.rint(m.net.logits(texts) * STEPS), -FARTHEST * STEPS, FARTHEST * STEPS).astype(np.int64)
        lang = np.array([m.guess(t) for t in texts], np.int64)
        found, n = np.unique(np.column_stack((lang, y, z)), axis=0, return_counts=True)
        yield from ((*map(int, r), int(k)) for r, k in zip(found, n, strict=True))

    found = (_each_pack(of, kernel, "lang long, y long, z long, n long").groupBy("lang", "y", "z").agg(F.sum("n").alias("n"))
             .orderBy("lang", "y", "z").collect())  # bounded by languages and steps
    shared.destroy()
    lang, y, z, n = (np.array([r[i] for r in found], np.int64) for i in range(4))
    return calibrate(z / STEPS, y, lang, len(c.guess.langs), n.astype(np.float64))


def fitted(docs: DataFrame, labels: DataFrame, seed: int = SEED) -> bytes:
    """State of the classifier fitted on all labelled texts of ``docs`` (doc_id, text, lang) and ``labels``
    (doc_id, toxic) that are not held out."""
    text_batches(docs.sparkSession)
    of, many = packs(docs, labels, seed)
    rows = of.select(F.explode("rows").alias("r")).select("r.toxic", "r.calibrates", "r.lang")
    kinds = {(r[0], r[1]): r[2] for r in rows.groupBy("calibrates", "toxic").count().collect()}  # four rows
    number = {(held, y): kinds.get((held, y), 0) for held in (False, True) for y in (0, 1)}
    if not all(number[True, y] for y in (0, 1)):  # too few to set apart: calibrate on the texts trained on
        number = {(held, y): 0 if held else number[False, y] + number[True, y] for held, y in number}
        own, apart = (lambda r: True), (lambda r: True)
        mine = rows
    else:
        own, apart = (lambda r: not r[4]), (lambda r: r[4])
        mine = rows.filter("not calibrates")
    others, toxic = number[False, 0], number[False, 1]
    if not (others and toxic):
        return Classifier(sum(number[h, 1] for h in (False, True)) / max(1, sum(number.values()))).state()
    langs = sorted(r[0] for r in mine.filter("lang is not null").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect())
    counts, words = _counted(of, langs, own)
    c = Classifier()
    c.net, live = started(counts, toxic, others, np.random.default_rng(seed))
    grads: dict = {}
    for i in range(1 if many == 1 else EPOCHS):
        _round(of, c.net, live, grads, (toxic, others), own, seed, i, EPOCHS if many == 1 else 1)
    c.guess = Guess.of_counts(langs, words)
    c.cuts, c.steep = _calibrated(of, c, apart)
    return c.state()


def score(docs: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text)."""
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Classifier.of(shared.value)
        for b in batches:
            out, held, n = [], [], 0
            for x in b.column(2).cast(pa.large_binary() if pa.types.is_large_string(b.column(2).type) else pa.binary()):
                held.append(word_ids(x.as_py()))
                n += held[-1].shape[1]
                if n >= BLOCK:
                    out.append(c.scores(held))
                    held, n = [], 0
            out.append(c.scores(held) if held else np.empty(0))
            s = np.concatenate(out)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s, pa.float64()), pa.array((s >= CUT).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text").mapInArrow(
        lean(run), "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, seed: int = SEED) -> DataFrame:
    """Fit on the labels that are not held out, and score every row."""
    return score(docs, fitted(docs, labels, seed))
