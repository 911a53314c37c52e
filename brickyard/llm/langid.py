"""Language identification by interpolated Kneser-Ney character models.

One n-gram model per language, fitted on a bounded sample of labelled rows.
All models share sorted arrays of 64-bit n-gram hashes, one per order, with
the interpolated log probability of every language beside each hash, and
sorted arrays of context hashes with the back-off weights. A text's language
is the one of least cross-entropy per character over the whole text. Texts
whose cross-entropy is beyond what the language's own held-back texts show at
that length are marked as rejected.

Text is read as lower-case letters with everything else as single spaces.
Null text and text without a letter give ``und`` with score 0, rejected.
Rows without a label don't train; with no labelled row at all every text is
``und``. Repeated rows predict alike; repeats inside the sample count once.
The label, source and id of a row are never inputs of its prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, lean, mix64, small_or_shuffled, text_batches, written

ORDER = 4
#: The training sample: whole texts of so many characters of each language, or
#: at least so many texts, cut where they don't fit whole (see ``fit``) ...
SAMPLE_CHARS, LEAST_TEXTS = 2_000_000, 20
#: ... of which this share calibrates the score and the rejection.
CALIBRATE = 0.25
#: Rejection never starts below this many scale units over the mean (1 nat a
#: character for a long text): noisy but legible text stays.
LEAST_REACH = 4.0
UND = "und"
PAD, SPACE = 1, 32
#: Codes scored at once; bounds a worker's memory for texts of any length.
SLICE = 150_000
_MULT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                               0xE7037ED1A0B428DB)]


def letter_table() -> np.ndarray:
    """Code point -> its lower-case letter, or a space for what isn't a letter."""
    out = np.full(0x110000, SPACE, dtype=np.uint32)
    for i in range(0x110000):
        if (c := chr(i)).isalpha():
            out[i] = ord(c.lower()[0])
    return out


def codes_of(text: str, table: np.ndarray, order: int) -> np.ndarray:
    """Letters and single spaces, after ``order - 1`` padding codes."""
    c = table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    gap = c == SPACE
    c = c[~(gap & np.concatenate(([True], gap[:-1])))]
    return np.concatenate((np.full(order - 1, PAD, dtype=np.uint32), c))


def gram_hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """Hash of the n-gram that ends at each place, for n from 0 to ``order``;
    places before the first full n-gram hold no meaning."""
    c = codes.astype(np.uint64)
    acc = np.zeros(len(c), dtype=np.uint64)
    out = [mix64(acc + np.uint64(1))]
    for n in range(1, order + 1):
        acc = acc.copy()
        acc[n - 1:] += c[:len(c) - n + 1] * _MULT[n - 1]
        out.append(mix64(acc + np.uint64(n + 1)))
    return out


class HashTable:
    """A sorted array of hashes with a directory over its leading bits."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(1, int(len(keys)).bit_length() + 1)
        self.keys = np.append(keys, np.uint64(2**64 - 1))
        self.start = np.searchsorted(keys, np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)).astype(np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash, -1 where absent."""
        at = self.start[h >> np.uint64(64 - self.bits)]
        left = np.flatnonzero(self.keys[at] < h)
        while len(left):
            at[left] += 1
            left = left[self.keys[at[left]] < h[left]]
        at[self.keys[at] != h] = -1
        at[at == len(self.keys) - 1] = -1
        return at


@dataclass
class Model:
    langs: list[str]
    order: int
    table: np.ndarray
    grams: list[HashTable] = field(default_factory=list)      # by order 1..N
    logp: list[np.ndarray] = field(default_factory=list)      # (grams, languages)
    contexts: list[HashTable] = field(default_factory=list)   # contexts of order 1..N
    backoff: list[np.ndarray] = field(default_factory=list)
    floor: float = 0.0
    temperature: float = 1.0
    typical: np.ndarray | None = None                         # (languages, 3): mean, spread, spread of a character

    def state(self) -> dict:
        """Plain arrays, for a broadcast (workers need not have this package)."""
        return {**self.__dict__, "grams": [g.__dict__ for g in self.grams], "contexts": [c.__dict__ for c in self.contexts]}

    @staticmethod
    def of(state: dict) -> Model:
        m = Model(**state)
        for name in ("grams", "contexts"):
            tables = []
            for d in state[name]:
                t = HashTable.__new__(HashTable)
                t.__dict__.update(d)
                tables.append(t)
            setattr(m, name, tables)
        return m

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy per character by language, scored characters) of each text."""
        parts = [codes_of(t, self.table, self.order) for t in texts]
        ends = np.cumsum([len(p) for p in parts])
        codes = np.concatenate(parts)
        doc = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
        total = np.zeros((len(texts), len(self.langs)))
        lap = self.order - 1
        for lo in range(0, len(codes), SLICE):
            cut = codes[max(0, lo - lap):lo + SLICE]
            skip = lo - max(0, lo - lap)
            own, at = cut[skip:], doc[lo:lo + SLICE]
            scored = np.flatnonzero(own != PAD)
            if not len(scored):
                continue
            h = [x[skip:][scored] for x in gram_hashes(cut, self.order)]
            prior = [np.concatenate(([np.uint64(0)], x))[skip:-1][scored] if skip == 0 else x[skip - 1:-1][scored]
                     for x in gram_hashes(cut, self.order)]
            lp = self._logp(h, prior)
            d = at[scored]
            first = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
            total[d[first]] += np.add.reduceat(lp, first, axis=0)
        n = np.diff(np.concatenate(([0], ends))) - lap
        return -total / np.maximum(n, 1)[:, None], n

    def _logp(self, h: list[np.ndarray], prior: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(h[0]), len(self.langs)), dtype=np.float32)
        left = np.arange(len(h[0]))
        for n in range(self.order, 0, -1):
            i = self.grams[n - 1].find(h[n][left])
            hit = i >= 0
            out[left[hit]] += self.logp[n - 1][i[hit]]
            left = left[~hit]
            if not len(left):
                return out
            i = self.contexts[n - 1].find(prior[n - 1][left])
            seen = i >= 0
            out[left[seen]] += self.backoff[n - 1][i[seen]]
        out[left] += np.float32(self.floor)
        return out

    def predict(self, texts: list[str]) -> list[tuple[str, float, float, bool]]:
        """(language, score, cross-entropy, rejected) of each text."""
        if not texts or not self.langs:
            return [(UND, 0.0, 0.0, True)] * len(texts)
        ce, n = self.entropies(texts)
        letters = np.array([any(map(str.isalpha, t)) for t in texts])
        best = ce.argmin(axis=1)
        low = ce[np.arange(len(texts)), best]
        z = -(ce - low[:, None]) * (self.temperature * np.sqrt(np.maximum(n, 1)))[:, None]
        score = 1 / np.exp(z).sum(axis=1)
        m, spread, char = (self.typical[best, i] for i in range(3))
        out = low > m + spread + char / np.sqrt(np.maximum(n, 1))
        return [(self.langs[b], float(s), float(c), bool(r)) if ok else (UND, 0.0, 0.0, True)
                for b, s, c, r, ok in zip(best, score, low, out, letters, strict=True)]


def groups(texts: pa.Array, chars: int = 2 * SLICE) -> Iterator[list[str]]:
    """Runs of texts (null: empty) of about so many characters, so that few are held as Python strings."""
    run, held = [], 0
    for t in texts:
        run.append(t.as_py() or "")
        held += len(run[-1])
        if held >= chars:
            yield run
            run, held = [], 0
    if run:
        yield run


def _judged(model: Model, texts: pa.Array) -> Iterator[tuple[str, float, float, bool]]:
    for run in groups(texts):
        yield from model.predict(run)


def _count_grams(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = letter_table()
        for b in batches:
            langs = b.column(0).to_pylist()
            for lang in sorted(set(langs)):
                for run_of in groups(b.column(1).filter(pa.array([x == lang for x in langs]))):
                    codes = np.concatenate([codes_of(t, table, order) for t in run_of])
                    h, scored = gram_hashes(codes, order), np.flatnonzero(codes != PAD)
                    for n in range(1, order + 1):
                        g, first, count = np.unique(h[n][scored], return_index=True, return_counts=True)
                        at = scored[first]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(g), pa.string()), pa.array(np.full(len(g), n, np.int32)), pa.array(g.view(np.int64)),
                             pa.array(h[n - 1][at - 1].view(np.int64) if n > 1 else np.zeros(len(g), np.int64)),
                             pa.array(h[n - 1][at].view(np.int64) if n > 1 else np.zeros(len(g), np.int64)), pa.array(count)],
                            names=["lang", "n", "gram", "ctx", "suffix", "count"])
    return run


def kneser_ney(langs: list[str], order: int, types: dict[tuple[str, int], tuple[np.ndarray, ...]], table: np.ndarray) -> Model:
    """Model from the n-gram types (gram, context, suffix, count) of each (language, order)."""
    model = Model(langs, order, table)
    chars = max([len(set().union(*(types[lang, 1][0].tolist() for lang in langs)))], default=1)
    model.floor = -float(np.log(chars + 1))
    below = None  # (sorted grams, P) of the order below
    for n in range(1, order + 1):
        union = np.unique(np.concatenate([types[lang, n][0] for lang in langs]))
        ctxs = np.unique(np.concatenate([types[lang, n][1] for lang in langs]))
        p = np.zeros((len(union), len(langs)))
        back = np.ones((len(ctxs), len(langs)))
        ctx_of = np.zeros(len(union), dtype=np.uint64)
        suffix_of = np.zeros(len(union), dtype=np.uint64)
        for k, lang in enumerate(langs):
            g, ctx, suffix, count = types[lang, n]
            if n < order:  # how many different n-grams of the order above end in this one
                up = types[lang, n + 1][2]
                s, c = np.unique(up, return_counts=True)
                count = np.zeros(len(g))
                count[np.searchsorted(g, s)] = c
            at, cat = np.searchsorted(union, g), np.searchsorted(ctxs, ctx)
            ctx_of[at], suffix_of[at] = ctx, suffix
            total = np.bincount(cat, count, len(ctxs))
            kinds = np.bincount(cat, count > 0, len(ctxs))
            ones, twos = (count == 1).sum(), (count == 2).sum()
            d = ones / (ones + 2 * twos) if ones and twos else 0.5
            p[at, k] = np.maximum(count - d, 0) / np.maximum(total[cat], 1)
            back[:, k] = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
        lower = below[1][np.searchsorted(below[0], suffix_of)] if below else 1 / (chars + 1)
        p += back[np.searchsorted(ctxs, ctx_of)] * lower
        model.grams.append(HashTable(union))
        model.logp.append(np.log(np.maximum(p, 1e-12)).astype(np.float32))
        model.contexts.append(HashTable(ctxs))
        model.backoff.append(np.log(np.maximum(back, 1e-12)).astype(np.float32))
        below = union, p
    return model


def _draw(rows: DataFrame, sample_chars: int) -> DataFrame:
    """(lang, h, take, place) of the texts drawn from ``rows`` (lang, text, h:
    the text's seeded hash), by the order that ``fit`` states."""
    piece = max(1, sample_chars // LEAST_TEXTS)
    texts = written(rows.groupBy("lang", "h").agg(F.max(F.length("text")).cast("long").alias("n")), "texts")
    short = texts.filter(F.col("n") <= piece)
    sizes = {r[0]: r[1] for r in short.groupBy("lang").agg(F.sum("n")).collect()}  # one row a language
    # a prefix of the hash order that holds the bound, so that no window sees a whole language
    shares = {lang: min(1.0, 4 * sample_chars / n) for lang, n in sizes.items()}
    while True:
        share = F.create_map(*[x for lang, s in shares.items() for x in (F.lit(lang), F.lit(s))])[F.col("lang")] if shares else F.lit(1.0)
        first = short.filter(F.col("h") / F.lit(2.0**64) + 0.5 <= share)
        got = {r[0]: r[1] for r in first.groupBy("lang").agg(F.sum("n")).collect()}
        poor = [lang for lang, s in shares.items() if s < 1 and got.get(lang, 0) < sample_chars]
        if not poor:
            break
        shares.update({lang: min(1.0, 2 * shares[lang]) for lang in poor})
    # more long texts than these have no room
    by_length = F.row_number().over(Window.partitionBy("lang").orderBy("n", "h"))
    long = texts.filter(F.col("n") > piece).withColumn("i", by_length).filter(F.col("i") <= LEAST_TEXTS).drop("i")
    order = Window.partitionBy("lang").orderBy(F.greatest("n", F.lit(piece)), "h")
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = F.col("upto") <= sample_chars
    return (first.unionByName(long).withColumns({"upto": upto, "place": F.row_number().over(order)})
            .filter(whole | (F.col("place") <= LEAST_TEXTS))
            .select("lang", "h", F.when(whole, F.col("n")).otherwise(F.least("n", F.lit(piece))).cast("int").alias("take"), "place"))


def sample(labelled: DataFrame, sample_chars: int, seed: int) -> DataFrame:
    """(lang, text, part) of the texts that ``fit`` draws; part, of 1000, deals
    them to calibration. ``text`` is a prefix for the long texts that fill up a
    language of few texts (see ``fit``); predictions always read whole texts."""
    rows = (labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
            .select("lang", "text", F.xxhash64(F.lit(seed), "text").alias("h")))
    drawn = written(_draw(rows, sample_chars), "drawn")
    part = F.when(F.col("place") == 1, 999).otherwise(F.pmod(F.xxhash64(F.lit(seed + 1), "text"), F.lit(1000)))
    return (rows.join(small_or_shuffled(drawn, drawn.count()), ["lang", "h"])
            .select("lang", F.substr("text", F.lit(1), F.col("take")).alias("text"), part.alias("part")).dropDuplicates(["lang", "text"]))


def fit(labelled: DataFrame, order: int = ORDER, sample_chars: int = SAMPLE_CHARS, seed: int = 42) -> Model:
    """Fit on (text, lang): a seeded sample of each language's different texts
    that hold a letter, whatever the table's size.

    Texts are drawn whole, in the order of a seeded hash, until the next one
    passes ``sample_chars``; those longer than a ``LEAST_TEXTS``-th of it come
    after the others, by length. A language of which fewer than ``LEAST_TEXTS``
    fit is filled up to that number with the first ``sample_chars / LEAST_TEXTS``
    characters of the next ones, so a sample never has more than twice
    ``sample_chars``. A language's first text is always trained on."""
    spark = labelled.sparkSession
    text_batches(spark)
    table = letter_table()
    pick = sample(labelled, sample_chars, seed).persist()
    counted = (pick.filter(F.col("part") >= int(1000 * CALIBRATE)).select("lang", "text")
               .mapInArrow(lean(_count_grams(order)), "lang string, n int, gram long, ctx long, suffix long, count long")
               .groupBy("lang", "n", "gram").agg(F.first("ctx").alias("ctx"), F.first("suffix").alias("suffix"), F.sum("count").alias("count")))
    got = counted.toArrow().combine_chunks()  # bounded by the sample
    names = got.column("lang").combine_chunks().dictionary_encode() if got.num_rows else None
    langs = sorted(names.dictionary.to_pylist()) if names is not None else []
    types = {}
    for lang in langs:
        mine = names.indices.to_numpy() == names.dictionary.to_pylist().index(lang)
        for n in range(1, order + 1):
            at = np.flatnonzero(mine & (got.column("n").to_numpy() == n))
            g, ctx, suffix, count = (got.column(c).to_numpy()[at] for c in ("gram", "ctx", "suffix", "count"))
            o = np.argsort(g.view(np.uint64))
            types[lang, n] = (g.view(np.uint64)[o], ctx.view(np.uint64)[o], suffix.view(np.uint64)[o], count[o].astype(float))
    if not langs:
        return Model([], order, table)
    model = kneser_ney(langs, order, types, table)
    held = pick.filter(F.col("part") < int(1000 * CALIBRATE)).select("lang", "text")
    shared = spark.sparkContext.broadcast(model.state())

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.of(shared.value)
        for b in batches:
            at = 0
            for texts in groups(b.column(1)):
                ce, n = own.entropies(texts)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), pa.array(ce.tolist(), pa.list_(pa.float64())), pa.array(n)],
                                                 names=["lang", "ce", "n"])
                at += len(texts)

    calibrate(model, held.mapInArrow(measure, "lang string, ce array<double>, n long").filter("n > 0").toPandas())
    pick.unpersist()
    shared.destroy()
    return model


def calibrate(model: Model, held) -> None:
    """Temperature of the score (least log loss) and, per language, how far
    above the mean a text's cross-entropy goes at a given length."""
    model.typical = np.array([[0.0, 1e9, 0.0]] * len(model.langs))
    held = held[held["lang"].isin(model.langs)]
    if not len(held):
        return
    ce = np.array(held["ce"].tolist())
    own = np.array([model.langs.index(x) for x in held["lang"]])
    n = held["n"].to_numpy(float)

    def loss(t):
        z = -(ce - ce.min(axis=1, keepdims=True)) * (t * np.sqrt(n))[:, None]
        return -(z[np.arange(len(z)), own] - np.log(np.exp(z).sum(axis=1))).mean()

    model.temperature = float(min((0.05, 0.1, 0.2, 0.5, 1, 2, 5, 10), key=loss))
    right = ce.argmin(axis=1) == own
    for k in range(len(model.langs)):
        if not (mine := right & (own == k)).any():
            continue
        c, m = ce[mine, k], n[mine]
        mean = np.average(c, weights=np.minimum(m, 1000))
        scale = 0.25 + 4 / np.sqrt(m)  # deviation that length leaves room for
        reach = max(1.5 * np.quantile((c - mean) / scale, 0.999), LEAST_REACH)
        model.typical[k] = mean, 0.25 * reach, 4 * reach


def predict(docs: DataFrame, model: Model, keep: list[str | Column]) -> DataFrame:
    """``keep`` columns of ``docs`` with lang_pred, score, cross_entropy and rejected, from ``text`` alone."""
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model.state())

    def kernel(batches):
        own = Model.of(shared.value)
        for texts in batches:
            rows = list(_judged(own, texts))
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.StructArray.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(4)],
                                             names=["lang_pred", "score", "cross_entropy", "rejected"])

    @F.arrow_udf("lang_pred string, score double, cross_entropy double, rejected boolean")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return lean(kernel)(batches)

    p = fresh(docs, "prediction")
    return docs.select(*keep, judge("text").alias(p)).select("*", f"{p}.*").drop(p)


def held_out() -> Column:
    """Rows kept from training: crc32 of the id as text, modulo 4, is 2 (false for a null id)."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame, keep: list[str], order: int = ORDER, sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """Fit on the rows that aren't held out and predict every row."""
    model = fit(docs.filter(~held_out()).select("doc_id", "text", "lang"), order, sample_chars)
    return predict(docs, model, [*keep])


def reject(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model doesn't reject, with their columns."""
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model.state())

    def kernel(batches):
        own = Model.of(shared.value)
        for texts in batches:
            yield pa.array([not r[3] for r in _judged(own, texts)], pa.bool_())

    @F.arrow_udf("boolean")
    def legible(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return lean(kernel)(batches)

    return docs.filter(legible("text"))
