"""Target-distribution importance resampling over hashed n-grams.

Words are runs of digits, A-Z letters (lower-cased) and characters beyond
ASCII; features are all runs of 1 to ``order`` consecutive words, joined by
one space, repeats counted. A feature's bucket is its crc32 modulo ``buckets``.
A bucket's gain is the log ratio of its smoothed shares in target and raw
documents; a document's weight is the sum of its features' gains. Gumbel noise
of a seeded hash turns the highest weights into a draw without replacement.

Head-tail vocabulary. A pass over raw and target texts counts words and pairs
in bounded tables of each task; the frequent ones make the head: each frequent
word's crc32 state and each frequent pair's bucket are broadcast (``HEAD``
words and as many pairs at most, none over ``HEAD_BYTES``). A longer feature's
crc goes on from its first word's state. Features outside the head take a
direct crc32. Both ways give the same bucket, so the head only saves work:
bucket totals, weights and draws are exact whatever it holds. Texts are cut
into words once more for the buckets, which are written as 16- or 32-bit
numbers; totals and weights read those.

Defined results: a null text has no features and weight 0; so has an empty
one. Very long texts are read whole. Documents of fewer than ``least_words``
words are not drawn, nor counted in the drawn share. Equal scores go to the
smaller id, a null id last, then to fewer features; rows equal in all of that
stand in the order they were stored. A null id is hashed as an empty one.
Repeated rows count each. An empty table gives no rows; an empty target gives
gains from smoothing alone. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import global_rank, lean, text_batches, written

BUCKETS, ORDER, SEED, PERCENT, LEAST_WORDS = 10_000, 1, 2024, 10, 20
#: Words (and pairs) in the head, greatest length of one in bytes, and entries a task counts before it drops the rarest.
HEAD, HEAD_BYTES, COUNTED = 20_000, 64, 200_000
#: A task reports its most frequent entries only: they are candidates for the head.
REPORTED = 2 * HEAD

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(raw: bytes | None) -> list[bytes]:
    """Words of UTF-8 text, A-Z lower-cased."""
    return _WORD.findall(raw.lower()) if raw else []


def _texts(column: pa.Array) -> Iterator[bytes | None]:
    """A text at a time as UTF-8."""
    for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield x.as_py()


def _head_counts(order: int):
    def kept(c: Counter, n: int) -> Counter:
        return Counter(dict(c.most_common(n)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [Counter() for _ in range(min(order, 2))]
        for b in batches:
            for raw in _texts(b.column(0)):
                w = words(raw)
                seen[0].update(w)
                if order > 1:
                    seen[1].update(map(b" ".join, zip(w, w[1:], strict=False)))
                for i, c in enumerate(seen):
                    if len(c) > COUNTED:  # bounded: the rarest half goes, which only makes the head less apt
                        seen[i] = kept(c, COUNTED // 2)
        for n, c in enumerate(seen, 1):
            top = [x for x in c.most_common(REPORTED) if x[1] > 1 and len(x[0]) <= HEAD_BYTES]
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(top), pa.int32()), pa.array([x for x, _ in top], pa.binary()),
                                              pa.array([k for _, k in top], pa.int64())], names=["n", "feature", "count"])
    return run


def head(texts: DataFrame, order: int) -> list[set[bytes]]:
    """The frequent words and, beyond order 1, the frequent pairs of ``texts`` (text)."""
    counts = written(texts.mapInArrow(lean(_head_counts(order)), "n int, feature binary, count long")
                     .groupBy("n", "feature").agg(F.sum("count").alias("count")), "head")
    return [{bytes(r[0]) for r in counts.filter(F.col("n") == n).orderBy(F.desc("count"), "feature").limit(HEAD).select("feature").collect()}
            for n in range(1, min(order, 2) + 1)]


class Hasher:
    """Buckets of a text's features by head tables and direct crc32."""

    def __init__(self, vocabulary: list[set[bytes]], order: int, buckets: int):
        self.order, self.buckets = order, buckets
        self.state = {w: crc32(w) for w in vocabulary[0]} if vocabulary else {}
        self.pair = {p: crc32(p) % buckets for p in vocabulary[1]} if len(vocabulary) > 1 else {}

    def __call__(self, w: list[bytes]) -> np.ndarray:
        get = self.state.get
        state = [s if (s := get(x)) is not None else crc32(x) for x in w]
        out = [np.array(state, np.uint32) % self.buckets]
        for n in range(2, self.order + 1):  # states go on from the run that is one word shorter
            if n == 2 and self.pair:
                pair, longer = self.pair.get, []
                known = []
                for s, a, x in zip(state, w, w[1:], strict=False):
                    at = pair(a + b" " + x)
                    if at is None or self.order > 2:
                        s = crc32(b" " + x, s)
                        at = s % self.buckets
                    longer.append(s)
                    known.append(at)
                state = longer
                out.append(np.array(known, np.uint32))
                continue
            state = [crc32(b" " + x, s) for s, x in zip(state, w[n - 1:], strict=False)]
            out.append(np.array(state, np.uint32) % self.buckets)
        return np.concatenate(out) if self.order > 1 else out[0]


FEATURES = "doc_id long, n_words long, n_features long, buckets binary"


def features(docs: DataFrame, vocabulary, order: int, buckets: int) -> DataFrame:
    """(doc_id, n_words, n_features, buckets) per row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(shared.value, order, buckets)
        for b in batches:
            n, got = [], []
            for raw in _texts(b.column(1)):
                w = words(raw)
                n.append(len(w))
                got.append(hasher(w).astype(kind).tobytes())
            size = np.dtype(kind).itemsize
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array([len(g) // size for g in got], pa.int64()),
                                              pa.array(got, pa.binary())], names=["doc_id", "n_words", "n_features", "buckets"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), FEATURES)


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def bucket_totals(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n): exact totals, added up in each task first."""
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for x in b.column(0):
                total += np.bincount(np.frombuffer(x.as_py(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])

    return rows.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int) -> list[int]:
    """The gain of every bucket (as many rows as buckets)."""
    spark = raw.sparkSession
    both = written(bucket_totals(raw, buckets).withColumnRenamed("n", "s").join(
        bucket_totals(target, buckets).withColumnRenamed("n", "t"), "bucket", "full"), "totals")
    s_all, t_all = both.agg(F.coalesce(F.sum("s"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))).first()
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(both, "bucket", "left").fillna(0, ["s", "t"])
    ratio = ((F.col("t") + 1).cast("double") * F.lit(float(s_all + buckets))) / ((F.col("s") + 1).cast("double") * F.lit(float(t_all + buckets)))
    return [r[0] for r in every.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain")).orderBy("bucket").select("gain").collect()]


def weights(rows: DataFrame, gain: list[int], buckets: int) -> DataFrame:
    """``rows`` of ``features`` with ``weight`` in place of the buckets."""
    shared = rows.sparkSession.sparkContext.broadcast(np.array(gain, np.int64))
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        for b in batches:
            w = [int(g[np.frombuffer(x.as_py(), kind)].sum()) for x in b.column(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(w, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    return rows.select("doc_id", "n_words", "n_features", "buckets").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int) -> Column:
    """A document's Gumbel noise in thousandths, from 32 bits of a seeded sha256 of its id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, order: int = ORDER, buckets: int = BUCKETS, percent: int = PERCENT,
             least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) per row of ``docs`` (doc_id,
    text); ``target`` (text) is the distribution to draw like. ``rank`` numbers
    the drawn rows, highest score first, and is null for the others."""
    text_batches(docs.sparkSession)
    vocabulary = head(docs.select("text").unionByName(target.select("text")), order)
    rows = written(features(docs, vocabulary, order, buckets), "features")
    wanted = written(features(target.select(F.lit(0).alias("doc_id"), "text"), vocabulary, order, buckets), "target")
    gain = gains(rows, wanted, buckets)
    # the row number is stored, so that a large group of equal rows can be split
    scored = written(weights(rows, gain, buckets).select(
        "doc_id", "n_words", "n_features", "weight", (F.col("weight") + noise(seed)).alias("score"),
        F.monotonically_increasing_id().alias("_row")), "scored")
    eligible = F.col("n_words") >= least_words
    n = scored.filter(eligible).count()
    ranked = global_rank(scored.withColumn("_out", ~eligible), [F.col("_out"), F.desc("score"), F.asc_nulls_last("doc_id"), F.col("n_features"), F.col("_row")], "drawn")
    drawn = ~F.col("_out") & (F.col("rank") < percent * n // 100)
    return ranked.select("doc_id", "n_features", "weight", "score", F.when(drawn, F.col("rank") + 1).alias("rank"))
