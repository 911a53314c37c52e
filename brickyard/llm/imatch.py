"""I-Match document fingerprints over randomised lexicon subsets.

The lexicon keeps the terms whose share of documents lies in a band of
inverse document frequency. A band with a lower share ``low`` bounds it: no
more than (mean distinct terms of a document) / low terms can be in it,
whatever the number of documents, so it may be broadcast.

Each of ``subsets`` seeds nests random subsets of the lexicon, every one half
the size of the one before. A document's hash under a seed covers its sorted
distinct terms in the smallest subset that it still meets. (Plain I-Match
fixes the subset's size, and then a changed third of a text changes every
hash; nesting keeps about as many hashes as terms are shared.) The
fingerprint writes the hashes side by side; the likeness of two fingerprints
is the share of equal hashes.

A text without a term in the band falls back to its terms above the band
(common ones), then to all its terms. Null text counts as empty; texts
without any term share a fingerprint of zeros (likeness 1 among themselves).
Equal texts, repeated rows included, have equal fingerprints. Very long texts
are read whole. Other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, parts, text_batches

#: Band of a term's share of all documents (idf from ln 10 to ln 1000).
LOW, HIGH = 1e-3, 1e-1
SUBSETS = 32
#: Candidate terms a worker holds at most; beyond, all terms are counted by a shuffle.
CANDIDATES = 500_000
#: Distinct terms a task counts before it sends partial counts on.
FLUSH_TERMS = 400_000
#: Shares below this many documents are noise: a lexicon term has this many at least.
LEAST_DOCS = 2

_term = re.compile(r"[^\W_]+").findall


def terms(text: str | None) -> set[str]:
    return set(_term(text.lower())) if text else set()


def _count_terms(low: float, only: frozenset | None):
    """Rows (term, documents). Without ``only``, a chunk sends just the terms
    with a share of ``low`` in it: a term with that share of all documents has
    it in one chunk at least."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        docs = 0

        def flush():
            least = 1 if only is not None else math.floor(low * docs)
            rows = [(t, c) for t, c in counts.items() if c >= least]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())],
                                              names=["term", "docs"])

        for b in batches:
            for t in b.column(0):
                found = terms(t.as_py())
                counts.update(found if only is None else found & only)
                docs += 1
                if len(counts) > FLUSH_TERMS:
                    yield flush()
                    counts.clear()
                    docs = 0
        yield flush()
    return run


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> dict[str, dict[str, int]]:
    """64-bit hashes of the terms within the ``band`` and ``above`` it.

    Exact counts over all documents, in two passes: terms that are frequent in
    some chunk, then the counts of those terms. If these candidates were too
    many to broadcast, every term is counted by a shuffle instead."""
    text_batches(docs.sparkSession)
    text = docs.select("text")
    n = docs.count()
    schema = "term string, docs long"
    candidates = text.mapInArrow(_count_terms(low, None), schema).select("term").distinct()
    found = [r[0] for r in candidates.limit(CANDIDATES + 1).collect()]
    if len(found) <= CANDIDATES:
        shared = docs.sparkSession.sparkContext.broadcast(frozenset(found))
        counted = text.mapInArrow(_count_terms_of(low, shared), schema)
    else:
        counted = text.mapInArrow(_count_terms(0.0, None), schema)
    least = max(LEAST_DOCS, low * n)
    rows = counted.groupBy("term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= least).collect()
    return {"band": {t: _hash(t) for t, c in rows if c <= high * n}, "above": {t: _hash(t) for t, c in rows if c > high * n}}


def _count_terms_of(low: float, shared):
    def run(batches):
        yield from _count_terms(low, shared.value)(batches)
    return run


def _hash(term: str) -> int:
    return int.from_bytes(hashlib.blake2b(term.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def fingerprints(texts: list[str | None], lex: dict[str, dict[str, int]], subsets: int = SUBSETS) -> np.ndarray:
    """(texts, subsets) of 32-bit hashes."""
    flat: list[int] = []
    sizes: list[int] = []
    band, above = lex["band"], lex["above"]
    for t in texts:
        found = terms(t)
        own = [band[x] for x in found & band.keys()] or [above[x] for x in found & above.keys()] or [_hash(x) for x in found]
        flat += own
        sizes.append(len(own))
    out = np.zeros((len(texts), subsets), dtype=np.uint32)
    size = np.array(sizes)
    full = np.flatnonzero(size)
    if not len(full):
        return out
    first = np.concatenate(([0], np.cumsum(size[full])))[:-1]
    h = np.array(flat, dtype=np.uint64)
    row = np.repeat(np.arange(len(full)), size[full])
    for k in range(subsets):
        x = mix64(h + np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (2**64 - 1)))
        # nested subsets hold the terms below 2^53, 2^52, ...: the smallest one that the least term is in
        x >>= np.uint64(11)
        bits = np.frexp(np.minimum.reduceat(x, first).astype(np.float64))[1].astype(np.uint64)
        inside = np.where(x < (np.uint64(1) << bits)[row], x * np.uint64(0xD6E8FEB86659FD93), np.uint64(0))
        out[full, k] = (mix64(np.add.reduceat(inside, first)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    return out


def as_text(prints: np.ndarray) -> list[str]:
    return [r.astype(">u4").tobytes().hex() for r in prints]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def fingerprint(docs: DataFrame, subsets: int = SUBSETS, low: float = LOW, high: float = HIGH) -> DataFrame:
    """(doc_id, fingerprint) per row of ``docs`` (doc_id, text)."""
    lex = docs.sparkSession.sparkContext.broadcast(lexicon(docs, low, high))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = fingerprints(b.column(1).to_pylist(), lex.value, subsets)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(as_text(p), pa.string())], names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, last) dealt into ranges of descending doc_id (null
    last) and sorted (repeated ids by text); each range ends with a copy of
    the row that follows it (last = true), the final one with the first row."""
    spark = docs.sparkSession
    n = parts(spark)
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    rows = docs.select("doc_id", "text")
    ids = rows.select(key.alias("k"))
    bounds = ids.select(F.percentile_approx("k", [i / n for i in range(1, n)] or [0.5], 100 * n)).first()[0]
    bounds = sorted(set(bounds or ()), reverse=True)
    # range p: ids below bounds[p - 1], from bounds[p]
    place = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b > F.col("k"))) if bounds else F.lit(0)
    heads = sorted((r[0], r[1]) for r in ids.groupBy(place.alias("p")).agg(F.max("k")).collect())  # one row a range
    placed = rows.select("doc_id", "text", key.alias("k")).withColumn("p", place)
    if not heads:
        return placed.select("doc_id", "text", F.lit(False).alias("last"))
    follow = spark.createDataFrame([(k, heads[i - 1][0]) for i, (_, k) in enumerate(heads)], "k long, before int")
    sent = placed.join(F.broadcast(follow), "k", "left").select(
        "doc_id", "text", "k", F.explode(F.when(F.col("before").isNull(), F.array(F.struct("p", F.lit(False).alias("last"))))
                                         .otherwise(F.array(F.struct("p", F.lit(False).alias("last")),
                                                            F.struct(F.col("before").alias("p"), F.lit(True).alias("last"))))).alias("s"))
    return (sent.select("doc_id", "text", "k", "s.p", "s.last").repartitionById(n, "p")
            .sortWithinPartitions("p", "last", F.col("k").desc(), "text").select("doc_id", "text", "last"))


EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def edited_fingerprints(docs: DataFrame, subsets: int = SUBSETS, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Fingerprints of every text and of its edited text: the last third
    replaced by as much of the start of the next document."""
    lex = docs.sparkSession.sparkContext.broadcast(lexicon(docs, low, high))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row that waits for its next one

        def done(rows):
            own = [r[1] for r in rows]
            third = [len(t) // 3 for t in own]
            edited = [t[:len(t) - m] + r[2][:m] for t, m, r in zip(own, third, rows, strict=True)]
            a = fingerprints(own, lex.value, subsets)
            e = fingerprints(edited, lex.value, subsets)
            # rows follow each other, but for the last of a range
            after = np.concatenate((a[1:], a[:1]))
            odd = [i for i, r in enumerate(rows) if r[2] is not (own[i + 1] if i + 1 < len(own) else None)]
            if odd:
                after[odd] = fingerprints([rows[i][2] for i in odd], lex.value, subsets)
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([len(t) for t in own], pa.int64()),
                 pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited], pa.string()),
                 pa.array(as_text(a), pa.string()), pa.array(as_text(e), pa.string()),
                 pa.array(likeness(a, e)), pa.array(likeness(a, after))], names=[x.split()[0] for x in EDITED.split(", ")])

        for b in batches:
            rows = []
            for doc_id, text, last in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                text = text or ""
                if held is not None:
                    rows.append((*held, text))
                held = None if last else (doc_id, text)
                if len(rows) == 1000:
                    yield done(rows)
                    rows = []
            if rows:
                yield done(rows)

    return with_next(docs).mapInArrow(run, EDITED)
