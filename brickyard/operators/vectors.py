"""Vector retrieval by cosine: exact on a grid, and by inverted lists for
large query sets.

``vector_topk`` is exact. Queries fall into blocks of counted size, corpus rows
into shards, and every (length, block, shard) cell is one co-group found by an
equi-join. A cell scores its rows with numpy in single precision, scores those
again in double precision that may be among a query's best so far (the margin
bounds the single precision's error, so results are exact), and sends ``k`` rows
per query on, once; a ``row_number() <= k`` window
(partial WindowGroupLimit before its shuffle) merges the cells. Queries and
corpus never pass through the driver, no pair rows are shuffled, no cross join
is planned. Its work is queries x rows.

``vector_topk_lists`` scores fewer pairs: vectors fall into lists around
centroids of a bounded sample, a query meets the lists nearest to it only, as
many as a sample needs for the recall asked for, and every score is exact. Lists
of neighbouring centroids share a bin of counted size; a query is sent to a bin
once, however many of the bin's lists it meets.

Vectors meet those of their own length; null and empty vectors, zero vectors
and those with a null or non-finite component take no part. Ids may be of any
orderable type; a null id is an id of its own. Repeated ids are rows of their
own, and ``exclude_self`` leaves all rows of a query's id out. Scores are
rounded to 6 places; ties go to the smaller id, a null id first.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brickyard.operators.text_index import ROUND, best_k
from brickyard.session import staged

# Kernels run in Python workers; they are pickled by value, so that executors
# need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_CELLS = 4_000_000     # scores held at once per task (rows x queries)
PAIRS, ROWS = 200_000, 32_768  # pairs scored again at once, corpus rows as a matrix at once
SLICE_BYTES = 16 << 20    # vectors that leave a task at once, copied to the lists or bins that they meet
SHARD_BYTES = 64 << 20    # float64 vectors of one cell's corpus side
BLOCK_BYTES = 64 << 20    # and of its query side
# inverted lists: the sample, the lists, and how recall is measured on the sample
SAMPLE_BYTES, SAMPLE_ROWS, MAX_LISTS, ROUNDS, MEASURED = 32 << 20, 40_000, 4_096, 8, 512


def _usable(df: DataFrame, id_col: str, vec_col: str, name: str) -> DataFrame:
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.select(F.col(id_col).alias(name), v.alias("v")).where("size(v) > 0").where(finite)


def _unit_rows(column: pa.ChunkedArray) -> np.ndarray:
    """List values of one length as a matrix of unit rows (nan for a zero vector)."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    m = flat.reshape(len(column), -1)
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    norms[norms == 0] = np.nan  # cosine undefined for a zero vector
    return m / norms


class _Top:
    """The best ``k`` rows per query so far, under (rounded score desc, place
    asc), places in order of id."""

    def __init__(self, q: np.ndarray, own: np.ndarray, k: int):
        self.q, self.q32, self.own, self.k = q, q.T.astype(np.float32), own, k
        self.score = np.full((len(q), k), -np.inf)
        self.place = np.full((len(q), k), -1, np.int64)
        self.margin = (q.shape[1] + 4) * 2.0 ** -23  # twice what single precision can be off for unit vectors

    def offer(self, m: np.ndarray, codes: np.ndarray, places: np.ndarray, some: np.ndarray | None = None) -> None:
        """Unit rows ``m``, their ids' codes and places, to the queries ``some`` (ascending; all, if None)."""
        who = np.arange(len(self.q)) if some is None else some
        q32 = self.q32 if some is None else self.q32[:, some]
        lo, step = 0, max(1, min(max(4 * self.k, 64), MAX_CELLS // len(who)))
        while lo < len(m):
            part, kth = m[lo:lo + step], self.score[who, -1]
            near = part.astype(np.float32) @ q32 >= (kth - self.margin).astype(np.float32)
            if np.count_nonzero(near) * 16 > near.size:  # many may come in: all again at once
                s = np.round(part @ self.q[who].T, ROUND).T
                i, r = np.nonzero(s >= kth[:, None])
                s = s[i, r]
            else:
                r, i = np.nonzero(near)
                s = np.empty(len(i))
                for x in range(0, len(i), PAIRS):
                    z = slice(x, x + PAIRS)
                    s[z] = np.einsum("nd,nd->n", part[r[z]], self.q[who[i[z]]])
                s = np.round(s, ROUND)
            # of equal scores the one at the smaller place stays
            new = places[lo + r]
            good = (s > kth[i]) | ((s == kth[i]) & (new < self.place[who[i], -1]))
            good &= (codes[lo + r] < 0) | (codes[lo + r] != self.own[who[i]])
            self._merge(who[i[good]], new[good], s[good])
            lo, step = lo + step, max(1, MAX_CELLS // len(who))

    def _merge(self, i: np.ndarray, place: np.ndarray, s: np.ndarray) -> None:
        if not len(i):
            return
        who = np.unique(i)
        i = np.concatenate((np.repeat(who, self.k), i))
        place, s = np.concatenate((self.place[who].ravel(), place)), np.concatenate((self.score[who].ravel(), s))
        order = np.lexsort((place, -s, i))
        start = np.searchsorted(i[order], who)
        best = order[start[:, None] + np.arange(self.k)]
        self.place[who], self.score[who] = place[best], s[best]


def _scorer(k: int, exclude_self: bool):
    """Co-group kernel: the best ``k`` corpus rows (did, v) of a cell for each of its
    queries (qid, v). With ``list`` and ``lists`` columns a row meets the queries that name its list only."""
    def score(docs: pa.Table, block: pa.Table) -> pa.Table:
        arrow = pa.schema([("query_id", block.schema.field("qid").type), ("doc_id", docs.schema.field("did").type), ("score", pa.float64())])
        if not (docs.num_rows and block.num_rows):
            return arrow.empty_table()
        codes: dict = {}
        own = np.array([codes.setdefault(x, len(codes)) for x in block.column("qid").to_pylist()])
        docs = docs.take(pc.sort_indices(docs.column("did"), null_placement="at_start"))
        code = np.array([codes.get(x, -1) for x in docs.column("did").to_pylist()]) if exclude_self else np.full(docs.num_rows, -1)
        top = _Top(_unit_rows(block.column("v")), own, k)
        if "list" in docs.column_names:
            held = docs.column("list").to_numpy()
            lists = block.column("lists").combine_chunks()
            asked, who = lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            by, rows = np.argsort(asked, kind="stable"), np.argsort(held, kind="stable")
            edges = [(np.searchsorted(asked, x, side, sorter=by), np.searchsorted(held, x, side, sorter=rows)) for x in np.unique(held) for side in ("left", "right")]
            meet = [(who[by[a:b]], rows[c:d]) for (a, c), (b, d) in zip(edges[::2], edges[1::2], strict=True)]
        else:
            meet = [(None, np.arange(docs.num_rows))]
        for some, at in meet:
            if some is None or len(some):
                for lo in range(0, len(at), ROWS):
                    rows = at[lo:lo + ROWS]
                    top.offer(_unit_rows(docs.column("v").take(pa.array(rows))), code[rows], rows, some)
        i, j = np.nonzero(top.place >= 0)
        return pa.table([block.column("qid").take(pa.array(i)), docs.column("did").take(pa.array(top.place[i, j])), pa.array(top.score[i, j])], schema=arrow)
    return score


def _schema(q: DataFrame, c: DataFrame) -> T.StructType:
    return T.StructType([T.StructField("query_id", q.schema["qid"].dataType), T.StructField("doc_id", c.schema["did"].dataType),
                         T.StructField("score", T.DoubleType())])


def _dealt(id_col: str, n: Column) -> Column:
    """A number below ``n``, by hash; equal ids meet."""
    return F.pmod(F.xxhash64(id_col), n)


def _all(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), n - 1))


def vector_topk(queries: DataFrame, corpus: DataFrame, k: int = 5, query_id: str = "vec_id",
                doc_id: str = "vec_id", vec_col: str = "embedding", exclude_self: bool = True,
                block_rows: int = 20_000) -> DataFrame:
    """Exact cosine top-``k`` corpus rows for every query vector:
    ``query_id, rank, doc_id, score``. A block holds about ``block_rows``
    queries or ``BLOCK_BYTES`` of vectors, a shard ``SHARD_BYTES`` (rows are
    counted, the widest vector is measured)."""
    q, c = _usable(queries, query_id, vec_col, "qid"), _usable(corpus, doc_id, vec_col, "did")
    size = {}
    for name, df in (("q", q), ("c", c)):
        size[name] = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("v")), F.lit(1)).alias("dim")).first()
    least = int(q.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    rows = max(1, min(block_rows, BLOCK_BYTES // (8 * size["q"]["dim"])))
    n_blocks = max(1, math.ceil(size["q"]["n"] / rows))
    # every shard sends each query's best k on: no more shards than the cells need
    shards = F.lit(max(1, min(math.ceil(least / n_blocks), size["c"]["n"]), math.ceil(size["c"]["n"] * size["c"]["dim"] * 8 / SHARD_BYTES))).cast("long")
    blocks = F.lit(n_blocks).cast("long")
    left = c.select("*", F.size("v").alias("__d"), _dealt("did", shards).alias("__s"), _all(blocks).alias("__b"))
    right = q.select("*", F.size("v").alias("__d"), _dealt("qid", blocks).alias("__b"), _all(shards).alias("__s"))
    cell = ["__d", "__b", "__s"]
    return best_k(left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(_scorer(k, exclude_self), _schema(q, c)), k)


# ---- inverted lists ------------------------------------------------------------

def _sample(c: DataFrame) -> np.ndarray:
    """Unit vectors of the commonest length, by a hash of id and vector: ``SAMPLE_ROWS`` or ``SAMPLE_BYTES`` of them."""
    sizes = c.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    if not sizes:
        return np.empty((0, 0))
    dim, n = sizes[0]
    most = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim)))
    rows = c.where(F.size("v") == dim).select("v", F.xxhash64("did", "v").alias("h"))
    if n > 2 * most:  # about twice the bound reaches the sort
        rows = rows.where(F.col("h") / F.lit(2.0 ** 64) + 0.5 <= 2 * most / n)
    return _units(np.array([r[0] for r in rows.orderBy("h").limit(most).select("v").collect()], np.float64).reshape(-1, dim))


def _units(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return (m / np.where(norms == 0, 1, norms))[norms[:, 0] > 0]


def centroids(sample: np.ndarray, n: int, seed: int = 42) -> np.ndarray:
    """``n`` unit centroids by spherical k-means; lists that run empty restart at the worst served row."""
    rng = np.random.default_rng(seed)
    c = sample[rng.permutation(len(sample))[:n]].copy()
    for _ in range(ROUNDS):
        s = sample @ c.T
        own, near = s.argmax(axis=1), s.max(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, own, sample)
        empty = np.flatnonzero(np.bincount(own, minlength=len(c)) == 0)
        total[empty] = sample[np.argsort(near)[:len(empty)]]
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 0, total / np.where(norm == 0, 1, norm), c)
    return c


def probes_for(sample: np.ndarray, c: np.ndarray, k: int, recall: float, seed: int = 42) -> int:
    """Lists a query must meet so that the share ``recall`` of its ``k`` best rows lies in them, measured on the sample."""
    if len(sample) < 2:
        return len(c)
    pick = np.random.default_rng(seed).permutation(len(sample))[:MEASURED]
    s = sample[pick] @ sample.T
    s[np.arange(len(pick)), pick] = -np.inf
    near = np.argpartition(-s, min(k, s.shape[1] - 1) - 1, axis=1)[:, :k]
    home = (sample @ c.T).argmax(axis=1)
    order = np.argsort(np.argsort(-(sample[pick] @ c.T), axis=1), axis=1)  # a list's place in each query's order
    needed = np.sort(np.take_along_axis(order, home[near], axis=1).ravel())
    return int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)]) + 1


def _met(b: pa.RecordBatch, c: np.ndarray, n: int, copies: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of the batch, their lists) for the ``n`` lists nearest to each vector, few enough rows at once
    for ``copies`` of each; a vector of another length has a list of its own length, numbered below zero."""
    v = b.column(1)
    lens = v.value_lengths().to_numpy()
    other, fits = np.flatnonzero(lens != c.shape[1]), np.flatnonzero(lens == c.shape[1])
    at = 0
    while at < len(other):
        some = other[at:at + max(1, int(np.searchsorted(np.cumsum(lens[other[at:]], dtype=np.int64) * 8, SLICE_BYTES)))]
        yield some, -lens[some].astype(np.int64)
        at += len(some)
    step = max(1, min(MAX_CELLS // len(c), SLICE_BYTES // (8 * c.shape[1] * copies)))
    for lo in range(0, len(fits), step):
        at = fits[lo:lo + step]
        s = v.take(pa.array(at)).flatten().to_numpy().reshape(len(at), -1) @ c.T
        top = np.argpartition(-s, n - 1, axis=1)[:, :n] if n < len(c) else np.tile(np.arange(len(c)), (len(at), 1))
        yield np.repeat(at, top.shape[1]), top.ravel().astype(np.int64)


def _assign(shared, n: int):
    """(id, v, list) for the ``n`` lists nearest to each vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, lists in _met(b, shared.value, n, n):
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(lists)], names=[*b.schema.names, "list"])
    return run


def _to_bins(shared, bins, n: int, n_bins: int):
    """(id, v, bin, lists): a vector once for every bin of the ``n`` lists nearest to it, and which of its lists it meets there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bin_of = bins.value
        for b in batches:
            for rows, lists in _met(b, shared.value, n, min(n, n_bins)):
                place = np.minimum(np.searchsorted(known, lists), len(known) - 1)
                there = known[place] == lists  # other lists hold no row
                rows, lists, bin_ = rows[there], lists[there], bin_of[place[there]]
                o = np.lexsort((lists, bin_, rows))
                rows, lists, bin_ = rows[o], lists[o], bin_[o]
                first = np.flatnonzero(np.diff(rows, prepend=-1).astype(bool) | np.diff(bin_, prepend=-1).astype(bool))
                at = pa.array(rows[first])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at), pa.array(bin_[first]),
                     pa.ListArray.from_arrays(pa.array(np.append(first, len(rows)), pa.int32()), pa.array(lists))], names=[*b.schema.names, "bin", "lists"])
    return run


def binned(counts: dict[int, int], c: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(lists in ascending order, the bin of each, number of bins): lists of neighbouring centroids ``c``
    share a bin up to ``rows`` rows; a list of another length (below zero) or of more rows has its own."""
    known = np.array(sorted(counts), np.int64)
    groups = max(1, min(len(c), math.ceil(sum(counts.values()) / rows)))
    near = (c @ centroids(c, groups).T).argmax(axis=1)
    bin_of, number, held = np.zeros(len(known), np.int64), -1, 0
    for i in sorted(range(len(known)), key=lambda i: (-1 if known[i] < 0 else near[known[i]], known[i])):
        n = counts[int(known[i])]
        if number < 0 or known[i] < 0 or held < 0 or held + n > rows:
            number, held = number + 1, 0
        bin_of[i], held = number, -1 if known[i] < 0 or n > rows else held + n
    return known, bin_of, number + 1


def _with_lists(df: DataFrame, shared, n: int, name: str) -> DataFrame:
    schema = T.StructType([df.schema[name], df.schema["v"], T.StructField("list", T.LongType())])
    return staged(df.mapInArrow(_assign(shared, n), schema), "lists")


def vector_topk_lists(queries: DataFrame, corpus: DataFrame, k: int = 5, query_id: str = "vec_id",
                      doc_id: str = "vec_id", vec_col: str = "embedding", exclude_self: bool = True,
                      recall: float = 0.95, n_lists: int | None = None, probes: int | None = None,
                      block_rows: int = 20_000) -> DataFrame:
    """Cosine top-``k`` by inverted lists, for query sets too large for
    ``vector_topk``: ``query_id, rank, doc_id, score``.

    A corpus row lies in the list of its nearest centroid; a query meets the
    ``probes`` lists nearest to it (by default as many as the sample needs for
    ``recall``, measured against exact search within it). Work is about
    queries x rows x probes / lists, with sqrt(rows) lists up to ``MAX_LISTS``.
    Only the centroids are learned, from a bounded sample; every row is in a
    list, every probed row is scored exactly, and lists of any size are split
    into shards and blocks. A query may find fewer than ``k`` rows only where
    its probed lists hold fewer.
    """
    q, c = _usable(queries, query_id, vec_col, "qid"), _usable(corpus, doc_id, vec_col, "did")
    spark = c.sparkSession
    sample = _sample(c)
    if not len(sample):
        return vector_topk(queries, corpus, k, query_id, doc_id, vec_col, exclude_self, block_rows)
    n_rows = c.count()
    centres = centroids(sample, max(1, min(n_lists or math.isqrt(n_rows), MAX_LISTS, len(sample))))
    probes = max(1, min(probes or probes_for(sample, centres, k, recall), len(centres)))
    shared = spark.sparkContext.broadcast(centres)
    held, dim = _with_lists(c, shared, 1, "did"), sample.shape[1]
    counts = {r[0]: r[1] for r in held.groupBy("list").count().collect()}  # a row a list; lengths that differ from the centroids' are few
    cells = min(int(spark.conf.get("spark.sql.shuffle.partitions", "8")), 2 * spark.sparkContext.defaultParallelism)
    rows = max(1, min(SHARD_BYTES // (8 * dim), math.ceil(n_rows / cells)))
    known, bin_of, n_bins = binned(counts, centres, rows)
    bins = spark.sparkContext.broadcast((known, bin_of))
    asked = q.mapInArrow(_to_bins(shared, bins, probes, n_bins), T.StructType(
        [q.schema["qid"], q.schema["v"], T.StructField("bin", T.LongType()), T.StructField("lists", T.ArrayType(T.LongType()))]))
    # the pieces that a bin's rows and queries fall into: a row a bin
    met = {r[0]: r[1] for r in asked.groupBy("bin").count().collect()}
    most = max(1, min(block_rows, BLOCK_BYTES // (8 * dim)))
    total, width = dict.fromkeys(range(n_bins), 0), dict.fromkeys(range(n_bins), dim)
    for x, at in zip(known.tolist(), bin_of.tolist(), strict=True):
        total[at], width[at] = total[at] + counts[x], dim if x >= 0 else -x
    grid = F.broadcast(spark.createDataFrame(
        [(x, at, math.ceil(total[at] / max(1, SHARD_BYTES // (8 * width[at]))), math.ceil(met[at] / min(most, max(1, BLOCK_BYTES // (8 * width[at])))))
         for x, at in zip(known.tolist(), bin_of.tolist(), strict=True) if at in met], "list long, bin long, shards long, blocks long"))
    left = held.join(grid, "list").select("did", "v", "list", "bin", _dealt("did", F.col("shards")).alias("__s"), _all(F.col("blocks")).alias("__b"))
    right = asked.join(F.broadcast(grid.select("bin", "shards", "blocks").distinct()), "bin").select(
        "qid", "v", "lists", "bin", _dealt("qid", F.col("blocks")).alias("__b"), _all(F.col("shards")).alias("__s"))
    cell = ["bin", "__b", "__s"]
    return best_k(left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(_scorer(k, exclude_self), _schema(q, c)), k)
