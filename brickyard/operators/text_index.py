"""Inverted index for keyword retrieval, and BM25 search over it.

The index is made in one pass over the texts. Documents are packed
into blocks where they are read (texts are dealt out first only if there are
fewer files than tasks of ``PART_CHARS`` need), no posting is shuffled, and every
block gives one row per term that it holds: the places of its documents,
how often each holds the term, and the greatest frequency and least length
among them, which bound the term's impact in the block. One more row per block,
without a term, lists the block's documents and their lengths. The rows of a
block are kept as one parcel, a compressed table, for they move together. As
rows of their own they are sorted by term inside each file, so that a stored
index is read by row group.

Postings and queries meet in cells (group of queries, shard of index blocks),
both sized by counts and as large as a task may hold, since postings move once
per group and weights once per shard. Weights move in parcels too. For a few queries, rows are joined with their terms first, so that
only matching postings move.

A cell keeps common terms as a matrix and the others as lists. Documents are
ordered by what they hold of the common terms and by length, and cut into
segments; a query skips a segment whose bound is below its k-th best score so
far. The rest is scored in single precision, and what may be among the best
``k`` by that is scored again in double precision. Results are exact.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from brickyard.session import staged, staged_counting

# Kernels run in Python workers; they are pickled by value, so that executors
# need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# tokenizer = lower-case, split on runs of anything that is not a
# Unicode letter or digit; BM25 parameters k1 = 1.2, b = 0.75.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
BM25_K1 = 1.2
BM25_B = 0.75

BLOCK_DOCS, BLOCK_TOKENS = 2_048, 1_000_000   # an index block holds so many documents, or about so many tokens, at most
PART_CHARS = 64_000_000                       # characters of text that a task indexes, about
SHARD_POSTINGS = 4_000_000                    # matching postings of a cell
GROUP_PAIRS, GROUP_QUERIES = 4_000_000, 250_000  # (query, term) pairs and queries of a cell
FEW_PAIRS = 50_000                            # up to so many pairs, index rows are joined with their terms
PARCEL_BYTES = 32_000_000                     # index rows that are packed together
SCORE_CELLS = 4_000_000                       # scores held at once (documents x queries)
DENSE_TERMS, DENSE_CELLS = 256, 16_000_000    # terms of a cell that are kept as a matrix, and its size (64 MB, and as much for the frequencies)
SEGMENT_DOCS, BOUND_DOCS, SMALL_DOCS = 256, 8, 2_048  # documents of a segment, and of each of its bounds; below SMALL_DOCS each stands alone
ALIKE_TERMS = 64                              # common terms by which texts are found alike
DRIFT = 1e-4                                  # more than single precision may change a score by, of its size, over DENSE_TERMS terms
ROUND = 6                                     # decimal places of a score
SLACK = 10.0 ** -ROUND                        # a bound this much below the k-th score can't reach it by rounding


def tokens(text) -> Column:
    """Lower-cased word tokens of ``text``: built-in lower/split/array_remove,
    all JVM-side with generated code (no lambda, no Python)."""
    t = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(t), TOKEN_SPLIT, -1), F.lit(""))


FACTS = ("term", "df", "cf", "max_tf", "min_len")
POSTINGS = ("block", "term", "places", "tfs", "ids", "lens")


def _no_term() -> Column:
    return F.col("term").isNull()


# ---- the index ---------------------------------------------------------------

class TermIndex(NamedTuple):
    """``rows``: one per (block, term), and one per block with a null term,
    which counts its documents in ``df`` and their tokens in ``cf``.
    ``parcels``, if there: the same, (block, part) with a block's rows as one value."""
    rows: DataFrame
    n_docs: int
    n_tokens: int
    parcels: DataFrame | None = None

    def facts(self) -> DataFrame:
        """What each block says of each of its terms, without postings."""
        if self.parcels is None:
            return self.rows.where(~_no_term()).select(*FACTS)
        return self.parcels.select("part").mapInArrow(_facts, self.rows.select(*FACTS).schema)

    def terms(self) -> DataFrame:
        """Per term: documents that hold it, occurrences, blocks, greatest frequency and least length of a holder."""
        return self.facts().groupBy("term").agg(
            F.sum("df").alias("df"), F.sum("cf").alias("cf"), F.count(F.lit(1)).alias("blocks"),
            F.max("max_tf").alias("max_tf"), F.min("min_len").alias("min_len"))


def _index_schema(did: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("block", T.LongType()), T.StructField("term", T.StringType()), T.StructField("df", T.LongType()),
        T.StructField("cf", T.LongType()), T.StructField("max_tf", T.IntegerType()), T.StructField("min_len", T.IntegerType()),
        T.StructField("places", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.IntegerType())),
        T.StructField("ids", T.ArrayType(did)), T.StructField("lens", T.ArrayType(T.IntegerType()))])


def _lists(offsets: np.ndarray, values: pa.Array, n_null: int) -> pa.Array:
    """Lists of ``values``, then ``n_null`` null lists."""
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
    return pa.concat_arrays([lists, pa.nulls(n_null, lists.type)])


def _block_rows(number: int, ids: pa.Array, toks: pa.ListArray) -> pa.RecordBatch:
    """The index rows of one block of documents, in order of term, its document row last."""
    n = len(ids)
    lens = toks.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int32)
    coded = toks.flatten().dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    doc = np.repeat(np.arange(n), lens)
    key, tf = np.unique(rank[coded.indices.to_numpy()] * n + doc, return_counts=True) if len(doc) else (np.empty(0, np.int64), np.empty(0, np.int64))
    term, place = key // max(n, 1), key % max(n, 1)
    start = np.searchsorted(term, np.arange(len(order)))
    ends = np.append(start, len(key))
    held = lens[place]
    reduce = (lambda f, x: f.reduceat(x, start)) if len(order) else (lambda f, x: np.empty(0, np.int64))
    cols = [
        pa.array(np.full(len(order) + 1, number, np.int64)),
        pa.concat_arrays([coded.dictionary.take(pa.array(order)).cast(pa.string()), pa.nulls(1, pa.string())]),
        pa.array(np.append(np.diff(ends), n).astype(np.int64)),
        pa.array(np.append(reduce(np.add, tf), lens.sum(dtype=np.int64)).astype(np.int64)),
        pa.concat_arrays([pa.array(reduce(np.maximum, tf).astype(np.int32)), pa.nulls(1, pa.int32())]),
        pa.concat_arrays([pa.array(reduce(np.minimum, held).astype(np.int32)), pa.nulls(1, pa.int32())]),
        _lists(ends, pa.array(place.astype(np.int32)), 1), _lists(ends, pa.array(tf.astype(np.int32)), 1),
        pa.concat_arrays([pa.nulls(len(order), pa.list_(ids.type)), pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), ids)]),
        pa.concat_arrays([pa.nulls(len(order), pa.list_(pa.int32())), pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.array(lens))])]
    return pa.RecordBatch.from_arrays(cols, names=["block", "term", "df", "cf", "max_tf", "min_len", "places", "tfs", "ids", "lens"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (id, tokens) as index rows, a batch a block."""
    from pyspark import TaskContext
    number = TaskContext.get().partitionId() << 32
    held, docs, size = [], 0, 0
    for b in batches:
        lens = b.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        at = 0
        while at < b.num_rows:
            # as many rows as the block has room for, one at least
            room = int(np.searchsorted(np.cumsum(lens[at:], dtype=np.int64), BLOCK_TOKENS - size, "right"))
            take = min(max(room, 0 if docs else 1), BLOCK_DOCS - docs, b.num_rows - at)
            if take:
                held.append(b.slice(at, take))
                docs, size, at = docs + take, size + int(lens[at:at + take].sum()), at + take
            if docs and (not take or docs >= BLOCK_DOCS or size >= BLOCK_TOKENS):
                yield _block_rows(number, *_joined(held))
                number, held, docs, size = number + 1, [], 0, 0
    if docs:
        yield _block_rows(number, *_joined(held))


def _pack_parcels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents as one row a block: its number, its documents and tokens, and its index rows as a parcel."""
    for rows in _pack(batches):
        number, _, docs, tokens = (rows.column(i)[-1].as_py() for i in range(4))
        yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in (number, docs, tokens)), pa.array([_parcel(pa.Table.from_batches([rows]))], pa.binary())],
                                         names=["block", "docs", "tokens", "part"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for t in _unpack(b.column("part")):
            for c in ("places", "tfs"):
                t = t.set_column(t.column_names.index(c), c, t.column(c).cast(pa.list_(pa.int32())))
            yield from t.to_batches()


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for t in _unpack(b.column("part")):
            yield from t.select(FACTS).filter(t.column("term").is_valid()).to_batches()


def _joined(held: list[pa.RecordBatch]) -> tuple[pa.Array, pa.Array]:
    return tuple(pa.concat_arrays([b.column(i) for b in held]) for i in range(2))


def open_index(rows: DataFrame) -> TermIndex:
    """The index of stored ``rows``."""
    n, total = rows.where(_no_term()).agg(F.sum("df"), F.sum("cf")).first()
    return TermIndex(rows, n or 0, total or 0)


def term_index(docs: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", terms: DataFrame | None = None) -> TermIndex:
    """The index over ``docs``, staged in the shared folder. With ``terms``
    (a column ``term``) only their postings are kept; counts of documents and
    tokens always cover all. Rows with a null text or id are documents too.
    Write ``rows`` to a table to keep the index; ``open_index`` takes it up again."""
    spark = docs.sparkSession
    src = docs.select(F.col(doc_id).alias("did"), F.col(doc_text).alias("text"))
    # a file may be one task's whatever its size: tasks follow the text, and all cores tokenise
    chars = src.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    least = max(spark.sparkContext.defaultParallelism, math.ceil(chars / PART_CHARS))
    if len(docs.inputFiles()) < least:
        src = src.repartition(least)
    src, schema = src.select("did", tokens("text").alias("toks")), _index_schema(src.schema["did"].dataType)
    if terms is None:
        parcels, seen = staged_counting(src.mapInArrow(_pack_parcels, "block long, docs long, tokens long, part binary"), "index", n=F.sum("docs"), total=F.sum("tokens"))
        rows = parcels.select("part").mapInArrow(_rows, schema).sortWithinPartitions("term")
        return TermIndex(rows, seen["n"] or 0, seen["total"] or 0, parcels.select("block", "part"))
    rows = src.mapInArrow(_pack, schema)
    wanted = terms.select("term").where("term is not null").distinct().withColumn("__hit", F.lit(True))
    rows = rows.join(wanted, "term", "left").where("__hit or term is null").select(*rows.columns)
    kept, seen = staged_counting(rows.sortWithinPartitions("term"), "index", n=F.sum(F.when(_no_term(), F.col("df"))), total=F.sum(F.when(_no_term(), F.col("cf"))))
    return TermIndex(kept, seen["n"] or 0, seen["total"] or 0)


# ---- search ------------------------------------------------------------------

class QueryTerms(NamedTuple):
    """``pairs`` (qid, term, qtf), how many, and about how many queries."""
    pairs: DataFrame
    n_pairs: int
    n_queries: int


def query_terms(queries: DataFrame, query_id: str, query_text: str) -> QueryTerms:
    """Each query's terms and how often it holds them, staged."""
    pairs = (queries.select(F.col(query_id).alias("qid"), F.explode(tokens(query_text)).alias("term"))
             .groupBy("qid", "term").agg(F.count(F.lit(1)).alias("qtf")))
    pairs, seen = staged_counting(pairs, "query-terms", n=F.count(F.lit(1)), q=F.approx_count_distinct(F.xxhash64("qid")))
    return QueryTerms(pairs, seen["n"], max(1, seen["q"]))


def search(index: TermIndex, terms: QueryTerms, k: int = 5, k1: float = BM25_K1, b: float = BM25_B,
           block_rows: int = 5_000, block_terms: int = 200_000) -> DataFrame:
    """Exact BM25 top-``k``: (query_id, rank, doc_id, score) for the queries of
    ``terms``.

    Every document that shares a term with a query scores above zero and
    counts, however small its score; scores are rounded to ``ROUND`` places,
    ties go to the smaller id (a null id first). A null query id is a query of
    its own. Repeated document ids are documents of their own. (The order of
    summation depends on the block of queries: a score within 1e-15 of a
    rounding edge may round either way.)
    """
    pairs, spark = terms.pairs, terms.pairs.sparkSession
    qid, did = pairs.schema["qid"].dataType, index.rows.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("query_id", qid), T.StructField("doc_id", did), T.StructField("score", T.DoubleType())])
    if not (terms.n_pairs and index.n_docs and index.n_tokens):
        return best_k(spark.createDataFrame([], schema), k)
    n_docs, avgdl = index.n_docs, index.n_tokens / index.n_docs
    # from the index rows' counts; the postings are not read for this
    counts = index.facts().groupBy("term").agg(F.sum("df").alias("df"))
    known, seen = staged_counting(counts.join(pairs.select("term").distinct(), "term", "left_semi"), "df", matching=F.sum("df"))
    matching = seen["matching"] or 0
    groups = max(1, math.ceil(terms.n_queries / GROUP_QUERIES), math.ceil(terms.n_pairs / GROUP_PAIRS))
    cells = min(int(spark.conf.get("spark.sql.shuffle.partitions", "8")), 2 * spark.sparkContext.defaultParallelism)
    shards = max(1, math.ceil(cells / groups), math.ceil(matching / SHARD_POSTINGS))
    own_group = F.pmod(F.xxhash64("qid"), F.lit(groups)).cast("int")
    every_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    every_shard = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    # blocks are numbered by task: dealt out in turn
    shard = F.pmod(F.shiftright("block", 32) + F.col("block").bitwiseAND(F.lit((1 << 32) - 1)), F.lit(shards))
    few, rows = terms.n_pairs <= FEW_PAIRS, index.rows
    if few:
        rows = rows.join(known.select("term"), "term").select(*rows.columns).unionByName(rows.where(_no_term()))
    if few or index.parcels is None:
        parcels = rows.select(shard.cast("long").alias("__s"), *POSTINGS).mapInArrow(_pack_rows, "__s long, part binary")
    else:
        parcels = index.parcels.select(shard.cast("long").alias("__s"), "part")
    left = parcels.withColumn("__b", every_group).groupBy("__b", "__s")
    weights = pairs.join(known, "term").select(
        own_group.alias("__b"), "qid", "term", (F.col("qtf") * F.log1p((n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))).alias("w"))

    def pack_weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if held := list(batches):
            t = pa.Table.from_batches(held)
            for b in pc.unique(t.column("__b")):
                for block in _query_blocks(t.filter(pc.equal(t.column("__b"), b)).drop_columns("__b"), block_rows, block_terms):
                    yield pa.RecordBatch.from_arrays([pa.array([b.as_py()], pa.int32()), pa.array([_parcel(block.sort_by("term"), "term", "qid")], pa.binary())], names=["__b", "part"])

    right = (weights.repartition("qid").mapInArrow(pack_weights, "__b int, part binary")
             .withColumn("__s", every_shard).groupBy("__b", "__s"))

    def score(postings: pa.Table, weights: pa.Table) -> pa.Table:
        if not (weights.num_rows and postings.num_rows):
            return pa.table([pa.array([], t) for t in arrow.types], schema=arrow)
        cell = _Cell(_unpack(weights.column("part")), avgdl, k1, b, k)
        return cell.over(lambda: _unpack(postings.column("part"))).table(arrow)

    arrow = to_arrow_schema(schema)
    return best_k(left.cogroup(right).applyInArrow(score, schema), k)


def _parcel(rows: pa.Table, *coded: str) -> bytes:
    """``rows`` as one compressed value, with the columns ``coded`` as dictionaries and lists of numbers in the smallest type."""
    rows = rows.combine_chunks()
    for c in coded:
        x = rows.column(c).combine_chunks().dictionary_encode()
        small = pa.from_numpy_dtype(np.min_scalar_type(len(x.dictionary)))
        rows = rows.set_column(rows.column_names.index(c), c, pa.DictionaryArray.from_arrays(x.indices.cast(small), x.dictionary))
    for c in {"places", "tfs"} & set(rows.column_names):
        most = pc.max(pc.list_flatten(rows.column(c))).as_py() or 0
        small = pa.list_(pa.from_numpy_dtype(np.min_scalar_type(most)))
        rows = rows.set_column(rows.column_names.index(c), c, rows.column(c).cast(small))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpack(parcels: pa.Array | pa.ChunkedArray) -> Iterator[pa.Table]:
    for x in parcels:
        yield pa.ipc.open_stream(x.as_buffer()).read_all()


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows in parcels, each of one shard ``__s``."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= PARCEL_BYTES:
            yield from _parcels(held)
            held, size = [], 0
    if held:
        yield from _parcels(held)


def _parcels(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    t = pa.Table.from_batches(held)
    shard = t.column("__s").to_numpy()
    t = t.drop_columns("__s")
    for s in np.unique(shard):
        part = _parcel(t.take(pa.array(np.flatnonzero(shard == s))))
        yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([part], pa.binary())], names=["__s", "part"])


def _query_blocks(weights: pa.Table, block_rows: int, block_terms: int) -> Iterator[pa.Table]:
    """``weights`` in blocks of whole queries: ``block_rows`` of them at most, and about ``block_terms`` pairs (one query at least)."""
    code = weights.column("qid").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    order = np.argsort(code, kind="stable")
    ends = np.cumsum(np.bincount(code))
    lo = 0
    while lo < len(ends):
        start = int(ends[lo - 1]) if lo else 0
        hi = min(max(int(np.searchsorted(ends, start + block_terms, "right")), lo + 1), lo + max(1, block_rows), len(ends))
        yield weights.take(pa.array(order[start:ends[hi - 1]]))
        lo = hi


def best_k(found: DataFrame, k: int) -> DataFrame:
    """Merge candidates (query_id, doc_id, score): score desc, id asc."""
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "doc_id", "score"))


def nulls_first(x):
    return (x is not None, x if x is not None else 0)


class Best:
    """The best ``k`` rows per query so far, under (rounded score desc, id asc,
    a null id first). Rows are offered in chunks; each chunk is cut to its own
    best ``k`` first, which is exact for the same order."""

    def __init__(self, qids: list, k: int):
        self.qids, self.k, self.kth = qids, k, np.full(len(qids), -np.inf)
        self.rows: list[list[tuple[float, object]]] = [[] for _ in qids]

    def offer(self, scores: np.ndarray, ids: list, ok: np.ndarray, queries: np.ndarray | None = None) -> None:
        """``scores``: rows x ``queries`` (all, if None), rows in ascending order of ``ids``; only ``ok`` ones count."""
        sc = np.where(ok, np.round(scores, ROUND), -np.inf)
        n = len(ids)
        kth = self.kth if queries is None else self.kth[queries]
        least = np.partition(sc, n - self.k, axis=0)[n - self.k] if n > self.k else -np.inf
        q, r = np.nonzero((ok & (sc >= np.maximum(least, kth)[None, :])).T)
        ends = np.searchsorted(q, np.arange(sc.shape[1] + 1))
        for j in np.unique(q):
            pick = r[ends[j]:ends[j + 1]]
            pick = pick[np.lexsort((pick, -sc[pick, j]))[:self.k]]   # ties to the smaller id: rows ascend by id
            at = j if queries is None else queries[j]
            both = self.rows[at] + [(-float(sc[i, j]), ids[i]) for i in pick]
            both.sort(key=lambda x: (x[0], *nulls_first(x[1])))
            self.rows[at] = both[:self.k]
            if len(both) >= self.k:
                self.kth[at] = -self.rows[at][-1][0]

    def table(self, schema: pa.Schema) -> pa.Table:
        flat = [(self.qids[j], d, -s) for j, rows in enumerate(self.rows) for s, d in rows]
        return pa.table([pa.array([f[i] for f in flat], schema.types[i]) for i in range(3)], names=schema.names)


class _Cell:
    """The best ``k`` documents of a shard for each query of a group."""

    def __init__(self, weights: pa.Table | Iterable[pa.Table], avgdl: float, k1: float, b: float, k: int):
        """``weights``: one table (qid, term, w), or several that share no query."""
        self.avgdl, self.k1, self.b, self.k, self.skipped = avgdl, k1, b, k, 0
        qids, held, parts = [], [], []
        for t in [weights] if isinstance(weights, pa.Table) else weights:
            term, qid = (t.column(c).combine_chunks() for c in ("term", "qid"))
            term = term if pa.types.is_dictionary(term.type) else term.dictionary_encode()
            qid = (qid.dictionary_decode() if pa.types.is_dictionary(qid.type) else qid).dictionary_encode(null_encoding="encode")
            q = qid.indices.to_numpy()
            order = np.argsort(q, kind="stable")
            parts.append((term.dictionary, term.indices.to_numpy()[order], t.column("w").to_numpy()[order]))
            held.append(np.bincount(q, minlength=len(qid.dictionary)))
            qids += qid.dictionary.to_pylist()
        self.terms = pa.chunked_array([x for x, _, _ in parts]).unique()
        self.t = np.concatenate([self._codes(x)[t] for x, t, _ in parts])
        self.w = np.concatenate([w for _, _, w in parts])
        self.best, self.n = Best(qids, k), len(qids)
        self.ends = np.append(0, np.cumsum(np.concatenate(held)))

    def _codes(self, terms: pa.Array) -> np.ndarray:
        """The number of each of ``terms`` among the queries' terms, or -1."""
        return pc.index_in(terms, value_set=self.terms, skip_nulls=True).fill_null(-1).to_numpy()

    def impact(self, tf, norm):
        return np.divide(tf * (self.k1 + 1), tf + norm, out=np.zeros_like(tf), where=tf > 0)   # without k1 an absent term has 0 / 0

    def run(self, *postings: pa.Table) -> Best:
        return self.over(lambda: iter(postings))

    def over(self, postings: Callable[[], Iterator[pa.Table]]) -> Best:
        """The best over ``postings``, index rows of whole blocks a table, which are gone through twice: all at once would fill a task."""
        if self._load(postings):
            step = min(max(1, SCORE_CELLS // self.size), self.n)
            self.sums = np.empty((step, self.size), np.float32)   # one place for all rounds: fresh memory costs as much as what is done in it
            for lo in range(0, self.n, step):
                self._score(lo, min(lo + step, self.n))
        return self.best

    def _load(self, postings: Callable[[], Iterator[pa.Table]]) -> bool:
        """Lay the shard's documents out, with its postings as a matrix of the terms that cost most, and as lists. False if nothing matches."""
        df, docs, numbers, codes, most = np.zeros(len(self.terms), np.int64), [], [], [], 0
        for rows in postings():
            code, n_held = self._codes(rows.column("term").combine_chunks()), pc.list_value_length(rows.column("places")).fill_null(0).to_numpy()
            df += np.bincount(code[code >= 0], n_held[code >= 0], len(df)).astype(np.int64)
            codes.append(code)
            most = max(most, pc.max(pc.list_flatten(rows.column("tfs"))).as_py() or 0)
            listed = rows.select(["block", "ids", "lens"]).filter(rows.column("term").is_null()).combine_chunks()
            docs.append(listed)
            numbers += listed.column("block").to_pylist()
        lens = np.concatenate([x.column("lens").combine_chunks().flatten().to_numpy() for x in docs])
        first = dict(zip(numbers, np.cumsum([0, *(n for x in docs for n in pc.list_value_length(x.column("lens")).to_pylist())]).tolist(), strict=False))
        self.ids = pa.concat_arrays([x.column("ids").combine_chunks().flatten() for x in docs])
        n = len(lens)
        if not n or not df.any():
            return False
        # a term's cost in lists: its postings, for each query that holds it
        cost = df * np.bincount(self.t, minlength=len(df))
        n_dense = min(DENSE_TERMS, max(1, DENSE_CELLS // n), int((cost > 0).sum()))
        dense = np.argpartition(-cost, n_dense - 1)[:n_dense]
        dense = dense[np.argsort(-cost[dense], kind="stable")]
        self.dense_of = np.full(len(df), -1, np.int64)
        self.dense_of[dense] = np.arange(n_dense)
        tfs, kept = np.zeros((n, n_dense), np.min_scalar_type(most)), []
        for rows, code in zip(postings(), codes, strict=True):
            rows = rows.combine_chunks()
            for r, is_dense in ((np.flatnonzero((code >= 0) & (self.dense_of[code] >= 0)), True), (np.flatnonzero((code >= 0) & (self.dense_of[code] < 0)), False)):
                places, tf = (rows.column(c).combine_chunks().take(pa.array(r)) for c in ("places", "tfs"))
                held = places.value_lengths().to_numpy()
                blocks, which = np.unique(rows.column("block").to_numpy()[r], return_inverse=True)
                start = np.array([first[x] for x in blocks.tolist()], np.int32)[which]
                doc, tf = places.flatten().to_numpy() + np.repeat(start, held), tf.flatten().to_numpy()
                if is_dense:
                    tfs[doc, np.repeat(self.dense_of[code[r]], held)] = tf
                else:
                    kept.append((code[r], held, doc.astype(np.int32), tf.astype(tfs.dtype)))
        norm = self.k1 * (1 - self.b + self.b * lens / self.avgdl)
        at = self._layout(_alike(tfs, lens), n)
        self.tfs, self.norm = np.zeros((self.size, n_dense), tfs.dtype), np.ones(self.size)
        self.tfs[at], self.norm[at] = tfs, norm
        del tfs
        self.dense = np.zeros((self.size, n_dense), np.float32)
        for lo in range(0, self.size, SEGMENT_DOCS):
            part = slice(lo, lo + SEGMENT_DOCS)
            self.dense[part] = self.impact(self.tfs[part].astype(float), self.norm[part, None])
        self.bound = self.dense.reshape(self.part, -1, n_dense).max(axis=0)
        self.doc = np.zeros(self.size, np.int64)
        self.doc[at] = np.arange(n)
        # documents by id, a null id first
        self.by_id = np.empty(n, np.int64)
        self.by_id[pc.sort_indices(self.ids, null_placement="at_start").to_numpy()] = np.arange(n)
        # lists by term: each part's rows go where their term's list stands
        self.start = np.append(0, np.cumsum(np.where(self.dense_of < 0, df, 0)))
        self.at, self.value, filled = np.empty(self.start[-1], np.int32), np.empty(self.start[-1]), self.start[:-1].copy()
        while kept:
            code, held, doc, tf = kept.pop()
            order = np.argsort(code, kind="stable")
            before = np.cumsum(held[order]) - held[order]
            same = np.searchsorted(code[order], code[order])
            to = np.empty(len(code), np.int64)
            to[order] = filled[code[order]] + before - before[same] if len(code) else 0
            begin = np.cumsum(held) - held
            to = np.repeat(to - begin, held) + np.arange(len(doc))
            self.at[to], self.value[to] = at[doc], self.impact(tf.astype(float), norm[doc])
            filled += np.bincount(code, held, len(df)).astype(np.int64)
        # each list in order of place
        step = max(1, len(df) // 16)
        for a in range(0, len(df), step):
            x, y = self.start[a], self.start[min(a + step, len(df))]
            order = np.argsort(np.repeat(np.arange(a, min(a + step, len(df))), np.diff(self.start[a:min(a + step, len(df)) + 1])) * self.size + self.at[x:y])
            self.at[x:y], self.value[x:y] = self.at[x:y][order], self.value[x:y][order]
        self._order(n_dense)
        pa.default_memory_pool().release_unused()
        return True

    def _order(self, n_dense: int) -> None:
        """Queries in an order in which neighbours hold much the same common terms, and so need the same segments and columns."""
        col, held = self.dense_of[self.t], np.diff(self.ends)
        common = (col >= 0) & (col < ALIKE_TERMS)
        has = np.zeros((self.n, min(ALIKE_TERMS, n_dense)), bool)
        has[np.repeat(np.arange(self.n), held)[common], col[common]] = True
        order = _alike(has, held)
        at = np.repeat(self.ends[order], held[order]) + np.arange(len(self.t))
        at -= np.repeat(np.cumsum(held[order]) - held[order], held[order])
        self.t, self.w = self.t[at], self.w[at]
        self.ends = np.append(0, np.cumsum(held[order]))
        self.best.qids = [self.best.qids[i] for i in order.tolist()]

    def _layout(self, order: np.ndarray, n: int) -> np.ndarray:
        """The place of each document: in ``order``, in segments; place i counts for bound i % bounds, ``per`` bounds make a segment."""
        segment, self.part = (SEGMENT_DOCS, BOUND_DOCS) if n >= SMALL_DOCS else (1, 1)
        self.per, self.size = segment // self.part, -(-n // segment) * segment
        r = np.arange(n)
        at = np.empty(n, np.int64)
        at[order] = r % self.part * (self.size // self.part) + r // self.part
        return at

    def _score(self, lo: int, hi: int) -> None:
        """The queries from ``lo`` to ``hi``."""
        n, k, size = hi - lo, self.k, self.per * self.part
        a, z = self.ends[lo], self.ends[hi]
        query, t, w = np.repeat(np.arange(n), np.diff(self.ends[lo:hi + 1])), self.t[a:z], self.w[a:z]
        col = self.dense_of[t]
        d = col >= 0
        weights = np.zeros((n, self.dense.shape[1]), np.float32)
        weights[query[d], col[d]] = w[d]
        cols = np.flatnonzero(weights.any(axis=0))
        weights = weights[:, cols]
        top = weights @ self.bound[:, cols].T
        some = ~d & (self.start[t + 1] > self.start[t])
        cut = np.searchsorted(query[some], np.arange(n + 1)).tolist()
        begin, end, by = self.start[t[some]], self.start[t[some] + 1], w[some]
        held, lists = end - begin, list(map(slice, begin.tolist(), end.tolist()))
        sums, at, value = self.sums[:n], self.at, self.value
        for i in range(n):
            x, y = cut[i], cut[i + 1]
            own = lists[x:y]
            if not own:
                sums[i] = 0
                continue
            part = np.concatenate([value[c] for c in own])
            part *= np.repeat(by[x:y], held[x:y])
            sums[i] = np.bincount(np.concatenate([at[c] for c in own]), part, self.size)
            top[i] += sums[i].reshape(self.part, -1).max(axis=0)
        top = top.reshape(n, -1, self.per).max(axis=2)
        n_seg = top.shape[1]
        # a lower bound of the k-th best score, from each query's most promising segments
        seeds = np.argpartition(-top, min(k, n_seg) - 1, axis=1)[:, :k]
        best = np.full((n, seeds.shape[1], min(k, size)), -np.inf)
        for g in np.unique(seeds):
            q, j = np.nonzero(seeds == g)
            sc = self._segment(weights, cols, g, q)
            best[q, j] = sc if size <= k else np.partition(sc, size - k, axis=1)[:, size - k:]
        best = best.reshape(n, -1)
        least = np.partition(best, best.shape[1] - k, axis=1)[:, best.shape[1] - k] if best.shape[1] >= k else np.full(n, -np.inf)
        least = least * (1 - DRIFT) - 2 * SLACK
        live = (top > 0) & (top >= least[:, None])
        self.skipped += n * n_seg - int(live.sum())
        found = []
        for g in np.flatnonzero(live.any(axis=0)):
            q = np.flatnonzero(live[:, g])
            sc = self._segment(weights, cols, g, q)
            r, c = np.nonzero((sc >= least[q][:, None]) & (sc > 0))
            if len(r):
                found.append((q[r], c // self.per * (self.size // self.part) + g * self.per + c % self.per, sc[r, c]))
        if not found:
            return
        q, at, sc = (np.concatenate(x) for x in zip(*found, strict=True))
        # what may be among the best k, once more, in double precision
        o = np.lexsort((-sc, q))
        q, at, sc = q[o], at[o], sc[o]
        begin = np.searchsorted(q, np.arange(n + 1))
        kth = begin[:-1] + k - 1
        least = np.where(kth < begin[1:], sc[np.minimum(kth, len(sc) - 1)] * (1 - DRIFT) - 2 * SLACK, -np.inf)
        may = sc >= least[q]
        q, at = q[may], at[may]
        first = np.searchsorted(query, np.arange(n + 1))
        held = first[q + 1] - first[q]
        pair = np.repeat(first[q] - np.cumsum(held) + held, held) + np.arange(held.sum())
        r = np.repeat(np.arange(len(q)), held)
        sc = np.round(np.bincount(r, w[pair] * self._values(t[pair], at[r]), len(q)), ROUND)
        doc = self.doc[at]
        o = np.lexsort((self.by_id[doc], -sc, q))
        q, sc, doc = q[o], sc[o], doc[o]
        keep = np.arange(len(q)) - np.searchsorted(q, q) < k
        for i, s, x in zip((lo + q[keep]).tolist(), sc[keep].tolist(), self.ids.take(pa.array(doc[keep])).to_pylist(), strict=True):
            self.best.rows[i].append((-s, x))

    def _values(self, t: np.ndarray, at: np.ndarray) -> np.ndarray:
        """What the documents ``at`` hold of the terms ``t``, in double precision."""
        out, col = np.zeros(len(t)), self.dense_of[t]
        d = col >= 0
        out[d] = self.impact(self.tfs[at[d], col[d]].astype(float), self.norm[at[d]])
        t, at = t[~d], at[~d]
        lo, end = self.start[t], self.start[t + 1]
        hi = end.copy()
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            less = open_ & (self.at[np.where(open_, mid, 0)] < at)
            lo, hi = np.where(less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
        hit = lo < end
        hit[hit] = self.at[lo[hit]] == at[hit]
        found = np.zeros(len(t))
        found[hit] = self.value[lo[hit]]
        out[~d] = found
        return out

    def _segment(self, weights: np.ndarray, cols: np.ndarray, g: int, q: np.ndarray) -> np.ndarray:
        """The scores of the queries ``q`` in segment ``g``, in single precision."""
        at = slice(g * self.per, (g + 1) * self.per)
        dense = self.dense.reshape(self.part, -1, self.dense.shape[1])[:, at].take(cols, axis=2).reshape(self.part * self.per, len(cols))
        return self.sums.reshape(len(self.sums), self.part, -1)[q, :, at].reshape(len(q), -1) + weights[q] @ dense.T


def _alike(tfs: np.ndarray, lens: np.ndarray, axes: int = 3, parts: int = 3, sample: int = 2_000) -> np.ndarray:
    """An order of texts in which neighbours hold much the same common terms and are about as long: bounds over them are close."""
    held = (tfs[:, :ALIKE_TERMS] > 0).astype(np.float32)
    kind = np.zeros(len(lens), np.int64)
    if held.size:
        held -= held.mean(axis=0)
        for axis in np.linalg.svd(held[::max(1, len(held) // sample)], full_matrices=False)[2][:axes]:
            x = held @ axis
            kind = kind * parts + np.digitize(x, np.quantile(x, np.arange(1, parts) / parts))
    return np.lexsort((lens, kind))


def keyword_topk(queries: DataFrame, docs: DataFrame, k: int = 5, query_id: str = "item_id",
                 query_text: str = "text", doc_id: str = "doc_id", doc_text: str = "text",
                 k1: float = BM25_K1, b: float = BM25_B, block_rows: int = 5_000,
                 block_terms: int = 200_000, index: TermIndex | None = None) -> DataFrame:
    """Exact BM25 top-``k`` documents per query text: ``search`` over a stored
    ``index``, or over one made of ``docs``, of these queries' terms only if they are few."""
    terms = query_terms(queries, query_id, query_text)
    if index is None:
        # many queries hold most of the postings: to sort the rest out, all would have to move
        index = term_index(docs, doc_id, doc_text, terms=terms.pairs if terms.n_pairs <= FEW_PAIRS else None)
    return search(index, terms, k, k1, b, block_rows, block_terms)
