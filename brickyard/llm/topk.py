"""Exact top-k inner-product search by tiled matrix products.

Vectors are quantised to integers and packed into shards of one length, one
binary row each; everything below happens among vectors of one length. Queries of several shards form a block. Every (block, shard) tile is
one equi-join row; a task multiplies it in strips, keeps each query's best k
of the tile by partial selection, and the lists of a query merge as a tree:
``FAN_IN`` lists at a time, round by round, so no task sees more than a
bounded number of lists of a query.

Products and the combined (score, place) key are exact: float64 where every
sum fits 53 bits, 64-bit integers beyond (scores wrap modulo 2^64 only past
that). Equal scores go to the smaller id, repeated ids to the row packed
first.

A vector that is null, empty, or holds a null or non-finite component takes no
part, nor does a row with a null id. Vectors of different lengths have no inner
product: each meets those of its own length. A vector of any length is read whole.
Repeated rows are candidates and queries of their own; a query never meets
its own row. With fewer than k candidates all are returned; empty tables give
no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Vectors in a shard, queries multiplied at once, lists merged at once.
SHARD, STRIP, FAN_IN = 8_192, 256, 16
#: Shards whose queries make one block; the corpus is sent once a block.
BLOCK = 48
PACKED = "part int, seq int, dim int, ids binary, vectors binary, places binary, n int"
RESULT = "query_id long, rank int, vec_id long, score long"


def quantise(x: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(x.astype(np.float64) * scale).astype(np.int64)


def _narrow(v: np.ndarray) -> bytes:
    """Little-endian integers of the least width that holds all, after a byte that names it."""
    top = int(np.abs(v).max(initial=0))
    width = 2 if top < 2**15 else 4 if top < 2**31 else 8
    return bytes([width]) + v.astype(f"<i{width}").tobytes()


def _wide(raw: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(raw, f"<i{raw[0]}", offset=1).astype(np.int64).reshape(-1, dim)


def _pack(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq, held, have = TaskContext.get().partitionId(), 0, {}, {}  # by length

        def emit(dim, n):
            nonlocal seq
            i, v, q = (np.concatenate([h[k] for h in held[dim]]) for k in range(3))
            o = np.argsort(i[:n], kind="stable")  # places ascend by id
            cols = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([dim], pa.int32()),
                    pa.array([i[:n][o].tobytes()], pa.binary()), pa.array([_narrow(v[:n][o])], pa.binary()),
                    pa.array([np.flatnonzero(q[:n][o]).astype(np.int64).tobytes()], pa.binary()), pa.array([n], pa.int32())]
            held[dim], have[dim], seq = [(i[n:], v[n:], q[n:])], len(i) - n, seq + 1
            return pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in PACKED.split(", ")])

        for b in batches:
            ids, is_query = b.column(0).to_numpy(zero_copy_only=False), np.array([bool(x) for x in b.column(2).to_pylist()], bool)
            lens = b.column(1).value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(lens).tolist():
                at = np.flatnonzero(lens == dim)
                flat = b.column(1).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                held.setdefault(dim, []).append((ids[at], quantise(flat, scale), is_query[at]))
                have[dim] = have.get(dim, 0) + len(at)
                while have[dim] >= SHARD:
                    yield emit(dim, SHARD)
        for dim in sorted(held):
            if have[dim]:
                yield emit(dim, have[dim])
    return run


def pack(vectors: DataFrame, is_query: Column, scale: int) -> tuple[DataFrame, dict[int, int]]:
    """(shards with a number ``g``, dense among those of their length; shards of each length)."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = (vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), is_query.alias("q"))
            .filter("vec_id is not null and size(embedding) > 0").filter(whole))
    n = max(1, rows.count())
    shards = written(rows.repartition(-(-n // SHARD)).mapInArrow(_pack(scale), PACKED), "shards")
    names = sorted((r[0], r[1], r[2]) for r in shards.select("dim", "part", "seq").collect())  # one row a shard
    count: dict[int, int] = {}
    numbered = []
    for dim, part, seq in names:
        numbered.append((part, seq, count.get(dim, 0)))
        count[dim] = count.get(dim, 0) + 1
    dense = vectors.sparkSession.createDataFrame(numbered, "part int, seq int, g int")
    return shards.join(F.broadcast(dense), ["part", "seq"]).drop("part", "seq"), count


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products, by float64 where that is exact."""
    if float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1] < 2**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


def best_of_tile(q: np.ndarray, own: np.ndarray | None, c: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, scores, ids) of the k best of the ascending ``ids`` for each
    query; ``own``: place of each query's own row, if it is in this shard."""
    none = np.iinfo(np.int64).min
    for at in range(0, len(q), STRIP):
        s = _products(q[at:at + STRIP], c)
        if own is not None:
            s[np.arange(len(s)), own[at:at + STRIP]] = none
        n = s.shape[1]
        least = np.partition(s, n - k, axis=1)[:, n - k] if n > k else np.full(len(s), none)
        row, place = np.nonzero((s >= least[:, None]) & (s != none))
        ends = np.searchsorted(row, np.arange(len(s) + 1))
        for r in range(len(s)):
            pick = place[ends[r]:ends[r + 1]]
            if len(pick) > k:  # of the equal last scores, the smaller ids: places ascend by id
                above = s[r, pick] > least[r]
                pick = np.concatenate((pick[above], pick[~above][:k - above.sum()]))
            yield at + r, s[r, pick], ids[pick]


LIST = pa.schema([("dim", pa.int32()), ("q_shard", pa.int32()), ("q_place", pa.int64()), ("query_id", pa.int64()), ("g", pa.int32()),
                  ("top", pa.list_(pa.struct([("worse", pa.int64()), ("vec_id", pa.int64())])))])
LIST_SQL = "dim int, q_shard int, q_place long, query_id long, g int, top array<struct<worse: long, vec_id: long>>"


def _tiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for j in range(b.num_rows):
                row = {n: b.column(i)[j].as_py() for i, n in enumerate(b.schema.names)}
                dim = row["dim"]
                ids, c = np.frombuffer(row["ids"], np.int64), _wide(row["vectors"], dim)
                for block in row["queries"]:
                    places = np.frombuffer(block["places"], np.int64)
                    qids = np.frombuffer(block["ids"], np.int64)
                    own = places if block["g"] == row["g"] else None
                    out = [{"dim": dim, "q_shard": block["g"], "q_place": int(places[i]), "query_id": int(qids[i]), "g": row["g"],
                            "top": [{"worse": -x, "vec_id": y} for x, y in zip(s.tolist(), v.tolist(), strict=True)]}
                           for i, s, v in best_of_tile(_wide(block["vectors"], dim), own, c, ids, k)]
                    yield pa.RecordBatch.from_pylist(out, schema=LIST)
    return run


def _queries():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                q = np.frombuffer(row["places"], np.int64)
                if len(q):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["dim"]], pa.int32()), pa.array([row["g"]], pa.int32()), pa.array([np.frombuffer(row["ids"], np.int64)[q].tobytes()], pa.binary()),
                         pa.array([_narrow(_wide(row["vectors"], row["dim"])[q])], pa.binary()), pa.array([row["places"]], pa.binary())],
                        names=["dim", "g", "ids", "vectors", "places"])
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``vectors`` (vec_id,
    embedding) that are queries; score is the integer inner product."""
    shards, count = pack(vectors, is_query, scale)
    if not count:
        return vectors.sparkSession.createDataFrame([], RESULT)
    sizes = vectors.sparkSession.createDataFrame(list(count.items()), "dim int, shards int")  # one row a length
    blocks = (shards.select("dim", "g", "ids", "vectors", "places").mapInArrow(_queries(), "dim int, g int, ids binary, vectors binary, places binary")
              .groupBy("dim", F.floor(F.col("g") / BLOCK).cast("int").alias("block")).agg(F.collect_list(F.struct("g", "ids", "vectors", "places")).alias("queries")))
    # one row a cell of a length's grid (shard, block), found by an equi-join on both
    n_blocks = F.floor((F.col("shards") - 1) / BLOCK).cast("int")
    left = shards.join(F.broadcast(sizes), "dim").select("dim", "g", "ids", "vectors", F.explode(F.sequence(F.lit(0), n_blocks)).alias("block"))
    right = blocks.join(F.broadcast(sizes), "dim").select("dim", "queries", "block", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("g"))
    lists = left.join(right, ["dim", "g", "block"]).select("dim", "g", "ids", "vectors", "queries").mapInArrow(_tiles(k), LIST_SQL)
    n = max(count.values())
    while True:  # tree merge: FAN_IN lists of a query at a time
        n = -(-n // FAN_IN)
        lists = (lists.groupBy("dim", "q_shard", "q_place", "query_id", F.floor(F.col("g") / FAN_IN).cast("int").alias("g"))
                 .agg(F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k).alias("top")))
        if n <= 1:
            break
    return lists.select("query_id", F.posexplode("top").alias("pos", "t")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"), (-F.col("t.worse")).alias("score"))
