"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brickyard.session import checkpoint_dir

#: A side is broadcast only below this size (rows are counted, their width is stated); beyond it the join shuffles.
BROADCAST_BYTES = 128 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Cut lineage through a Parquet table in the shared checkpoint folder."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"_{name}"
    return name


def parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def small_or_shuffled(df: DataFrame, rows: int, width: int = 128) -> DataFrame:
    """Hint a broadcast when the counted rows, of ``width`` bytes at most, allow
    it; otherwise leave the join to shuffle."""
    return F.broadcast(df) if rows * width <= BROADCAST_BYTES else df


#: Rows of an Arrow batch where whole texts go to workers.
TEXT_BATCH = 2_000


def text_batches(spark: SparkSession) -> None:
    """Bound Arrow batches for tables of whole texts: of Spark's default
    10,000 rows, each task holds some 100 MB, in the JVM and again in the
    worker. A batch size that the session sets itself stays. Bytes of a batch
    are bounded by Spark (``maxBytesPerBatch``, 64 MB unless the session says
    otherwise). The setting holds for the session: plans read it when they run."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(TEXT_BATCH))


def lean(kernel):
    """``kernel`` over batches, after which the worker's freed memory goes back
    to the system: workers are reused, and would keep their peak otherwise."""
    def run(batches):
        try:
            yield from kernel(batches)
        finally:
            pa.default_memory_pool().release_unused()
            libc = ctypes.CDLL(None)
            if hasattr(libc, "malloc_trim"):
                libc.malloc_trim(0)
    return run


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker process. Kernels are
    pickled by value, so their own module globals are new in every task."""
    mod = sys.modules.setdefault("_brickyard_worker_cache", types.ModuleType("_brickyard_worker_cache"))
    return mod.__dict__.setdefault("cache", {})


def global_rank(df: DataFrame, order: list[Column], tag: str) -> DataFrame:
    """Add ``rank``: the row's 0-based place in the total order of ``order``.
    ``df`` is evaluated twice (sampled, then shuffled): write it first if it is dear.

    One range shuffle; equal or hot keys spread over partitions as long as the
    order's last columns tell rows apart. The sorted rows are written once
    (so that a retry reads the same rows), counted by partition, and each
    partition's offset (one row a partition) is joined back.
    """
    spark = df.sparkSession
    s = written(df.repartitionByRange(parts(spark), *order).sortWithinPartitions(*order)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), tag)
    counts = sorted((r[0], r[1]) for r in s.groupBy("_pid").count().collect())  # one row a partition
    offs, at = [], 0
    for pid, n in counts:
        offs.append((pid, at))
        at += n
    o = spark.createDataFrame(offs, "_pid int, _off long")
    return s.join(F.broadcast(o), "_pid").withColumn("rank", F.col("_off") + F.col("_row")).drop("_pid", "_row", "_off")


def connected_components(edges: DataFrame, tag: str) -> DataFrame:
    """(node, label): label is the least node reachable over ``edges`` (a, b).

    Alternating large-star and small-star rounds; every round is two
    aggregations and joins on node, written to the shared folder. Rounds grow
    with the logarithm of the longest path. Nodes without an edge to another
    node are not returned.
    """
    e = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .filter("a <> b").distinct(), tag)
    before = None
    while True:
        # large star: a points to the least neighbour of its lower neighbour b. Written, so that the
        # join below is one of two plain shuffles and a node with very many neighbours can be split
        low = written(e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), "m"), f"{tag}-low")
        large = e.join(low, "b", "left").select("a", F.coalesce("m", "b").alias("b")).filter("a <> b").distinct()
        # small star: a's lower neighbours and a itself point to the least of them
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low2, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low2.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        e = written(small, tag)
        now = e.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.count_distinct("a")).first()
        if now[0] == now[2] and now == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
                e.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        before = now


_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (wrapping arithmetic)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    c = worker_cache()
    have = c.get(("pow", int(base)))
    if have is None or len(have) < n:
        m = max(n, 1 << 16)
        full = np.full(m, base, dtype=np.uint64)
        full[0] = 1
        have = c[("pow", int(base))] = np.multiply.accumulate(full)
    return have[:n]


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes and start offsets of the words ``[^\\x20\\x09-\\x0D]+`` of
    UTF-8 bytes, A-Z lower-cased; polynomial prefix sums, so no Python loop."""
    b = np.frombuffer(raw.lower(), dtype=np.uint8)
    word = ~((b == 32) | ((b >= 9) & (b <= 13)))
    edge = np.flatnonzero(np.diff(np.concatenate(([0], word.view(np.int8), [0]))))
    s, e = edge[::2], edge[1::2]
    if not len(s):
        return np.empty(0, np.uint64), s
    pre = np.empty(len(b) + 1, dtype=np.uint64)
    pre[0] = 0
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * powers(_P, len(b)), out=pre[1:])
    h = (pre[e] - pre[s]) * powers(_P_INV, len(b))[s]
    return mix64(h ^ ((e - s).astype(np.uint64) << np.uint64(48))), s


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles in order; the whole sequence as one if shorter."""
    n = len(words)
    if n == 0:
        return words
    m = max(1, n - k + 1)
    out = np.zeros(m, dtype=np.uint64)
    for i in range(min(k, n)):
        out = mix64(out + words[i:i + m] + np.uint64(i + 1))
    return out
