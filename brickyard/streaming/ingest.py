"""``availableNow`` file ingest: each micro-batch is stamped and upserted
into a versioned Parquet target. The stream checkpoint (in the shared
checkpoint folder) records which files were loaded, replacing the
``col > max(col)`` watermark -- so late files on an old date still load,
and a lost executor or restarted job resumes without duplicates."""

from __future__ import annotations

import json
from functools import reduce
from hashlib import md5
from operator import or_
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brickyard.operators.clean import dedupe_latest
from brickyard.operators.load import merge_partitions, upsert
from brickyard.operators.star import bronze_capture
from brickyard.session import checkpoint_dir


def _latest_version(spark: SparkSession, root: str) -> str | None:
    """Newest committed ``v=N`` under ``root`` on whatever file system the
    path names (HDFS, object stores, local), via the session's Hadoop conf."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    vs = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v=") and name[2:].isdigit() and \
                fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            vs.append(int(name[2:]))
    return f"{root.rstrip('/')}/v={max(vs)}" if vs else None


def _numbered(spark: SparkSession, root: str, load: str) -> tuple[int, bool]:
    """The version that the load ``load`` makes and whether it is committed.
    The number is noted under the load's id before anything is written."""
    jvm, fs_of = spark.sparkContext._jvm, lambda p: p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    root = root.rstrip("/")
    notes = jvm.org.apache.hadoop.fs.Path(f"{root}/_loads")
    fs = fs_of(notes)
    tail = f"-{quote(load, safe='')}"
    for st in fs.listStatus(notes) if fs.exists(notes) else []:
        name = st.getPath().getName()
        if name.endswith(tail) and name[:-len(tail)].isdigit():
            n = int(name[:-len(tail)])
            return n, fs.exists(jvm.org.apache.hadoop.fs.Path(f"{root}/v={n}/_SUCCESS"))
    cur = _latest_version(spark, root)
    n = 0 if cur is None else int(cur.rsplit("=", 1)[1]) + 1
    fs.create(jvm.org.apache.hadoop.fs.Path(f"{root}/_loads/{n}{tail}"), True).close()
    return n, False


def ingest_available(spark: SparkSession, source_dir: str, schema: StructType | str, target_root: str,
                     key, src_sys: str = "raw", run_ts=None, name: str = "ingest",
                     max_files_per_trigger: int | None = None,
                     partition_cols: list[str] | None = None,
                     order_by: list[str] | None = None, track_moves: bool = True) -> str | None:
    """Load every new file under ``source_dir`` into ``target_root`` and return
    the path of the newest committed version (``{target_root}/v=N``).

    Each micro-batch reads the current version, upserts the batch by ``key``
    and writes version N+1 (never overwriting what it reads). Versions are
    whole tables, so readers always see a committed snapshot. With
    ``partition_cols`` the target is instead one partitioned table and each
    batch rewrites only the partitions it touches (``merge_partitions``,
    looking for moved keys unless ``track_moves`` is off); the return value is
    then ``target_root``.

    A key may come more than once in a drop: the latest row wins, by
    ``order_by`` (descending; default the file's modification time), then by
    file path and content. With ``order_by``, the row's own time, it wins over
    batches too: an older row in a later drop does not replace a newer one.
    Rows with a null key are all kept.

    The stream's checkpoint goes by ``name``, source and target. Every batch is
    recorded under the stream's id and its epoch: one that comes again, because
    the job died before the stream noted it, changes nothing or is finished.
    """
    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/stream-{name}-{md5(f'{source_dir}|{target_root}'.encode()).hexdigest()[:16]}"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    cols = stream.columns
    stream = stream.select("*", F.col("_metadata.file_modification_time").alias("__time"), F.col("_metadata.file_path").alias("__path"))

    def load_batch(batch: DataFrame, epoch: int) -> None:
        stream_id = json.loads(spark.read.text(f"{ckpt}/metadata").first()[0])["id"]
        merge_batch(spark, batch, f"{stream_id}:{epoch}", cols, target_root, key, src_sys, run_ts, partition_cols, order_by, track_moves)

    q = (stream.writeStream.foreachBatch(load_batch)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return target_root if partition_cols else _latest_version(spark, target_root)


def merge_batch(spark: SparkSession, batch: DataFrame, load: str, cols: list[str], target_root: str, key, src_sys: str, run_ts,
                partition_cols: list[str] | None, order_by: list[str] | None, track_moves: bool) -> None:
    """Load one batch (``cols`` beside ``__time`` and ``__path`` of its files) under the id ``load``."""
    keys = [key] if isinstance(key, str) else list(key)
    null_key = reduce(or_, (F.col(k).isNull() for k in keys))
    ties = [F.xxhash64(*cols)]
    latest = dedupe_latest(batch.where(~null_key), keys, order_by or ["__time"], [F.col("__path").desc(), *ties])
    new = bronze_capture(latest.unionByName(batch.where(null_key)).select(*cols), src_sys, run_ts)
    if partition_cols:
        merge_partitions(new, target_root, key, partition_cols, track_moves=track_moves, load=load, latest_by=order_by or (), tie_breakers=ties)
        return
    n, done = _numbered(spark, target_root, load)
    if done:
        return
    cur = _latest_version(spark, target_root)
    out = new if cur is None else upsert(spark.read.parquet(cur), new, key, validate=False, latest_by=order_by or (), tie_breakers=ties)
    out.write.mode("overwrite").parquet(f"{target_root.rstrip('/')}/v={n}")


def latest_by_key(stream: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The latest row per key of a stream, kept as state: ``max_by`` over the
    row's own order (descending, a null counts as latest, then by content), a
    JVM aggregate whose state is one row a key. In update mode each batch
    gives the keys it touches with their latest rows so far; late, older rows
    change nothing. Rows with a null key share one state row: filter them first.
    On a batch DataFrame it gives the same rows as over the whole stream."""
    rest = [c for c in stream.columns if c not in keys]
    order = F.struct(*[x for c in order_by for x in (F.col(c).isNull(), F.col(c))], F.xxhash64(*stream.columns))
    return (stream.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__row"))
            .select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in stream.columns]))
