"""Session helpers: a tuned builder for local runs and the checkpoint folder rule."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings that matter at any scale: AQE re-plans joins from runtime sizes
# (size-checked broadcast), coalesces small shuffle partitions and splits
# skewed join partitions; ANSI keeps failed casts loud.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "brickyard",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the defaults above.

    On a cluster the master and memory come from spark-submit; locally we use
    ``local[N]`` with shuffle partitions matched to cores instead of 200.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage.

    A cluster names it in ``spark.checkpoint.dir``; we read that setting from
    the session and only pick our own folder when it is unset and the master
    is local (tests); any other master raises. Never a local checkpoint:
    those die with their executor.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            # a folder of the driver's own would be empty or partial on every other machine
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="brickyard-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def staged(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: its
    plan runs once however often the result is used, and executors that are
    lost cost no recomputation of what stands above."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_together(**tables: DataFrame) -> dict[str, DataFrame]:
    """``staged`` for several tables that don't read each other, as jobs side by side."""
    with ThreadPoolExecutor(len(tables)) as pool:
        jobs = {name: pool.submit(staged, df, name) for name, df in tables.items()}
        return {name: job.result() for name, job in jobs.items()}


def staged_counting(df: DataFrame, tag: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``staged``, and aggregates over its rows taken while they are written."""
    seen = Observation()
    out = staged(df.observe(seen, *(c.alias(name) for name, c in metrics.items())), tag)
    return out, seen.get
