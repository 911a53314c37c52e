"""Source scans and table sinks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on the file system it names (HDFS, object store, local)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_source(spark: SparkSession, base: str, name: str, schema: StructType | str | None = None,
                fmt: str = "parquet") -> DataFrame:
    """Scan ``{base}/{name}.parquet`` (or a directory / catalog table when
    ``base`` is None). Column pruning and filter pushdown happen in the scan."""
    if base is None:
        return spark.table(name)
    path = f"{base.rstrip('/')}/{name.removesuffix(f'.{fmt}')}.{fmt}"
    if not path_exists(spark, path) and path_exists(spark, f"{base.rstrip('/')}/{name}"):
        path = f"{base.rstrip('/')}/{name}"
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_seed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Typed CSV seed with a header row (no schema inference)."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def _norm(p: str) -> str:
    p = p.rstrip("/")
    for pre in ("file://", "file:"):
        if p.startswith(pre):
            p = p[len(pre):]
    return p


def write_table(df: DataFrame, path: str | None = None, name: str | None = None,
                mode: str = "overwrite", partition_by: Iterable[str] | None = None,
                properties: Mapping[str, str] | None = None, fmt: str = "parquet",
                bucket_by: tuple[int, list[str]] | None = None) -> None:
    """Full-refresh sink to ``path`` (files) or ``name`` (catalog table).

    Refuses to overwrite a location the plan itself reads (which would
    delete its own input mid-job): write a new version path instead and
    swap it in. ``properties`` become table properties for catalog tables.
    """
    if path is not None and mode == "overwrite":
        target = _norm(path)
        for f in df.inputFiles():
            if _norm(f) == target or _norm(f).startswith(target + "/"):
                raise ValueError(f"refusing to overwrite {path}: the plan reads it")
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by is not None:
        if name is None:
            raise ValueError("bucket_by needs a catalog table name")
        n, cols = bucket_by
        w = w.bucketBy(n, *cols).sortBy(*cols)
    if name is not None:
        if path is not None:
            w = w.option("path", path)
        w.saveAsTable(name)
        if properties:
            props = ", ".join(f"'{k}'='{v}'" for k, v in properties.items())
            df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({props})")
    else:
        w.save(path)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """View sink: register the lazy plan under ``name`` (inlined by Catalyst)."""
    df.createOrReplaceTempView(name)
    return df
