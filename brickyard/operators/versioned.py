"""Merges that readers see whole: partitions are written beside the old ones
and become visible by one small pointer.

A target is a folder of plain Parquet. Every load writes the partitions it
changes into a folder of its own under ``parts``, and the keys it touches into
one under ``keys``; nothing is overwritten. The pointer is the newest
``current/v=N``: one row per live partition and key bucket with the folder that
holds it, and the ids of the loads that are in. Spark's commit of that one
small write is the switch: before it a reader has the old table, after it the
new one, and a load that was killed on the way leaves only folders that
nobody reads. A load whose id is in already changes nothing.

``keys`` maps every non-null key to its partition, in buckets by the key's
hash. A load reads the buckets of its own keys only, so keys that move between
partitions are found without reading the table's keys, and only partitions
that hold an incoming key, or take one in, are read and written again.

One writer at a time; a second one that commits the same number fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from brickyard.operators.clean import order_columns, silver_clean
from brickyard.operators.load import assert_unique, upsert
from brickyard.session import staged

_POINTER = "kind string, id string, folder string"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


class Version(NamedTuple):
    """A committed state: its number, the folder of each live partition and
    key bucket, the loads that are in, schema and partition columns."""
    number: int
    parts: dict[str, str]
    keys: dict[str, str]
    loads: frozenset[str]
    schema: StructType
    partition_cols: tuple[str, ...]
    buckets: int


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed states, oldest first."""
    path, fs = _path(spark, f"{root.rstrip('/')}/current")
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    done = [int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit() and fs.exists(_path(spark, f"{root.rstrip('/')}/current/{n}/_SUCCESS")[0])]
    return sorted(done)


def current(spark: SparkSession, root: str, number: int | None = None) -> Version | None:
    """The newest committed state of ``root`` (or the one of that number), None before the first load.
    Its rows number the partitions and key buckets."""
    have = versions(spark, root)
    if not have:
        return None
    n = have[-1] if number is None else number
    by: dict[str, dict[str, str]] = {"part": {}, "key": {}, "load": {}, "schema": {}, "by": {}, "buckets": {}}
    for r in spark.read.schema(_POINTER).parquet(f"{root.rstrip('/')}/current/v={n}").collect():
        by[r.kind][r.id] = r.folder
    schema = StructType.fromJson(json.loads(next(iter(by["schema"]))))
    return Version(n, by["part"], by["key"], frozenset(by["load"]), schema, tuple(c for _, c in sorted((v, k) for k, v in by["by"].items())), int(next(iter(by["buckets"]))))


def _read(spark: SparkSession, root: str, v: Version, ids: Sequence[str]) -> DataFrame:
    """The partitions ``ids`` of a state."""
    if not ids:
        return spark.createDataFrame([], v.schema)
    paths = [f"{root.rstrip('/')}/parts/{v.parts[i]}/{i}".rstrip("/") for i in ids]
    schema = StructType([*v.schema.fields]).add("load", StringType())
    return (spark.read.schema(schema).option("basePath", f"{root.rstrip('/')}/parts").parquet(*paths).select(*v.schema.names))


def read_current(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The table as of its newest committed load (or as of state ``number``)."""
    v = current(spark, root, number)
    if v is None:
        raise ValueError(f"{root} holds no committed load")
    return _read(spark, root, v, sorted(v.parts))


def _values(cols: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("string") for c in cols]) if cols else F.array().cast("array<string>")


def _folder(spark: SparkSession, cols: Sequence[str], values: Sequence[str | None]) -> str:
    """The partition's path below a load's folder, as Spark writes it."""
    util = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(util.getPartitionPathString(c, v) for c, v in zip(cols, values, strict=True))


def _key_rows(df: DataFrame, key: Sequence[str], cols: Sequence[str], buckets: int) -> DataFrame:
    return df.dropna(subset=list(key)).select(*key, _values(cols).alias("__part"), F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias("__bucket"))


def _known(spark: SparkSession, root: str, v: Version, buckets: Sequence[str], key: Sequence[str]) -> DataFrame:
    """The key map's rows in ``buckets``."""
    have = [f"{root.rstrip('/')}/keys/{v.keys[b]}/__bucket={b}" for b in buckets if b in v.keys]
    schema = StructType([f for f in v.schema.fields if f.name in key]).add("__part", ArrayType(StringType())).add("__bucket", IntegerType()).add("load", StringType())
    schema = StructType([schema[k] for k in key] + schema.fields[len(key):])
    if not have:
        return spark.createDataFrame([], schema).drop("load")
    return spark.read.schema(schema).option("basePath", f"{root.rstrip('/')}/keys").parquet(*have).drop("load")


def merge(source: DataFrame, root: str, key, partition_cols: Sequence[str] = (), load: str | None = None,
          preserve: Sequence[str] = (), validate: bool = True, latest_by: Sequence = (), tie_breakers: Sequence = (),
          key_buckets: int = 64) -> Version:
    """Upsert ``source`` into the table at ``root`` by ``key`` and commit;
    returns the new state (the present one if the load ``load`` is in already).

    Matched rows take the source's version wherever their old row lies,
    unmatched and null-key rows insert, ``preserve`` columns keep the target's
    value; with ``latest_by`` older rows replace nothing (see ``upsert``).
    Duplicate source keys raise, on the first load too. The first load sets the
    number of the key map's buckets: a load reads and rewrites those of its
    keys, so give a table about one for every million keys. Lists that come
    to the driver number the partitions and key buckets that the load touches.
    """
    spark, root = source.sparkSession, root.rstrip("/")
    ks, cols = [key] if isinstance(key, str) else list(key), list(partition_cols)
    old = current(spark, root)
    if old is not None:
        if load is not None and load in old.loads:
            return old
        if list(old.partition_cols) != cols:
            raise ValueError(f"{root} is partitioned by {list(old.partition_cols)}")
    batch = staged(source, "batch")
    if validate:
        assert_unique(batch, ks)
    name = f"load={uuid.uuid4().hex}"
    incoming = {tuple(r[0]) for r in batch.select(_values(cols).alias("v")).distinct().collect()}
    n_buckets = old.buckets if old else key_buckets
    keys = _key_rows(batch, ks, cols, n_buckets)
    buckets = sorted(str(r[0]) for r in keys.select("__bucket").distinct().collect())
    schema = batch.schema
    if old is None:
        merged, owned, touched = batch, keys, set()
    else:
        known = _known(spark, root, old, buckets, ks)
        holders = {tuple(r[0]) for r in known.join(keys.select(*ks), ks, "left_semi").select("__part").distinct().collect()}
        touched = {_folder(spark, cols, p) for p in incoming | holders}
        before = _read(spark, root, old, sorted(touched & set(old.parts)))
        merged = upsert(before.select(*batch.columns), batch, ks, preserve=preserve, validate=False, latest_by=latest_by, tie_breakers=tie_breakers)
        owned = known.join(keys.select(*ks), ks, "left_anti").select(*keys.columns).unionByName(keys)
    writer = merged.write.partitionBy(*cols) if cols else merged.write
    writer.parquet(f"{root}/parts/{name}")
    _write_keys(owned, f"{root}/keys/{name}")
    written = spark.read.schema(schema).parquet(f"{root}/parts/{name}").select(_values(cols).alias("v")).distinct().collect()
    parts = {k: f for k, f in (old.parts if old else {}).items() if k not in touched}
    parts.update({_folder(spark, cols, r[0]): name for r in written})
    kept = {**(old.keys if old else {}), **{b: name for b in buckets}}
    state = Version(old.number + 1 if old else 0, parts, kept, (old.loads if old else frozenset()) | ({load} if load is not None else set()), schema, tuple(cols), n_buckets)
    _commit(spark, root, state)
    return state


def merge_silver(bronze: DataFrame, root: str, columns: Mapping[str, tuple[object, str]], keys: Sequence[str],
                 tie_breakers: Sequence = (), order_by: Sequence = ("src_upd_ts",), load: str | None = None, buckets: int = 64) -> Version:
    """Keep a silver table up to date from batches of bronze rows: the batch's
    winners (``silver_clean``) are merged with the stored winners of their keys
    only, by the same order. The table keeps each winner's order columns, so
    late and tied rows end as in a full rebuild; it is dealt into ``buckets``
    partitions by key, and those without a touched key are not read."""
    _, ob, tb = order_columns(columns, order_by, tie_breakers)
    won = silver_clean(bronze, columns, keys, tie_breakers, order_by, keep_order=True)
    won = won.withColumn("__bucket_of", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    return merge(won, root, list(keys), ["__bucket_of"], load, validate=False, latest_by=ob, tie_breakers=tb, key_buckets=buckets)


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    """The silver rows that ``merge_silver`` keeps at ``root``."""
    df = read_current(spark, root)
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def _write_keys(rows: DataFrame, path: str) -> None:
    rows.repartition("__bucket").write.partitionBy("__bucket").parquet(path)


def _commit(spark: SparkSession, root: str, v: Version) -> None:
    rows = [("part", k, f) for k, f in v.parts.items()] + [("key", k, f) for k, f in v.keys.items()] + [("load", x, "") for x in v.loads]
    rows += [("schema", v.schema.json(), ""), ("buckets", str(v.buckets), ""), *(("by", c, f"{i:04d}") for i, c in enumerate(v.partition_cols))]
    path, fs = _path(spark, f"{root}/current/v={v.number}")
    if fs.exists(path) and not fs.exists(_path(spark, f"{root}/current/v={v.number}/_SUCCESS")[0]):
        fs.delete(path, True)  # what a killed commit left
    spark.createDataFrame(rows, _POINTER).coalesce(1).write.parquet(f"{root}/current/v={v.number}")


def remove_unread(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete what no one of the ``keep`` newest states refers to; returns the folders."""
    root, have = root.rstrip("/"), versions(spark, root)
    if not have:
        return []
    states = [current(spark, root, n) for n in have[-keep:]]
    gone = []
    for kind, live in (("parts", {f for v in states for f in v.parts.values()}), ("keys", {f for v in states for f in v.keys.values()}),
                       ("current", {f"v={n}" for n in have[-keep:]})):
        path, fs = _path(spark, f"{root}/{kind}")
        for s in fs.listStatus(path) if fs.exists(path) else []:
            if s.getPath().getName() not in live:
                fs.delete(s.getPath(), True)
                gone.append(f"{kind}/{s.getPath().getName()}")
    return sorted(gone)
