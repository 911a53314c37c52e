"""Incremental loads: high-water-mark filter, schema sync and upsert (merge).

Parquet tables have no MERGE, so an upsert is expressed as
``target ⟕anti source-keys ∪ source``: one join on the unique key. The
result must be written to a *new* location (``sources.io.write_table``
refuses to overwrite a path the plan reads) and then swapped in.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from hashlib import md5
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brickyard.operators.clean import dedupe_latest
from brickyard.session import checkpoint_dir, staged


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def incremental_filter(source: DataFrame, target: DataFrame | str | None, col: str,
                       inclusive: bool = False, on_empty: str = "none",
                       target_col: str | None = None) -> DataFrame:
    """Rows of ``source`` past the target's high-water mark ``max(col)``.

    The mark is a scalar subquery: Spark runs it first and pushes
    ``col > mark`` into the source scan. Strict ``>`` by default, so rows
    arriving later on the max value are skipped; ``inclusive=True`` uses
    ``>=`` (safe when followed by an upsert). With an empty or all-null
    target the mark is null: ``on_empty="none"`` loads nothing (parity),
    ``"all"`` loads everything. ``target=None`` means a first run: all rows.
    A path as ``target`` takes the mark from the files' footers (``footer_mark``).
    """
    if target is None:
        return source
    if on_empty not in ("none", "all"):
        raise ValueError("on_empty must be 'none' or 'all'")
    mark = (F.lit(footer_mark(source.sparkSession, target, target_col or col)) if isinstance(target, str)
            else target.agg(F.max(target_col or col)).scalar())
    c = F.col(col)
    cmp = (c >= mark) if inclusive else (c > mark)
    if on_empty == "all":
        cmp = F.when(mark.isNull(), F.lit(True)).otherwise(cmp)
    return source.where(cmp)


def footer_mark(spark: SparkSession, path: str, col: str):
    """``max(col)`` of the Parquet table at ``path``, answered from its files'
    footers: the V2 source takes the aggregation over and reads no column
    (whole and floating numbers, booleans and dates; of other types, such as
    timestamps, the one column is read). None for an empty table. The session's
    settings are as before afterwards."""
    return _footer_plan(spark, path, col, lambda df: df.first()[0])


def _footer_plan(spark: SparkSession, path: str, col: str, use):
    own = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k, None) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        return use(spark.read.parquet(path).agg(F.max(col)))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}  # digits that a whole type may need
_RANK = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


class SchemaChange(ValueError):
    """A column's incoming type can't hold what the target has."""


def merged_type(old: T.DataType, new: T.DataType, where: str) -> T.DataType:
    """The narrowest type that holds both the target's values and the incoming
    ones: whole numbers widen along byte, short, int, long and into decimals,
    decimals to the larger scale and whole part, float to double, date to
    timestamp_ntz, structs field by field (fields of the incoming side, in its
    order), arrays and maps by their elements. Anything else that differs
    raises ``SchemaChange`` by the column's path."""
    if old == new or isinstance(old, T.NullType):
        return new
    if isinstance(new, T.NullType):
        return old
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        have = {f.name.lower(): f for f in old.fields}
        return T.StructType([T.StructField(f.name, merged_type(have[f.name.lower()].dataType, f.dataType, f"{where}.{f.name}")
                                           if f.name.lower() in have else f.dataType) for f in new.fields])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(merged_type(old.elementType, new.elementType, f"{where}.element"))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(merged_type(old.keyType, new.keyType, f"{where}.key"), merged_type(old.valueType, new.valueType, f"{where}.value"))
    kinds = type(old), type(new)
    if all(k in _RANK for k in kinds):
        return max(old, new, key=lambda t: _RANK.index(type(t)))
    if all(k in _WHOLE or k is T.DecimalType for k in kinds):
        sides = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_WHOLE[type(t)], 0) for t in (old, new)]
        whole, scale = max(s[0] for s in sides), max(s[1] for s in sides)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    if kinds in ((T.FloatType, T.DoubleType), (T.DoubleType, T.FloatType)) or set(kinds) <= {T.ByteType, T.ShortType, T.IntegerType, T.DoubleType}:
        return T.DoubleType()
    if set(kinds) == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    raise SchemaChange(f"{where}: {new.simpleString()} can't replace {old.simpleString()}")


def _fits(old: T.DataType, new: T.DataType) -> bool:
    """Whether a struct, at any depth, has to be rebuilt field by field."""
    if isinstance(new, T.StructType):
        return isinstance(old, T.StructType) and [f.name for f in old.fields] == [f.name for f in new.fields] and all(
            _fits(a.dataType, b.dataType) for a, b in zip(old.fields, new.fields, strict=True))
    if isinstance(new, T.ArrayType):
        return _fits(old.elementType, new.elementType)
    if isinstance(new, T.MapType):
        return _fits(old.keyType, new.keyType) and _fits(old.valueType, new.valueType)
    return True


def _reshaped(c: Column, old: T.DataType, new: T.DataType) -> Column:
    """A column of type ``old`` as ``new``: fields by name at every depth, missing ones null."""
    if _fits(old, new):
        return c if old == new else c.cast(new)
    if isinstance(new, T.StructType):
        have = {f.name.lower(): f for f in old.fields}
        parts = [(_reshaped(c.getField(have[f.name.lower()].name), have[f.name.lower()].dataType, f.dataType) if f.name.lower() in have
                  else F.lit(None).cast(f.dataType)).alias(f.name) for f in new.fields]
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(new, T.ArrayType):
        return F.transform(c, lambda x: _reshaped(x, old.elementType, new.elementType))
    return F.transform_values(c, lambda k, v: _reshaped(v, old.valueType, new.valueType))


def synced_schema(target: T.StructType, incoming: T.StructType) -> T.StructType:
    """The incoming columns, in their order, with types that hold both sides (``merged_type``)."""
    have = {f.name.lower(): f for f in target.fields}
    return T.StructType([T.StructField(f.name, merged_type(have[f.name.lower()].dataType, f.dataType, f.name)
                                       if f.name.lower() in have else f.dataType) for f in incoming.fields])


def _as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    have = {f.name.lower(): f for f in df.schema.fields}
    return df.select(*[(_reshaped(F.col(have[f.name.lower()].name), have[f.name.lower()].dataType, f.dataType) if f.name.lower() in have
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def sync_schema(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Reshape ``target`` to ``incoming``'s columns, nested ones too: new columns
    and fields are null in old rows, dropped ones disappear, and types widen to
    what holds both sides; a type that can't raises ``SchemaChange``."""
    return _as_schema(target, synced_schema(target.schema, incoming.schema))


def assert_unique(df: DataFrame, key) -> None:
    """Raise if a non-null ``key`` repeats in ``df`` (a merge with duplicate
    source keys matching one target row is an error). This is an action."""
    ks = _keys(key)
    dup = df.dropna(subset=ks).groupBy(*ks).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"upsert source has duplicate key {dup[0].asDict()}")


def upsert(target: DataFrame, source: DataFrame, key, preserve: Sequence[str] = (),
           validate: bool = True, latest_by: Sequence = (), tie_breakers: Sequence = ()) -> DataFrame:
    """Merge ``source`` into ``target`` on ``key``: matched rows take the source
    version (every column), unmatched source rows insert, other target rows
    stay. Null keys never match, so they always insert.

    ``preserve`` names columns whose *target* value survives a match (e.g.
    a first-loaded stamp). With ``latest_by`` a matched row is replaced only by
    one that ``dedupe_latest`` puts before it (descending, nulls first, then
    ``tie_breakers``): a late, older row changes nothing. Source keys must be unique: ``validate`` checks it
    (an action over the source's keys); pass False only where they are unique
    by construction. The source plan is used more than once: stage it first
    if it is dear (``load_incremental`` does). Plan: a left-anti join of target against the source keys plus a union --
    one shuffle on the key (or a broadcast of the source keys when AQE sees
    a small batch); keys are unique per side, so there is no skew.
    """
    ks = _keys(key)
    if validate:
        assert_unique(source, ks)
    src = source
    if preserve:
        # an explicit match flag, so a preserved value that is null stays null
        old = target.select(*ks, F.lit(True).alias("__hit"),
                            *[F.col(p).alias(f"__old_{p}") for p in preserve])
        hit = F.col("__hit").isNotNull()
        src = source.join(old, ks, "left").select(
            *[F.when(hit, F.col(f"__old_{c}")).otherwise(F.col(c)).alias(c) if c in preserve else F.col(c)
              for c in source.columns])
    if latest_by:
        null_key = reduce(or_, (F.col(k).isNull() for k in ks))
        held = target.join(source.select(*ks), ks, "left_semi").select(*source.columns)
        src = dedupe_latest(held.unionByName(src.where(~null_key)), ks, latest_by, tie_breakers or [F.xxhash64(*source.columns)]
                            ).select(*source.columns).unionByName(src.where(null_key))
    # equi-join keys never match on null, so null-key rows stay and insert
    kept = target.join(source.select(*ks), ks, "left_anti")
    return kept.select(*source.columns).unionByName(src)


def load_incremental(source: DataFrame, target: DataFrame | None, unique_key,
                     watermark: str | None, inclusive: bool = False, on_empty: str = "none",
                     preserve: Sequence[str] = (), sync: bool = True,
                     validate: bool = True, latest_by: Sequence = (), tie_breakers: Sequence = ()) -> DataFrame:
    """Incremental model load = watermark filter + schema sync + upsert.

    The batch (the rows past the mark) is written once to the shared folder,
    so its plan runs once; its keys are checked there. A first run
    (``target is None``) returns the whole source, staged and checked alike.
    """
    if target is None:
        if not validate:
            return source
        source = staged(source, "batch")
        assert_unique(source, unique_key)
        return source
    new = incremental_filter(source, target, watermark, inclusive, on_empty) if watermark else source
    new = staged(new, "batch")
    tgt = target
    if sync:
        schema = synced_schema(target.schema, new.schema)
        tgt, new = _as_schema(target, schema), _as_schema(new, schema)
    return upsert(tgt, new, unique_key, preserve=preserve, validate=validate, latest_by=latest_by, tie_breakers=tie_breakers)


def _null_safe(cols: Sequence[str], values: Sequence) -> Column:
    cond = F.lit(True)
    for c, v in zip(cols, values, strict=True):
        cond = cond & F.col(c).eqNullSafe(F.lit(v))
    return cond


def _any_of(cols: Sequence[str], rows: Sequence[tuple]) -> Column:
    """Partition filter: one IN list for a single column (a backfill can touch
    thousands of partitions), else an OR of null-safe equalities."""
    if len(cols) == 1:
        vals = [r[0] for r in rows if r[0] is not None]
        cond = F.col(cols[0]).isin(vals) if vals else F.lit(False)
        return cond | F.col(cols[0]).isNull() if any(r[0] is None for r in rows) else cond
    cond = F.lit(False)
    for r in rows:
        cond = cond | _null_safe(cols, r)
    return cond


def merge_partitions(source: DataFrame, target_path: str, key, partition_cols: Sequence[str],
                     preserve: Sequence[str] = (), validate: bool = True,
                     track_moves: bool = True, load: str | None = None,
                     latest_by: Sequence = (), tie_breakers: Sequence = ()) -> list[tuple]:
    """Upsert ``source`` into the partitioned Parquet table at ``target_path``
    rewriting only the partitions it touches. Returns their values.

    Only the partitions that hold incoming keys or take them in are rewritten.
    The old partitions are found by the key columns of every partition, since
    a key may land in another one than before (a line whose order date was null
    at first); ``track_moves=False`` leaves that out where keys never move.
    (``versioned.merge`` finds them by a key map, and shows readers old or new
    only.)

    The target is read with the source's types, so partition values such as
    ``01`` stay strings. Duplicate source keys raise, on the first load too.
    Touched rows are merged with ``upsert``, written to the shared checkpoint
    folder (the table is never overwritten while the same plan reads it),
    and written back with dynamic partition overwrite. Partitions that a move
    has emptied are deleted after that. A crash between the two leaves moved
    rows in both places; running the same load again finds and removes the old
    ones. With a load id the merged rows are kept under it: a load that was
    killed while they were written back is finished from them, and one that is
    through changes nothing, so null keys are not inserted twice. The collected
    lists are bounded by the number of partitions.
    """
    spark = source.sparkSession
    ks, pcols = _keys(key), list(partition_cols)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(target_path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    redo = None if load is None else f"{checkpoint_dir(spark).rstrip('/')}/load-{md5(f'{target_path}|{load}'.encode()).hexdigest()}"
    if redo and _exists(spark, f"{redo}/merged/_SUCCESS") and _exists(spark, f"{redo}/touched/_SUCCESS"):
        merged = spark.read.schema(source.schema).parquet(f"{redo}/merged")
        touched = {tuple(r) for r in spark.read.schema(source.select(*pcols).schema).parquet(f"{redo}/touched").collect()}
        if not _exists(spark, f"{redo}/done"):
            _publish(spark, merged, touched, target_path, pcols)
            fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{redo}/done"))
        return sorted(touched, key=str)
    batch = staged(source, "batch")
    if validate:
        assert_unique(batch, ks)
    touched = {tuple(r) for r in batch.select(*pcols).distinct().collect()}
    merged = batch
    if fs.exists(root):
        target = spark.read.schema(batch.schema).parquet(target_path)
        if track_moves:
            touched |= {tuple(r) for r in target.select(*ks, *pcols).join(batch.select(*ks), ks, "left_semi")
                        .select(*pcols).distinct().collect()}
        if touched:
            old = target.select(*batch.columns).where(_any_of(pcols, sorted(touched, key=str)))
            merged = upsert(old, batch, ks, preserve=preserve, validate=False, latest_by=latest_by, tie_breakers=tie_breakers)
    if not touched:
        return []
    if redo:
        merged.write.mode("overwrite").parquet(f"{redo}/merged")
        spark.createDataFrame(sorted(touched, key=str), batch.select(*pcols).schema).write.mode("overwrite").parquet(f"{redo}/touched")
        merged = spark.read.schema(batch.schema).parquet(f"{redo}/merged")
    elif merged is not batch:
        merged = staged(merged, "merge")
    _publish(spark, merged, touched, target_path, pcols)
    if redo:
        fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{redo}/done"))
    return sorted(touched, key=str)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _publish(spark: SparkSession, merged: DataFrame, touched: set[tuple], target_path: str, pcols: list[str]) -> None:
    """Write ``merged`` over its partitions, then delete those of ``touched``
    that it leaves empty. Doing it again gives the same."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(target_path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*pcols).parquet(target_path)
    kept = {tuple(r) for r in merged.select(*pcols).distinct().collect()}
    empty = sorted(touched - kept, key=str)
    if not empty:
        return
    # the folder of each partition as it was read, so that no value is ever turned into a path here
    left = (spark.read.schema(merged.schema).parquet(target_path).where(_any_of(pcols, empty))
            .select(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")).distinct().collect())
    for (where,) in left:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(where))  # the column holds a URI
        fs.delete(path, True)
        parent = path.getParent()
        while parent.depth() > root.depth() and fs.exists(parent) and len(fs.listStatus(parent)) == 0:
            fs.delete(parent, False)   # parents left empty
            parent = parent.getParent()
