"""Namespaces, tables and the ways to write them."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.utils import AnalysisException

from pursewatch.operators.changes import AFTER, IMAGE, change_images
from pursewatch.operators.upsert import union_evolved
from pursewatch.scratch import scratch_path


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    location: str,
    partition_by: Sequence[str] = (),
) -> None:
    """External Parquet table with a declared schema; nothing happens where it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts} "
        f"OPTIONS (compression 'snappy') LOCATION '{location}'"
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def name_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order and types; a column the rows lack is NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def path_or_none(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """Rows under a path, read with a known schema; None where the path is not there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def stored_rows(
    spark: SparkSession,
    path: str,
    partition: T.StructField | None = None,
    schema: T.StructType | None = None,
) -> DataFrame | None:
    """Rows under a path; None where nothing is there yet.

    With ``schema`` no file footer is opened: its columns are read, NULL where a file lacks them.
    Otherwise the files' schemas are merged. ``partition`` fixes the type of the folder column,
    which Spark would guess otherwise.
    """
    if schema is not None:
        return path_or_none(spark, path, schema)
    try:
        found = spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    if partition is None:
        return found
    fields = [f for f in found.schema if f.name != partition.name]
    return spark.read.schema(T.StructType([*fields, partition])).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it is; nothing happens where there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def retire_snapshots(spark: SparkSession, base: str, keep: int) -> None:
    """Delete all but the ``keep`` newest snapshot folders that ``publish`` left under a base."""
    where = spark._jvm.org.apache.hadoop.fs.Path(base)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath() for f in files.listStatus(where)] if files.exists(where) else []
    # names begin with the time of writing, so they sort by age
    snapshots = sorted(f.getName() for f in found if f.getName().startswith("snapshot-"))
    for name in snapshots[:-keep] if keep > 0 else []:
        remove_folder(spark, f"{base.rstrip('/')}/{name}")


def publish(
    df: DataFrame,
    base: str,
    name: str,
    partition_by: Sequence[str] = (),
    temporary: bool = False,
    keep: int = 0,
) -> DataFrame:
    """Full refresh: write a new snapshot folder, then point the view ``name`` at it.

    With ``keep`` only so many of the newest snapshots stay; without, none is deleted.

    Readers see the old snapshot or the new one, never a half-written table, and the rows may
    come from the old snapshot itself. Columns may be added from one snapshot to the next.
    """
    spark = df.sparkSession
    path = f"{base.rstrip('/')}/snapshot-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    write_balanced(df, path, partition_by, "errorifexists")
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    try:
        spark.sql(f"CREATE OR REPLACE {kind} {name} AS SELECT * FROM parquet.`{path}`")
    except AnalysisException as e:
        # folders of no rows leave no file that would tell the columns
        if not partition_by or e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        write_balanced(df.limit(0), path, (), "overwrite")
        spark.sql(f"CREATE OR REPLACE {kind} {name} AS SELECT * FROM parquet.`{path}`")
    if keep:
        retire_snapshots(spark, base, keep)
    return spark.table(name)


def write_balanced(
    df: DataFrame, path: str, partition_by: Sequence[str], mode: str, keys: Sequence[str] = (), **options: str
) -> None:
    """Write files of even size.

    Without folders AQE has already sized the tasks. With folders the rows are gathered per
    folder, so that not every task adds a file to each; a folder with too many rows is split.
    With ``keys`` each file is sorted by them and has Bloom filters of them, so that a reader who
    looks for some keys skips most row groups.
    """
    rows = df.hint("rebalance", *map(F.col, partition_by)) if partition_by else df
    if keys:
        rows = rows.sortWithinPartitions(*partition_by, *keys)
        options |= {f"parquet.bloom.filter.enabled#{k}": "true" for k in keys}
    rows.write.mode(mode).options(**options).partitionBy(*partition_by).parquet(path)


def upsert_partitions(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    partition: str,
    newer_by: str | Sequence[str] | None = None,
    schema: T.StructType | None = None,
    feed: str | None = None,
) -> DataFrame:
    """Upsert into a table kept in folders of one column, such as the event day; returns what
    changed, as before and after images.

    ``updates`` holds one row per key. The images are stored first (in the folder ``feed``, or a
    scratch folder), then applied: so a call that died may be repeated, and one that died after
    its images were stored may be ended by ``apply_images``. ``schema`` is the table's declared one.
    """
    kind = updates.schema[partition].dataType
    target = stored_rows(spark, path, T.StructField(partition, kind), schema)
    images = change_images(target, updates, keys, newer_by)
    where = feed or scratch_path(spark, "changes")
    images.write.mode("overwrite").parquet(where)
    images = spark.read.schema(images.schema).parquet(where)
    apply_images(spark, path, images, keys, partition, schema)
    return images


def apply_images(
    spark: SparkSession,
    path: str,
    images: DataFrame,
    keys: Sequence[str],
    partition: str,
    schema: T.StructType | None = None,
) -> None:
    """Bring a table in folders to the state that stored images tell; to do so again changes nothing.

    Only folders that an image names are rewritten, by Spark's dynamic overwrite; one that has lost
    all its rows is deleted after that. Only the list of these folders' values reaches the driver,
    no longer than what it lists anyway to plan a read.
    """
    named = [r[0] for r in images.select(partition).distinct().collect()]
    if not named:
        if stored_rows(spark, path, schema=schema) is None:
            write_balanced(images.drop(IMAGE), path, [partition], "append", keys)
        return
    kind = images.schema[partition]
    target = stored_rows(spark, path, kind, schema)
    after = images.where(F.col(IMAGE) == AFTER).drop(IMAGE)
    if target is None:
        write_balanced(after, path, [partition], "append", keys)
        return

    def within(values: list) -> Column:
        inside = F.col(partition).isin([v for v in values if v is not None])
        return inside | F.col(partition).isNull() if None in values else inside

    # a key's images are two at most, and its copies are in the named folders
    kept = target.where(within(named)).join(images.select(*keys).distinct(), list(keys), "left_anti")
    seen = Observation()
    rows = union_evolved(kept, after).observe(
        seen,
        F.collect_set(partition).alias("values"),
        F.count(F.when(F.col(partition).isNull(), 1)).alias("without"),
    )
    write_balanced(rows, path, [partition], "overwrite", keys, partitionOverwriteMode="dynamic")
    filled = {*seen.get["values"], *([None] if seen.get["without"] else [])}
    emptied = [v for v in named if v not in filled]
    if emptied:
        folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1)
        for r in target.where(within(emptied)).select(folder).distinct().collect():
            remove_folder(spark, unquote(r[0]))


def merge_into(
    updates: DataFrame, name: str, keys: Sequence[str], newer_by: Sequence[str] = ()
) -> None:
    """Upsert through a catalog whose table format supports MERGE.

    With ``newer_by`` an update that is older than the stored row loses.
    """
    match = " AND ".join(f"{name}.{k} = updates.{k}" for k in keys)
    new, old = (", ".join(f"{side}.{c}" for c in newer_by) for side in ("updates", name))
    newer = F.expr(f"struct({new}) >= struct({old})") if newer_by else None
    (
        updates.alias("updates")
        .mergeInto(name, F.expr(match))
        .whenMatched(newer)
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
