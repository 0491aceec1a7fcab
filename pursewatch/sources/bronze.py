"""Bronze files: every business column as text, one folder per partner, table and day.

Each increment goes straight to its own leaf folder, so several partners can be written at
once (Spark's committer keeps its work files per output folder) and no shuffle is needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.utils import AnalysisException

from pursewatch.functions.casts import to_timestamp
from pursewatch.operators.projection import all_strings, first_of_duplicates, with_lineage


@dataclass(frozen=True)
class Written:
    rows: int
    newest: datetime | None
    batch_id: str | None = None
    unversioned: int = 0


def day_folder(root: str, partner: str, table: str, day: date, plain: bool = False) -> str:
    leaf = f"{day:%Y/%m/%d}" if plain else f"ingest_date={day:%Y-%m-%d}"
    return f"{root.rstrip('/')}/partner={partner.lower()}/table={table}/{leaf}"


def write_increment(
    df: DataFrame,
    root: str,
    partner: str,
    table: str,
    run_ts: datetime,
    watermark: str | None = None,
    plain: bool = False,
    batch_id: str | None = None,
) -> Written:
    """Append one increment and report its row count and newest watermark value.

    ``batch_id`` is stored with each row, so that the increment can be told from others of the
    same run time. Of columns that share a name the first is written. Rows without a watermark
    value are counted as ``unversioned`` and not written.

    All figures are observed while the rows are written. The job has a single stage without
    a shuffle, so retried tasks are counted once.
    """
    df = first_of_duplicates(df)
    timed = F.col(watermark).isNotNull() if watermark in df.columns else F.lit(True)
    if df.where(timed).isEmpty():
        return Written(0, None, batch_id, df.where(~timed).count() if watermark in df.columns else 0)
    seen = Observation()
    newest = F.max(to_timestamp(F.col(watermark))) if watermark in df.columns else F.lit(None)
    rows = with_lineage(all_strings(df), partner, table, run_ts)
    if batch_id is not None:
        rows = rows.withColumn("batch_id", F.lit(batch_id))
    counts = [F.count(F.when(timed, 1)).alias("rows"), F.count(F.when(~timed, 1)).alias("untimed")]
    rows = rows.observe(seen, *counts, newest.alias("newest")).where(timed)
    folder = day_folder(root, partner, table, run_ts.date(), plain)
    rows.write.mode("append").parquet(folder)
    return Written(seen.get["rows"], seen.get["newest"], batch_id, seen.get["untimed"])


def read_bronze(
    spark: SparkSession,
    root: str,
    table: str,
    columns: Sequence[str] | None = None,
    day: date | None = None,
    plain: bool = False,
) -> DataFrame:
    """All partners' rows of a table, with ``partner`` and ``table`` taken from the folders.

    With ``columns`` the schema is known beforehand (all text) and no file footer is opened
    for it; columns that older files lack are NULL. Otherwise the files' schemas are merged.
    ``plain`` reads day folders of the form 2024/01/31 instead of ingest_date=2024-01-31.
    """
    reader = spark.read.option("basePath", root)
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    else:
        reader = reader.option("mergeSchema", "true")
    base = f"{root.rstrip('/')}/partner=*/table={table}"
    if not plain:
        df = reader.parquet(base)
        return df if day is None else df.where(F.col("ingest_date") == F.lit(day))
    return reader.parquet(f"{base}/*/*/*" if day is None else f"{base}/{day:%Y/%m/%d}")


def stream_bronze(
    spark: SparkSession, root: str, table: str, columns: Sequence[str], **options: str
) -> DataFrame:
    """New files of a table as a stream; ``options`` may limit what a micro-batch takes in."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (
        spark.readStream.schema(schema)
        .options(basePath=root, **options)
        .parquet(f"{root.rstrip('/')}/partner=*/table={table}")
    )


def read_day(
    spark: SparkSession, root: str, table: str, day: date, plain: bool = False
) -> DataFrame | None:
    """Rows that one run date brought, or None where that date has no readable files."""
    try:
        df = read_bronze(spark, root, table, day=day, plain=plain)
        return None if df.isEmpty() else df
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
