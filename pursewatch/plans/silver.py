"""Bronze text to typed silver rows, one per key."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from pursewatch.functions.casts import to_timestamp
from pursewatch.operators.dedup import latest_per_key
from pursewatch.operators.projection import project, require_keys, split_rejects
from pursewatch.sources.tables import TableSpec

VERSION = "_version"


def typed_rows(bronze: DataFrame, spec: TableSpec, run_ts: datetime | str, *extra: Column) -> DataFrame:
    """Declared columns of every bronze row, and the time that orders a key's versions."""
    order = spec.order_by if spec.order_by in bronze.columns else "ingest_ts"
    return project(bronze, spec, run_ts, to_timestamp(F.col(order)).alias(VERSION), *extra)


def build_silver(bronze: DataFrame, spec: TableSpec, run_ts: datetime | str) -> DataFrame:
    """Latest row per typed key. A row without a key fails the job."""
    latest = latest_per_key(typed_rows(bronze, spec, run_ts), spec.keys, [VERSION])
    return require_keys(latest.drop(VERSION), spec.keys)


def build_silver_with_rejects(
    bronze: DataFrame, spec: TableSpec, run_ts: datetime | str
) -> tuple[DataFrame, DataFrame]:
    """Latest row per typed key, and the rows set aside because they have none."""
    good, rejected = split_rejects(typed_rows(bronze, spec, run_ts), spec.keys)
    return latest_per_key(good, spec.keys, [VERSION]).drop(VERSION), rejected.drop(VERSION)
