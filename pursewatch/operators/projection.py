"""Projections: typed columns, lineage, key enforcement."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pursewatch.functions.predicates import missing_key, partner_id
from pursewatch.functions.timing import ingest_stamp, moment

if TYPE_CHECKING:
    from pursewatch.sources.tables import TableSpec


def project(df: DataFrame, spec: TableSpec, run_ts: datetime | str, *extra: Column) -> DataFrame:
    """The declared columns, or every column where none is declared."""
    if not spec.rules:
        return df.select("*", *extra)
    now = moment(run_ts)
    return df.select(*[rule.build(now) for rule in spec.rules], *extra)


def all_strings(df: DataFrame) -> DataFrame:
    """Every column as text, so that partners' differing types cannot clash in bronze."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def with_lineage(df: DataFrame, partner: str, table: str, run_ts: datetime | str) -> DataFrame:
    return df.withColumns(
        {
            "ingest_ts": ingest_stamp(moment(run_ts)),
            "source_partner": partner_id(F.lit(partner)),
            "batch_table": F.lit(table),
        }
    )


def first_of_duplicates(df: DataFrame) -> DataFrame:
    """Keep the first of columns that share a name."""
    names = df.columns
    if len(set(names)) == len(names):
        return df
    firsts = [i for i, n in enumerate(names) if n not in names[:i]]
    by_position = df.toDF(*[f"c{i}" for i in range(len(names))])
    return by_position.select(*[F.col(f"c{i}").alias(names[i]) for i in firsts])


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail the job on a row without its key."""
    columns = {}
    for k in keys:
        message = F.lit(f"null key in column {k}")
        stop = F.raise_error(message).cast(df.schema[k].dataType)
        columns[k] = F.when(F.col(k).isNull(), stop).otherwise(F.col(k))
    return df.withColumns(columns)


def split_rejects(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all keys, and the others with the reason they were set aside."""
    reason = F.concat_ws(
        ", ", *[F.when(F.col(k).isNull(), F.lit(f"null key: {k}")) for k in keys]
    )
    lacking = missing_key(*keys)
    return df.where(~lacking), df.where(lacking).withColumn("reject_reason", reason)


def _has_order(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _has_order(kind.elementType)
    return not isinstance(kind, T.MapType | T.VariantType)


def total_order(df: DataFrame, *leave_out: str) -> list[Column]:
    """What rows are compared by, column by column; values without an order by their JSON text."""
    chosen = [f for f in df.schema if f.name not in leave_out]
    return [F.col(f.name) if _has_order(f.dataType) else F.to_json(F.struct(f.name)) for f in chosen]
