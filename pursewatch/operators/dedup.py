"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from pursewatch.operators.projection import total_order


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """The newest row of every key; all rows without a key count as one key.

    ``order_by`` decides, newest first and NULL last; ``ties`` (by default all other columns)
    make the order total, so every run and every retried task picks the same row. The rank
    filter is pushed below the shuffle, so each task sends on at most one row per key.
    """
    by = total_order(df, *keys, *order_by) if ties is None else [F.col(c) for c in ties]
    order = [c.desc_nulls_last() for c in [*map(F.col, order_by), *by]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Some row of every key; use it only where the rows of a key are interchangeable."""
    return df.dropDuplicates(list(keys))
