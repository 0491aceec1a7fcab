"""Update, insert and schema union by key or by name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from pursewatch.operators.dedup import latest_per_key


def union_evolved(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows by column name; a column that one side lacks is NULL there."""
    return a.unionByName(b, allowMissingColumns=True)


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    newer_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``updates`` replace those of the same key, others are added, none is deleted.

    Both sides hold one row per key. The target is the large side of an anti join against the
    keys of the updates: while those are small enough for the planner to broadcast, the
    target is not shuffled. With ``newer_by`` an update that is older than the stored row
    loses, so batches may arrive in any order.
    """
    if newer_by is not None:
        return _upsert_newer(target, updates, keys, newer_by)
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return union_evolved(kept, updates)


def _upsert_newer(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], newer_by: str | Sequence[str]
) -> DataFrame:
    # one full join, so that each side is read and shuffled once whatever its size
    order = [newer_by] if isinstance(newer_by, str) else list(newer_by)
    old, new = (df.withColumn("_here", F.lit(True)) for df in (target, updates))
    same = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    both = old.alias("old").join(new.alias("new"), reduce(and_, same), "full")

    # structs compare field by field with NULL lowest, as the newest-first order has it
    def version(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{c}") for c in order])

    take_new = F.col("new._here").isNotNull() & (
        F.col("old._here").isNull() | (version("new") >= version("old"))
    )

    def pick(c: str) -> Column:
        of = [F.col(f"{s}.{c}") if c in df.columns else F.lit(None)
              for s, df in (("new", updates), ("old", target))]
        return F.when(take_new, of[0]).otherwise(of[1]).alias(c)

    return both.select(*[pick(c) for c in dict.fromkeys([*target.columns, *updates.columns])])


def insert_if_absent(
    target: DataFrame, rows: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Add rows whose key is new; on conflict the stored row stays.

    Repeated keys among the new rows are folded first, so each key is looked up once.
    """
    one_per_key = latest_per_key(rows, keys, order_by)
    new = one_per_key.join(target.select(*keys), list(keys), "left_anti")
    return union_evolved(target, new)
