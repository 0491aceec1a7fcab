"""High-watermark increments per partner and table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from pursewatch.functions.predicates import changed_after, partner_id
from pursewatch.functions.timing import moment
from pursewatch.model import EPOCH


def changed_since(
    df: DataFrame,
    column: str,
    watermark: datetime | str,
    look_back: timedelta = timedelta(0),
    untimed: bool = False,
) -> DataFrame:
    """Rows newer than one watermark; the literal comparison reaches the scan.

    With ``untimed`` also those without a time, for a caller that counts them.

    A ``look_back`` re-reads that much more for rows that came late. Repeats do no harm, as
    the latest row per key is taken afterwards.
    """
    since = moment(watermark)
    if look_back:
        since = since - F.expr(f"INTERVAL '{look_back.total_seconds():.6f}' SECOND")
    new = changed_after(column, since)
    return df.where(new | F.col(column).isNull() if untimed else new)


def current_watermarks(history: DataFrame) -> DataFrame:
    """The standing mark of every partner and table; marks only ever rise."""
    return history.groupBy("partner", "table_name").agg(F.max("watermark").alias("watermark"))


def changed_since_marks(
    df: DataFrame,
    column: str,
    table: str,
    marks: DataFrame,
    partner: str = "source_partner",
    partners: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of several partners, each newer than its own mark; no mark means from the start.

    The marks, one per partner, are read first, so that the comparison is with literals: the
    lowest one bounds the scan (the epoch, unless ``partners`` says that all have marks).
    """
    standing = current_watermarks(marks.where(F.col("table_name") == table)).collect()
    own = {r.partner: r.watermark for r in standing}
    known = partners is not None and {p.lower() for p in partners} <= set(own)
    mark = moment(EPOCH)
    for name, value in sorted(own.items()):
        mark = F.when(partner_id(F.col(partner)) == name, moment(value)).otherwise(mark)
    lowest = min(own.values()) if known and own else EPOCH
    return df.where(changed_after(column, moment(lowest)) & changed_after(column, mark))


def advance_watermarks(
    marks: DataFrame, batch: DataFrame, column: str, table: str, partner: str = "source_partner"
) -> DataFrame:
    """Marks after a batch: the newest value seen, unchanged where nothing new came."""
    seen = (
        batch.groupBy(partner_id(F.col(partner)).alias("partner"))
        .agg(F.max(column).alias("watermark"))
        .where(F.col("watermark").isNotNull())
        .select("partner", F.lit(table).alias("table_name"), "watermark")
    )
    standing = marks.select("partner", "table_name", "watermark")
    return current_watermarks(standing.unionByName(seen))


def high_watermark(target: DataFrame, *columns: str) -> DataFrame:
    """One row: the newest version a table holds, from the first column it has."""
    present = [c for c in columns if c in target.columns]
    if not present:
        raise ValueError(f"none of {columns} in {target.columns}")
    return target.agg(F.max(present[0]).alias("high_watermark"))


def newer_than(df: DataFrame, column: Column, high_watermark: datetime | None) -> DataFrame:
    """Rows past a high watermark, all rows where there is none yet."""
    return df if high_watermark is None else df.where(column > moment(high_watermark))
