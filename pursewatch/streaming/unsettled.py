"""Transactions that stay pending for too long, found while their changes stream in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from pursewatch.functions.timing import as_utc_instant, from_utc_instant
from pursewatch.model import FAILED, PENDING, SUCCESS


def _of(at: str, *states: str) -> Column:
    # it names the event time, so it stays above the watermark: both sides of the join then
    # measure time by all rows, and one without rows of its own does not hold the other back
    return F.when(F.col("status").isin(*states), F.col(at)).isNotNull()


def unsettled_stream(changes: DataFrame, limit: str, lateness: str) -> DataFrame:
    """Each pending state of a transaction that no settled one followed within ``limit``, once.

    Returns transaction_id and pending_at. An outer interval join: a pending state waits until the
    watermark, the newest time less ``lateness``, is past its limit, and leaves if a settled state
    came by then; a settled one waits only for pending ones up to ``limit`` older that come later.
    So the state holds the changes of ``limit`` and ``lateness``, whatever the stream's age. Rows
    later than the watermark are dropped; ``late_rows`` tells how many.
    """
    timed = changes.withColumn("pending_at", as_utc_instant(F.col("updated_at")))
    pending = timed.withWatermark("pending_at", lateness).where(_of("pending_at", PENDING))
    pending = pending.select("transaction_id", "pending_at").dropDuplicates(["transaction_id", "pending_at"])
    settled = changes.withColumn("settled_at", as_utc_instant(F.col("updated_at")))
    settled = settled.withWatermark("settled_at", lateness).where(_of("settled_at", SUCCESS, FAILED))
    settled = settled.select(F.col("transaction_id").alias("settled_id"), "settled_at")
    in_time = (F.col("settled_at") >= F.col("pending_at")) & (
        F.col("settled_at") <= F.col("pending_at") + F.expr(f"interval {limit}")
    )
    joined = pending.join(settled, (F.col("transaction_id") == F.col("settled_id")) & in_time, "left_outer")
    waiting = joined.where(F.col("settled_id").isNull())
    return waiting.select("transaction_id", from_utc_instant(F.col("pending_at")).alias("pending_at"))


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query's stateful operators dropped because they came after the watermark.

    From the progress of its last batches, as many as ``spark.sql.streaming.numRecentProgressUpdates``.
    """
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
