"""States of a transaction over time."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from pursewatch.functions.timing import elapsed_seconds
from pursewatch.model import APPROVED, FAILED, PENDING, SUCCESS


def _first(*states: str) -> Column:
    return F.min(F.when(F.col("status").isin(*states), F.col("updated_at")))


def timeline(changes: DataFrame) -> DataFrame:
    """Per transaction: first time of each state, seconds between, outcome, completeness.

    The outcome is the settled state that came last; SUCCESS where both came at once. A
    transaction without one is ``stuck``, one without all three steps ``incomplete``. The
    aggregate keeps a few timestamps per transaction, however many changes it had.
    """
    last = {s: F.max(F.when(F.col("status") == s, F.col("updated_at"))) for s in (SUCCESS, FAILED)}
    times = changes.groupBy("transaction_id").agg(
        F.count(F.lit(1)).alias("changes"),
        _first(PENDING).alias("pending_at"),
        _first(APPROVED).alias("approved_at"),
        _first(SUCCESS, FAILED).alias("settled_at"),
        last[SUCCESS].alias("_success"),
        last[FAILED].alias("_failed"),
    )
    outcome = F.when(
        F.col("_success").isNotNull()
        & (F.col("_failed").isNull() | (F.col("_success") >= F.col("_failed"))),
        F.lit(SUCCESS),
    ).when(F.col("_failed").isNotNull(), F.lit(FAILED))
    steps = ["pending_at", "approved_at", "settled_at"]
    complete = F.col(steps[0]).isNotNull() & F.col(steps[1]).isNotNull() & F.col(steps[2]).isNotNull()
    return times.select(
        "transaction_id",
        "changes",
        *steps,
        elapsed_seconds(F.col("pending_at"), F.col("approved_at")).alias("approval_seconds"),
        elapsed_seconds(F.col("approved_at"), F.col("settled_at")).alias("settlement_seconds"),
        outcome.alias("outcome"),
        outcome.isNull().alias("stuck"),
        (~complete).alias("incomplete"),
    )


def unsettled(changes: DataFrame, limit: str, until: Column) -> DataFrame:
    """Each pending state that no settled one followed within ``limit``, as far as that is known
    at the time ``until``: transaction_id, pending_at."""
    pending = changes.where(F.col("status") == PENDING).select(
        "transaction_id", F.col("updated_at").alias("pending_at")
    )
    settled = changes.where(F.col("status").isin(SUCCESS, FAILED)).select(
        F.col("transaction_id").alias("settled_id"), F.col("updated_at").alias("settled_at")
    )
    end = F.col("pending_at") + F.expr(f"interval {limit}")
    in_time = (F.col("settled_at") >= F.col("pending_at")) & (F.col("settled_at") <= end)
    over = pending.where(end < until).distinct()
    return over.join(settled, (F.col("transaction_id") == F.col("settled_id")) & in_time, "left_anti")


def latency_sketches(
    tx: DataFrame, partner: str = "partner", day: str = "transaction_time", k: int = 400
) -> DataFrame:
    """Per partner and day: measured rows, their smallest and largest latency, and a KLL sketch of
    all. A few kilobytes each; those of any days can be added up later without the transactions."""
    latency = elapsed_seconds(F.col("transaction_time"), F.col("updated_at"))
    rows = tx.select(partner, F.col(day).cast("date").alias("day"), latency.alias("latency"))
    return rows.where(F.col("latency").isNotNull()).groupBy(partner, "day").agg(
        F.count(F.lit(1)).alias("measured"),
        F.min("latency").alias("min_latency"),
        F.max("latency").alias("max_latency"),
        F.kll_sketch_agg_bigint("latency", k).alias("sketch"),
    )


def latency_of_period(
    sketches: DataFrame, first: date, last: date, partner: str = "partner", percentiles: tuple[float, ...] = (0.5, 0.95, 0.99)
) -> DataFrame:
    """Latency per partner over some days, from their sketches alone.

    Counts and extremes are exact; a percentile is a latency whose rank is off by the sketch's
    bound at most, about 0.7 % of the rows for k = 400.
    """
    inside = sketches.where(F.col("day").between(F.lit(first), F.lit(last)))
    merged = inside.groupBy(partner).agg(
        F.sum("measured").alias("measured"),
        F.min("min_latency").alias("min_latency"),
        F.max("max_latency").alias("max_latency"),
        F.kll_merge_agg_bigint("sketch").alias("sketch"),
    )
    at = {f"p{round(p * 100)}_latency": F.kll_sketch_get_quantile_bigint("sketch", F.lit(p)) for p in percentiles}
    return merged.withColumns(at).drop("sketch")


def latency_by_partner(
    tx: DataFrame, partner: str = "partner", percentiles: tuple[float, ...] = (0.5, 0.95, 0.99)
) -> DataFrame:
    """Seconds from start to last update per partner, with exact percentiles.

    Rows are first counted per whole second, so what leaves a task, and what the percentiles
    work on, grows with the range of latencies and not with the number of transactions.
    """
    latency = elapsed_seconds(F.col("transaction_time"), F.col("updated_at"))
    counted = (
        tx.select(partner, latency.alias("latency"))
        .groupBy(partner, "latency")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    measured = F.when(F.col("latency").isNotNull(), F.col("n"))
    total = F.coalesce(F.sum(measured), F.lit(0))
    aggregates = [
        total.alias("measured"),
        F.try_divide(F.sum(F.col("latency") * F.col("n")), total).alias("avg_latency"),
        F.min("latency").alias("min_latency"),
        F.max("latency").alias("max_latency"),
    ]
    at = F.percentile("latency", F.array(*map(F.lit, percentiles)), F.col("n")).alias("_at")
    found = counted.groupBy(partner).agg(*aggregates, at)
    for i, p in enumerate(percentiles):
        found = found.withColumn(f"p{round(p * 100)}_latency", F.col("_at")[i])
    return found.drop("_at")
