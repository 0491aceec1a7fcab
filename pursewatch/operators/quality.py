"""Data-quality probes. Each one scans its table once and aggregates before any shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pursewatch.functions.timing import elapsed_seconds, moment
from pursewatch.model import (
    BASELINE_DAYS,
    FRESHNESS_LIMIT_SECONDS,
    SEASON_LIMIT,
    SEASON_WEEKS,
    SPIKE_RATIO,
)
from pursewatch.operators.trend import median


def _unpivot(totals: DataFrame, entries: Sequence[Column]) -> DataFrame:
    return totals.select(F.inline(F.array(*entries)))


def cast_failures(raw: DataFrame, typed: Mapping[str, Column]) -> DataFrame:
    """Per column: values present, and those among them that its cast turned into NULL."""
    counts = []
    for name, cast in typed.items():
        present = F.col(name).isNotNull()
        counts.append(F.count(F.when(present, 1)).alias(f"{name}_present"))
        counts.append(F.count(F.when(present & cast.isNull(), 1)).alias(f"{name}_failed"))
    return _unpivot(
        raw.agg(*counts),
        [
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(f"{name}_present").alias("present"),
                F.col(f"{name}_failed").alias("failed"),
            )
            for name in typed
        ],
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: all rows and those that are NULL."""
    names = list(columns or df.columns)
    counts = [F.count(F.lit(1)).alias("_rows")]
    counts += [F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in names]
    return _unpivot(
        df.agg(*counts),
        [
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("_rows").alias("row_count"),
                F.col(c).alias("null_count"),
            )
            for c in names
        ],
    )


def schema_drift(expected: T.StructType, actual: T.StructType) -> list[tuple[str, str, str, str]]:
    """(column, change, expected type, actual type) for each column that differs."""
    want = {f.name: f.dataType.simpleString() for f in expected}
    have = {f.name: f.dataType.simpleString() for f in actual}
    found = [(c, "missing", t, "") for c, t in want.items() if c not in have]
    found += [(c, "added", "", t) for c, t in have.items() if c not in want]
    found += [(c, "retyped", want[c], have[c]) for c in want if c in have and want[c] != have[c]]
    return sorted(found)


def schema_integrity(df: DataFrame, expected: T.StructType, required: Sequence[str]) -> DataFrame:
    """Per column of either schema: its drift, and its NULLs where it is required."""
    drift = {c: (change, a, b) for c, change, a, b in schema_drift(expected, df.schema)}
    names = list(dict.fromkeys([*expected.names, *df.columns]))
    nulls = null_profile(df)
    want = {f.name: f.dataType.simpleString() for f in expected}
    report = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.lit(drift.get(c, ("none", "", ""))[0]).alias("drift"),
                    F.lit(want.get(c, "")).alias("expected_type"),
                    F.lit(df.schema[c].dataType.simpleString() if c in df.columns else "").alias(
                        "actual_type"
                    ),
                    F.lit(c in required).alias("required"),
                )
                for c in names
            ]
        )
    )
    columns = df.sparkSession.range(0, 1, 1, 1).select(report)
    return columns.join(nulls, "column_name", "left").withColumn(
        "unexpected_nulls",
        F.when(F.col("required"), F.coalesce(F.col("null_count"), F.lit(0))).otherwise(0),
    )


def freshness(
    df: DataFrame,
    event_time: str = "transaction_time",
    ingest_time: str = "ingest_ts",
    partner: str = "partner",
    limit_seconds: int = FRESHNESS_LIMIT_SECONDS,
) -> DataFrame:
    """Per partner: lag from event to ingest in seconds, and whether any row exceeds the limit."""
    lag = elapsed_seconds(F.col(event_time), F.col(ingest_time))
    return (
        df.select(partner, lag.alias("lag"))
        .groupBy(partner)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.max("lag").alias("max_lag_seconds"),
            F.avg("lag").alias("avg_lag_seconds"),
            F.count(F.when(F.col("lag") > limit_seconds, 1)).alias("late_rows"),
        )
        .withColumn("breached", F.col("late_rows") > 0)
    )


def _daily_counts(
    df: DataFrame, first_day: date, last_day: date, earlier: int, event_time: str, partner: str, partners: Sequence[str]
) -> DataFrame:
    """Rows per partner and day of a period and of some days before it, also where there are none.

    Days before the period begin with the partner's first one with rows. Only partner-day counts
    leave the scan; the days without rows are generated per partner from those.
    """
    from_day = first_day - timedelta(days=earlier)
    start, end = (moment(f"{d} 00:00:00") for d in (from_day, last_day + timedelta(days=1)))
    in_period = (F.col(event_time) >= start) & (F.col(event_time) < end)
    seen = df.where(in_period).select(
        F.col(partner), F.col(event_time).cast("date").alias("day"), F.lit(1).alias("n")
    )
    if partners:
        known = F.explode(F.array(*map(F.lit, partners))).alias(partner)
        listed = df.sparkSession.range(0, 1, 1, 1).select(known)
        seen = seen.unionByName(listed.select(partner, F.lit(first_day).alias("day"), F.lit(0).alias("n")))
    counts = seen.groupBy(partner, "day").agg(F.sum("n").alias("n"))
    # at most one entry per day of the period and of the baseline before it
    by_day = F.map_from_entries(F.collect_list(F.struct("day", "n"))).alias("by_day")
    since = F.least(F.min("day"), F.lit(first_day)).alias("since")
    calendar = F.explode(F.sequence(F.col("since"), F.lit(last_day))).alias("day")
    grid = counts.groupBy(partner).agg(by_day, since).select(partner, "by_day", calendar)
    return grid.select(
        partner, "day", F.coalesce(F.try_element_at("by_day", "day"), F.lit(0)).alias("row_count")
    )


def volume_anomalies(
    df: DataFrame,
    last_day: date,
    days: int,
    event_time: str = "transaction_time",
    partner: str = "partner",
    spike_ratio: float = SPIKE_RATIO,
    partners: Sequence[str] = (),
) -> DataFrame:
    """Per partner and day of the period: rows, mean of the days before, and the anomaly.

    A day without rows is ``no_data``; one with at least ``spike_ratio`` times the mean of the
    up to seven days before is a ``spike``; days before the period count in that mean, from the
    partner's first day with rows among them on. Only partner-day counts leave the scan; the days
    without rows are generated per partner from those. ``partners`` names those to report even
    if they sent nothing in the whole period.
    """
    first_day = last_day - timedelta(days=days - 1)
    filled = _daily_counts(df, first_day, last_day, BASELINE_DAYS, event_time, partner, partners)
    before = Window.partitionBy(partner).orderBy("day").rowsBetween(-BASELINE_DAYS, -1)
    spike = F.col("row_count") >= F.lit(spike_ratio) * F.col("baseline")
    based = filled.withColumn("baseline", F.avg("row_count").over(before))
    return based.where(F.col("day") >= F.lit(first_day)).withColumn(
        "anomaly",
        F.when(F.col("row_count") == 0, F.lit("no_data"))
        .when((F.col("baseline") > 0) & spike, F.lit("spike"))
        .otherwise(F.lit("none")),
    )


def seasonal_volume(
    df: DataFrame,
    last_day: date,
    days: int,
    weeks: int = SEASON_WEEKS,
    event_time: str = "transaction_time",
    partner: str = "partner",
    limit: float = SEASON_LIMIT,
    least_weeks: int = 2,
    partners: Sequence[str] = (),
) -> DataFrame:
    """Per partner and day of the period: rows against the same weekday of the weeks before.

    The baseline is those days' median; the spread is the largest of their median distance from
    it (x 1.4826, as for a normal spread), the root of the baseline, which counts vary by anyway,
    and 1. A day more than ``limit`` spreads away is ``high`` or ``low``, one without rows where
    the baseline has some is ``no_data``; with fewer than ``least_weeks`` days before, ``unknown``.
    One odd week moves neither median, and a weekly pattern is no alarm. Only partner-day counts
    are shuffled.
    """
    first_day = last_day - timedelta(days=days - 1)
    counts = _daily_counts(df, first_day, last_day, 7 * weeks, event_time, partner, partners)
    same = Window.partitionBy(partner, F.weekday("day")).orderBy("day").rowsBetween(-weeks, -1)
    based = counts.withColumn("before", F.collect_list("row_count").over(same))
    based = based.withColumn("baseline", median(F.col("before")))
    off = F.transform("before", lambda x: F.abs(x - F.col("baseline")))
    spread = F.greatest(F.lit(1.4826) * median(off), F.sqrt("baseline"), F.lit(1.0))
    found = based.where(F.col("day") >= F.lit(first_day)).withColumn("spread", spread)
    away = (F.col("row_count") - F.col("baseline")) / F.col("spread")
    return found.select(
        partner,
        "day",
        "row_count",
        "baseline",
        "spread",
        F.when(F.size("before") < least_weeks, F.lit("unknown"))
        .when((F.col("row_count") == 0) & (F.col("baseline") > 0), F.lit("no_data"))
        .when(away > limit, F.lit("high"))
        .when(away < -limit, F.lit("low"))
        .otherwise(F.lit("none"))
        .alias("anomaly"),
    )


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class Unique:
    column: str


@dataclass(frozen=True)
class Accepted:
    column: str
    values: tuple


@dataclass(frozen=True)
class Relationship:
    column: str
    parent: DataFrame
    parent_column: str


TableTest = NotNull | Unique | Accepted | Relationship


def violating_rows(df: DataFrame, test: TableTest) -> DataFrame:
    """The rows that break a test; for uniqueness the repeated values with their count."""
    c = F.col(test.column)
    if isinstance(test, NotNull):
        return df.where(c.isNull())
    if isinstance(test, Unique):
        repeats = df.where(c.isNotNull()).groupBy(test.column).agg(F.count(F.lit(1)).alias("n"))
        return repeats.where(F.col("n") > 1)
    if isinstance(test, Accepted):
        return df.where(c.isNotNull() & ~c.isin(*test.values))
    parent = test.parent.select(F.col(test.parent_column).alias(test.column))
    return df.where(c.isNotNull()).join(parent, test.column, "left_anti")


def run_table_tests(df: DataFrame, tests: Sequence[TableTest]) -> DataFrame:
    """Per test: its kind, column, number of violations and whether it passed.

    The row-wise tests share one pass; uniqueness and relationships take one shuffle each, of
    the column's values counted beforehand.
    """
    rowwise = [t for t in tests if isinstance(t, (NotNull, Accepted))]
    parts = []
    if rowwise:
        bad = []
        for i, t in enumerate(rowwise):
            c = F.col(t.column)
            cond = c.isNull() if isinstance(t, NotNull) else c.isNotNull() & ~c.isin(*t.values)
            bad.append(F.count(F.when(cond, 1)).alias(f"t{i}"))
        entries = [_result(t, F.col(f"t{i}")) for i, t in enumerate(rowwise)]
        parts.append(_unpivot(df.agg(*bad), entries))
    for t in tests:
        if isinstance(t, Unique):
            n = violating_rows(df, t).agg(F.count(F.lit(1)).alias("n"))
            parts.append(_unpivot(n, [_result(t, F.col("n"))]))
        elif isinstance(t, Relationship):
            # count per value first: a value that holds a third of the rows joins as one row
            values = df.where(F.col(t.column).isNotNull()).groupBy(t.column)
            counted = values.agg(F.count(F.lit(1)).alias("n"))
            parent = t.parent.select(F.col(t.parent_column).alias(t.column))
            orphans = counted.join(parent, t.column, "left_anti")
            n = orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
            parts.append(_unpivot(n, [_result(t, F.col("n"))]))
    results = reduce(lambda a, b: a.unionByName(b), parts)
    return results.withColumn("passed", F.col("violations") == 0)


def _result(test: TableTest, violations: Column) -> Column:
    kind = {
        NotNull: "not_null",
        Unique: "unique",
        Accepted: "accepted_values",
        Relationship: "relationships",
    }[type(test)]
    return F.struct(
        F.lit(kind).alias("test"),
        F.lit(test.column).alias("column_name"),
        violations.cast("bigint").alias("violations"),
    )


def orphan_transactions(
    tx: DataFrame, users: DataFrame, cards: DataFrame, within: Sequence[str] = ()
) -> DataFrame:
    """Transactions whose user or card is unknown or, where cards name their owner, whose card
    belongs to another user.

    ``within`` names the columns that their keys share, such as the partner.

    Distinct (user, card) pairs are checked first, so a pair that holds a third of all rows is
    looked up once; the few bad pairs then select their transactions.
    """
    pair = [*within, "user_id", "card_id"]
    known_user = users.select(*within, "user_id").distinct().withColumn("_user", F.lit(True))
    known_card = cards.select(*within, "card_id").distinct().withColumn("_card", F.lit(True))
    checked = (
        tx.select(*pair)
        .distinct()
        .join(known_user, [*within, "user_id"], "left")
        .join(known_card, [*within, "card_id"], "left")
    )
    reasons = [
        F.when(F.col("_user").isNull(), F.lit("unknown user")),
        F.when(F.col("_card").isNull(), F.lit("unknown card")),
    ]
    if "user_id" in cards.columns:
        owned = cards.select(*pair).distinct().withColumn("_owned", F.lit(True))
        checked = checked.join(owned, pair, "left")
        foreign = F.col("_card").isNotNull() & F.col("_owned").isNull()
        reasons.append(F.when(foreign, F.lit("card of another user")))
    bad = (
        checked.select(*pair, F.concat_ws(", ", *reasons).alias("orphan_reason"))
        .where(F.col("orphan_reason") != "")
        .select(*[F.col(c).alias(f"_{c}") for c in pair], "orphan_reason")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in pair]
    return tx.join(bad, reduce(and_, same)).drop(*[f"_{c}" for c in pair])
