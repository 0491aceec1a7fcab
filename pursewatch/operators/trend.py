"""Changes of level in what the ledger tells over months."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Runs that a series' level is taken from; what a value may differ by, and what may add up, in spreads.
BASELINE_RUNS = 10
SLACK = 0.5
ALARM = 5.0


def median(values: Column) -> Column:
    """Of an array of numbers; NULL of an empty one."""
    ordered, n = F.array_sort(values), F.size(values)
    low, high = (F.try_element_at(ordered, F.shiftright(n + k, 1)) for k in (1, 2))
    return F.when(n > 0, (low + high) / 2)


def change_points(
    ledger: DataFrame,
    metric: str,
    by: Sequence[str] = ("pipeline_stage", "table_name"),
    at: str = "execution_time",
    baseline: int = BASELINE_RUNS,
    slack: float = SLACK,
    alarm: float = ALARM,
    floor: float = 1.0,
) -> DataFrame:
    """Runs at which the level of a ledger metric has changed for good: the series, ``changed_at``,
    ``noticed_at``, ``direction`` and the level ``before`` and ``after``.

    Page's cumulative sums, upwards and downwards. A series' level is the median of its first
    ``baseline`` runs; its spread is 1.4826 times their median distance from it, but no less than
    the level's root, which counts vary by anyway, and ``floor``. Every later run adds its distance from the level, in spreads, less ``slack``; a sum never
    falls below 0. Above ``alarm`` the change is noticed; it began when that sum left 0. The level
    is then the median of the ``baseline`` runs from there on, or of those there are, and both
    sums start again behind the run that noticed. So slow drifts and small steps are found that no
    single run shows, and one odd run is not (its distance counts for ``alarm`` / 2 at most).

    Runs without the metric are left out; runs of one time are ordered by the metric. A series is
    one value per run, some thousands in a year, gathered and folded in one task per series.
    """
    value = F.col(metric).cast("double")
    rows = ledger.where(value.isNotNull()).groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct(F.col(at).alias("at"), value.alias("value")))).alias("runs")
    )
    known = rows.where(F.size("runs") > baseline).withColumn("values", F.col("runs.value"))

    def first(of: Column) -> Column:
        return F.slice(of, 1, baseline)

    known = known.withColumn("level", median(first(F.col("values"))))
    off = F.transform(first(F.col("values")), lambda x: F.abs(x - F.col("level")))
    known = known.withColumn("spread", F.greatest(F.lit(1.4826) * median(off), F.sqrt(F.abs("level")), F.lit(float(floor))))
    found = "array<struct<since: int, noticed: int, up: boolean, before: double, after: double>>"
    start = F.struct(
        F.col("level"),
        F.lit(0.0).alias("up"),
        F.lit(0.0).alias("down"),
        F.lit(0).alias("up_since"),
        F.lit(0).alias("down_since"),
        F.array().cast(found).alias("found"),
    )

    def step(s: Column, i: Column) -> Column:
        most = F.lit(alarm / 2)
        z = (F.element_at("values", i) - s["level"]) / F.col("spread")
        z = F.greatest(F.least(z, most), -most)
        # at most a sum of two is taken anew per step, so each is written out once as a struct
        sums = F.struct(
            F.greatest(s["up"] + z - slack, F.lit(0.0)).alias("up"),
            F.greatest(s["down"] - z - slack, F.lit(0.0)).alias("down"),
        )

        def moved(n: Column) -> Column:
            up_since = F.when(s["up"] > 0, s["up_since"]).otherwise(i)
            down_since = F.when(s["down"] > 0, s["down_since"]).otherwise(i)
            up = n["up"] >= n["down"]
            since = F.when(up, up_since).otherwise(down_since)
            after = median(F.slice(F.col("values"), since, F.lit(baseline)))
            told = F.struct(since.alias("since"), i.alias("noticed"), up.alias("up"), s["level"].alias("before"), after.alias("after"))
            zero = F.lit(0.0)
            alarmed = F.struct(
                after.alias("level"), zero.alias("up"), zero.alias("down"), i.alias("up_since"), i.alias("down_since"),
                F.concat(s["found"], F.array(told)).alias("found"),
            )
            quiet = F.struct(
                s["level"].alias("level"), n["up"].alias("up"), n["down"].alias("down"),
                up_since.alias("up_since"), down_since.alias("down_since"), s["found"].alias("found"),
            )
            return F.when(F.greatest(n["up"], n["down"]) > alarm, alarmed).otherwise(quiet)

        return F.element_at(F.transform(F.array(sums), moved), 1)

    places = F.sequence(F.lit(baseline + 1), F.size("runs"))
    told = known.select(*by, "runs", F.explode(F.aggregate(places, start, step)["found"]).alias("c"))
    return told.select(
        *by,
        F.element_at("runs", F.col("c.since"))["at"].alias("changed_at"),
        F.element_at("runs", F.col("c.noticed"))["at"].alias("noticed_at"),
        F.when(F.col("c.up"), "up").otherwise("down").alias("direction"),
        F.col("c.before").alias("before"),
        F.col("c.after").alias("after"),
    )
