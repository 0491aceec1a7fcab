"""The risk profile kept up to date from the feeds of changed transactions.

Two tables of sums stand for all transactions: per user and card over all time, and per user and
day over the last days. A changed transaction's old image is taken off them and its new one added,
so a run reads its own changes, the sums, and one day folder of transactions: the day in which the
seven days begin, of which only a part counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pursewatch.functions.predicates import has_keys, recent_failure, recent_success
from pursewatch.model import FAILED, MAX_RISK_SCORE, SPEND_WINDOW_DAYS, SUCCESS
from pursewatch.operators.changes import AFTER, IMAGE, signed
from pursewatch.plans.gold import compromised_cards, profile_rows
from pursewatch.sources.managed import publish

#: Days before the seven that are kept, for runs with an older time.
SPARE_DAYS = 7

Feeds = Callable[[int], DataFrame | None]


def card_parts(images: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Per user and card: transactions, and those with a risk above the limit."""
    risky = F.when(F.col("risk_score").cast("double") > MAX_RISK_SCORE, signed()).otherwise(0)
    by = images.where(has_keys("user_id")).groupBy(*within, "user_id", "card_id")
    return by.agg(F.sum(signed()).alias("n"), F.sum(risky).alias("risky"))


def day_parts(images: DataFrame, since: date, within: Sequence[str] = ()) -> DataFrame:
    """Per user and day of the transaction, from a day on: what was spent, in how many, and failures."""
    day = F.col("transaction_time").cast("date")
    paid = (F.col("status") == SUCCESS) & F.col("amount").isNotNull()
    rows = images.where(has_keys("user_id") & (day >= F.lit(since)))
    return rows.groupBy(*within, "user_id", day.alias("day")).agg(
        F.sum(F.when(paid, F.col("amount") * signed())).alias("spend"),
        F.sum(F.when(paid, signed()).otherwise(0)).alias("spend_rows"),
        F.sum(F.when(F.col("status") == FAILED, signed()).otherwise(0)).alias("failed"),
    )


def _summed(parts: Sequence[DataFrame], by: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """Parts added up by key; a key whose sums are all 0 stands for nothing."""
    columns = [*by, *[F.coalesce(F.col(c), F.lit(0)).cast(t).alias(c) for c, t in sums.items()]]
    together = reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])
    totals = together.groupBy(*by).agg(*[F.sum(c).cast(t).alias(c) for c, t in sums.items()])
    return totals.where(reduce(or_, [F.col(c) != 0 for c in sums]))


def _known(spark: SparkSession, name: str) -> DataFrame | None:
    return spark.table(name) if spark.catalog.tableExists(name) else None


def _upto(parts: DataFrame | None) -> int:
    """The last feed that sums hold; sums of nothing hold none."""
    return 0 if parts is None else parts.agg(F.max("upto")).first()[0] or 0


CARD_SUMS = {"n": "bigint", "risky": "bigint"}
DAY_SUMS = {"spend": "decimal(38,2)", "spend_rows": "bigint", "failed": "bigint"}


def maintained_profile(
    users: DataFrame,
    cards: DataFrame,
    tx: DataFrame,
    as_of: datetime,
    within: Sequence[str],
    feeds: Feeds,
    last: int,
    base: str,
    name: str,
    temporary: bool = True,
    keep: int = 3,
) -> DataFrame:
    """The rows of ``user_risk_profile``, from sums that the feeds past them are added to.

    ``feeds(n)`` gives the images of all feeds past number n up to ``last``. The sums are kept as
    snapshots under ``base``, seen by views that begin with ``name``; their rows tell the last feed
    that they hold, so a run that dies, or is repeated, adds each feed once. Without a view, or for
    a time before the days that are kept, the sums are made from the feeds from the first on.
    ``tx`` is the table as the feeds left it, of which the day that the seven days begin in is read.
    """
    spark = users.sparkSession
    start = as_of - timedelta(days=SPEND_WINDOW_DAYS)

    def images(after: int) -> DataFrame:
        found = feeds(after)
        return found if found is not None else tx.limit(0).withColumn(IMAGE, F.lit(AFTER))

    def kept(rows: DataFrame, kind: str, **told: Column) -> DataFrame:
        marked = rows.withColumns({"upto": F.lit(last).cast("bigint"), **told})
        return publish(marked, f"{base}/{kind}", f"{name}_{kind}", (), temporary, keep)

    by_card = [*within, "user_id", "card_id"]
    pairs = _known(spark, f"{name}_cards")
    upto = _upto(pairs)
    if pairs is None or upto < last:
        old = [pairs] if upto else []
        pairs = kept(_summed([*old, card_parts(images(upto), within)], by_card, CARD_SUMS), "cards")

    by_day = [*within, "user_id", "day"]
    days = _known(spark, f"{name}_days")
    upto = _upto(days)
    since = days.agg(F.max("since")).first()[0] if upto else None
    if since is None or since > start.date():
        days, upto = None, 0
    # days only leave, as none that left was added to since
    since = max(since if upto else date.min, start.date() - timedelta(days=SPARE_DAYS))
    if days is None or upto < last:
        old = [days.where(F.col("day") >= F.lit(since))] if upto else []
        parts = _summed([*old, day_parts(images(upto), since, within)], by_day, DAY_SUMS)
        days = kept(parts, "days", since=F.lit(since))

    first = F.col("event_date") if "event_date" in tx.columns else F.col("transaction_time").cast("date")
    begun = tx.where(has_keys("user_id") & (first == F.lit(start.date())))
    partial = begun.groupBy(*within, "user_id").agg(
        F.sum(F.when(recent_success(as_of), F.col("amount"))).alias("spend"),
        F.count(F.when(recent_success(as_of), F.col("amount"))).alias("spend_rows"),
        F.count(F.when(recent_failure(as_of), 1)).alias("failed"),
    )
    whole = days.where(F.col("day") > F.lit(start.date()))
    spent = _summed([whole, partial], [*within, "user_id"], DAY_SUMS)

    marked = compromised_cards(cards, within).withColumn("hit", F.lit(True))
    touched = pairs.where("n > 0").join(marked, [*within, "card_id"], "left").groupBy(*within, "user_id").agg(
        F.max("hit").alias("hit"), F.sum("risky").alias("risky")
    )
    per_user = touched.join(spent, [*within, "user_id"], "left").select(
        *within,
        "user_id",
        "spend",
        "spend_rows",
        F.col("failed").alias("failed_tx_7d"),
        # above the limit or not is all that the profile asks
        F.when(F.col("risky") > 0, F.lit(float("inf"))).alias("max_risk_score"),
        "hit",
    )
    return profile_rows(users, per_user, as_of, within)
