"""Gold products: user risk profile, merchant days, the unified wallet."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pursewatch.functions.casts import to_myr
from pursewatch.functions.predicates import (
    compromised,
    has_keys,
    high_risk,
    recent_failure,
    recent_success,
)
from pursewatch.functions.timing import day_of, elapsed_seconds, moment
from pursewatch.model import PROFILE_SCHEMA, UNIFIED_WALLET_SCHEMA
from pursewatch.operators.projection import require_keys
from pursewatch.sources.managed import conform


def _velocity(as_of: datetime | str) -> list[Column]:
    """Mergeable parts of the seven-day figures; risk is over all time.

    Money is summed as decimal and turned into a double at the end, so the result does not
    depend on the order of the rows or on tasks that ran twice.
    """
    spent = F.when(recent_success(as_of), F.col("amount"))
    return [
        F.sum(spent).alias("spend"),
        F.count(spent).alias("spend_rows"),
        F.count(F.when(recent_failure(as_of), 1)).alias("failed_tx_7d"),
        F.max(F.col("risk_score").cast("double")).alias("max_risk_score"),
    ]


def _spend_figures() -> list[Column]:
    spend = F.col("spend").cast("double")
    return [
        F.coalesce(spend, F.lit(0.0)).alias("total_spend_7d"),
        F.when(F.col("spend_rows") > 0, spend / F.col("spend_rows")).alias("avg_spend_7d"),
    ]


def spend_velocity(tx: DataFrame, as_of: datetime | str) -> DataFrame:
    """Per user: spend and failures of the last seven days, highest risk score ever."""
    per_user = tx.where(has_keys("user_id")).groupBy("user_id").agg(*_velocity(as_of))
    return per_user.select("user_id", *_spend_figures(), "failed_tx_7d", "max_risk_score")


def compromised_cards(cards: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    return cards.where(compromised()).select(*within, "card_id").distinct()


def compromised_users(tx: DataFrame, cards: DataFrame) -> DataFrame:
    """Users with any transaction, of any age and status, on a compromised card."""
    pairs = tx.where(has_keys("user_id", "card_id")).select("user_id", "card_id")
    return pairs.join(compromised_cards(cards), "card_id", "left_semi").select("user_id").distinct()


def user_risk_profile(
    users: DataFrame,
    cards: DataFrame,
    tx: DataFrame,
    as_of: datetime | str,
    within: Sequence[str] = (),
) -> DataFrame:
    """One row per user with the seven-day spend and the high-risk flag.

    ``within`` names the columns that users and cards have in their keys besides their ids, such
    as the partner; all three tables hold them, and a user's rows are those that agree in them.

    Transactions are scanned once: aggregated per (user, card) first, which leaves a handful
    of rows per user, then marked by card and folded per user. The join on the card therefore
    never sees raw transactions, however many of them one card has.
    """
    per_card = (
        tx.where(has_keys("user_id"))
        .groupBy(*within, "user_id", "card_id")
        .agg(*_velocity(as_of))
    )
    marked = compromised_cards(cards, within).withColumn("hit", F.lit(True))
    per_user = (
        per_card.join(marked, [*within, "card_id"], "left")
        .groupBy(*within, "user_id")
        .agg(
            F.sum("spend").alias("spend"),
            F.sum("spend_rows").alias("spend_rows"),
            F.sum("failed_tx_7d").alias("failed_tx_7d"),
            F.max("max_risk_score").alias("max_risk_score"),
            F.max("hit").alias("hit"),
        )
    )
    return profile_rows(users, per_user, as_of, within)


def profile_rows(
    users: DataFrame, per_user: DataFrame, as_of: datetime | str, within: Sequence[str] = ()
) -> DataFrame:
    """Every user with the figures of ``per_user``: spend, spend_rows, failed_tx_7d,
    max_risk_score and hit, which is not NULL where a card of theirs is compromised."""
    return users.select(*within, F.col("user_id").try_cast("bigint").alias("user_id")).join(
        per_user, [*within, "user_id"], "left"
    ).select(
        *within,
        "user_id",
        *_spend_figures(),
        high_risk(F.col("hit"), F.col("failed_tx_7d"), F.col("max_risk_score")).alias("high_risk"),
        moment(as_of).alias("profile_updated_at"),
    )


def keyed_profile(profile: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """The profile as it is stored: its declared columns, and no row without a user."""
    extra = [profile.schema[c] for c in within]
    return require_keys(conform(profile, T.StructType([*extra, *PROFILE_SCHEMA])), [*within, "user_id"])


def merchant_daily_summary(tx: DataFrame) -> DataFrame:
    """Per merchant and day: volume in MYR and mean risk score."""
    return tx.groupBy("merchant_id", day_of(F.col("transaction_time")).alias("date")).agg(
        F.sum("amount_myr").alias("total_volume"),
        F.avg("risk_score").alias("avg_risk_score"),
    )


def top_merchant_days(summary: DataFrame, n: int = 10) -> DataFrame:
    """The n largest merchant days; equal volumes in order of merchant and day."""
    return summary.orderBy(F.desc("total_volume"), "merchant_id", "date").limit(n)


def unified_wallet(
    tx: DataFrame, users: DataFrame, cards: DataFrame, within: Sequence[str] = ()
) -> DataFrame:
    """Every transaction with its user, its card, its MYR amount and its latency.

    ``within`` as in the profile. Users and cards hold one row per key. Small ones are broadcast by the planner; otherwise
    both sides shuffle on the key and AQE splits a key that holds too many transactions.
    """
    user_columns = users.select(*within, "user_id", "current_age", "yearly_income", "credit_score")
    card_columns = cards.select(*within, "card_id", "card_brand", "credit_limit", "card_on_dark_web")
    wide = tx.join(user_columns, [*within, "user_id"], "left")
    wide = wide.join(card_columns, [*within, "card_id"], "left")
    enriched = wide.withColumns(
        {
            "amount_myr": to_myr(F.col("amount")),
            "processing_latency": elapsed_seconds(F.col("transaction_time"), F.col("updated_at")),
        }
    )
    return conform(enriched, UNIFIED_WALLET_SCHEMA)
