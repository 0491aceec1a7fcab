"""Named conditions of the risk rules."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

from pursewatch.functions.timing import window_start
from pursewatch.model import FAILED, MAX_FAILED_IN_WINDOW, MAX_RISK_SCORE, SUCCESS


def changed_after(column: str, watermark: Column) -> Column:
    return F.col(column) > watermark


def has_keys(*columns: str) -> Column:
    cond = F.col(columns[0]).isNotNull()
    for c in columns[1:]:
        cond = cond & F.col(c).isNotNull()
    return cond


def missing_key(*columns: str) -> Column:
    return ~has_keys(*columns)


def compromised() -> Column:
    return F.col("is_compromised") == F.lit(True)


def recent(status: str, as_of: datetime | str) -> Column:
    """Given status, at or after the start of the window; there is no upper bound."""
    return (F.col("status") == status) & (F.col("transaction_time") >= window_start(as_of))


def recent_success(as_of: datetime | str) -> Column:
    return recent(SUCCESS, as_of)


def recent_failure(as_of: datetime | str) -> Column:
    return recent(FAILED, as_of)


def high_risk(touched_compromised: Column, failed: Column, risk: Column) -> Column:
    return (
        F.when(touched_compromised.isNotNull(), F.lit(True))
        .when(failed > MAX_FAILED_IN_WINDOW, F.lit(True))
        .when(risk > MAX_RISK_SCORE, F.lit(True))
        .otherwise(F.lit(False))
    )


def partner_id(c: Column) -> Column:
    """Partner names compare in lower case."""
    return F.lower(c)


def table_suffix(partner: Column, suffixes: dict[str, str]) -> Column:
    """Suffix of a partner's source tables; none for an unlisted partner."""
    chain = F
    for name, suffix in suffixes.items():
        chain = chain.when(partner_id(partner) == name.lower(), F.lit(suffix))
    return chain.otherwise(F.lit("")) if suffixes else F.lit("")
