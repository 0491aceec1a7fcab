from __future__ import annotations

from datetime import datetime

TX_DDL = (
    "transaction_id string, user_id bigint, card_id bigint, amount decimal(18,2), status string, "
    "transaction_time timestamp_ntz, updated_at timestamp_ntz, merchant_id bigint, risk_score double"
)


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def tx_row(tid="t1", user=1, card=10, amount="10.00", status="SUCCESS", at="2024-01-30 00:00:00",
           updated=None, merchant=5, risk=0.1):
    from decimal import Decimal

    at = ts(at) if at else None
    updated = ts(updated) if updated else at
    amount = None if amount is None else Decimal(amount)
    return (tid, user, card, amount, status, at, updated, merchant, risk)


def rows(df, *order):
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((x is None, str(x)) for x in r)) if not order else found


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
