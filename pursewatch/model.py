"""Fixed values and schemas of the wallet data model."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

# Fixed values -------------------------------------------------------------
PENDING, APPROVED, SUCCESS, FAILED = "PENDING", "APPROVED", "SUCCESS", "FAILED"
MYR_RATE = Decimal("4.70")
SPEND_WINDOW_DAYS = 7
MAX_FAILED_IN_WINDOW = 3
MAX_RISK_SCORE = 0.8
FRESHNESS_LIMIT_SECONDS = 2 * 60 * 60
SPIKE_RATIO = 5.0
BASELINE_DAYS = 7
#: Our choice: weeks that a weekday is compared with, and spreads that are out of the ordinary.
SEASON_WEEKS = 8
SEASON_LIMIT = 6.0
EPOCH = "1970-01-01 00:00:00"
DEFAULT_KEY = "id"
STAGE_BRONZE = "source_to_bronze"
STAGE_SILVER = "bronze_to_silver"

MONEY = T.DecimalType(18, 2)

PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType(), False),
        T.StructField("total_spend_7d", T.DoubleType()),
        T.StructField("avg_spend_7d", T.DoubleType()),
        T.StructField("high_risk", T.BooleanType()),
        T.StructField("profile_updated_at", T.TimestampNTZType()),
    ]
)

UNIFIED_WALLET_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("card_id", T.LongType()),
        T.StructField("amount", MONEY),
        T.StructField("status", T.StringType()),
        T.StructField("transaction_time", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("use_chip", T.StringType()),
        T.StructField("merchant_id", T.LongType()),
        T.StructField("merchant_name", T.StringType()),
        T.StructField("mcc", T.LongType()),
        T.StructField("risk_score", T.DoubleType()),
        T.StructField("partner", T.StringType()),
        T.StructField("current_age", T.IntegerType()),
        T.StructField("yearly_income", T.DoubleType()),
        T.StructField("credit_score", T.IntegerType()),
        T.StructField("card_brand", T.StringType()),
        T.StructField("credit_limit", T.DoubleType()),
        T.StructField("card_on_dark_web", T.BooleanType()),
        T.StructField("amount_myr", MONEY),
        T.StructField("processing_latency", T.LongType()),
    ]
)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("execution_time", T.TimestampType(), False),
        T.StructField("pipeline_stage", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("source_count", T.LongType()),
        T.StructField("target_count", T.LongType()),
        T.StructField("bronze_raw_count", T.LongType()),
        T.StructField("silver_deduped_count", T.LongType()),
        T.StructField("null_pk_count", T.LongType()),
    ]
)

#: Increments as they were written, and what became of them.
BATCH_SCHEMA = T.StructType(
    [
        T.StructField("partner", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("ingest_date", T.DateType(), False),
        T.StructField("row_count", T.LongType(), False),
    ]
)

BATCH_STATE_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("state", T.StringType(), False),
        T.StructField("rule", T.StringType()),
        T.StructField("feed", T.LongType()),
        T.StructField("noted_at", T.TimestampNTZType()),
    ]
)

WATERMARK_SCHEMA = T.StructType(
    [
        T.StructField("partner", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("watermark", T.TimestampNTZType(), False),
        T.StructField("committed_at", T.TimestampNTZType(), False),
    ]
)
