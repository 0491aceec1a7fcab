"""One query per operator, each over the whole provided tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks import views as V
from checks.views import AS_OF
from pursewatch.functions import casts, layout, predicates
from pursewatch.functions.timing import elapsed_seconds, moment, watermark_text
from pursewatch.model import EPOCH, LEDGER_SCHEMA, PROFILE_SCHEMA, UNIFIED_WALLET_SCHEMA
from pursewatch.operators import audit, changes, dedup, incremental, lifecycle, parity, projection
from pursewatch.operators import quality, trend
from pursewatch.operators import upsert as ups
from pursewatch.plans import batches, gold
from pursewatch.plans.daily_run import Run, run_day
from pursewatch.scratch import scratch_path
from pursewatch.sources import bronze, managed
from pursewatch.sources.partners import SUFFIXES, partner_frames, union_partners
from pursewatch.sources.tables import load_tables, table_from_payload
from pursewatch.streaming import daily_summary, latest_state, unsettled

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RUN_TS = datetime(2024, 1, 31)
MID = "2024-01-16 00:00:00"
SHIP_SPLIT = "1998-06-01 00:00:00"
SPECS = load_tables()


def check(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that must give the same rows."""

    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return register


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines hand back the same kind of value."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def parts(df: DataFrame) -> dict[str, DataFrame]:
    """A frame split by partner, as separate source tables would hold it."""
    is_a = F.col("source_partner") == "partner_a"
    return {
        "partner_a": df.where(is_a).drop("source_partner"),
        "partner_b": df.where(~is_a).drop("source_partner"),
    }


# ---- gold -----------------------------------------------------------------

# fixed values: the output names and the thresholds 7 days, 3 failures, risk 0.8
WEEK = f"TIMESTAMP '{AS_OF}' - INTERVAL 7 DAYS"


def velocity_sql(key: str = "user_id") -> str:
    return f"""velocity AS (
  SELECT {key}, CAST(sum(amount) FILTER (status = 'SUCCESS' AND recent) AS DOUBLE) AS spend,
    count(amount) FILTER (status = 'SUCCESS' AND recent) AS paid,
    count(*) FILTER (status = 'FAILED' AND recent) AS failed_tx_7d, max(risk_score) AS max_risk_score
  FROM (SELECT *, transaction_time >= {WEEK} AS recent FROM tx) WHERE user_id IS NOT NULL GROUP BY {key})"""


def profile_sql(columns: str, same_user: str, same_card: str) -> str:
    """Each rule by itself: failures, risk, or a compromised card anywhere in the history."""
    return f"""SELECT {columns}, coalesce(spend, 0.0) AS total_spend_7d,
  CASE WHEN paid > 0 THEN spend / paid END AS avg_spend_7d,
  coalesce(failed_tx_7d > 3, false) OR coalesce(max_risk_score > 0.8, false)
    OR EXISTS (SELECT 1 FROM tx JOIN cards c ON {same_card} WHERE c.card_on_dark_web AND {same_user}) AS high_risk,
  TIMESTAMP '{AS_OF}' AS profile_updated_at
FROM users u LEFT JOIN velocity v ON {same_user.replace("tx.", "v.")}"""


@check(
    V.with_views(V.TX, V.USERS, V.CARDS, velocity_sql())
    + profile_sql("u.user_id", "tx.user_id = u.user_id", "c.card_id = tx.card_id")
)
def user_risk_profile(spark, sf):
    return gold.user_risk_profile(V.users(spark, sf), V.silver_cards(spark, sf), V.tx(spark, sf), AS_OF)


BY_PARTNER = "tx.user_id = u.user_id AND tx.source_partner = u.source_partner"


@check(
    V.with_views(V.TX, V.USERS, V.CARDS, velocity_sql("source_partner, user_id"))
    + profile_sql(
        "u.source_partner, u.user_id", BY_PARTNER,
        "c.card_id = tx.card_id AND c.source_partner = tx.source_partner",
    )
)
def user_risk_profile_by_partner(spark, sf):
    """Keys of partner and id: equal ids of two partners are two users, two cards."""
    cards = V.silver_cards(spark, sf)
    within = ["source_partner"]
    return gold.user_risk_profile(V.users(spark, sf), cards, V.tx(spark, sf), AS_OF, within)


@check(
    V.with_views(V.TX, V.CARDS)
    + """SELECT DISTINCT user_id FROM tx WHERE user_id IS NOT NULL
  AND card_id IN (SELECT card_id FROM cards WHERE card_on_dark_web)"""
)
def compromised_users(spark, sf):
    return gold.compromised_users(V.tx(spark, sf), V.silver_cards(spark, sf))


@check(
    V.with_views(V.TX, velocity_sql())
    + """SELECT user_id, coalesce(spend, 0.0) AS total_spend_7d,
  CASE WHEN paid > 0 THEN spend / paid END AS avg_spend_7d, failed_tx_7d, max_risk_score FROM velocity"""
)
def spend_velocity_7d(spark, sf):
    return gold.spend_velocity(V.tx(spark, sf), AS_OF)


MERCHANT_SQL = """SELECT merchant_id, CAST(date_trunc('day', transaction_time) AS TIMESTAMP) AS date,
  CAST(SUM(CAST(ROUND(amount * 4.70, 2) AS DECIMAL(18,2))) AS DOUBLE) AS total_volume,
  ROUND(AVG(risk_score), 6) AS avg_risk_score
FROM tx GROUP BY 1, 2"""


def _in_myr(tx: DataFrame) -> DataFrame:
    return tx.withColumn("amount_myr", casts.to_myr(F.col("amount")))


def _summary(summary: DataFrame) -> DataFrame:
    return plain(summary.withColumn("avg_risk_score", F.round("avg_risk_score", 6)))


@check(V.with_views(V.TX) + MERCHANT_SQL)
def merchant_daily_summary(spark, sf):
    return _summary(gold.merchant_daily_summary(_in_myr(V.tx(spark, sf))))


@check(V.with_views(V.TX) + MERCHANT_SQL + " ORDER BY total_volume DESC, merchant_id, date LIMIT 10")
def top_merchant_days(spark, sf):
    summary = gold.merchant_daily_summary(_in_myr(V.tx(spark, sf)))
    return _summary(gold.top_merchant_days(summary))


@check(
    V.with_views(V.TX, V.USERS, V.CARDS)
    + """SELECT transaction_id, tx.user_id, tx.card_id, CAST(amount AS DOUBLE) AS amount, status,
  transaction_time, updated_at, use_chip, merchant_id, merchant_name, mcc, risk_score,
  tx.source_partner AS partner, current_age, yearly_income, credit_score, card_brand,
  credit_limit, card_on_dark_web,
  CAST(CAST(ROUND(amount * 4.70, 2) AS DECIMAL(18,2)) AS DOUBLE) AS amount_myr,
  date_sub('second', transaction_time, updated_at) AS processing_latency
FROM tx LEFT JOIN users u ON tx.user_id = u.user_id LEFT JOIN cards c ON tx.card_id = c.card_id"""
)
def unified_wallet(spark, sf):
    tx = V.tx(spark, sf).withColumnRenamed("source_partner", "partner")
    users = V.users(spark, sf).drop("source_partner")
    return plain(gold.unified_wallet(tx, users, V.cards(spark, sf).drop("source_partner")))


@check(
    V.with_views(V.TX_STATES)
    + """SELECT *, date_sub('second', pending_at, approved_at) AS approval_seconds,
  date_sub('second', approved_at, settled_at) AS settlement_seconds,
  outcome IS NULL AS stuck,
  pending_at IS NULL OR approved_at IS NULL OR settled_at IS NULL AS incomplete
FROM (SELECT transaction_id, COUNT(*) AS changes,
  MIN(CASE WHEN status = 'PENDING' THEN updated_at END) AS pending_at,
  MIN(CASE WHEN status = 'APPROVED' THEN updated_at END) AS approved_at,
  MIN(CASE WHEN status IN ('SUCCESS', 'FAILED') THEN updated_at END) AS settled_at,
  arg_max(status, updated_at + CASE status WHEN 'SUCCESS' THEN INTERVAL 1 MICROSECOND
    ELSE INTERVAL 0 MICROSECOND END) FILTER (status IN ('SUCCESS', 'FAILED')) AS outcome
  FROM tx_states GROUP BY transaction_id)"""
)
def lifecycle_timeline(spark, sf):
    return lifecycle.timeline(V.tx_states(spark, sf))


@check(
    V.with_views(V.TX)
    + """SELECT source_partner, COUNT(*) AS measured, AVG(s) AS avg_latency,
  MIN(s) AS min_latency, MAX(s) AS max_latency, quantile_cont(s, 0.5) AS p50_latency,
  quantile_cont(s, 0.95) AS p95_latency, quantile_cont(s, 0.99) AS p99_latency
FROM (SELECT source_partner, date_sub('second', transaction_time, updated_at) AS s FROM tx)
GROUP BY source_partner"""
)
def partner_latency(spark, sf):
    return lifecycle.latency_by_partner(V.tx(spark, sf), "source_partner")


# ---- silver ---------------------------------------------------------------


@check(V.with_views(V.TX_STATES, V.LATEST) + "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM latest")
def latest_state_per_key(spark, sf):
    latest = dedup.latest_per_key(
        V.tx_states(spark, sf), ["transaction_id"], ["updated_at"], V.STATE_TIES
    )
    return plain(V.with_orders(latest, spark, sf))


@check(V.with_views(V.TX_STATES) + "SELECT DISTINCT transaction_id, true AS is_a_stored_row FROM tx_states")
def dedup_any_row(spark, sf):
    """Which row is chosen is open; it must be one row per key, and whole as it is stored."""
    states = V.tx_states(spark, sf)
    chosen = dedup.any_per_key(states, ["transaction_id"]).alias("c")
    same = [F.col(f"c.{c}").eqNullSafe(F.col(f"s.{c}")) for c in states.columns]
    whole = chosen.join(states.alias("s"), reduce(and_, same), "left_semi")
    return whole.select("transaction_id", F.lit(True).alias("is_a_stored_row"))


def _silver(spark: SparkSession, raw: DataFrame, table: str) -> DataFrame:
    return plain(projection.project(projection.all_strings(raw), SPECS[table], RUN_TS))


@check(
    V.with_views(V.USERS)
    + f"""SELECT TRY_CAST(CAST(user_id AS VARCHAR) AS BIGINT) AS user_id,
  TRY_CAST(CAST(current_age AS VARCHAR) AS INTEGER) AS age,
  TRY_CAST(CAST(yearly_income AS VARCHAR) AS DOUBLE) AS income, source_partner AS partner,
  TIMESTAMP '{AS_OF}' AS ingest_ts FROM users"""
)
def silver_projection_users(spark, sf):
    return _silver(spark, V.users(spark, sf), "users")


@check(
    V.with_views(V.CARDS)
    + f"""SELECT TRY_CAST(CAST(card_id AS VARCHAR) AS BIGINT) AS card_id, card_brand,
  TRY_CAST(CAST(card_on_dark_web AS VARCHAR) AS BOOLEAN) AS is_compromised,
  TRY_CAST(CAST(credit_limit AS VARCHAR) AS DOUBLE) AS credit_limit, source_partner AS partner,
  TIMESTAMP '{AS_OF}' AS ingest_ts FROM cards"""
)
def silver_projection_cards(spark, sf):
    return _silver(spark, V.cards(spark, sf), "cards")


TYPED_TX = f"""SELECT transaction_id, TRY_CAST(user_id AS BIGINT) AS user_id,
  TRY_CAST(card_id AS BIGINT) AS card_id,
  CAST(ROUND(TRY_CAST(amount AS DECIMAL(18,2)), 2) AS DOUBLE) AS amount, status,
  TRY_CAST(transaction_time AS TIMESTAMP) AS transaction_time,
  TRY_CAST(updated_at AS TIMESTAMP) AS updated_at, use_chip,
  TRY_CAST(merchant_id AS BIGINT) AS merchant_id, merchant_name,
  TRY_CAST(mcc AS BIGINT) AS mcc, TRY_CAST(risk_score AS DOUBLE) AS risk_score,
  source_partner AS partner,
  CAST(CAST(ROUND(TRY_CAST(amount AS DECIMAL(18,2)) * 4.70, 2) AS DECIMAL(18,2)) AS DOUBLE) AS amount_myr,
  TIMESTAMP '{AS_OF}' AS ingest_ts FROM tx_text"""


@check(V.with_views(V.TX, V.TX_TEXT) + TYPED_TX)
def silver_projection_transactions(spark, sf):
    return _silver(spark, V.tx_text(spark, sf), "transactions")


@check(
    V.with_views(V.TX, V.TX_TEXT)
    + """SELECT transaction_id AS as_text, TRY_CAST(mcc AS BIGINT) AS as_bigint,
  TRY_CAST(mcc AS INTEGER) AS as_int, TRY_CAST(risk_score AS DOUBLE) AS as_double,
  CAST(TRY_CAST(amount AS DECIMAL(18,2)) AS DOUBLE) AS as_money,
  CAST(CAST(ROUND(TRY_CAST(amount AS DECIMAL(18,2)) * 4.70, 2) AS DECIMAL(18,2)) AS DOUBLE) AS as_myr,
  TRY_CAST(CASE WHEN amount = 'abc' THEN amount ELSE CAST(status = 'SUCCESS' AS VARCHAR) END AS BOOLEAN) AS as_boolean,
  TRY_CAST(updated_at AS TIMESTAMP) AS as_timestamp, TRY_CAST(amount AS TIMESTAMP) AS amount_as_timestamp,
  TRY_CAST(transaction_id || '.49999999999' AS BIGINT) AS just_below_half,
  TRY_CAST('-' || transaction_id || '.50000000000000' AS INTEGER) AS just_half
FROM tx_text"""
)
def try_cast_matrix(spark, sf):
    amount = F.col("amount")
    flag = F.when(amount == "abc", amount).otherwise((F.col("status") == "SUCCESS").cast("string"))
    return plain(
        V.tx_text(spark, sf).select(
            casts.to_text(F.col("transaction_id")).alias("as_text"),
            casts.to_bigint(F.col("mcc")).alias("as_bigint"),
            casts.to_int(F.col("mcc")).alias("as_int"),
            casts.to_double(F.col("risk_score")).alias("as_double"),
            casts.to_money(amount).alias("as_money"),
            casts.to_myr(amount).alias("as_myr"),
            casts.to_boolean(flag).alias("as_boolean"),
            casts.to_timestamp(F.col("updated_at")).alias("as_timestamp"),
            casts.to_timestamp(amount).alias("amount_as_timestamp"),
            casts.to_bigint(F.concat("transaction_id", F.lit(".49999999999"))).alias("just_below_half"),
            casts.to_int(F.concat(F.lit("-"), "transaction_id", F.lit(".50000000000000"))).alias("just_half"),
        )
    )


@check(V.with_views(V.USERS) + "SELECT * FROM users")
def pass_through_projection(spark, sf):
    undeclared = table_from_payload({"table": "users", "pk": "user_id"})
    return projection.project(V.users(spark, sf), undeclared, RUN_TS)


@check(V.with_views(V.TX) + "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM tx")
def all_string_bronze(spark, sf):
    raw = V.tx(spark, sf)
    text = projection.all_strings(raw)
    return plain(text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in raw.schema]))


@check(
    V.with_views(V.TX)
    + """SELECT transaction_id, '2024-01-31 00:00:00' AS ingest_ts, lower('PARTNER_A') AS source_partner,
  'transactions' AS batch_table, strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f') AS watermark_text FROM tx"""
)
def lineage_columns(spark, sf):
    rows = projection.with_lineage(V.tx(spark, sf), "PARTNER_A", "transactions", RUN_TS)
    return rows.select(
        "transaction_id",
        "ingest_ts",
        "source_partner",
        "batch_table",
        watermark_text(F.col("updated_at")).alias("watermark_text"),
    )


@check(
    V.with_views(V.TX, V.TX_BADKEYS)
    + """SELECT transaction_id, user_id, transaction_time,
  CASE WHEN transaction_id IS NULL THEN 'null key: transaction_id' END AS reject_reason FROM tx_badkeys"""
)
def reject_null_keys(spark, sf):
    good, rejected = projection.split_rejects(V.tx_badkeys(spark, sf), ["transaction_id"])
    columns = ["transaction_id", "user_id", "transaction_time"]
    return ups.union_evolved(good.select(*columns), rejected.select(*columns, "reject_reason"))


@check(
    V.with_views(V.TX, V.TX_TEXT)
    + """SELECT * FROM (
  SELECT 'amount' AS column_name, COUNT(amount) AS present,
    COUNT(CASE WHEN TRY_CAST(amount AS DECIMAL(18,2)) IS NULL THEN amount END) AS failed FROM tx_text
  UNION ALL SELECT 'mcc', COUNT(mcc), COUNT(CASE WHEN TRY_CAST(mcc AS BIGINT) IS NULL THEN mcc END) FROM tx_text
  UNION ALL SELECT 'user_id', COUNT(user_id), COUNT(CASE WHEN TRY_CAST(user_id AS BIGINT) IS NULL THEN user_id END) FROM tx_text
  UNION ALL SELECT 'transaction_time', COUNT(transaction_time),
    COUNT(CASE WHEN TRY_CAST(transaction_time AS TIMESTAMP) IS NULL THEN 1 END) FROM tx_text
  UNION ALL SELECT 'status', COUNT(status), COUNT(CASE WHEN TRY_CAST(status AS BIGINT) IS NULL THEN status END) FROM tx_text)"""
)
def cast_failure_report(spark, sf):
    return quality.cast_failures(
        V.tx_text(spark, sf),
        {
            "amount": casts.to_money(F.col("amount")),
            "mcc": casts.to_bigint(F.col("mcc")),
            "user_id": casts.to_bigint(F.col("user_id")),
            "transaction_time": casts.to_timestamp(F.col("transaction_time")),
            "status": casts.to_bigint(F.col("status")),
        },
    )


# ---- partners, increments, upserts -----------------------------------------


@check(
    V.with_views(V.TX)
    + """SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount, CASE source_partner WHEN 'partner_a' THEN use_chip END AS use_chip),
  CASE source_partner WHEN 'partner_b' THEN '_partner_b' ELSE '' END AS table_suffix FROM tx"""
)
def partner_union(spark, sf):
    split = parts(V.tx(spark, sf))
    tables = {
        "transactions": split["partner_a"],
        "transactions_partner_b": split["partner_b"].drop("use_chip"),
    }
    both = union_partners(partner_frames(tables.__getitem__, "transactions"))
    suffix = predicates.table_suffix(F.col("source_partner"), SUFFIXES)
    return plain(both.withColumn("table_suffix", suffix))


MARKS_SQL = f"""marks AS (SELECT 'partner_a' AS partner, 'transactions' AS table_name,
  MAX(updated_at) AS watermark FROM tx WHERE source_partner = 'partner_a' AND updated_at <= TIMESTAMP '{MID}')"""


def _first_marks(tx: DataFrame) -> DataFrame:
    """Marks after a first run of one partner up to the middle of the month."""
    first = tx.where((F.col("source_partner") == "partner_a") & (F.col("updated_at") <= moment(MID)))
    none = first.sparkSession.createDataFrame([], "partner string, table_name string, watermark timestamp_ntz")
    return incremental.advance_watermarks(none, first, "updated_at", "transactions")


@check(
    V.with_views(V.TX, MARKS_SQL)
    + """SELECT transaction_id, source_partner, updated_at FROM tx LEFT JOIN marks ON partner = source_partner
WHERE updated_at > COALESCE(watermark, TIMESTAMP '1970-01-01 00:00:00')"""
)
def incremental_extract(spark, sf):
    tx = V.tx(spark, sf)
    new = incremental.changed_since_marks(tx, "updated_at", "transactions", _first_marks(tx))
    return new.select("transaction_id", "source_partner", "updated_at")


@check(
    V.with_views(V.TX)
    + f"SELECT transaction_id, source_partner, transaction_time FROM tx WHERE transaction_time > TIMESTAMP '{MID}'"
)
def incremental_extract_pushed(spark, sf):
    """All partners have marks, so the lowest bounds the scan of the stored column."""
    tx = V.tx(spark, sf)
    names = ["partner_a", "partner_b"]
    marks = spark.sql(
        "SELECT explode(array('partner_a', 'partner_b')) AS partner, 'transactions' AS table_name, "
        f"timestamp_ntz'{MID}' AS watermark"
    )
    new = incremental.changed_since_marks(tx, "transaction_time", "transactions", marks, partners=names)
    return new.select("transaction_id", "source_partner", "transaction_time")


@check(
    V.with_views(V.TX, MARKS_SQL)
    + f"""SELECT partner, table_name, MAX(watermark) AS watermark FROM (
  SELECT * FROM marks
  UNION ALL SELECT source_partner, 'transactions', MAX(updated_at) FROM tx
    WHERE updated_at > TIMESTAMP '{MID}' GROUP BY 1
  UNION ALL SELECT 'partner_b', 'users', TIMESTAMP '{EPOCH}') GROUP BY 1, 2"""
)
def watermark_advance(spark, sf):
    tx = V.tx(spark, sf)
    other = _first_marks(tx).select(
        F.lit("partner_b").alias("partner"), F.lit("users").alias("table_name"), moment(EPOCH).alias("watermark")
    )
    marks = _first_marks(tx).unionByName(other)
    batch = incremental.changed_since(tx, "updated_at", MID)
    after = incremental.advance_watermarks(marks, batch, "updated_at", "transactions")
    return incremental.advance_watermarks(after, batch.where(F.lit(False)), "updated_at", "transactions")


def _halves(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    early = F.col("updated_at") < moment(SHIP_SPLIT)
    return tuple(
        dedup.latest_per_key(half, ["transaction_id"], ["updated_at"], V.STATE_TIES)
        for half in (changes.where(early), changes.where(~early))
    )


@check(ORACLES["latest_state_per_key"])
def upsert_by_key(spark, sf):
    first, second = _halves(V.tx_states(spark, sf))
    return plain(V.with_orders(ups.upsert(first, second, ["transaction_id"]), spark, sf))


@check(ORACLES["latest_state_per_key"])
def upsert_out_of_order(spark, sf):
    first, second = _halves(V.tx_states(spark, sf))
    newer_by = ["updated_at", *V.STATE_TIES]
    merged = ups.upsert(second, first, ["transaction_id"], newer_by)
    return plain(V.with_orders(merged, spark, sf))


@check(
    V.with_views(V.USERS)
    + """SELECT user_id, CASE WHEN yearly_income >= 0 THEN current_age ELSE -1 END AS current_age, yearly_income
FROM users"""
)
def insert_if_absent(spark, sf):
    users = V.users(spark, sf).select("user_id", "current_age", "yearly_income")
    stored = users.where(F.col("yearly_income") >= 0)
    offered = users.where(F.col("yearly_income") < 5000).withColumn("current_age", F.lit(-1))
    return ups.insert_if_absent(stored, offered.unionByName(offered), ["user_id"])


@check(V.with_views(V.USERS) + "SELECT user_id, current_age, source_partner FROM users")
def duplicate_source_columns(spark, sf):
    """A source that names columns twice, written to bronze: the first of each name counts."""
    root = scratch_path(spark, "bronze")
    users = V.users(spark, sf)
    twice = users.select("user_id", "current_age", "source_partner", "user_id", (F.col("current_age") + 1).alias("current_age"))
    bronze.write_increment(twice, root, "partner_a", "users", RUN_TS)
    back = bronze.read_bronze(spark, root, "users", ["user_id", "current_age", "source_partner"])
    asked = users.select("user_id", "source_partner")
    found = back.select(F.col("user_id").cast("bigint"), F.col("current_age").cast("bigint"))
    return found.join(asked, "user_id").select("user_id", "current_age", "source_partner")


@check(
    V.with_views(V.USERS)
    + """SELECT user_id, current_age, CASE WHEN source_partner = 'partner_b' THEN credit_score END AS credit_score
FROM users"""
)
def schema_union_by_name(spark, sf):
    split = parts(V.users(spark, sf))
    old = split["partner_a"].select("user_id", "current_age")
    return ups.union_evolved(old, split["partner_b"].select("credit_score", "user_id", "current_age"))


@check(
    V.with_views(V.TX)
    + f"""SELECT transaction_id, ingest_ts FROM tx WHERE ingest_ts > (
  SELECT MAX(ingest_ts) FROM tx WHERE transaction_time < TIMESTAMP '{MID}')"""
)
def silver_incremental_read(spark, sf):
    tx = V.tx(spark, sf).select("transaction_id", "transaction_time", "ingest_ts")
    stored = tx.where(F.col("transaction_time") < moment(MID)).drop("transaction_time")
    mark = incremental.high_watermark(stored, "updated_at", "ingest_ts").first()[0]
    fresh = incremental.newer_than(tx, F.col("ingest_ts"), mark)
    return fresh.select("transaction_id", "ingest_ts")


# ---- audit and quality -----------------------------------------------------


@check(
    V.with_views(V.TX, V.TX_BADKEYS, V.USERS)
    + """SELECT 'source_to_bronze' AS pipeline_stage, 'transactions' AS table_name,
  (SELECT COUNT(*) FROM tx) AS source_count, (SELECT COUNT(*) FROM tx_badkeys) AS target_count,
  (SELECT COUNT(*) FROM tx_badkeys WHERE transaction_id IS NULL) AS null_pk_count
UNION ALL SELECT 'source_to_bronze', 'users', (SELECT COUNT(*) FROM users),
  (SELECT COUNT(*) FROM users WHERE yearly_income >= 0), 0"""
)
def audit_source_to_bronze(spark, sf):
    return _bronze_audit(spark, sf).select(
        "pipeline_stage", "table_name", "source_count", "target_count", "null_pk_count"
    )


def _bronze_audit(spark: SparkSession, sf: str) -> DataFrame:
    users = V.users(spark, sf)
    layers = [
        audit.Layer("transactions", "source", V.tx(spark, sf), ("transaction_id",)),
        audit.Layer("transactions", "bronze", V.tx_badkeys(spark, sf), ("transaction_id",)),
        audit.Layer("users", "source", users, ("user_id",)),
        audit.Layer("users", "bronze", users.where(F.col("yearly_income") >= 0), ("user_id",)),
    ]
    return audit.source_to_bronze(layers, RUN_TS)


@check(
    V.with_views(V.TX_STATES, V.USERS)
    + """SELECT 'bronze_to_silver' AS pipeline_stage, 'transactions' AS table_name,
  (SELECT COUNT(*) FROM tx_states) AS bronze_raw_count,
  (SELECT COUNT(DISTINCT transaction_id) FROM tx_states) AS silver_deduped_count, 0 AS null_pk_count
UNION ALL SELECT 'bronze_to_silver', 'users', (SELECT COUNT(*) FROM users), (SELECT COUNT(*) FROM users), 0"""
)
def audit_bronze_to_silver(spark, sf):
    states, users = V.tx_states(spark, sf), V.users(spark, sf)
    silver = dedup.latest_per_key(states, ["transaction_id"], ["updated_at"], V.STATE_TIES)
    layers = [
        audit.Layer("transactions", "bronze", states, ("transaction_id",)),
        audit.Layer("transactions", "silver", silver, ("transaction_id",)),
        audit.Layer("users", "bronze", users, ("user_id",)),
        audit.Layer("users", "silver", users, ("user_id",)),
    ]
    return audit.bronze_to_silver(layers, RUN_TS).select(
        "pipeline_stage", "table_name", "bronze_raw_count", "silver_deduped_count", "null_pk_count"
    )


@check(
    "WITH audit AS ("
    + ORACLES["audit_source_to_bronze"]
    + """)
SELECT pipeline_stage, table_name, 'null_key' AS rule, null_pk_count > 0 AS breached,
  CAST(null_pk_count AS BIGINT) AS detail FROM audit
UNION ALL SELECT pipeline_stage, table_name, 'row_parity', source_count <> target_count,
  target_count - source_count FROM audit
UNION ALL SELECT pipeline_stage, table_name, 'unreadable', false, 0 FROM audit
UNION ALL SELECT pipeline_stage, table_name, 'partner_failed', table_name = 'users',
  CASE WHEN table_name = 'users' THEN 1 ELSE 0 END FROM audit
UNION ALL SELECT pipeline_stage, table_name, 'type_mismatch', table_name = 'transactions' AND n > 0,
  CASE WHEN table_name = 'transactions' THEN n ELSE 0 END
  FROM audit, (SELECT count(*) AS n FROM events WHERE event_id % 101 = 0)"""
)
def circuit_breaker_report(spark, sf):
    failures = quality.cast_failures(V.tx_text(spark, sf), {"amount": casts.to_money(F.col("amount"))})
    wrong = failures.agg(F.sum("failed").alias("wrong")).withColumn("table_name", F.lit("transactions"))
    asked = _bronze_audit(spark, sf).join(wrong, "table_name", "left")
    return audit.breaches(
        asked.withColumns(
            {
                "type_mismatches": F.coalesce("wrong", F.lit(0)),
                "failed_partners": F.when(F.col("table_name") == "users", 1).otherwise(0),
            }
        )
    )


@check(
    V.with_views(V.TX_STATES, V.USERS)
    + """SELECT *, silver_count = gold_count AS gold_parity FROM (
SELECT 'transactions' AS table_name, (SELECT COUNT(*) FROM tx_states) AS source_count,
  (SELECT COUNT(*) FROM tx_states) AS bronze_count,
  (SELECT COUNT(DISTINCT transaction_id) FROM tx_states) AS bronze_keys_count,
  (SELECT COUNT(DISTINCT transaction_id) FROM tx_states) AS silver_count,
  CAST(NULL AS BIGINT) AS gold_count, true AS bronze_parity, true AS silver_parity
UNION ALL SELECT 'users', (SELECT COUNT(*) FROM users),
  (SELECT COUNT(*) FROM users WHERE yearly_income >= 0),
  (SELECT COUNT(*) FROM users WHERE yearly_income >= 0), (SELECT COUNT(*) FROM users),
  (SELECT COUNT(*) FROM users), (SELECT COUNT(*) = COUNT(CASE WHEN yearly_income >= 0 THEN 1 END) FROM users),
  (SELECT COUNT(*) = COUNT(CASE WHEN yearly_income >= 0 THEN 1 END) FROM users))"""
)
def reconcile_layers(spark, sf):
    states, users = V.tx_states(spark, sf), V.users(spark, sf)
    silver = dedup.latest_per_key(states, ["transaction_id"], ["updated_at"], V.STATE_TIES)
    key, uid = ("transaction_id",), ("user_id",)
    layers = [
        audit.Layer("transactions", "source", states, key),
        audit.Layer("transactions", "bronze", states, key),
        audit.Layer("transactions", "silver", silver, key),
        audit.Layer("users", "source", users, uid),
        audit.Layer("users", "bronze", users.where(F.col("yearly_income") >= 0), uid),
        audit.Layer("users", "silver", users, uid),
        audit.Layer("users", "gold", user_risk_profile(spark, sf), uid),
    ]
    return audit.reconcile(layers)


@check(
    V.with_views(V.TX, V.TX_BADKEYS)
    + """SELECT 'transaction_id' AS column_name, COUNT(*) AS row_count,
  COUNT(CASE WHEN transaction_id IS NULL THEN 1 END) AS null_count FROM tx_badkeys
UNION ALL SELECT 'user_id', COUNT(*), COUNT(CASE WHEN user_id IS NULL THEN 1 END) FROM tx_badkeys
UNION ALL SELECT 'amount', COUNT(*), COUNT(CASE WHEN amount IS NULL THEN 1 END) FROM tx_badkeys
UNION ALL SELECT 'status', COUNT(*), COUNT(CASE WHEN status IS NULL THEN 1 END) FROM tx_badkeys"""
)
def null_profile(spark, sf):
    return quality.null_profile(V.tx_badkeys(spark, sf), ["transaction_id", "user_id", "amount", "status"])


@check(
    V.with_views(V.USERS)
    + """SELECT 'user_id' AS column_name, 'none' AS drift, true AS required,
  COUNT(*) - COUNT(user_id) AS unexpected_nulls FROM users
UNION ALL SELECT 'age', 'missing', false, 0
UNION ALL SELECT 'yearly_income', 'retyped', true, COUNT(*) - COUNT(yearly_income) FROM users
UNION ALL SELECT 'current_age', 'added', false, 0
UNION ALL SELECT 'credit_score', 'added', true,
  COUNT(*) - COUNT(CASE WHEN credit_score >= 400 THEN 1 END) FROM users
UNION ALL SELECT 'source_partner', 'added', false, 0"""
)
def schema_integrity(spark, sf):
    score = F.col("credit_score")
    users = V.users(spark, sf).withColumn("credit_score", F.when(score >= 400, score))
    expected = T.StructType.fromDDL("user_id bigint, age int, yearly_income decimal(18,2)")
    report = quality.schema_integrity(users, expected, ["user_id", "yearly_income", "credit_score"])
    return report.select(
        "column_name", "drift", "required", F.col("unexpected_nulls").cast("bigint").alias("unexpected_nulls")
    )


@check(
    V.with_views(V.TX)
    + """SELECT source_partner, COUNT(*) AS row_count, MAX(lag) AS max_lag_seconds, AVG(lag) AS avg_lag_seconds,
  COUNT(CASE WHEN lag > 7200 THEN 1 END) AS late_rows, COUNT(CASE WHEN lag > 7200 THEN 1 END) > 0 AS breached
FROM (SELECT source_partner, date_sub('second', transaction_time, ingest_ts) AS lag FROM tx)
GROUP BY source_partner"""
)
def freshness_sla(spark, sf):
    return quality.freshness(V.tx(spark, sf), partner="source_partner")


@check(
    V.with_views(V.TX, V.TX_VOLUME)
    + """, grid AS (SELECT source_partner, CAST(day AS TIMESTAMP) AS day
  FROM (SELECT DISTINCT source_partner FROM tx_volume),
    (SELECT UNNEST(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS day)),
counted AS (SELECT g.source_partner, g.day, COUNT(t.transaction_id) AS row_count FROM grid g
  LEFT JOIN tx_volume t ON t.source_partner = g.source_partner
    AND CAST(date_trunc('day', t.transaction_time) AS TIMESTAMP) = g.day GROUP BY 1, 2),
based AS (SELECT *, AVG(row_count) OVER (PARTITION BY source_partner ORDER BY day
  ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS baseline FROM counted)
SELECT source_partner, day, row_count, ROUND(baseline, 6) AS baseline,
  CASE WHEN row_count = 0 THEN 'no_data' WHEN baseline > 0 AND row_count >= 5 * baseline THEN 'spike'
    ELSE 'none' END AS anomaly FROM based"""
)
def volume_anomaly(spark, sf):
    return _volume(spark, sf, 30)


@check(ORACLES["volume_anomaly"] + " WHERE day >= TIMESTAMP '2024-01-20'")
def volume_anomaly_recent(spark, sf):
    """A period that starts long after the data does; its first day is a spike."""
    return _volume(spark, sf, 11)


def _volume(spark: SparkSession, sf: str, days: int) -> DataFrame:
    tx = V.tx_volume(spark, sf)
    found = quality.volume_anomalies(tx, date(2024, 1, 30), days, partner="source_partner")
    return found.withColumns({"day": F.col("day").cast("timestamp_ntz"), "baseline": F.round("baseline", 6)})


@check(
    V.with_views(V.TX, V.TX_BADKEYS)
    + """, ledger AS (SELECT CAST(date_trunc('day', ingest_ts) AS TIMESTAMP) AS run_day, source_partner AS table_name,
  COUNT(*) AS bronze_raw_count, COUNT(DISTINCT transaction_id) AS silver_deduped_count,
  COUNT(CASE WHEN transaction_id IS NULL THEN 1 END) AS null_pk_count FROM tx_badkeys GROUP BY 1, 2)
SELECT run_day, table_name, bronze_raw_count, silver_deduped_count, null_pk_count,
  COALESCE(bronze_raw_count - lag(bronze_raw_count) OVER w, 0) AS bronze_raw_count_change,
  COALESCE(silver_deduped_count - lag(silver_deduped_count) OVER w, 0) AS silver_deduped_count_change,
  COALESCE(null_pk_count - lag(null_pk_count) OVER w, 0) AS null_pk_count_change,
  ROUND(null_pk_count / CAST(bronze_raw_count AS DOUBLE), 6) AS null_pk_share
FROM ledger WINDOW w AS (PARTITION BY table_name ORDER BY run_day)"""
)
def audit_trend(spark, sf):
    """The ledger that daily audits of each partner would have left, and its trend."""
    keys = F.col("transaction_id")
    daily = (
        V.tx_badkeys(spark, sf)
        .groupBy(F.date_trunc("day", "ingest_ts").alias("execution_time"), F.col("source_partner").alias("table_name"))
        .agg(
            F.count(F.lit(1)).alias("bronze_raw_count"),
            F.count_distinct(keys).alias("silver_deduped_count"),
            F.count(F.when(keys.isNull(), 1)).alias("null_pk_count"),
        )
        .withColumn("pipeline_stage", F.lit("bronze_to_silver"))
    )
    trend = audit.ledger_trend(managed.conform(daily, LEDGER_SCHEMA))
    changes = ["bronze_raw_count_change", "silver_deduped_count_change", "null_pk_count_change"]
    return trend.select(
        F.col("execution_time").cast("timestamp_ntz").alias("run_day"),
        "table_name",
        "bronze_raw_count",
        "silver_deduped_count",
        "null_pk_count",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in changes],
        F.round("null_pk_share", 6).alias("null_pk_share"),
    )


@check(
    V.with_views(V.TX, V.TX_BADKEYS, V.USERS, V.CARDS)
    + """, results AS (
  SELECT 'not_null' AS test, 'transaction_id' AS column_name,
    COUNT(CASE WHEN transaction_id IS NULL THEN 1 END) AS violations FROM tx_badkeys
  UNION ALL SELECT 'accepted_values', 'status',
    COUNT(CASE WHEN status NOT IN ('PENDING', 'SUCCESS', 'FAILED') THEN 1 END) FROM tx_badkeys
  UNION ALL SELECT 'unique', 'transaction_id', COUNT(*) FROM (SELECT transaction_id FROM tx_badkeys
    WHERE transaction_id IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)
  UNION ALL SELECT 'unique', 'merchant_id', COUNT(*) FROM (SELECT merchant_id FROM tx_badkeys
    GROUP BY 1 HAVING COUNT(*) > 1)
  UNION ALL SELECT 'relationships', 'user_id', COUNT(*) FROM tx_badkeys t
    WHERE NOT EXISTS (SELECT 1 FROM cards c WHERE c.card_id = t.user_id))
SELECT *, violations = 0 AS passed FROM results"""
)
def table_tests(spark, sf):
    return quality.run_table_tests(
        V.tx_badkeys(spark, sf),
        [
            quality.NotNull("transaction_id"),
            quality.Accepted("status", ("PENDING", "SUCCESS", "FAILED")),
            quality.Unique("transaction_id"),
            quality.Unique("merchant_id"),
            quality.Relationship("user_id", V.cards(spark, sf), "card_id"),
        ],
    )


@check(
    V.with_views(V.TX, V.TX_ORPHANS, V.USERS, V.CARDS)
    + """SELECT transaction_id, user_id, card_id,
  concat_ws(', ', CASE WHEN NOT u THEN 'unknown user' END, CASE WHEN NOT c THEN 'unknown card' END) AS orphan_reason
FROM (SELECT *, EXISTS (SELECT 1 FROM users x WHERE x.user_id = t.user_id) AS u,
  EXISTS (SELECT 1 FROM cards x WHERE x.card_id = t.card_id) AS c FROM tx_orphans t)
WHERE NOT u OR NOT c"""
)
def orphan_transactions(spark, sf):
    found = quality.orphan_transactions(V.tx_orphans(spark, sf), V.users(spark, sf), V.cards(spark, sf))
    return found.select("transaction_id", "user_id", "card_id", "orphan_reason")


# ---- written and read back ---------------------------------------------------


def _write_bronze(spark: SparkSession, root: str, rows: DataFrame, run_ts: datetime, table: str) -> None:
    for partner, df in parts(rows).items():
        bronze.write_increment(df, root, partner, table, run_ts, "updated_at")


@check(
    V.with_views(V.TX)
    + """SELECT * EXCLUDE (ingest_ts, source_partner) REPLACE (CAST(amount AS DOUBLE) AS amount),
  source_partner AS partner, 'transactions' AS "table" FROM tx"""
)
def bronze_roundtrip(spark, sf):
    """Two runs a day apart, written per partner and read back with their folder columns."""
    root = scratch_path(spark, "bronze")
    tx = V.tx(spark, sf).drop("ingest_ts")
    early = F.col("updated_at") <= moment(MID)
    _write_bronze(spark, root, tx.where(early), RUN_TS - timedelta(days=1), "transactions")
    _write_bronze(spark, root, tx.where(~early), RUN_TS, "transactions")
    back = bronze.read_bronze(spark, root, "transactions", SPECS["transactions"].bronze_columns())
    types = {f.name: f.dataType for f in tx.schema if f.name != "source_partner"}
    return plain(back.select(*[F.col(c).cast(t) for c, t in types.items()], "partner", "table"))


@check(
    V.with_views(V.TX)
    + f"SELECT transaction_id, source_partner FROM tx WHERE updated_at > TIMESTAMP '{MID}'"
)
def bronze_day_slice(spark, sf):
    """Only the rows that one run date brought, from plain year/month/day folders."""
    root = scratch_path(spark, "bronze")
    tx = V.tx(spark, sf).drop("ingest_ts")
    early = F.col("updated_at") <= moment(MID)
    for rows, ts in ((tx.where(early), RUN_TS - timedelta(days=1)), (tx.where(~early), RUN_TS)):
        for partner, df in parts(rows).items():
            bronze.write_increment(df, root, partner, "transactions", ts, "updated_at", plain=True)
    day = bronze.read_day(spark, root, "transactions", RUN_TS.date(), plain=True)
    return day.select("transaction_id", "source_partner")


@check(
    V.with_views(V.TX_STATES, V.LATEST)
    + """SELECT transaction_id, updated_at, status, CAST(amount AS DOUBLE) AS amount,
  strftime(transaction_time, '%Y-%m') AS month FROM latest"""
)
def stream_latest_state(spark, sf):
    """The change feed in two increments, merged into month folders by two streaming runs."""
    root = scratch_path(spark, "stream")
    states = V.with_orders(V.tx_states(spark, sf), spark, sf).drop("source_partner", "user_id")
    early = F.col("updated_at") < moment(SHIP_SPLIT)
    for half in (states.where(~early), states.where(early)):
        half.write.mode("append").parquet(f"{root}/feed")
        feed = spark.readStream.schema(states.schema).parquet(f"{root}/feed")
        latest_state.stream_latest_state(
            feed.withColumn("month", F.date_format("transaction_time", "yyyy-MM")),
            f"{root}/silver",
            f"{root}/checkpoint",
            ["transaction_id"],
            ["updated_at"],
            V.STATE_TIES,
            "month",
        ).awaitTermination()
    columns = ["transaction_id", "updated_at", "status", "amount", "month"]
    return plain(spark.read.schema(_with_month(states)).parquet(f"{root}/silver").select(*columns))


def _with_month(states: DataFrame) -> T.StructType:
    return T.StructType([*states.schema.fields, T.StructField("month", T.StringType())])


@check(ORACLES["merchant_daily_summary"])
def stream_daily_summary(spark, sf):
    """Transactions in two increments, summed by two streaming runs."""
    root = scratch_path(spark, "stream")
    tx = _in_myr(V.tx(spark, sf)).select("merchant_id", "transaction_time", "amount_myr", "risk_score")
    early = F.col("transaction_time") < moment(MID)
    for half in (tx.where(~early), tx.where(early)):
        half.write.mode("append").parquet(f"{root}/feed")
        feed = spark.readStream.schema(tx.schema).parquet(f"{root}/feed")
        daily_summary.stream_daily_parts(feed, f"{root}/parts", f"{root}/checkpoint").awaitTermination()
    return _summary(daily_summary.read_daily_summary(spark, f"{root}/parts"))


@check(
    V.with_views(V.TX)
    + MERCHANT_SQL.replace(
        "GROUP BY 1, 2",
        """GROUP BY 1, 2 HAVING CAST(date_trunc('day', MIN(transaction_time)) AS TIMESTAMP) + INTERVAL 3 DAYS
  <= (SELECT MAX(transaction_time) FROM tx)""",
    )
)
def stream_closed_days(spark, sf):
    """Days that ended two days or more before the newest transaction, each emitted once."""
    root = scratch_path(spark, "stream")
    tx = _in_myr(V.tx(spark, sf)).select("merchant_id", "transaction_time", "amount_myr", "risk_score")
    tx.write.parquet(f"{root}/feed")
    feed = spark.readStream.schema(tx.schema).parquet(f"{root}/feed")
    days = daily_summary.closed_days(feed, "2 days")
    sink = days.writeStream.outputMode("append").option("checkpointLocation", f"{root}/checkpoint")
    sink.trigger(availableNow=True).format("parquet").start(f"{root}/days").awaitTermination()
    return _summary(spark.read.schema(days.schema).parquet(f"{root}/days"))


@check(
    V.with_views(V.TX)
    + """SELECT transaction_id, source_partner, CAST(amount AS DOUBLE) AS amount, transaction_time,
  CAST(date_trunc('day', transaction_time) AS TIMESTAMP) AS event_day FROM tx"""
)
def published_by_event_day(spark, sf):
    """A table replaced by rows read from itself, kept in folders by event day."""
    root = scratch_path(spark, "published")
    tx = V.tx(spark, sf).select("transaction_id", "source_partner", "amount", "transaction_time")
    tx = tx.withColumn("event_date", F.to_date("transaction_time"))
    name = "tx_" + root.rsplit("-", 1)[-1]
    first = tx.where(F.col("source_partner") == "partner_a")
    stored = managed.publish(first, root, name, ["event_date"], temporary=True)
    rest = tx.where(F.col("source_partner") != "partner_a")
    both = managed.publish(ups.union_evolved(stored, rest), root, name, ["event_date"], temporary=True)
    day = F.col("event_date").cast("timestamp_ntz").alias("event_day")
    return plain(both.select("transaction_id", "source_partner", "amount", "transaction_time", day))


@check(
    V.with_views(V.TX_STATES, V.LATEST)
    + """SELECT transaction_id, updated_at, status, source_partner FROM latest"""
)
def upsert_by_folder(spark, sf):
    """Two batches of changes, the later one first, merged into folders that are rewritten only
    where a batch touches them."""
    root = scratch_path(spark, "folders")
    first, second = _halves(V.tx_states(spark, sf))
    newer_by = ["updated_at", *V.STATE_TIES]
    for batch in (second, first):
        managed.upsert_partitions(spark, root, batch, ["transaction_id"], "source_partner", newer_by)
    columns = ["transaction_id", "updated_at", "status", "source_partner"]
    return spark.read.schema(first.schema).parquet(root).select(*columns)


def _sources(spark: SparkSession, sf: str, before: str | None = None) -> dict:
    tx = V.tx(spark, sf).drop("ingest_ts")
    if before is not None:
        tx = tx.where(F.col("updated_at") <= moment(before))
    tables = {"transactions": tx, "users": V.users(spark, sf), "cards": V.cards(spark, sf)}
    split = {t: parts(df) for t, df in tables.items()}
    return {p: {t: split[t][p.lower()] for t in tables} for p in ("PARTNER_A", "PARTNER_B")}


def _view_names(root: str) -> dict[str, str]:
    """Temporary views of this call alone, as a session may run a query more than once."""
    call = root.rsplit("-", 1)[-1]
    return {"silver": f"silver_{call}_", "gold": f"gold_{call}_"}


@check(ORACLES["user_risk_profile"])
def layers_full_refresh(spark, sf):
    """Two runs over all layers with full silver refreshes; the profile after the second."""
    root = scratch_path(spark, "layers")
    names = _view_names(root)
    run_day(spark, _sources(spark, sf, MID), Run(root, RUN_TS - timedelta(hours=2), **names))
    return run_day(spark, _sources(spark, sf), Run(root, RUN_TS, **names))


@check(ORACLES["user_risk_profile"])
def layers_incremental(spark, sf):
    """The same two runs, with the second merging only what is new into silver."""
    root = scratch_path(spark, "layers")
    names = _view_names(root)
    first = Run(root, RUN_TS - timedelta(hours=2), **names)
    run_day(spark, _sources(spark, sf, MID), first, incremental=True)
    return run_day(spark, _sources(spark, sf), Run(root, RUN_TS, **names), incremental=True)


@check(ORACLES["user_risk_profile"])
def layers_resumed(spark, sf):
    """A first attempt in which one partner fails, then the same run again, merged by increments."""
    root = scratch_path(spark, "layers")
    run = Run(root, RUN_TS, **_view_names(root))
    sources = _sources(spark, sf)
    lost = dict(sources["PARTNER_B"])
    lost["transactions"] = lost["transactions"].withColumn("status", F.raise_error(F.lit("source is down")).cast("string"))
    try:
        run_day(spark, {**sources, "PARTNER_B": lost}, run, incremental=True)
    except audit.CircuitOpen as e:
        if "partner_failed" not in str(e):
            raise
    return run_day(spark, sources, run, incremental=True)


@check(
    V.with_views(V.TX, V.TX_BADKEYS)
    + """SELECT transaction_id, status, updated_at, CAST(NULL AS VARCHAR) AS reject_reason FROM tx_badkeys
  WHERE transaction_id IS NOT NULL
UNION ALL SELECT transaction_id, status, updated_at, 'null key: transaction_id' FROM tx_badkeys
  WHERE transaction_id IS NULL"""
)
def layers_incremental_rejects(spark, sf):
    """Rows without a key through two incremental runs: silver and what was set aside."""
    root = scratch_path(spark, "layers")
    names = _view_names(root)
    bad = V.tx_badkeys(spark, sf).drop("ingest_ts")
    for k, rows in enumerate((bad.where(F.col("updated_at") <= moment(MID)), bad)):
        split, others = parts(rows), _sources(spark, sf)
        sources = {p: {**others[p], "transactions": split[p.lower()]} for p in others}
        run_day(spark, sources, Run(root, RUN_TS + timedelta(hours=k), rejects=True, **names), incremental=True)
    columns = ["transaction_id", "status", "updated_at"]
    silver = spark.table(f"{names['silver']}transactions").select(*columns)
    aside = spark.table(f"{names['silver']}transactions_rejects").select(*columns, "reject_reason")
    return ups.union_evolved(silver, aside)


@check(
    V.with_views(V.TX_STATES, V.LATEST)
    + """SELECT transaction_id, updated_at, status, strftime(updated_at, '%Y') AS year FROM latest"""
)
def upsert_moved_folders(spark, sf):
    """Two batches in folders by the year of the last change: most keys of the second one move."""
    root = scratch_path(spark, "folders")
    columns = ["transaction_id", "updated_at", "status", F.date_format("updated_at", "yyyy").alias("year")]
    newer_by = ["updated_at", "status"]
    halves = [half.select(*columns) for half in _halves(V.tx_states(spark, sf))]
    for batch in halves:
        managed.upsert_partitions(spark, root, batch, ["transaction_id"], "year", newer_by, batch.schema)
    return spark.read.schema(halves[0].schema).parquet(root)


@check(
    ORACLES["audit_bronze_to_silver"]
    + """ UNION ALL SELECT pipeline_stage, table_name, NULL, NULL, null_pk_count FROM ("""
    + ORACLES["audit_source_to_bronze"]
    + ")"
)
def ledger_written(spark, sf):
    """Both audits appended to a declared ledger table and read back by its name."""
    root = scratch_path(spark, "ledger")
    name = "ledger_" + root.rsplit("-", 1)[-1]
    managed.create_table(spark, name, LEDGER_SCHEMA, f"{root}/rows")
    states, users = V.tx_states(spark, sf), V.users(spark, sf)
    silver = dedup.latest_per_key(states, ["transaction_id"], ["updated_at"], V.STATE_TIES)
    layers = [
        audit.Layer("transactions", "bronze", states, ("transaction_id",)),
        audit.Layer("transactions", "silver", silver, ("transaction_id",)),
        audit.Layer("users", "bronze", users, ("user_id",)),
        audit.Layer("users", "silver", users, ("user_id",)),
    ]
    for rows in (audit.bronze_to_silver(layers, RUN_TS), _bronze_audit(spark, sf)):
        managed.append_rows(managed.conform(rows, LEDGER_SCHEMA), f"{root}/rows")
    spark.catalog.refreshTable(name)
    return managed.read_table(spark, name).select(
        "pipeline_stage", "table_name", "bronze_raw_count", "silver_deduped_count", "null_pk_count"
    )


@check(ORACLES["unified_wallet"])
def wallet_table(spark, sf):
    """The unified wallet in a namespace, as an external table with its declared schema."""
    root = scratch_path(spark, "wallet")
    namespace = "lake_" + root.rsplit("-", 1)[-1]
    managed.create_namespace(spark, namespace, f"{root}/space")
    name = f"{namespace}.wallet"
    managed.create_table(spark, name, UNIFIED_WALLET_SCHEMA, f"{root}/rows")
    tx = V.tx(spark, sf).withColumnRenamed("source_partner", "partner")
    users = V.users(spark, sf).drop("source_partner")
    wide = gold.unified_wallet(tx, users, V.cards(spark, sf).drop("source_partner"))
    managed.append_rows(wide, f"{root}/rows")
    spark.catalog.refreshTable(name)
    return plain(managed.read_table(spark, name))


@check(ORACLES["user_risk_profile"])
def profile_table(spark, sf):
    """The profile stored as a declared table, its keys enforced."""
    root = scratch_path(spark, "profile")
    name = "profile_" + root.rsplit("-", 1)[-1]
    managed.create_table(spark, name, PROFILE_SCHEMA, f"{root}/rows")
    managed.append_rows(gold.keyed_profile(user_risk_profile(spark, sf)), f"{root}/rows")
    spark.catalog.refreshTable(name)
    return managed.read_table(spark, name)


@check(ORACLES["merchant_daily_summary"])
def stream_summary_folded(spark, sf):
    """Three streaming runs, the first two folded into one set of sums in between."""
    root = scratch_path(spark, "stream")
    tx = _in_myr(V.tx(spark, sf)).select("merchant_id", "transaction_time", "amount_myr", "risk_score")
    for k in range(3):
        tx.where(F.col("merchant_id") % 3 == k).write.mode("append").parquet(f"{root}/feed")
        feed = spark.readStream.schema(tx.schema).parquet(f"{root}/feed")
        daily_summary.stream_daily_parts(feed, f"{root}/parts", f"{root}/checkpoint").awaitTermination()
        if k == 1:
            daily_summary.fold_daily_parts(spark, f"{root}/parts")
    return _summary(daily_summary.read_daily_summary(spark, f"{root}/parts"))


@check(
    V.with_views(V.TX)
    + f"""SELECT 'freshness' AS log, source_partner AS subject, COUNT(*) AS row_count,
  COUNT(*) FILTER (date_sub('second', transaction_time, TIMESTAMP '{AS_OF}') > 7200) AS late_or_gold, true AS said
FROM tx GROUP BY 2
UNION ALL SELECT 'volume', source_partner, COUNT(*) FILTER (transaction_time >= TIMESTAMP '{AS_OF}'), 0,
  COUNT(*) FILTER (transaction_time >= TIMESTAMP '{AS_OF}') = 0 FROM tx GROUP BY 2
UNION ALL SELECT 'layers', 'transactions', (SELECT COUNT(*) FROM tx), NULL, true
UNION ALL SELECT 'layers', 'cards', (SELECT COUNT(*) FROM supplier), NULL, true
UNION ALL SELECT 'layers', 'users', (SELECT COUNT(*) FROM customer), (SELECT COUNT(*) FROM customer), true"""
)
def layers_report(spark, sf):
    """What a run logs besides its ledger: lateness, a day without rows, and agreeing layers."""
    root = scratch_path(spark, "layers")
    run_day(spark, _sources(spark, sf), Run(root, RUN_TS, report=True, **_view_names(root)))
    log = {name: spark.read.parquet(f"{root}/quality/{name}") for name in ("freshness", "volume", "layers")}
    agree = F.col("bronze_parity") & F.col("silver_parity") & F.coalesce("gold_parity", F.lit(True))
    found = [
        log["freshness"].select("partner", "row_count", "late_rows", "breached"),
        log["volume"].select("partner", "row_count", F.lit(0), F.col("anomaly") == "no_data"),
        log["layers"].select("table_name", "silver_count", "gold_count", agree),
    ]
    columns = ["subject", "row_count", "late_or_gold", "said"]
    rows = [df.toDF(*columns).select(F.lit(name).alias("log"), "*") for name, df in zip(log, found)]
    return reduce(DataFrame.unionByName, rows)


# ---- batches held back, feeds of changes ------------------------------------------


@check(
    V.with_views(V.TX)
    + """SELECT mode, step, transaction_id,
  CASE WHEN source_partner = 'partner_a' OR CAST(transaction_id AS BIGINT) % 101 <> 0 THEN CAST(amount AS DOUBLE) END AS amount
FROM tx, (VALUES ('full'), ('incremental')) m(mode), (VALUES ('held'), ('released')) s(step)
WHERE step = 'released' OR source_partner = 'partner_a'"""
)
def layers_quarantined(spark, sf):
    """One partner's batch has amounts that no cast reads. It stops the run; the next one goes on
    without it, and the one after that with it, once it is released. Both modes."""
    found = []
    readable = F.col("transaction_id").cast("bigint") % 101 != 0
    amount = F.when(readable, F.col("amount").cast("string")).otherwise("abc")
    wrong = V.tx(spark, sf).drop("ingest_ts").withColumn("amount", amount)
    for mode in ("full", "incremental"):
        root = scratch_path(spark, "layers")
        names, sources = _view_names(root), _sources(spark, sf)
        sources["PARTNER_B"]["transactions"] = parts(wrong)["partner_b"]
        try:
            run_day(spark, sources, Run(root, RUN_TS, **names), mode == "incremental")
        except audit.CircuitOpen as e:
            if "type_mismatch" not in str(e):
                raise
        else:
            raise RuntimeError("a stopped batch passed")
        for hour, step in enumerate(("held", "released"), 1):
            if step == "released":
                ids = [b.batch_id for b in batches.batches_in(spark, root, batches.STOPPED)]
                batches.release_batches(spark, root, ids, RUN_TS)
            run = Run(root, RUN_TS + timedelta(hours=hour), past_held=True, **names)
            run_day(spark, sources, run, mode == "incremental")
            silver = spark.table(f"{names['silver']}transactions")
            told = [F.lit(mode).alias("mode"), F.lit(step).alias("step")]
            rows = silver.select(*told, "transaction_id", F.col("amount").cast("double").alias("amount"))
            kept = f"{root}/seen-{step}"
            rows.write.parquet(kept)
            found.append(spark.read.schema(rows.schema).parquet(kept))
    return reduce(DataFrame.unionByName, found)


def _earlier_versions(tx: DataFrame) -> DataFrame:
    """Every transaction as it was 60 days before: pending, on another card, some by another user
    or on another day."""
    n = F.col("transaction_id").cast("bigint")
    return tx.withColumns(
        {
            "status": F.lit("PENDING"),
            "card_id": F.col("card_id") + 1,
            "user_id": F.when(n % 5 == 0, F.col("user_id") + 1).otherwise(F.col("user_id")),
            "risk_score": F.lit(0.9),
            "transaction_time": F.when(n % 3 == 0, F.col("transaction_time") - F.expr("interval 2 days")).otherwise(
                F.col("transaction_time")
            ),
            "updated_at": F.col("updated_at") - F.expr("interval 60 days"),
        }
    )


@check(ORACLES["user_risk_profile"])
def layers_changed_profile(spark, sf):
    """Three incremental runs in which every transaction changes its state, its card and some their
    user or day; the profile is kept from the feeds of changes."""
    root = scratch_path(spark, "layers")
    names = _view_names(root)
    now = _sources(spark, sf)
    old = parts(_earlier_versions(V.tx(spark, sf).drop("ingest_ts")))
    for k, real in enumerate(((), ("PARTNER_A",), ("PARTNER_A", "PARTNER_B"))):
        sources = {p: {**now[p], **({} if p in real else {"transactions": old[p.lower()]})} for p in now}
        profile = run_day(spark, sources, Run(root, RUN_TS - timedelta(hours=5 * (2 - k)), **names), incremental=True)
    return profile


@check(
    V.with_views(V.TX_STATES, V.LATEST)
    + """SELECT transaction_id, updated_at, status, CAST(amount AS DOUBLE) AS amount, source_partner FROM latest"""
)
def change_feed_replayed(spark, sf):
    """Two batches of changes merged into folders; the table that their feeds alone lead to."""
    root = scratch_path(spark, "feeds")
    newer_by = ["updated_at", *V.STATE_TIES]
    for k, batch in enumerate(_halves(V.tx_states(spark, sf))):
        managed.upsert_partitions(
            spark, f"{root}/table", batch, ["transaction_id"], "source_partner", newer_by, batch.schema, f"{root}/feeds/feed={k}"
        )
    schema = T.StructType([*changes.image_schema(batch.schema), T.StructField("feed", T.IntegerType())])
    again = changes.replay(spark.read.schema(schema).parquet(f"{root}/feeds"))
    return plain(again.select("transaction_id", "updated_at", "status", "amount", "source_partner"))


BY_USER = """changes AS (SELECT CAST(user_id AS VARCHAR) AS transaction_id, status, updated_at FROM tx)"""


@check(
    V.with_views(V.TX, BY_USER)
    + """SELECT DISTINCT transaction_id, updated_at AS pending_at FROM changes p WHERE status = 'PENDING'
  AND updated_at + INTERVAL 6 HOURS < (SELECT max(updated_at) - INTERVAL 1 DAY FROM changes)
  AND NOT EXISTS (SELECT 1 FROM changes s WHERE s.transaction_id = p.transaction_id AND s.status IN ('SUCCESS', 'FAILED')
    AND s.updated_at BETWEEN p.updated_at AND p.updated_at + INTERVAL 6 HOURS)"""
)
def stream_unsettled(spark, sf):
    """Pending states of each user that nothing settles within six hours, from two streaming runs."""
    root = scratch_path(spark, "stream")
    rows = V.tx(spark, sf).select(F.col("user_id").cast("string").alias("transaction_id"), "status", "updated_at")
    early = F.col("updated_at") < moment(MID)
    for half in (rows.where(early), rows.where(~early)):
        half.write.mode("append").parquet(f"{root}/feed")
        feed = spark.readStream.schema(rows.schema).parquet(f"{root}/feed")
        found = unsettled.unsettled_stream(feed, "6 hours", "1 day")
        sink = found.writeStream.outputMode("append").option("checkpointLocation", f"{root}/checkpoint")
        query = sink.trigger(availableNow=True).format("parquet").start(f"{root}/found")
        query.awaitTermination()
        if unsettled.late_rows(query):
            raise RuntimeError("rows came too late")
    return spark.read.schema(found.schema).parquet(f"{root}/found")


@check(ORACLES["stream_unsettled"])
def unsettled_changes(spark, sf):
    """The same from a finished table."""
    rows = V.tx(spark, sf).select(F.col("user_id").cast("string").alias("transaction_id"), "status", "updated_at")
    newest = rows.agg(F.max("updated_at")).first()[0]
    return lifecycle.unsettled(rows, "6 hours", moment(newest - timedelta(days=1)))


# ---- agreement, seasons, levels, sketches, layout ---------------------------------


@check(
    V.with_views(V.TX)
    + """, other AS (SELECT CASE WHEN transaction_id::BIGINT % 997 = 13 THEN transaction_id || '-2' ELSE transaction_id END AS transaction_id,
  CASE WHEN transaction_id::BIGINT % 499 = 7 THEN amount + 0.01 ELSE amount END AS amount,
  CASE WHEN transaction_id::BIGINT % 503 <> 3 THEN status END AS status, user_id FROM tx)
SELECT transaction_id, count(l.h) AS left_rows, count(r.h) AS right_rows,
  CASE WHEN count(r.h) = 0 THEN 'missing' WHEN count(l.h) = 0 THEN 'added' ELSE 'changed' END AS difference
FROM (SELECT transaction_id, (amount, status, user_id)::VARCHAR AS h FROM tx) l
FULL JOIN (SELECT transaction_id, (amount, status, user_id)::VARCHAR AS h FROM other) r USING (transaction_id)
WHERE l.h IS DISTINCT FROM r.h GROUP BY 1"""
)
def content_parity(spark, sf):
    """A layer in which some amounts, states and keys are not those of the other."""
    tx = V.tx(spark, sf).select("transaction_id", "amount", "status", "user_id")
    n = F.col("transaction_id").cast("bigint")
    other = tx.select(
        F.when(n % 997 == 13, F.concat("transaction_id", F.lit("-2"))).otherwise(F.col("transaction_id")).alias("transaction_id"),
        F.when(n % 499 == 7, F.col("amount") + F.lit("0.01").cast("decimal(18,2)")).otherwise(F.col("amount")).cast("decimal(18,2)").alias("amount"),
        F.when(n % 503 != 3, F.col("status")).alias("status"),
        "user_id",
    )
    return parity.differing_keys(tx, other, ["transaction_id"], ["amount", "status", "user_id"])


@check(
    V.with_views(V.TX, V.TX_VOLUME)
    + """, grid AS (SELECT source_partner, CAST(day AS TIMESTAMP) AS day
  FROM (SELECT DISTINCT source_partner FROM tx_volume),
    (SELECT UNNEST(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS day)),
counted AS (SELECT g.source_partner, g.day, COUNT(t.transaction_id) AS row_count FROM grid g
  LEFT JOIN tx_volume t ON t.source_partner = g.source_partner
    AND CAST(date_trunc('day', t.transaction_time) AS TIMESTAMP) = g.day GROUP BY 1, 2),
lists AS (SELECT *, list(row_count) OVER (PARTITION BY source_partner, dayofweek(day) ORDER BY day
  ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS before FROM counted),
based AS (SELECT *, list_median(before) AS baseline FROM lists),
spreads AS (SELECT *, greatest(1.4826 * list_median(list_transform(before, lambda x: abs(x - baseline))), sqrt(baseline), 1.0) AS spread FROM based)
SELECT source_partner, day, row_count, baseline, ROUND(CASE WHEN baseline IS NULL THEN 1.0 ELSE spread END, 6) AS spread,
  CASE WHEN coalesce(len(before), 0) < 2 THEN 'unknown' WHEN row_count = 0 AND baseline > 0 THEN 'no_data'
    WHEN (row_count - baseline) / spread > 6 THEN 'high' WHEN (row_count - baseline) / spread < -6 THEN 'low' ELSE 'none' END AS anomaly
FROM spreads"""
)
def seasonal_volume(spark, sf):
    found = quality.seasonal_volume(V.tx_volume(spark, sf), date(2024, 1, 30), 30, partner="source_partner")
    return found.withColumns({"day": F.col("day").cast("timestamp_ntz"), "spread": F.round("spread", 6)})


@check(
    V.with_views(V.TX, V.TX_VOLUME).replace("WITH ", "WITH RECURSIVE ", 1)
    + """, ledger AS (SELECT source_partner AS table_name, CAST(date_trunc('day', transaction_time) AS TIMESTAMP) AS run_day,
  COUNT(*) AS n FROM tx_volume GROUP BY 1, 2),
lists AS (SELECT table_name, list(n ORDER BY run_day) AS v, list(run_day ORDER BY run_day) AS d FROM ledger
  GROUP BY 1 HAVING count(*) > 10),
levels AS (SELECT *, list_median(v[1:10]) AS level0 FROM lists),
s AS (SELECT *, greatest(1.4826 * list_median(list_transform(v[1:10], lambda x: abs(x - level0))), sqrt(level0), 1.0) AS spread FROM levels),
r(table_name, i, level, up, down, us, ds, since, was, is_up, told) AS (
  SELECT table_name, 10, CAST(level0 AS DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE, 0, 0, 0, 0.0::DOUBLE, false, false FROM s
  UNION ALL
  SELECT table_name, i, CASE WHEN told THEN list_median(v[since:since + 9]) ELSE level END,
    CASE WHEN told THEN 0.0 ELSE up END, CASE WHEN told THEN 0.0 ELSE down END, us, ds, since, level, is_up, told
  FROM (SELECT *, greatest(up, down) > 5 AS told, up >= down AS is_up, CASE WHEN up >= down THEN us ELSE ds END AS since
    FROM (SELECT table_name, v, i + 1 AS i, level, greatest(up + z - 0.5, 0.0) AS up, greatest(down - z - 0.5, 0.0) AS down,
        CASE WHEN up > 0 THEN us ELSE i + 1 END AS us, CASE WHEN down > 0 THEN ds ELSE i + 1 END AS ds
      FROM (SELECT r.*, v, greatest(least((v[i + 1] - level) / spread, 2.5), -2.5) AS z
        FROM r JOIN s USING (table_name) WHERE i < len(v)))))
SELECT table_name, d[since] AS changed_at, d[i] AS noticed_at, CASE WHEN is_up THEN 'up' ELSE 'down' END AS direction,
  was AS before, level AS after FROM r JOIN s USING (table_name) WHERE told"""
)
def level_changes(spark, sf):
    """The ledger that daily audits would have left: a level that rises or falls for good is told
    with its day, a single day without rows is not."""
    daily = (
        V.tx_volume(spark, sf)
        .groupBy(F.date_trunc("day", "transaction_time").alias("execution_time"), F.col("source_partner").alias("table_name"))
        .agg(F.count(F.lit(1)).alias("bronze_raw_count"))
        .withColumn("pipeline_stage", F.lit("bronze_to_silver"))
    )
    found = trend.change_points(managed.conform(daily, LEDGER_SCHEMA), "bronze_raw_count")
    days = {c: F.col(c).cast("timestamp_ntz") for c in ("changed_at", "noticed_at")}
    return found.withColumns(days).drop("pipeline_stage")


@check(
    V.with_views(V.TX)
    + """SELECT source_partner, COUNT(*) AS measured, MIN(s) AS min_latency, MAX(s) AS max_latency,
  true AS p50_near, true AS p95_near, true AS p99_near
FROM (SELECT source_partner, date_sub('second', transaction_time, updated_at) AS s FROM tx
  WHERE transaction_time >= TIMESTAMP '2024-01-05' AND transaction_time < TIMESTAMP '2024-01-21') GROUP BY 1"""
)
def latency_of_period(spark, sf):
    """Latency over some days from stored daily sketches; the percentiles' ranks are within the
    sketches' bound of those of the rows themselves."""
    root = scratch_path(spark, "sketches")
    tx = V.tx(spark, sf)
    lifecycle.latency_sketches(tx, "source_partner").write.parquet(f"{root}/days")
    first, last = date(2024, 1, 5), date(2024, 1, 20)
    found = lifecycle.latency_of_period(spark.read.parquet(f"{root}/days"), first, last, "source_partner")
    seconds = elapsed_seconds(F.col("transaction_time"), F.col("updated_at"))
    rows = tx.where(F.col("transaction_time").cast("date").between(F.lit(first), F.lit(last)))
    counted = rows.groupBy("source_partner", seconds.alias("s")).agg(F.count(F.lit(1)).alias("n"))
    near = []
    for p in (50, 95, 99):
        at = F.col(f"p{p}_latency")
        below, upto = (F.sum(F.when(c, F.col("n")).otherwise(0)) / F.sum("n") for c in (F.col("s") < at, F.col("s") <= at))
        near.append(((below <= p / 100 + 0.01) & (upto >= p / 100 - 0.01)).alias(f"p{p}_near"))
    same = ["source_partner", "measured", "min_latency", "max_latency"]
    return counted.join(found, "source_partner").groupBy(*same).agg(*near)


@check(
    V.with_views(V.TX)
    + """SELECT 'user' AS kind, CAST(user_id AS VARCHAR) AS value, COUNT(*) AS row_count, true AS few_files FROM tx GROUP BY user_id
UNION ALL SELECT 'day', strftime(transaction_time, '%Y-%m-%d'), COUNT(*), true FROM tx GROUP BY 2"""
)
def clustered_layout(spark, sf):
    """Transactions in files clustered by user and time: for every user and every day, whether most
    files lie outside its value by their smallest and largest ones."""
    root = scratch_path(spark, "clustered")
    tx = V.tx(spark, sf).select("transaction_id", "user_id", "transaction_time")
    layout.write_clustered(tx, f"{root}/tx", ["user_id", "transaction_time"], 64)
    back = spark.read.schema(tx.schema).parquet(f"{root}/tx").withColumn("file", F.col("_metadata.file_path"))
    back = back.withColumn("day", F.col("transaction_time").cast("date"))
    files = back.groupBy("file").agg(
        *[f(c).alias(f"{n}_{c}") for c in ("user_id", "day") for n, f in (("least", F.min), ("most", F.max))]
    )
    n_files = files.count()
    found = []
    for kind, c in (("user", "user_id"), ("day", "day")):
        values = back.groupBy(c).agg(F.count(F.lit(1)).alias("row_count"))
        inside = (F.col(c) >= F.col(f"least_{c}")) & (F.col(c) <= F.col(f"most_{c}"))
        # one row per file: a table's list of files
        touched = values.join(F.broadcast(files), inside).groupBy(c, "row_count").agg(F.count(F.lit(1)).alias("n"))
        few = (F.col("n") * 2 <= n_files).alias("few_files")
        found.append(touched.select(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("value"), "row_count", few))
    return found[0].unionByName(found[1])
