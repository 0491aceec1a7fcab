"""Wallet tables as views over the provided test tables, once in Spark and once in SQL.

Every view keeps all rows of its table; faults are injected by changing values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

AS_OF = "2024-01-31 00:00:00"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tx(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "events").selectExpr(
        "cast(event_id as string) as transaction_id",
        "user_id",
        "user_id % 100 as card_id",
        "cast(value as decimal(18,2)) as amount",
        """case event_type when 'purchase' then 'SUCCESS' when 'error' then 'FAILED'
             when 'click' then 'APPROVED' else 'PENDING' end as status""",
        "ts as transaction_time",
        "ts + make_dt_interval(0, 0, 0, event_id % 8) as updated_at",
        "case event_id % 3 when 0 then 'Swipe' when 1 then 'Chip' else 'Online' end as use_chip",
        "event_id % 50 as merchant_id",
        "'Merchant_' || cast(event_id % 50 as string) as merchant_name",
        "1000 + event_id % 9000 as mcc",
        "value / 500 as risk_score",
        "case when event_id % 2 = 0 then 'partner_a' else 'partner_b' end as source_partner",
        "ts + make_dt_interval(0, 0, event_id % 300, 0) as ingest_ts",
    )


TX = """tx AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, user_id, user_id % 100 AS card_id,
    CAST(value AS DECIMAL(18,2)) AS amount,
    CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED'
      WHEN 'click' THEN 'APPROVED' ELSE 'PENDING' END AS status,
    ts AS transaction_time, ts + to_seconds(event_id % 8) AS updated_at,
    CASE event_id % 3 WHEN 0 THEN 'Swipe' WHEN 1 THEN 'Chip' ELSE 'Online' END AS use_chip,
    event_id % 50 AS merchant_id, 'Merchant_' || CAST(event_id % 50 AS VARCHAR) AS merchant_name,
    1000 + event_id % 9000 AS mcc, value / 500 AS risk_score,
    CASE WHEN event_id % 2 = 0 THEN 'partner_a' ELSE 'partner_b' END AS source_partner,
    ts + to_minutes(event_id % 300) AS ingest_ts
  FROM events)"""

TX_COLUMNS = [
    "transaction_id", "user_id", "card_id", "amount", "status", "transaction_time", "updated_at",
    "use_chip", "merchant_id", "merchant_name", "mcc", "risk_score", "source_partner", "ingest_ts",
]

STATE_TIES = [
    "line_number", "amount", "card_id", "merchant_id", "status", "quantity", "discount", "tax",
]


def tx_states(spark: SparkSession, sf: str) -> DataFrame:
    """The change rows alone; ``with_orders`` adds what the order knows of a transaction."""
    return _table(spark, sf, "lineitem").selectExpr(
        "l_orderkey as transaction_id",
        "l_suppkey as card_id",
        "l_partkey as merchant_id",
        "cast(l_extendedprice as decimal(18,2)) as amount",
        """case when l_returnflag = 'N' then 'PENDING' when l_returnflag = 'R' then 'APPROVED'
             when l_linestatus = 'F' then 'SUCCESS' else 'FAILED' end as status""",
        "l_shipdate as updated_at",
        "l_linenumber as line_number",
        "l_quantity as quantity",
        "l_discount as discount",
        "l_tax as tax",
        "case when l_orderkey % 2 = 0 then 'partner_a' else 'partner_b' end as source_partner",
    )


def with_orders(states: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """User and start time of each transaction; joined after the changes are folded, when a
    transaction is one row, wherever that is possible."""
    orders = _table(spark, sf, "orders").selectExpr(
        "o_orderkey as transaction_id", "o_custkey as user_id", "o_orderdate as transaction_time"
    )
    return states.join(orders, "transaction_id")


TX_STATES = """tx_states AS (
  SELECT l_orderkey AS transaction_id, o_custkey AS user_id, l_suppkey AS card_id,
    l_partkey AS merchant_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
    CASE WHEN l_returnflag = 'N' THEN 'PENDING' WHEN l_returnflag = 'R' THEN 'APPROVED'
      WHEN l_linestatus = 'F' THEN 'SUCCESS' ELSE 'FAILED' END AS status,
    o_orderdate AS transaction_time, l_shipdate AS updated_at, l_linenumber AS line_number,
    l_quantity AS quantity, l_discount AS discount, l_tax AS tax,
    CASE WHEN l_orderkey % 2 = 0 THEN 'partner_a' ELSE 'partner_b' END AS source_partner
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

LATEST = """latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY updated_at DESC,
      line_number DESC, amount DESC, card_id DESC, merchant_id DESC, status DESC, quantity DESC,
      discount DESC, tax DESC) AS rn FROM tx_states) WHERE rn = 1)"""


def users(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "customer").selectExpr(
        "c_custkey as user_id",
        "cast(18 + c_custkey % 53 as int) as current_age",
        "c_acctbal as yearly_income",
        "cast(300 + c_custkey % 551 as int) as credit_score",
        "case when c_custkey % 2 = 0 then 'partner_a' else 'partner_b' end as source_partner",
    )


USERS = """users AS (
  SELECT c_custkey AS user_id, CAST(18 + c_custkey % 53 AS INTEGER) AS current_age,
    c_acctbal AS yearly_income, CAST(300 + c_custkey % 551 AS INTEGER) AS credit_score,
    CASE WHEN c_custkey % 2 = 0 THEN 'partner_a' ELSE 'partner_b' END AS source_partner
  FROM customer)"""


def cards(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "supplier").selectExpr(
        "s_suppkey as card_id",
        """case s_suppkey % 3 when 0 then 'Visa' when 1 then 'Mastercard' else 'Amex' end
             as card_brand""",
        "s_acctbal as credit_limit",
        "s_acctbal < 0 as card_on_dark_web",
        "case when s_suppkey % 2 = 0 then 'partner_a' else 'partner_b' end as source_partner",
    )


CARDS = """cards AS (
  SELECT s_suppkey AS card_id,
    CASE s_suppkey % 3 WHEN 0 THEN 'Visa' WHEN 1 THEN 'Mastercard' ELSE 'Amex' END AS card_brand,
    s_acctbal AS credit_limit, s_acctbal < 0 AS card_on_dark_web,
    CASE WHEN s_suppkey % 2 = 0 THEN 'partner_a' ELSE 'partner_b' END AS source_partner
  FROM supplier)"""


def silver_cards(spark: SparkSession, sf: str) -> DataFrame:
    return cards(spark, sf).withColumnRenamed("card_on_dark_web", "is_compromised")


def tx_orphans(spark: SparkSession, sf: str) -> DataFrame:
    return tx(spark, sf).withColumn("card_id", F.col("user_id"))


TX_ORPHANS = "tx_orphans AS (SELECT * REPLACE (user_id AS card_id) FROM tx)"


def tx_volume(spark: SparkSession, sf: str) -> DataFrame:
    """partner_b sends nothing on one day; partner_a sends little and then much more."""
    t, p = F.col("transaction_time"), F.col("source_partner")
    on_day = (t >= F.lit("2024-01-15").cast("timestamp_ntz")) & (t < F.lit("2024-01-16").cast("timestamp_ntz"))
    early = t < F.lit("2024-01-20").cast("timestamp_ntz")
    return tx(spark, sf).withColumn(
        "source_partner",
        F.when((p == "partner_b") & on_day, "partner_c")
        .when((p == "partner_a") & early & (F.minute(t) >= 3), "partner_c")
        .otherwise(p),
    )


TX_VOLUME = """tx_volume AS (SELECT * REPLACE (CASE
    WHEN source_partner = 'partner_b' AND transaction_time >= TIMESTAMP '2024-01-15'
      AND transaction_time < TIMESTAMP '2024-01-16' THEN 'partner_c'
    WHEN source_partner = 'partner_a' AND transaction_time < TIMESTAMP '2024-01-20'
      AND EXTRACT(minute FROM transaction_time) >= 3 THEN 'partner_c'
    ELSE source_partner END AS source_partner) FROM tx)"""


def tx_badkeys(spark: SparkSession, sf: str) -> DataFrame:
    bad = F.col("transaction_id").cast("bigint") % 97 == 0
    return tx(spark, sf).withColumn("transaction_id", F.when(~bad, F.col("transaction_id")))


TX_BADKEYS = """tx_badkeys AS (SELECT * REPLACE (CASE WHEN CAST(transaction_id AS BIGINT) % 97 <> 0
    THEN transaction_id END AS transaction_id) FROM tx)"""


def tx_text(spark: SparkSession, sf: str) -> DataFrame:
    """Every column as text, some amounts unreadable and some merchant codes with a fraction."""
    n = F.col("transaction_id").cast("bigint")
    text = tx(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in TX_COLUMNS])
    return text.withColumns(
        {
            "amount": F.when(n % 101 == 0, "abc").otherwise(F.col("amount")),
            "mcc": F.when(n % 103 == 0, F.concat("mcc", F.lit(".5"))).otherwise(F.col("mcc")),
        }
    )


TX_TEXT = """tx_text AS (SELECT * REPLACE (
    CASE WHEN CAST(transaction_id AS BIGINT) % 101 = 0 THEN 'abc' ELSE amount END AS amount,
    CASE WHEN CAST(transaction_id AS BIGINT) % 103 = 0 THEN mcc || '.5' ELSE mcc END AS mcc)
  FROM (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM tx))"""


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"
