from decimal import Decimal

from pyspark.sql import functions as F

from helpers import TX_DDL, final_plan, plan, rows, ts, tx_row
from pursewatch.model import UNIFIED_WALLET_SCHEMA
from pursewatch.operators.lifecycle import latency_by_partner, timeline
from pursewatch.plans.gold import (
    compromised_users, keyed_profile, merchant_daily_summary, spend_velocity, top_merchant_days,
    unified_wallet, user_risk_profile,
)

AS_OF = "2024-01-31 00:00:00"


def profile(spark, tx, users=(1,), cards=((10, False),)):
    u = spark.createDataFrame([(x,) for x in users], "user_id bigint")
    c = spark.createDataFrame(list(cards), "card_id bigint, is_compromised boolean")
    got = user_risk_profile(u, c, spark.createDataFrame(tx, TX_DDL), AS_OF)
    return {r.user_id: (r.total_spend_7d, r.avg_spend_7d, r.high_risk) for r in got.collect()}


def test_user_without_transactions(spark):
    assert profile(spark, [], users=[7]) == {7: (0.0, None, False)}


def test_only_pending_rows(spark):
    assert profile(spark, [tx_row(status="PENDING")]) == {1: (0.0, None, False)}


def test_failures_above_three(spark):
    failed = [tx_row(tid=str(i), status="FAILED") for i in range(4)]
    assert profile(spark, failed[:3])[1][2] is False
    assert profile(spark, failed)[1][2] is True


def test_failures_add_up_over_cards(spark):
    failed = [tx_row(tid=str(i), card=10 + i, status="FAILED") for i in range(4)]
    assert profile(spark, failed)[1][2] is True


def test_risk_threshold(spark):
    assert profile(spark, [tx_row(risk=0.8)])[1][2] is False
    assert profile(spark, [tx_row(risk=0.81)])[1][2] is True
    assert profile(spark, [tx_row(risk=None)])[1][2] is False
    assert profile(spark, [tx_row(risk=0.9, at="2020-01-01 00:00:00", status="PENDING")])[1][2] is True


def test_window_edge_and_future_rows(spark):
    edge = tx_row(tid="a", amount="5.00", at="2024-01-24 00:00:00")
    older = tx_row(tid="b", amount="7.00", at="2024-01-23 23:59:59.999999")
    future = tx_row(tid="c", amount="9.00", at="2024-03-01 00:00:00")
    assert profile(spark, [edge, older, future])[1] == (14.0, 7.0, False)


def test_compromised_card_used_once_long_ago(spark):
    tx = [tx_row(status="FAILED", at="2019-01-01 00:00:00")]
    assert profile(spark, tx, cards=[(10, True)])[1] == (0.0, None, True)
    assert profile(spark, tx, cards=[(10, None)])[1][2] is False
    assert profile(spark, tx, cards=[(10, True), (10, True)])[1][2] is True


def test_repeated_card_rows_do_not_multiply_spend(spark):
    assert profile(spark, [tx_row()], cards=[(10, True), (10, True)])[1] == (10.0, 10.0, True)


def test_null_user_and_null_card(spark):
    tx = [tx_row(user=None), tx_row(tid="b", card=None, amount="3.00")]
    assert profile(spark, tx, cards=[(10, True)]) == {1: (3.0, 3.0, False)}


def test_profile_schema_and_key(spark):
    u = spark.createDataFrame([(1,)], "user_id bigint")
    c = spark.createDataFrame([(10, True)], "card_id bigint, is_compromised boolean")
    got = keyed_profile(user_risk_profile(u, c, spark.createDataFrame([tx_row()], TX_DDL), AS_OF))
    assert got.columns == ["user_id", "total_spend_7d", "avg_spend_7d", "high_risk", "profile_updated_at"]
    assert got.first().profile_updated_at == ts(AS_OF)


def test_velocity_matches_profile_rules(spark):
    tx = spark.createDataFrame(
        [tx_row(amount="10.10"), tx_row(tid="b", amount="0.20"), tx_row(tid="c", status="FAILED")], TX_DDL)
    r = spend_velocity(tx, AS_OF).first()
    assert tuple(r) == (1, 10.3, 5.15, 1, 0.1)


def test_compromised_users_semi_join(spark):
    tx = spark.createDataFrame([tx_row(), tx_row(user=2, card=11), tx_row(user=1)], TX_DDL)
    cards = spark.createDataFrame([(10, True), (11, False)], "card_id bigint, is_compromised boolean")
    assert rows(compromised_users(tx, cards)) == [(1,)]


def test_profile_scans_transactions_once(spark, root):
    spark.createDataFrame([tx_row()], TX_DDL).write.parquet(f"{root}/tx")
    tx = spark.read.parquet(f"{root}/tx")
    u = spark.createDataFrame([(1,)], "user_id bigint")
    c = spark.createDataFrame([(10, True)], "card_id bigint, is_compromised boolean")
    text = plan(user_risk_profile(u, c, tx, AS_OF), "simple")
    assert text.count("FileScan parquet") == 1
    assert "merchant_id" not in text.split("ReadSchema")[1]
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_merchant_days_and_top(spark):
    data = [(5, ts("2024-01-01 10:00:00"), Decimal("1.00"), 0.5), (5, ts("2024-01-01 23:59:59"), Decimal("2.00"), None),
            (4, ts("2024-01-02 00:00:00"), Decimal("3.00"), 0.25)]
    tx = spark.createDataFrame(data, "merchant_id bigint, transaction_time timestamp_ntz, amount_myr decimal(18,2), risk_score double")
    summary = merchant_daily_summary(tx)
    assert rows(summary) == [
        (4, ts("2024-01-02"), Decimal("3.00"), 0.25), (5, ts("2024-01-01"), Decimal("3.00"), 0.5)]
    assert [r.merchant_id for r in top_merchant_days(summary, 1).collect()] == [4]
    assert "TakeOrderedAndProject" in plan(top_merchant_days(summary), "simple")


def wallet(spark, tx):
    users = spark.createDataFrame([(1, 30, 1000.0, 700)], "user_id bigint, current_age int, yearly_income double, credit_score int")
    cards = spark.createDataFrame([(10, "Visa", 5.0, True)], "card_id bigint, card_brand string, credit_limit double, card_on_dark_web boolean")
    return unified_wallet(tx, users, cards)


def test_unified_wallet_shape(spark):
    tx = spark.createDataFrame(
        [tx_row(updated="2024-01-30 00:00:07"), tx_row(tid="b", user=9, card=None)], TX_DDL)
    got = wallet(spark, tx)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in UNIFIED_WALLET_SCHEMA]
    by_id = {r.transaction_id: r for r in got.collect()}
    assert (by_id["t1"].amount_myr, by_id["t1"].processing_latency, by_id["t1"].card_brand) == (Decimal("47.00"), 7, "Visa")
    assert (by_id["b"].current_age, by_id["b"].card_brand) == (None, None)


def test_hot_user_is_split_in_the_wallet_join(spark):
    tight = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k) for k in tight}
    for k, v in tight.items():
        spark.conf.set(k, v)
    try:
        tx = spark.range(0, 60000, 1, 8).selectExpr(
            "cast(id as string) transaction_id", "if(id % 3 = 0, 1, id) user_id", "id % 50 card_id",
            "cast(1 as decimal(18,2)) amount", "'SUCCESS' status",
            "timestamp_ntz'2024-01-01 00:00:00' transaction_time", "timestamp_ntz'2024-01-01 00:00:01' updated_at")
        users = spark.range(0, 60000, 1, 4).selectExpr("id user_id", "1 current_age", "1d yearly_income", "1 credit_score")
        cards = spark.range(50).selectExpr("id card_id", "'Visa' card_brand", "1d credit_limit", "false card_on_dark_web")
        got = unified_wallet(tx, users, cards).drop("partner")
        assert "skew=true" in final_plan(got)
        assert got.where(F.col("current_age") == 1).count() == 60000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_lifecycle(spark):
    def step(tid, status, at):
        return tx_row(tid=tid, status=status, at="2024-01-01 00:00:00", updated=at)

    tx = spark.createDataFrame([
        step("a", "SUCCESS", "2024-01-01 00:00:07"), step("a", "PENDING", "2024-01-01 00:00:00"),
        step("a", "APPROVED", "2024-01-01 00:00:02"), step("b", "PENDING", "2024-01-01 00:00:00"),
        step("c", "FAILED", "2024-01-01 00:00:07"), step("c", "SUCCESS", "2024-01-01 00:00:05")], TX_DDL)
    got = {r.transaction_id: r for r in timeline(tx).collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert (a.approval_seconds, a.settlement_seconds, a.outcome, a.stuck, a.incomplete) == (2, 5, "SUCCESS", False, False)
    assert (b.outcome, b.stuck, b.incomplete) == (None, True, True)
    assert (c.outcome, c.settled_at, c.incomplete) == ("FAILED", ts("2024-01-01 00:00:05"), True)


def test_latency_by_partner(spark):
    data = [("a", ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:0%d" % i)) for i in range(8)]
    df = spark.createDataFrame(data, "partner string, transaction_time timestamp_ntz, updated_at timestamp_ntz")
    df = df.unionByName(spark.createDataFrame([("a", None, data[0][2]), ("b", None, data[0][2])], df.schema))
    a, b = latency_by_partner(df, percentiles=(0.5, 1.0)).orderBy("partner").collect()
    assert tuple(a) == ("a", 8, 3.5, 0, 7, 3.5, 7.0)
    assert tuple(b) == ("b", 0, None, None, None, None, None)


def test_equal_ids_of_two_partners_are_two_users(spark):
    u = spark.createDataFrame([("a", 1), ("b", 1)], "source_partner string, user_id bigint")
    c = spark.createDataFrame([("a", 10, False), ("b", 10, True)], "source_partner string, card_id bigint, is_compromised boolean")
    tx = spark.createDataFrame([tx_row("t1", amount="7.00")], TX_DDL).withColumn("source_partner", F.lit("a"))
    got = rows(keyed_profile(user_risk_profile(u, c, tx, AS_OF, ["source_partner"]), ["source_partner"]).drop("profile_updated_at"))
    assert got == [("a", 1, 7.0, 7.0, False), ("b", 1, 0.0, None, False)]
