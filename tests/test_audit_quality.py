from datetime import date, datetime

import pytest
from pyspark.sql import functions as F, types as T

from helpers import TX_DDL, plan, rows, ts, tx_row
from pursewatch.model import LEDGER_SCHEMA
from pursewatch.operators import audit, quality
from pursewatch.operators.audit import (
    CircuitOpen, Layer, breaches, bronze_to_silver, enforce, layer_counts, ledger_trend,
    reconcile, source_to_bronze,
)
from pursewatch.sources.managed import conform

RUN = "2024-01-31 00:00:00"


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id string")


def layer(spark, name, *values, table="t"):
    return Layer(table, name, ids(spark, *values), ("id",))


def test_audit_rows_follow_the_ledger_schema(spark):
    got = source_to_bronze([layer(spark, "source", "a", "b"), layer(spark, "bronze", "a", None)], RUN)
    r = got.first()
    assert got.columns == [*LEDGER_SCHEMA.names, "error"]
    assert (r.pipeline_stage, r.table_name, r.source_count, r.target_count, r.null_pk_count) == ("source_to_bronze", "t", 2, 2, 1)
    assert (r.bronze_raw_count, r.silver_deduped_count, r.error) == (None, None, None)
    assert r.execution_time == datetime(2024, 1, 31)


def test_empty_bronze_counts_zero(spark):
    r = bronze_to_silver([layer(spark, "bronze"), layer(spark, "silver")], RUN).first()
    assert (r.bronze_raw_count, r.silver_deduped_count, r.null_pk_count) == (0, 0, 0)


def test_unreadable_layer_is_unknown_not_zero(spark):
    layers = [layer(spark, "bronze", "a"), Layer("t", "silver", None, ("id",), "no such table")]
    r = bronze_to_silver(layers, RUN).first()
    assert (r.bronze_raw_count, r.silver_deduped_count, r.error) == (1, None, "no such table")
    with pytest.raises(CircuitOpen, match="unreadable"):
        enforce(bronze_to_silver(layers, RUN))


def test_several_tables_and_composite_keys(spark):
    pair = spark.createDataFrame([("a", 1), ("a", None), ("a", 1)], "p string, id int")
    layers = [layer(spark, "bronze", "x"), Layer("u", "bronze", pair, ("p", "id"))]
    assert rows(layer_counts(layers).select("table_name", "rows", "null_pk_count")) == [("t", 1, 0), ("u", 3, 1)]
    keyed = [Layer("t", "bronze", ids(spark, "x", "x", None), ("id",), distinct=("id",)),
             Layer("u", "bronze", pair, ("p", "id"), distinct=("p", "id")), layer(spark, "silver", "x", "y")]
    got = layer_counts(keyed).select("table_name", "layer", "rows", "null_pk_count", "distinct_keys")
    assert rows(got) == [("t", "bronze", 3, 1, 1), ("t", "silver", 2, 0, 0), ("u", "bronze", 3, 1, 1)]


def test_breaker_rules(spark):
    good = [layer(spark, "source", "a"), layer(spark, "bronze", "a")]
    enforce(source_to_bronze(good, RUN))
    with pytest.raises(CircuitOpen, match="null_key"):
        enforce(source_to_bronze([layer(spark, "source", None), layer(spark, "bronze", None)], RUN))
    with pytest.raises(CircuitOpen, match="row_parity"):
        enforce(source_to_bronze([layer(spark, "source", "a", "b"), layer(spark, "bronze", "a")], RUN))
    silver = bronze_to_silver([layer(spark, "bronze", "a", "a"), layer(spark, "silver", "a")], RUN)
    enforce(silver.withColumn("expected_silver", F.lit(1)))
    with pytest.raises(CircuitOpen, match="silver_parity"):
        enforce(silver.withColumn("expected_silver", F.lit(2)))
    assert breaches(silver).where("breached").count() == 0


def test_reconcile_four_layers(spark):
    layers = [layer(spark, "source", "a", "b"), layer(spark, "bronze", "a", "a", None),
              layer(spark, "silver", "a"), layer(spark, "gold", "a")]
    r = reconcile(layers).first()
    assert (r.source_count, r.bronze_count, r.bronze_keys_count, r.silver_count, r.gold_count) == (2, 3, 1, 1, 1)
    assert (r.bronze_parity, r.silver_parity, r.gold_parity) == (False, True, True)


def test_trend_over_the_ledger(spark):
    history = [(ts(f"2024-01-0{d}"), "bronze_to_silver", "t", n, nulls) for d, n, nulls in ((1, 10, 0), (2, 15, 3))]
    df = spark.createDataFrame(history, "execution_time timestamp, pipeline_stage string, table_name string, bronze_raw_count bigint, null_pk_count bigint")
    got = ledger_trend(conform(df, LEDGER_SCHEMA)).orderBy("execution_time").collect()
    assert [(r.bronze_raw_count_change, r.null_pk_count_change, r.null_pk_share) for r in got] == [(None, None, 0.0), (5, 3, 0.2)]


def test_cast_failures_count_present_values_only(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "a string")
    got = quality.cast_failures(df, {"a": F.col("a").try_cast("int")})
    assert rows(got) == [("a", 2, 1)]


def test_schema_drift_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    expected = T.StructType.fromDDL("a bigint, c string")
    assert quality.schema_drift(expected, df.schema) == [
        ("a", "retyped", "bigint", "int"), ("b", "added", "", "string"), ("c", "missing", "string", "")]
    got = {r.column_name: (r.drift, r.null_count, r.unexpected_nulls) for r in quality.schema_integrity(df, expected, ["b"]).collect()}
    assert got == {"a": ("retyped", 0, 0), "b": ("added", 1, 1), "c": ("missing", None, 0)}


def test_freshness_limit(spark):
    data = [("a", ts("2024-01-01 00:00:00"), ts("2024-01-01 02:00:00")), ("b", ts("2024-01-01 00:00:00"), ts("2024-01-01 02:00:01"))]
    df = spark.createDataFrame(data, "partner string, transaction_time timestamp_ntz, ingest_ts timestamp_ntz")
    got = quality.freshness(df).select("partner", "max_lag_seconds", "late_rows", "breached")
    assert rows(got) == [("a", 7200, 0, False), ("b", 7201, 1, True)]


def test_volume_gaps_and_spikes(spark):
    def day(p, d, n):
        return [(p, ts(f"2024-01-{d:02d} 12:00:00"))] * n

    data = [r for d in range(1, 9) for r in day("a", d, 2)] + day("a", 9, 10) + day("b", 1, 4) + day("a", 20, 99)
    df = spark.createDataFrame(data, "partner string, transaction_time timestamp_ntz")
    got = quality.volume_anomalies(df, date(2024, 1, 10), days=10)
    assert got.count() == 20
    found = {(r.partner, r.day.day): r.anomaly for r in got.where("anomaly <> 'none'").collect()}
    listed = quality.volume_anomalies(df, date(2024, 1, 10), days=10, partners=["a", "silent"])
    assert listed.count() == 30 and listed.where("partner = 'silent' AND anomaly = 'no_data'").count() == 10
    assert rows(listed.where("partner <> 'silent'")) == rows(got)
    assert found == {("a", 9): "spike", ("a", 10): "no_data", **{("b", d): "no_data" for d in range(2, 11)}}


def test_table_tests_and_their_rows(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (2, None)], "id int, s string")
    parent = spark.createDataFrame([(1,)], "pid int")
    tests = [quality.NotNull("id"), quality.Accepted("s", ("x", "y")), quality.Unique("id"), quality.Relationship("id", parent, "pid")]
    got = {(r.test, r.column_name): (r.violations, r.passed) for r in quality.run_table_tests(df, tests).collect()}
    assert got == {("not_null", "id"): (1, False), ("accepted_values", "s"): (1, False),
                   ("unique", "id"): (1, False), ("relationships", "id"): (1, False)}
    assert [quality.violating_rows(df, t).count() for t in tests] == [1, 1, 1, 1]


def test_orphans_with_and_without_owners(spark):
    tx = spark.createDataFrame([tx_row("a", 1, 10), tx_row("b", 9, 10), tx_row("c", 1, 99), tx_row("d", 2, 10), tx_row("e", None, 10)], TX_DDL)
    users = spark.createDataFrame([(1,), (2,)], "user_id bigint")
    cards = spark.createDataFrame([(10,)], "card_id bigint")
    got = quality.orphan_transactions(tx, users, cards).select("transaction_id", "orphan_reason")
    assert rows(got) == [("b", "unknown user"), ("c", "unknown card"), ("e", "unknown user")]
    owned = cards.withColumn("user_id", F.lit(1).cast("bigint"))
    got = {r.transaction_id: r.orphan_reason for r in quality.orphan_transactions(tx, users, owned).collect()}
    assert got["d"] == "card of another user" and "a" not in got and len(got) == 4


def test_a_key_in_two_frames_of_a_layer_counts_once(spark):
    frames = [Layer("t", "bronze", ids(spark, *v), ("id",), distinct=("id",)) for v in (("a", "b"), ("a", "b", None))]
    r = layer_counts(frames).first()
    assert (r.rows, r.distinct_keys, r.null_pk_count) == (5, 2, 1)


def test_baseline_reaches_before_the_period(spark):
    days = [(f"2024-01-{d:02d} 08:00:00", 10 if d < 20 else 100) for d in range(1, 21)]
    df = spark.createDataFrame([(ts(t), "a") for t, n in days for _ in range(n)], "transaction_time timestamp_ntz, partner string")
    got = rows(quality.volume_anomalies(df, date(2024, 1, 20), days=1))
    assert got == [("a", date(2024, 1, 20), 100, 10.0, "spike")]


def test_rows_of_one_time_in_the_trend_have_an_order(spark):
    one = source_to_bronze([layer(spark, "source", "a"), layer(spark, "bronze", "a")], RUN)
    two = source_to_bronze([layer(spark, "source", "a", "b"), layer(spark, "bronze", "a", "b")], RUN)
    for both in (one.unionByName(two), two.unionByName(one)):
        assert rows(ledger_trend(both.drop("error")).select("source_count", "source_count_change")) == [(1, None), (2, 1)]


def test_rules_on_partners_types_and_times(spark):
    audit = source_to_bronze([layer(spark, "source", "a"), layer(spark, "bronze", "a")], RUN)
    enforce(audit.withColumns({c: F.lit(0) for c in ("failed_partners", "type_mismatches", "unversioned_rows")}))
    for column, rule in (("failed_partners", "partner_failed"), ("type_mismatches", "type_mismatch"), ("unversioned_rows", "unversioned")):
        with pytest.raises(CircuitOpen, match=rf"t: {rule} \(3\)"):
            enforce(audit.withColumn(column, F.lit(3)))


def test_counts_of_layers_sort_no_rows(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    layers = [
        audit.Layer("t", "bronze", rows, ("k",), distinct=("k",)),
        audit.Layer("t", "silver", None, ("k",), "not there"),
        audit.Layer("t", "silver", None, ("k",), "gone"),
    ]
    counts = audit.layer_counts(layers)
    found = {r.layer: tuple(r)[2:] for r in counts.collect()}
    assert found == {"bronze": (4, 1, 2, None), "silver": (None, 0, 0, "not there")}
    assert "SortAggregate" not in plan(counts)
