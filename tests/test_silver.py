import pytest
from pyspark.sql import functions as F, types as T

from helpers import plan, rows, ts
from pursewatch.operators.dedup import any_per_key, latest_per_key
from pursewatch.operators.projection import (
    all_strings, first_of_duplicates, project, require_keys, split_rejects, with_lineage,
)
from pursewatch.operators.upsert import insert_if_absent, union_evolved, upsert
from pursewatch.plans.silver import build_silver, build_silver_with_rejects
from pursewatch.sources.tables import key_of, load_tables, table_from_env, table_from_payload

RUN = "2024-01-31 00:00:00"
USERS = "user_id string, current_age string, yearly_income string, source_partner string, ingest_ts string"


def users_spec(**extra):
    return table_from_payload({
        "table": "users", "pk": "user_id", "order_by": "ingest_ts",
        "columns": {"user_id": {"from": "user_id", "as": "bigint"},
                    "age": {"from": "current_age", "as": "int"},
                    "partner": {"from": "source_partner", "as": "string"}}, **extra})


def test_declarations_are_validated():
    tables = load_tables()
    assert set(tables) == {"users", "cards", "transactions"}
    assert key_of(tables, "cards") == ("card_id",)
    assert key_of(tables, "unknown") == ("id",)
    with pytest.raises(ValueError):
        table_from_payload({"table": "t", "pk": "k", "columns": {"a": {"from": "a", "as": "nope"}}})
    with pytest.raises(ValueError):
        table_from_payload({"table": "t", "pk": "k", "columns": {"a": "a"}})
    with pytest.raises(ValueError):
        table_from_payload({"pk": "k"})


def test_declaration_from_environment():
    assert table_from_env({"TASK_PAYLOAD": '{"table": "t", "pk": "k"}'}).keys == ("k",)
    spec = table_from_env({"TABLE_NAME": "t"})
    assert (spec.table, spec.keys, spec.rules) == ("t", ("id",), ())


def test_projection_with_sql_expression_and_pass_through(spark):
    df = spark.createDataFrame([("1", "x")], "id string, a string")
    spec = table_from_payload({"table": "t", "pk": "id", "columns": {"id": "try_cast(id as bigint)", "b": "upper(a)", "at": {"run_ts": True}}})
    assert rows(project(df, spec, RUN)) == [(1, "X", ts(RUN))]
    assert rows(project(df, table_from_payload({"table": "t"}), RUN)) == [("1", "x")]
    assert spec.bronze_columns() is None


def test_same_key_in_two_spellings_is_one_row(spark):
    bronze = spark.createDataFrame(
        [("1", "20", None, "a", "2024-01-01 00:00:00"), ("01", "21", None, "a", "2024-01-02 00:00:00")], USERS)
    assert rows(build_silver(bronze, users_spec(), RUN)) == [(1, 21, "a")]


def test_bad_keys_fail_or_are_set_aside(spark):
    bronze = spark.createDataFrame(
        [(None, "20", None, "a", "2024-01-01 00:00:00"), ("x", "21", None, "a", "2024-01-02 00:00:00"),
         ("3", "22", None, "a", "2024-01-02 00:00:00")], USERS)
    with pytest.raises(Exception, match="null key in column user_id"):
        build_silver(bronze, users_spec(), RUN).collect()
    good, rejected = build_silver_with_rejects(bronze, users_spec(), RUN)
    assert rows(good) == [(3, 22, "a")]
    assert [r.reject_reason for r in rejected.collect()] == ["null key: user_id"] * 2


def test_same_id_from_two_partners(spark):
    bronze = spark.createDataFrame(
        [("1", "20", None, "a", "2024-01-01 00:00:00"), ("1", "21", None, "b", "2024-01-02 00:00:00")], USERS)
    assert rows(build_silver(bronze, users_spec(), RUN)) == [(1, 21, "b")]
    both = users_spec(pk=["partner", "user_id"])
    assert rows(build_silver(bronze, both, RUN)) == [(1, 20, "a"), (1, 21, "b")]


def test_latest_is_a_total_order(spark):
    data = [("k", ts("2024-01-02"), v) for v in ("a", "c", "b")] + [("k", None, "z"), ("n", None, "y")]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, v string")
    for n in (1, 3, 8):
        got = latest_per_key(df.repartition(n), ["k"], ["t"])
        assert rows(got) == [("k", ts("2024-01-02"), "c"), ("n", None, "y")]
    assert rows(any_per_key(df.select("k"), ["k"])) == [("k",), ("n",)]
    once = latest_per_key(df, ["k"], ["t"])
    assert rows(latest_per_key(once, ["k"], ["t"])) == rows(once)


def test_latest_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 10 as k", "id as t")
    text = plan(latest_per_key(df, ["k"], ["t"]))
    before_exchange = text[: text.index("Exchange")]
    assert text.count("WindowGroupLimit") >= 2 and "WindowGroupLimit" in text
    assert "ArrowEval" not in text and "BatchEvalPython" not in text and before_exchange


def test_duplicate_columns_and_lineage(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS b, 3 AS a")
    assert rows(first_of_duplicates(df)) == [(1, 2)]
    tagged = with_lineage(spark.sql("SELECT 1 AS a"), "PARTNER_A", "users", RUN)
    assert rows(tagged) == [(1, RUN, "partner_a", "users")]
    text = all_strings(spark.sql("SELECT 1 AS a, DATE'2024-01-01' AS `b c`, true AS d"))
    assert {f.dataType for f in text.schema} == {T.StringType()}
    assert rows(text) == [("1", "2024-01-01", "true")]


def test_require_and_split_keep_all_rows(spark):
    df = spark.createDataFrame([(1, 2), (None, 3), (4, None)], "a int, b int")
    good, bad = split_rejects(df, ["a", "b"])
    assert good.count() + bad.count() == df.count()
    assert rows(bad.select("reject_reason")) == [("null key: a",), ("null key: b",)]
    assert rows(require_keys(good, ["a", "b"])) == [(1, 2)]


KV = "k bigint, t timestamp_ntz, v string"


def test_upsert_replaces_adds_and_keeps(spark):
    old = spark.createDataFrame([(1, ts("2024-01-01"), "old"), (2, ts("2024-01-01"), "keep")], KV)
    new = spark.createDataFrame([(1, ts("2024-01-02"), "new"), (3, ts("2024-01-02"), "add")], KV)
    merged = upsert(old, new, ["k"])
    assert [(r[0], r[2]) for r in rows(merged)] == [(1, "new"), (2, "keep"), (3, "add")]
    assert rows(upsert(merged, new, ["k"])) == rows(merged)


def test_late_older_state_does_not_win(spark):
    old = spark.createDataFrame([(1, ts("2024-01-05"), "newer"), (2, None, "undated")], KV)
    new = spark.createDataFrame(
        [(1, ts("2024-01-02"), "older"), (2, ts("2024-01-02"), "dated"), (3, None, "first")], KV)
    assert [(r[0], r[2]) for r in rows(upsert(old, new, ["k"], "t"))] == [(1, "newer"), (2, "dated"), (3, "first")]
    undated = spark.createDataFrame([(1, None, "undated")], KV)
    assert [(r[0], r[2]) for r in rows(upsert(old, undated, ["k"], "t"))] == [(1, "newer"), (2, "undated")]


def test_upsert_evolves_the_schema(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(2, 9)], "k int, w int")
    assert upsert(old, new, ["k"]).columns == ["k", "v", "w"]
    assert rows(union_evolved(old, new)) == [(1, "a", None), (2, None, 9)]


def test_insert_if_absent_keeps_the_stored_row(spark):
    old = spark.createDataFrame([(1, "old")], "k int, v string")
    new = spark.createDataFrame([(1, "new"), (2, "a"), (2, "b")], "k int, v string")
    assert rows(insert_if_absent(old, new, ["k"])) == [(1, "old"), (2, "b")]


def test_upsert_leaves_a_large_target_unshuffled(spark, root):
    spark.range(200000).selectExpr("id as k", "cast(id as string) as v").write.parquet(f"{root}/t")
    spark.range(5).selectExpr("id as k", "'new' as v").write.parquet(f"{root}/u")
    merged = upsert(spark.read.parquet(f"{root}/t"), spark.read.parquet(f"{root}/u"), ["k"])
    merged.collect()
    assert "Exchange hashpartitioning" not in plan(merged)


def test_nested_maps_take_part_in_the_order(spark):
    df = spark.sql("SELECT 'k' AS k, 1 AS t, struct(map('a', n) AS m) AS s FROM VALUES (1), (3), (2) v(n)")
    found = {str(latest_per_key(d, ["k"], ["t"]).first().s) for d in (df, df.orderBy(F.col("s.m.a").desc()))}
    assert len(found) == 1
