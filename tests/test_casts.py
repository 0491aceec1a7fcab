from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F, types as T

from pursewatch.functions import casts, predicates, timing
from pursewatch.model import MONEY
from helpers import plan, ts


def run(spark, cast, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    out = df.select("i", cast(F.col("x")).alias("y"))
    return [r.y for r in out.orderBy("i").collect()]


WHOLE = ["1.5", "2.5", "-2.5", "1e3", " 7 ", "abc", "", "99999999999999999999", None]


def test_text_to_whole_numbers(spark):
    assert run(spark, casts.to_bigint, WHOLE) == [2, 3, -3, 1000, 7, None, None, None, None]
    assert run(spark, casts.to_int, ["3.5", "2147483648", "-1"]) == [4, None, -1]


def test_text_to_boolean(spark):
    values = ["true", "y", "yes", "1", "on", "1.0", "F", "no", ""]
    expected = [True, True, True, True, None, None, False, False, None]
    assert run(spark, casts.to_boolean, values) == expected


def test_text_to_double(spark):
    assert run(spark, casts.to_double, ["1.5", "1e2", "", "1.5d", "2f", "x"]) == [1.5, 100.0] + [None] * 4
    assert str(run(spark, casts.to_double, ["nan"])[0]) == "nan"
    assert run(spark, casts.to_double, ["inf"]) == [float("inf")]


def test_text_to_timestamp(spark):
    values = ["2024-01-02 03:04:05.123456", "2024-01-02", "2024-01", "2024", "x", "2024-13-01"]
    expected = [ts("2024-01-02 03:04:05.123456"), ts("2024-01-02"), None, None, None, None]
    assert run(spark, casts.to_timestamp, values) == expected


def test_money_and_currency(spark):
    assert run(spark, casts.to_money, ["12.345", "-12.345", "x"]) == [Decimal("12.35"), Decimal("-12.35"), None]
    assert run(spark, casts.to_myr, ["0.05", "-0.05", "100"]) == [Decimal("0.24"), Decimal("-0.24"), Decimal("470.00")]
    assert run(spark, casts.to_myr, ["9999999999999999.99"]) == [None]
    df = spark.range(1).select(casts.to_money(F.lit("1")).alias("a"), casts.to_myr(F.lit("1")).alias("b"))
    assert [f.dataType for f in df.schema] == [MONEY, MONEY]


@pytest.mark.parametrize(
    "cast,sql",
    [(casts.to_bigint, "BIGINT"), (casts.to_int, "INTEGER"), (casts.to_double, "DOUBLE"),
     (casts.to_money, "DECIMAL(18,2)"), (casts.to_boolean, "BOOLEAN"), (casts.to_timestamp, "TIMESTAMP")],
)
def test_casts_agree_with_sql_try_cast(spark, cast, sql):
    values = [*WHOLE[:-1], "0.5", "-0.5", "1e-3", "+5", ".5", "5.", "1,000", "t", "no", "1.5d",
              "2024-01-02T03:04:05", "2024-1-2", "2024-01", "2024-01-02 25:00:00", "12.345", "true"]
    con = duckdb.connect()
    expected = [con.execute(f"SELECT TRY_CAST(? AS {sql})", [v]).fetchall()[0][0] for v in values]
    assert run(spark, cast, values) == expected


def test_elapsed_counts_whole_seconds(spark):
    a, b = timing.moment("2024-01-01 00:00:00.9"), timing.moment("2024-01-01 00:00:02.1")
    assert spark.range(1).select(timing.elapsed_seconds(a, b)).first()[0] == 1


def test_time_columns_carry_no_zone(spark):
    t = timing.moment("2024-01-31 10:11:12.5")
    df = spark.range(1).select(
        timing.day_of(t).alias("day"),
        timing.window_start("2024-01-31 00:00:00").alias("start"),
        timing.or_epoch(F.lit(None).cast("timestamp_ntz")).alias("epoch"),
        timing.watermark_text(t).alias("text"),
        timing.ingest_stamp(t).alias("stamp"),
    )
    assert [df.schema[c].dataType for c in ("day", "start", "epoch")] == [T.TimestampNTZType()] * 3
    assert tuple(df.first()) == (
        ts("2024-01-31"), ts("2024-01-24"), ts("1970-01-01"),
        "2024-01-31 10:11:12.500000", "2024-01-31 10:11:12",
    )


def test_partner_names_and_suffixes(spark):
    df = spark.createDataFrame([("PARTNER_A",), ("Partner_B",), ("other",)], "p string")
    got = df.select(
        predicates.partner_id(F.col("p")), predicates.table_suffix(F.col("p"), {"partner_b": "_partner_b"})
    ).collect()
    assert [tuple(r) for r in got] == [("partner_a", ""), ("partner_b", "_partner_b"), ("other", "")]


def test_whole_numbers_are_rounded_once(spark):
    values = ["0.49999999999", "1.49999999999", "-0.49999999999999", "2.50000000000000", "-2.5000000000001", "7.99999999999 "]
    assert run(spark, casts.to_bigint, values) == [0, 1, 0, 3, -3, 8]


def test_plain_whole_numbers_and_times_read_as_the_others_do(spark):
    texts = ["7", "-7", "0", "-0", "+7", "007", " 7 ", "7.0", "1.5", "-1.5", "1e3", "2147483648", "9223372036854775807",
             "9223372036854775808", "7\x7f", "", "abc", None, "true"]
    wanted = [7, -7, 0, 0, 7, 7, 7, 7, 2, -2, 1000, 2147483648, 9223372036854775807, None, None, None, None, None, None]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").repartition(3)
    whole = df.select("k", casts.to_bigint(F.col("t")).alias("b"), casts.to_int(F.col("t")).alias("i"))
    found = {r.k: (r.b, r.i) for r in whole.collect()}
    small = [w if w is not None and w < 2**31 else None for w in wanted]
    assert [found[k] for k in range(len(texts))] == list(zip(wanted, small))
    times = ["2024-01-31", "2024-01-31 01:02:03.5", "2024-1-3", " 2024-01-31 ", "2024-01", "2024", "-2024-1", "2024-01-", "2024-13-01", "abcd-ef-gh"]
    asked = spark.createDataFrame(list(enumerate(times)), "k int, t string").repartition(3)
    asked = asked.select("k", casts.to_timestamp(F.col("t")).isNotNull().alias("read")).collect()
    assert {times[r.k] for r in asked if r.read} == {"2024-01-31", "2024-01-31 01:02:03.5", "2024-1-3", " 2024-01-31 "}


def test_plain_whole_numbers_take_no_decimals(spark):
    # the decimals are in a branch that such text does not reach
    rows = spark.range(2).select(F.col("id").cast("string").alias("t"))
    shown = plan(rows.select(casts.to_bigint(F.col("t")).alias("b")), "simple")
    assert shown.index("CASE WHEN") < shown.index(" THEN ") < shown.index("decimal(38,10)")
