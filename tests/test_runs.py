import re
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows, ts
from pursewatch.model import LEDGER_SCHEMA
from pursewatch.operators.audit import CircuitOpen
from pursewatch.operators.changes import change_images, replay
from pursewatch.operators.dedup import latest_per_key
from pursewatch.plans.batches import RELEASED, STOPPED, Batch, batch_states, batches_in, reject_batches, release_batches
from pursewatch.plans.daily_run import Run, _typed, ingest, read_feeds, run_day
from pursewatch.plans.gold import keyed_profile, merchant_daily_summary, user_risk_profile
from pursewatch.streaming.daily_summary import closed_days, read_daily_summary, stream_daily_parts
from pursewatch.sources.bronze import read_bronze, write_increment
from pursewatch.sources.tables import load_tables
from pursewatch.plans.silver import build_silver
from pursewatch.streaming.latest_state import stream_latest_state, stream_silver

T0 = datetime(2024, 1, 30, 8, 0, 0)
SOURCE_TX = (
    "transaction_id string, user_id int, card_id int, amount string, status string, "
    "transaction_time timestamp_ntz, updated_at timestamp_ntz, use_chip string, merchant_id int, "
    "merchant_name string, mcc int, risk_score float"
)


def change(tid, user, card, status, seconds, amount="10.00", risk=0.1):
    at = ts("2024-01-29 12:00:00")
    return (tid, user, card, amount, status, at, at + timedelta(seconds=seconds), "Chip", 50000, "Merchant_50000", 1000, risk)


def partner(spark, changes, users=(1,), cards=((10, False),)):
    return {
        "transactions": spark.createDataFrame(changes, SOURCE_TX),
        "users": spark.createDataFrame([(u, 30, "1000.00", 700) for u in users], "user_id int, current_age int, yearly_income string, credit_score int"),
        "cards": spark.createDataFrame([(c, 1, "Visa", "5.00", bad) for c, bad in cards], "card_id int, user_id int, card_brand string, credit_limit string, card_on_dark_web boolean"),
    }


FIRST = [change("t1", 1, 10, "PENDING", 0), change("t1", 1, 10, "APPROVED", 2)]
SECOND = [change("t1", 1, 10, "SUCCESS", 7), change("t2", 1, 10, "PENDING", 9)]


@pytest.mark.parametrize("incremental", [False, True])
def test_two_runs_equal_one(spark, root, incremental):
    b = partner(spark, [change("t9", 2, 20, "SUCCESS", 7, "3.00")], users=(2, 3), cards=((20, True),))
    names = {"silver": f"s{incremental}_", "gold": f"g{incremental}_"}
    first = {"PARTNER_A": partner(spark, FIRST), "PARTNER_B": b}
    run_day(spark, first, Run(f"{root}/two", T0, **names), incremental)
    second = {"PARTNER_A": partner(spark, FIRST + SECOND), "PARTNER_B": b}
    later = T0 + timedelta(hours=2)
    gold = rows(run_day(spark, second, Run(f"{root}/two", later, **names), incremental))
    states = rows(spark.table(f"s{incremental}_transactions").select("transaction_id", "status"))
    assert states == [("t1", "SUCCESS"), ("t2", "PENDING"), ("t9", "SUCCESS")]
    assert gold == [(1, 10.0, 10.0, False, later), (2, 3.0, 3.0, True, later), (3, 0.0, None, False, later)]
    at_once = rows(run_day(spark, second, Run(f"{root}/one", later, silver="o_", gold="o_"), incremental))
    assert at_once == gold
    ledger = spark.read.parquet(f"{root}/two/ledger")
    assert ledger.columns == [*LEDGER_SCHEMA.names, "error"]
    assert ledger.count() == 2 * 2 * 3
    tx = ledger.where("table_name = 'transactions'").where(F.col("execution_time") == F.lit(later).cast("timestamp"))
    by_stage = {r.pipeline_stage: r for r in tx.collect()}
    bronze, silver = by_stage["source_to_bronze"], by_stage["bronze_to_silver"]
    assert (bronze.source_count, bronze.target_count) == ((2, 2) if incremental else (5, 5))
    assert (silver.bronze_raw_count, silver.silver_deduped_count) == ((2, 2) if incremental else (5, 3))


def test_ingest_is_safe_to_repeat(spark, root):
    sources = {"a": partner(spark, FIRST)}
    run = Run(root, T0)
    written, errors = ingest(spark, sources, run)
    assert errors == {} and written["a", "transactions"].rows == 2
    written, _ = ingest(spark, sources, run)
    assert written["a", "transactions"].rows == 0
    marks = spark.read.parquet(f"{root}/watermarks").where("table_name = 'transactions'").collect()
    assert [m.watermark for m in marks] == [ts("2024-01-29 12:00:02")]


def test_one_failing_partner_does_not_stop_the_other(spark, root):
    broken = partner(spark, FIRST)
    broken["transactions"] = broken["transactions"].withColumn("amount", F.raise_error(F.lit("source is down")).cast("string"))
    written, errors = ingest(spark, {"a": broken, "b": partner(spark, FIRST)}, Run(root, T0))
    assert list(errors) == ["a"] and written["b", "users"].rows == 1
    marks = spark.read.parquet(f"{root}/watermarks")
    assert rows(marks.select("partner")) == [("b",)]


def test_null_keys_stop_the_run_or_are_set_aside(spark, root):
    bad = partner(spark, [*FIRST, change(None, 1, 10, "SUCCESS", 1)])
    with pytest.raises(CircuitOpen, match="transactions: null_key"):
        run_day(spark, {"a": bad}, Run(f"{root}/stop", T0, silver="n_", gold="n_"))
    assert spark.read.parquet(f"{root}/stop/ledger").count() == 3
    run_day(spark, {"a": bad}, Run(f"{root}/go", T0, silver="m_", gold="m_", rejects=True))
    assert spark.table("m_transactions").count() == 1
    assert [r.reject_reason for r in spark.table("m_transactions_rejects").collect()] == ["null key: transaction_id"]


@pytest.mark.parametrize("incremental", [False, True])
def test_null_keys_are_set_aside_in_either_mode(spark, root, incremental):
    bad = partner(spark, [*FIRST, change(None, 1, 10, "SUCCESS", 1)])
    names = {"silver": f"na{incremental}_", "gold": f"na{incremental}_"}
    run_day(spark, {"a": bad}, Run(root, T0, rejects=True, **names), incremental)
    name = f"na{incremental}_transactions"
    assert spark.table(name).count() == 1
    assert [r.reject_reason for r in spark.table(f"{name}_rejects").collect()] == ["null key: transaction_id"]


def broken(spark, changes):
    source = partner(spark, changes)
    source["transactions"] = source["transactions"].withColumn("amount", F.raise_error(F.lit("source is down")).cast("string"))
    return source


def test_a_failed_partner_stops_the_run_and_its_rows_come_later(spark, root):
    a, b = partner(spark, FIRST), partner(spark, [change("t9", 2, 20, "SUCCESS", 7)], users=(2,), cards=((20, False),))
    names = {"silver": "fp_", "gold": "fp_"}
    later = T0 + timedelta(hours=2)
    with pytest.raises(CircuitOpen, match="partner_failed"):
        run_day(spark, {"a": a, "b": broken(spark, FIRST)}, Run(root, T0, **names), incremental=True)
    assert not spark.catalog.tableExists("fp_user_risk_profile")
    run_day(spark, {"a": a, "b": broken(spark, FIRST)}, Run(root, T0, partial=True, **names), incremental=True)
    assert rows(spark.table("fp_transactions").select("transaction_id")) == [("t1",)]
    # the same run time again, now with the partner; then a later run, then an older one
    run_day(spark, {"a": a, "b": b}, Run(root, T0, **names), incremental=True)
    assert rows(spark.table("fp_transactions").select("transaction_id")) == [("t1",), ("t9",)]
    gold = rows(run_day(spark, {"a": a, "b": b}, Run(root, later, **names), incremental=True))
    c = partner(spark, [change("t5", 1, 10, "SUCCESS", 8)])
    run_day(spark, {"a": a, "b": b, "c": c}, Run(root, T0 - timedelta(hours=2), **names), incremental=True)
    assert rows(spark.table("fp_transactions").select("transaction_id")) == [("t1",), ("t5",), ("t9",)]
    assert len(gold) == 2


@pytest.mark.parametrize("incremental", [False, True])
def test_the_same_run_twice_changes_nothing(spark, root, incremental):
    names = {"silver": f"tw{incremental}_", "gold": f"tw{incremental}_"}
    sources, run = {"a": partner(spark, FIRST + SECOND)}, Run(root, T0, **names)
    once = rows(run_day(spark, sources, run, incremental))
    assert rows(run_day(spark, sources, run, incremental)) == once


def test_increments_that_silver_lost_track_of_are_merged_again(spark, root):
    """A crash after bronze was written and before silver: the next run takes both increments."""
    names = {"silver": "cr_", "gold": "cr_"}
    ingest(spark, {"a": partner(spark, FIRST)}, Run(root, T0, **names))
    run_day(spark, {"a": partner(spark, FIRST + SECOND)}, Run(root, T0, **names), incremental=True)
    assert rows(spark.table("cr_transactions").select("transaction_id", "status")) == [("t1", "SUCCESS"), ("t2", "PENDING")]


def test_types_and_change_times_stop_the_run(spark, root):
    wrong = partner(spark, [change("t1", 1, 10, "SUCCESS", 0, amount="abc")])
    with pytest.raises(CircuitOpen, match="transactions: type_mismatch"):
        run_day(spark, {"a": wrong}, Run(f"{root}/x", T0, silver="ty_", gold="ty_"))
    run_day(spark, {"a": wrong}, Run(f"{root}/y", T0, silver="tz_", gold="tz_", lenient=True))
    untimed = partner(spark, FIRST)
    untimed["transactions"] = untimed["transactions"].withColumn("updated_at", F.when(F.col("status") == "APPROVED", F.col("updated_at")))
    with pytest.raises(CircuitOpen, match=r"transactions: unversioned \(1\)"):
        run_day(spark, {"a": untimed}, Run(f"{root}/z", T0, silver="tu_", gold="tu_"), incremental=True)
    ledger = {r.table_name: r for r in spark.read.parquet(f"{root}/z/ledger").collect()}
    assert ledger["transactions"].error == "1 rows without a change time"


# ---- batches that are held back

BAD = {
    "null_key": (change(None, 1, 10, "SUCCESS", 20), "null_key (1)"),
    "type_mismatch": (change("t2", 1, 10, "SUCCESS", 20, amount="abc"), "type_mismatch (1)"),
}


def states(spark, root):
    found = batch_states(spark, root).where("table_name = 'transactions'")
    return sorted((r.row_count, r.state, r.rule) for r in found.collect())


@pytest.mark.parametrize(("kind", "incremental"), [("null_key", True), ("type_mismatch", False)])
def test_a_stopped_batch_is_never_published(spark, root, incremental, kind):
    """The runs after a stop stop as well, whatever comes next, until somebody decides."""
    wrong, rule = BAD[kind]
    n = f"st{kind[0]}{incremental}_"
    names = {"silver": n, "gold": n}
    later = [T0 + timedelta(hours=h) for h in range(8)]
    good = {"a": partner(spark, FIRST)}
    bad = {"a": partner(spark, [*FIRST, wrong])}
    more = {"a": partner(spark, [*FIRST, wrong, change("t3", 1, 10, "SUCCESS", 30)])}
    before = rows(run_day(spark, good, Run(root, later[0], **names), incremental))

    def silver():
        return rows(spark.table(f"{n}transactions").select("transaction_id", "status"))

    for sources, at in ((bad, later[1]), (more, later[3])):
        with pytest.raises(CircuitOpen, match=re.escape(f"transactions: {rule} in batch")):
            run_day(spark, sources, Run(root, at, **names), incremental)
        assert silver() == [("t1", "APPROVED")] and rows(spark.table(f"{n}user_risk_profile")) == before
    assert states(spark, root) == [(1, "clean", None), (1, "stopped", rule), (2, "merged" if incremental else "clean", None)]

    # without it, by choice
    run_day(spark, more, Run(root, later[4], past_held=True, **names), incremental)
    assert silver() == [("t1", "APPROVED"), ("t3", "SUCCESS")]
    (held,) = [b.batch_id for b in batches_in(spark, root, STOPPED)]
    with pytest.raises(ValueError, match="no such batch"):
        release_batches(spark, root, ["other"], later[5])

    release_batches(spark, root, [held], later[5])
    gold = rows(run_day(spark, more, Run(root, later[5], **names), incremental))
    assert silver() == [("t1", "APPROVED"), *([("t2", "SUCCESS")] if kind == "type_mismatch" else []), ("t3", "SUCCESS")]
    assert gold == [(1, 10.0, 10.0, False, later[5])]
    if kind == "null_key":
        assert [r.reject_reason for r in spark.table(f"{n}transactions_rejects").collect()] == ["null key: transaction_id"]
    with pytest.raises(ValueError, match="not stopped"):
        reject_batches(spark, root, [b.batch_id for b in batches_in(spark, root, "merged", "clean")][:1], later[6])


def test_a_rejected_batch_stays_out_for_good(spark, root, incremental=True):
    n = f"rj{incremental}_"
    names = {"silver": n, "gold": n}
    sources = {"a": partner(spark, [change("t1", 1, 10, "SUCCESS", 1, amount="abc")])}
    with pytest.raises(CircuitOpen, match="type_mismatch"):
        run_day(spark, sources, Run(root, T0, **names), incremental)
    reject_batches(spark, root, [b.batch_id for b in batches_in(spark, root, STOPPED)], T0)
    sources = {"a": partner(spark, [change("t1", 1, 10, "SUCCESS", 1, amount="abc"), change("t2", 1, 10, "SUCCESS", 2, "3.00")])}
    gold = rows(run_day(spark, sources, Run(root, T0 + timedelta(hours=1), **names), incremental))
    assert gold == [(1, 3.0, 3.0, False, T0 + timedelta(hours=1))]
    assert rows(spark.table(f"{n}transactions").select("transaction_id")) == [("t2",)]


def test_a_run_that_died_before_its_checks_is_checked_later(spark, root):
    names = {"silver": "dc_", "gold": "dc_"}
    ingest(spark, {"a": partner(spark, [change("t1", 1, 10, "SUCCESS", 1, amount="abc")])}, Run(root, T0, **names))
    with pytest.raises(CircuitOpen, match="type_mismatch"):
        run_day(spark, {"a": partner(spark, [change("t2", 1, 10, "SUCCESS", 2)])}, Run(root, T0, **names), incremental=True)


# ---- feeds of changes, and the profile kept from them


def many_changes(seed, n=150):
    """Runs of changes: states, amounts, cards, users and even the time of a transaction change."""
    import random

    r = random.Random(seed)
    runs, at = [[] for _ in range(4)], {}
    for k in range(4):
        for _ in range(n):
            i = r.randrange(n)
            start = ts("2024-01-20 03:00:00") + timedelta(hours=r.randrange(24 * 10), seconds=r.randrange(3600))
            at[i] = start if i not in at or r.random() < 0.3 else at[i]
            row = list(change(f"t{i}", r.choice([1, 2, 3, None]), r.choice([10, 20, 30]), r.choice(["PENDING", "SUCCESS", "FAILED"]),
                              0, f"{r.randrange(1, 500)}.{r.randrange(100):02d}", r.choice([0.1, 0.5, 0.9, None])))
            row[5], row[6] = at[i], ts("2024-01-30") + timedelta(hours=k * 2, seconds=len(runs[k]))
            runs[k].append(tuple(row))
    return runs


def test_maintained_profile_equals_the_full_one(spark, root):
    """After several runs with changed states, moved days and a window that moves on and back."""
    people, plastic = (1, 2, 3, 4), ((10, False), (20, False), (30, True))
    names = {"silver": "mp_", "gold": "mp_"}
    times = [ts("2024-01-30 03:30:00"), ts("2024-01-30 09:00:01"), ts("2024-02-03 00:00:00"), ts("2024-01-31 12:00:00")]
    runs = many_changes(4)
    for k, at in enumerate(times):
        source = {"a": partner(spark, runs[k], people, plastic)}
        found = rows(run_day(spark, source, Run(root, at, **names), incremental=True))
        tables = [spark.table(f"mp_{t}") for t in ("users", "cards", "transactions")]
        assert found == rows(keyed_profile(user_risk_profile(*tables, at)))
    feeds = read_feeds(spark, Run(root, T0), "transactions", spark.table("mp_transactions").schema)
    assert feeds.select("feed").distinct().count() == 4
    assert rows(replay(feeds)) == rows(spark.table("mp_transactions"))
    # the sums alone lead there too, and so do feeds read anew when the sums are lost
    for view in [t.name for t in spark.catalog.listTables() if t.name.startswith("mp_profile_parts")]:
        spark.catalog.dropTempView(view)
    again = rows(run_day(spark, {"a": partner(spark, [], people, plastic)}, Run(root, times[3], **names), incremental=True))
    assert again == found
    # far back in time: the days kept do not reach there
    old = ts("2024-01-24 05:00:00")
    found = rows(run_day(spark, {"a": partner(spark, [], people, plastic)}, Run(root, old, **names), incremental=True))
    assert found == rows(keyed_profile(user_risk_profile(*tables, old)))


def test_maintained_profile_reads_one_day_of_transactions(spark, root):
    from pursewatch.plans import daily_run

    names = {"silver": "od_", "gold": "od_"}
    for k, changes in enumerate(many_changes(5)[:2]):
        run = Run(root, ts("2024-01-30 09:00:00") + timedelta(hours=k), **names)
        run_day(spark, {"a": partner(spark, changes, (1, 2, 3))}, run, incremental=True)
    silver = {t: spark.table(f"od_{t}") for t in ("users", "cards", "transactions")}
    text = plan(daily_run._maintained(spark, run, silver, []))
    scans = [part for part in text.split("\n\n") if "/silver/transactions/live" in part]
    assert len(scans) == 1 and "event_date" in scans[0] and "2024-01-23" in scans[0]
    assert "changes/transactions" not in text


@pytest.mark.parametrize("point", ["apply", "note"])
def test_a_run_that_died_after_its_feed_was_stored(spark, root, monkeypatch, point):
    """The next run applies the stored feed, and the profile takes it in once."""
    from pursewatch.plans import daily_run

    names = {"silver": f"fd{point}_", "gold": f"fd{point}_"}
    run_day(spark, {"a": partner(spark, FIRST)}, Run(root, T0, **names), incremental=True)
    real = daily_run.apply_images

    def die(*given):
        if point == "note":
            real(*given)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(daily_run, "apply_images", die)
        with pytest.raises(RuntimeError):
            run_day(spark, {"a": partner(spark, FIRST + SECOND)}, Run(root, T0, **names), incremental=True)
    more = [*FIRST, *SECOND, change("t4", 1, 10, "SUCCESS", 12, "5.00")]
    gold = rows(run_day(spark, {"a": partner(spark, more)}, Run(root, T0, **names), incremental=True))
    assert gold == [(1, 15.0, 7.5, False, T0)]
    table = spark.table(f"fd{point}_transactions")
    assert rows(table.select("transaction_id", "status")) == [("t1", "SUCCESS"), ("t2", "PENDING"), ("t4", "SUCCESS")]
    assert rows(replay(read_feeds(spark, Run(root, T0), "transactions", table.schema))) == rows(table)


def test_dimensions_keep_few_snapshots_and_later_versions_win(spark, root):
    names = {"silver": "ds_", "gold": "ds_"}
    for k in range(3):
        users = spark.createDataFrame([(1, 30 + k, "1.00", 1)], "user_id int, current_age int, yearly_income string, credit_score int")
        source = {**partner(spark, FIRST), "users": users}
        run_day(spark, {"a": source}, Run(root, T0 + timedelta(hours=k), keep=2, **names), incremental=True)
    assert rows(spark.table("ds_users").select("user_id", "age")) == [(1, 32)]
    assert len(list(Path(root, "silver", "users", "versions").iterdir())) == 2


def test_a_reader_counts_at_the_source(spark, root):
    class Counting:
        def __init__(self, df):
            self.df = df

        def __call__(self, since):
            return self.df.where(F.col("updated_at").isNotNull())

        def total(self):
            return self.df.count()

        def untimed(self):
            return self.df.where(F.col("updated_at").isNull()).count()

    tables = partner(spark, FIRST)
    source = {**tables, "transactions": Counting(tables["transactions"])}
    run_day(spark, {"a": source}, Run(f"{root}/x", T0, silver="ct_", gold="ct_"))
    ledger = {(r.pipeline_stage, r.table_name): r for r in spark.read.parquet(f"{root}/x/ledger").collect()}
    row = ledger["source_to_bronze", "transactions"]
    assert (row.source_count, row.target_count) == (2, 2)
    untimed = tables["transactions"].withColumn("updated_at", F.when(F.col("status") == "APPROVED", F.col("updated_at")))
    with pytest.raises(CircuitOpen, match=r"transactions: unversioned \(1\)"):
        run_day(spark, {"a": {**tables, "transactions": Counting(untimed)}}, Run(f"{root}/y", T0, silver="cu_", gold="cu_"), incremental=True)


def test_upsert_and_full_refresh_break_ties_alike(spark, root):
    one, two = ([change("t1", 1, 10, s, 5, amount=a)] for s, a in (("SUCCESS", "9.00"), ("SUCCESS", "10.00")))
    found = []
    for incremental, order in ((True, (one, two)), (True, (two, one)), (False, (two, one))):
        n = f"tie{len(found)}_"
        for i, changes in enumerate(order):
            run = Run(f"{root}/{n}", T0 + timedelta(hours=i), silver=n, gold=n, look_back=timedelta(days=1))
            run_day(spark, {"a": partner(spark, changes)}, run, incremental)
        found.append(rows(spark.table(f"{n}transactions").select("amount")))
    assert found == [found[0]] * 3


def test_a_table_without_rows_on_the_first_day(spark, root):
    first = partner(spark, [])
    names = {"silver": "em_", "gold": "em_"}
    assert len(rows(run_day(spark, {"a": first}, Run(root, T0, **names), incremental=True))) == 1
    run_day(spark, {"a": partner(spark, FIRST)}, Run(root, T0 + timedelta(hours=1), **names), incremental=True)
    assert spark.table("em_transactions").count() == 1


def test_a_source_can_be_a_reader(spark, root):
    asked = []
    sources = partner(spark, FIRST)
    table = sources["transactions"]
    sources["transactions"] = lambda since: asked.append(since) or table
    run_day(spark, {"a": sources}, Run(root, T0, silver="rd_", gold="rd_"), incremental=True)
    run_day(spark, {"a": sources}, Run(root, T0, silver="rd_", gold="rd_"), incremental=True)
    assert asked == [None, ts("2024-01-29 12:00:02")]


def test_a_corrected_event_day_moves(spark, root):
    late = list(change("t1", 1, 10, "SUCCESS", 9))
    late[5] = late[5] - timedelta(days=3)
    names = {"silver": "cd_", "gold": "cd_"}
    run_day(spark, {"a": partner(spark, FIRST)}, Run(root, T0, **names), incremental=True)
    run_day(spark, {"a": partner(spark, [tuple(late)])}, Run(root, T0 + timedelta(hours=1), **names), incremental=True)
    assert [(r.status, str(r.event_date)) for r in spark.table("cd_transactions").collect()] == [("SUCCESS", "2024-01-26")]


def test_silver_holds_the_declared_types(spark, root):
    run_day(spark, {"a": partner(spark, FIRST)}, Run(root, T0, silver="y_", gold="y_"))
    types = dict(spark.table("y_transactions").dtypes)
    assert types["amount"] == types["amount_myr"] == "decimal(18,2)"
    assert (types["user_id"], types["transaction_time"], types["event_date"]) == ("bigint", "timestamp_ntz", "date")
    assert spark.table("y_transactions").first().amount_myr == Decimal("47.00")


FEED = "id string, t timestamp_ntz, v string, day string"


def test_stream_equals_batch_in_any_order(spark, root):
    import random

    rng = random.Random(7)
    data = [(f"k{i % 40}", ts("2024-01-01") + timedelta(seconds=rng.randrange(50)), f"v{rng.randrange(9)}", f"d{i % 40 % 4}") for i in range(400)]
    expected = rows(latest_per_key(spark.createDataFrame(data, FEED), ["id"], ["t"], ["v"]))
    for part in range(4):
        spark.createDataFrame(data[part::4], FEED).coalesce(1).write.mode("append").parquet(f"{root}/feed")
        feed = spark.readStream.schema(FEED).option("maxFilesPerTrigger", 1).parquet(f"{root}/feed")
        if part % 2:
            stream_latest_state(feed, f"{root}/silver", f"{root}/cp", ["id"], ["t"], ["v"], "day").awaitTermination()
    assert rows(spark.read.parquet(f"{root}/silver").select("id", "t", "v", "day")) == expected


TX_FEED = "merchant_id bigint, transaction_time timestamp_ntz, amount_myr decimal(18,2), risk_score double"


def feed_rows():
    return [(i % 3, ts("2024-01-01") + timedelta(hours=7 * i), Decimal(i), i / 8) for i in range(40)]


def test_streamed_days_equal_batch_days(spark, root):
    df = spark.createDataFrame(feed_rows(), TX_FEED)
    df.repartition(5).write.parquet(f"{root}/feed")
    feed = spark.readStream.schema(TX_FEED).option("maxFilesPerTrigger", 1).parquet(f"{root}/feed")
    stream_daily_parts(feed, f"{root}/parts", f"{root}/cp").awaitTermination()
    got = read_daily_summary(spark, f"{root}/parts").select("merchant_id", "date", "total_volume", "avg_risk_score")
    assert [(a, b, float(c), d) for a, b, c, d in rows(got)] == [(a, b, float(c), d) for a, b, c, d in rows(merchant_daily_summary(df))]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kuala_Lumpur"])
def test_closed_days_are_emitted_once(spark, root, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        _closed_days(spark, root)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _closed_days(spark, root):
    df = spark.createDataFrame(feed_rows(), TX_FEED)
    df.coalesce(1).write.parquet(f"{root}/feed")
    feed = spark.readStream.schema(TX_FEED).parquet(f"{root}/feed")
    query = (closed_days(feed, "1 day").writeStream.outputMode("append").format("parquet")
             .option("path", f"{root}/out").option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start())
    query.awaitTermination()
    out = rows(spark.read.parquet(f"{root}/out").select("merchant_id", "date"))
    whole = rows(merchant_daily_summary(df).select("merchant_id", "date"))
    last = max(d for _, d in whole)
    assert out == [r for r in whole if r[1] < last - timedelta(days=1)]


def test_streamed_silver_equals_rebuilt_silver(spark, root):
    spec = load_tables()["transactions"]
    feed = [FIRST, [change("t2", 1, 10, "SUCCESS", 9), change(None, 1, 10, "SUCCESS", 1)], SECOND]
    for i, changes in enumerate(feed):
        df = spark.createDataFrame(changes, SOURCE_TX)
        write_increment(df, f"{root}/bronze", "ab"[i % 2], "transactions", T0 + timedelta(days=i), "updated_at")
        target = (f"{root}/bronze", spec, f"{root}/silver", f"{root}/cp", T0, f"{root}/rejects")
        stream_silver(spark, *target).awaitTermination()
    columns = ["transaction_id", "status", "updated_at", "amount_myr", "partner"]
    got = rows(spark.read.parquet(f"{root}/silver").select(*columns))
    bronze = read_bronze(spark, f"{root}/bronze", "transactions", spec.bronze_columns())
    assert got == rows(build_silver(bronze.where("transaction_id IS NOT NULL"), spec, T0).select(*columns))
    assert [r[:2] for r in got] == [("t1", "SUCCESS"), ("t2", "SUCCESS")]
    assert [r.reject_reason for r in spark.read.parquet(f"{root}/rejects").collect()] == ["null key: transaction_id"]
    strict = stream_silver(spark, f"{root}/bronze", spec, f"{root}/strict", f"{root}/cp2", T0)
    with pytest.raises(Exception, match="null key in column transaction_id"):
        strict.awaitTermination()


def test_missing_bronze_is_reported_not_counted_as_zero(spark, root):
    partial = {"a": {k: v for k, v in partner(spark, FIRST).items() if k != "cards"}}
    with pytest.raises(CircuitOpen, match="cards: unreadable"):
        run_day(spark, partial, Run(root, T0, silver="q_", gold="q_"))
    ledger = {r.table_name: r for r in spark.read.parquet(f"{root}/ledger").collect()}
    assert ledger["cards"].target_count is None and "PATH_NOT_FOUND" in ledger["cards"].error
    assert ledger["users"].target_count == 1


def test_images_are_made_in_compiled_code(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 2), ("b", 1), ("c", 3)], "k string, v int")
    images = change_images(old, new, ["k"], ["v"])
    assert rows(images) == [("after", "a", 2), ("after", "c", 3), ("before", "a", 1)]
    assert "lambdafunction" not in plan(images)


def test_released_batches_are_read_with_the_others(spark, root):
    given = [("t1", "held"), (None, "held"), ("t2", "clean"), (None, "clean"), ("t3", None), (None, None)]
    spec = load_tables()["transactions"]
    bronze = spark.createDataFrame(given, "transaction_id string, batch_id string")
    others = [c for c in spec.bronze_columns() if c not in bronze.columns]
    bronze.select("*", *[F.lit(None).cast("string").alias(c) for c in others]).write.parquet(f"{root}/b")
    stored = spark.read.parquet(f"{root}/b")
    batch = Batch("a", "transactions", "held", datetime(2024, 1, 31).date(), 2, RELEASED, None, True, None)
    good, rejected = _typed(spark, Run(root, datetime(2024, 1, 31)), spec, stored, [batch])
    # rows without a key stay where nobody released them: they fail the job later
    assert rows(good.select("transaction_id")) == [("t1",), ("t2",), ("t3",), (None,), (None,)]
    assert rows(rejected.select("transaction_id", "reject_reason")) == [(None, "null key: transaction_id")]
    assert plan(good, "simple").count("FileScan") == 1
