"""Agreement of layers, seasons, levels, sketches and layouts."""

import math
import random
import statistics
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import rows, ts
from pursewatch.functions import layout
from pursewatch.operators import lifecycle, parity
from pursewatch.operators.quality import seasonal_volume
from pursewatch.operators.trend import change_points
from pursewatch.streaming.unsettled import late_rows, unsettled_stream

# ---- content of two layers

TWO = "k string, p int, v string, d double"


def differing(a, b):
    groups = defaultdict(lambda: (Counter(), Counter()))
    for side, data in enumerate((a, b)):
        for r in data:
            groups[r[:2]][side][r] += 1
    found = []
    for key, (x, y) in groups.items():
        if x != y:
            kind = "missing" if not y else "added" if not x else "changed"
            found.append((*key, sum(x.values()), sum(y.values()), kind))
    return sorted(found, key=str)


def compare(spark, a, b, depth=parity.DEPTH):
    frames = [spark.createDataFrame(x, TWO).repartition(3) for x in (a, b)]
    return sorted(map(tuple, parity.differing_keys(*frames, ["k", "p"], ["v", "d"], depth).collect()), key=str)


@pytest.mark.parametrize("depth", [0, 1, 3])
def test_differing_keys_match_brute_force(spark, depth):
    r = random.Random(depth)
    a = [(f"k{i % 90}" if i % 17 else None, i % 3 or None, r.choice(["x", "y", None, ""]), r.choice([1.0, None])) for i in range(300)]
    b = list(a)
    r.shuffle(b)
    assert compare(spark, a, b, depth) == []
    for i in r.sample(range(len(b)), 12):
        b[i] = (*b[i][:2], r.choice(["z", None, ""]), b[i][3])
    b += [b[0], ("new", 1, "x", 1.0)]
    b.remove(a[5])
    assert compare(spark, a, b, depth) == differing(a, b) != []


def test_one_changed_value_is_found_in_one_bucket(spark):
    left = spark.range(20_000).selectExpr("cast(id as string) as k", "id % 7 as v")
    right = left.withColumn("v", F.when(F.col("k") == "777", 9).otherwise(F.col("v")))
    trees = [parity.tree_of(parity.bucket_sums(x, ["k"], ["v"])).persist() for x in (left, right)]
    assert len(parity.differing_buckets(*trees)) == 1
    assert trees[0].where("level = 0").first().n == 20_000
    assert rows(parity.differing_keys(left, right, ["k"], ["v"])) == [("777", 1, 1, "changed")]
    empty = left.limit(0)
    assert rows(parity.differing_keys(empty, empty, ["k"], ["v"])) == []
    assert parity.differing_keys(left, empty, ["k"], ["v"]).where("difference = 'missing'").count() == 20_000


def test_sums_of_parts_add_up(spark):
    df = spark.range(5_000).selectExpr("id as k", "id * 3 as v")
    both = parity.bucket_sums(df.where("k < 99"), ["k"], ["v"]).unionByName(parity.bucket_sums(df.where("k >= 99"), ["k"], ["v"]))
    added = both.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in "nab"])
    assert rows(added) == rows(parity.bucket_sums(df, ["k"], ["v"]))


# ---- volume by weekday


def weeks(spark, counts, start=date(2024, 1, 1)):
    at = [(p, datetime.combine(start + timedelta(days=d), datetime.min.time())) for (p, d), n in counts.items() for _ in range(n)]
    return spark.createDataFrame(at, "partner string, transaction_time timestamp_ntz")


def test_a_weekly_pattern_is_no_alarm_and_a_planted_level_is(spark):
    r = random.Random(3)
    counts = {("a", d): (10 if d % 7 in (5, 6) else 60) + r.randrange(-3, 4) for d in range(70)}
    counts["a", 30] = 400  # an odd day long ago moves no median
    counts["a", 65] = 10  # a Wednesday as quiet as a Sunday
    counts["a", 68] = 60  # a Sunday as busy as a Wednesday
    counts["a", 66] = 0
    counts.update({("new", d): 5 for d in range(64, 70)})
    last = date(2024, 1, 1) + timedelta(days=69)
    found = {(x.partner, x.day): x for x in seasonal_volume(weeks(spark, counts), last, 10, partners=["a", "silent"]).collect()}
    odd = {(k[0], (k[1] - date(2024, 1, 1)).days): x.anomaly for k, x in found.items() if x.anomaly != "none"}
    assert {k: v for k, v in odd.items() if k[0] == "a"} == {("a", 65): "low", ("a", 66): "no_data", ("a", 68): "high"}
    assert {v for k, v in odd.items() if k[0] == "new"} == {"unknown"}
    assert len([k for k in found if k[0] == "silent"]) == 10
    sunday = found["a", date(2024, 1, 1) + timedelta(days=69)]
    before = [counts["a", 69 - 7 * k] for k in range(1, 9)]
    assert sunday.baseline == statistics.median(before)


# ---- levels

LEDGER = "execution_time timestamp, pipeline_stage string, table_name string, source_count bigint"


def brute_changes(values, baseline=10, slack=0.5, alarm=5.0):
    level = statistics.median(values[:baseline])
    spread = max(1.4826 * statistics.median([abs(v - level) for v in values[:baseline]]), math.sqrt(level), 1.0)
    up = down = 0.0
    up_since = down_since = 0
    found = []
    for i in range(baseline, len(values)):
        z = min(max((values[i] - level) / spread, -alarm / 2), alarm / 2)
        up_since, down_since = up_since if up > 0 else i, down_since if down > 0 else i
        up, down = max(up + z - slack, 0.0), max(down - z - slack, 0.0)
        if max(up, down) > alarm:
            since = up_since if up >= down else down_since
            after = statistics.median(values[since : since + baseline])
            found.append((since, i, "up" if up >= down else "down", level, after))
            level, up, down = after, 0.0, 0.0
    return found


def test_levels_match_brute_force(spark):
    r = random.Random(9)
    series = {"steady": [100 + r.randrange(-5, 6) for _ in range(60)]}
    series["odd run"] = [*series["steady"][:30], 5000, *series["steady"][31:]]
    series["step"] = [*series["steady"][:30], *[v + 12 for v in series["steady"][30:]]]
    series["up and down"] = [100 + (40 if 20 <= k < 40 else 0) + r.randrange(-3, 4) for k in range(60)]
    series["drift"] = [100 + max(0, k - 25) // 2 + r.randrange(-2, 3) for k in range(60)]
    series["constant"] = [7] * 25 + [9] * 25
    series["short"] = [1, 500, 1]
    series["walk"] = [r.randrange(0, 60) for _ in range(80)]
    start = datetime(2024, 1, 1)
    data = [(start + timedelta(hours=k), "s", n, v) for n, values in series.items() for k, v in enumerate(values)]
    r.shuffle(data)
    data += [(start, "s", "nothing", None), (start + timedelta(hours=99), "s", "step", None)]
    found = defaultdict(list)
    for x in change_points(spark.createDataFrame(data, LEDGER).repartition(4), "source_count").collect():
        told = [int((x[c] - start).total_seconds() // 3600) for c in ("changed_at", "noticed_at")]
        found[x.table_name].append((*told, x.direction, x.before, x.after))
    assert {n: sorted(f) for n, f in found.items()} == {n: b for n, v in series.items() if len(v) > 10 and (b := brute_changes(v))}
    assert "steady" not in found and "odd run" not in found
    (step,) = found["step"]
    assert step[0] in (30, 31) and step[2] == "up"
    assert [x[2] for x in found["up and down"]] == ["up", "down"]


# ---- latency from sketches


def test_sketches_of_days_answer_for_any_period(spark):
    r = random.Random(2)
    start = ts("2024-01-01")
    data = []
    for i in range(6_000):
        at = start + timedelta(minutes=i * 3)
        data.append(("ab"[i % 2], at, at + timedelta(seconds=int(r.expovariate(1 / 300)))))
    data.append(("a", start, None))
    df = spark.createDataFrame(data, "partner string, transaction_time timestamp_ntz, updated_at timestamp_ntz")
    days = lifecycle.latency_sketches(df.repartition(5)).persist()
    for first, last in ((date(2024, 1, 2), date(2024, 1, 2)), (date(2024, 1, 1), date(2024, 1, 13)), (date(2025, 1, 1), date(2025, 2, 1))):
        found = {x.partner: x for x in lifecycle.latency_of_period(days, first, last).collect()}
        for p in "ab":
            own = sorted(int((b - a).total_seconds()) for q, a, b in data if q == p and b and first <= a.date() <= last)
            if not own:
                assert p not in found
                continue
            x = found[p]
            assert (x.measured, x.min_latency, x.max_latency) == (len(own), own[0], own[-1])
            for share, got in ((0.5, x.p50_latency), (0.95, x.p95_latency), (0.99, x.p99_latency)):
                below, upto = (sum(v < got for v in own) / len(own), sum(v <= got for v in own) / len(own))
                assert below - 0.01 <= share <= upto + 0.01


# ---- clustered files


def test_interleaved_bits(spark):
    df = spark.createDataFrame([(5, 3), (0, 0), (7, 7), (4, 0), (0, 4)], "a int, b int")
    got = [r[0] for r in df.select(layout.interleaved([F.col("a"), F.col("b")], 3)).collect()]
    assert got == [0b100111, 0, 0b111111, 0b100000, 0b010000]


def test_clustered_files_prune_by_both_columns(spark, root):
    df = spark.range(40_000).selectExpr(
        "case when id % 3 = 0 then 7 else cast(rand(4) * 1000 as bigint) end as u",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(rand(5) * 40000 as int)) as t", "id")
    df = df.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS u, CAST(NULL AS TIMESTAMP_NTZ) AS t, -1L AS id"))
    df = df.withColumn("day", F.to_date("t")).persist()
    layout.write_clustered(df, f"{root}/z", ["u", "t"], 32)
    back = spark.read.parquet(f"{root}/z")
    assert rows(back.agg(F.count("id"), F.sum("id"))) == rows(df.agg(F.count("id"), F.sum("id")))

    def read_rows(condition):
        found = back.where(condition)
        found.collect()
        stack = [found._jdf.queryExecution().executedPlan()]
        while stack:
            node = stack.pop()
            if node.nodeName().startswith("Scan parquet"):
                return node.metrics().apply("numOutputRows").value()
            stack += [node.children().apply(i) for i in range(node.children().size())]
            if node.nodeName() == "AdaptiveSparkPlan":
                stack.append(node.executedPlan())

    assert read_rows("u = 500") < 40_000 / 3
    assert read_rows("day = date'2024-01-11'") < 40_000 / 3
    # a value that holds a third of the rows is spread over files by the other column
    sizes = [r[1] for r in back.where("u = 7").groupBy(F.col("_metadata.file_path")).count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 40_000 / 8


# ---- pending for too long

CHANGES = "transaction_id string, status string, updated_at timestamp_ntz"


def change_rows(seed=1, n=400):
    r = random.Random(seed)
    start = ts("2024-01-01")
    return [(f"t{r.randrange(60)}", r.choice(["PENDING", "APPROVED", "SUCCESS", "FAILED"]), start + timedelta(minutes=30 * i + r.randrange(40)))
            for i in range(n)]


def test_unsettled_stream_equals_batch(spark, root):
    data = change_rows()
    data += [d for d in data if d[1] == "PENDING"][:20]  # repeated rows are told once
    first, last = data[: len(data) // 2], data[len(data) // 2 :]
    for part in (first, [*last, ("late", "PENDING", ts("2023-12-01"))]):
        spark.createDataFrame(part, CHANGES).coalesce(1).write.mode("append").parquet(f"{root}/feed")
        feed = spark.readStream.schema(CHANGES).parquet(f"{root}/feed")
        found = unsettled_stream(feed, "9 hours", "2 hours")
        query = found.writeStream.outputMode("append").option("checkpointLocation", f"{root}/cp")
        query = query.trigger(availableNow=True).format("parquet").start(f"{root}/out")
        query.awaitTermination()
    newest = max(d[2] for d in data)
    limit = newest - timedelta(hours=2)
    want = sorted({
        (i, t) for i, s, t in data
        if s == "PENDING" and t + timedelta(hours=9) < limit
        and not any(j == i and x in ("SUCCESS", "FAILED") and t <= u <= t + timedelta(hours=9) for j, x, u in data)
    })
    out = rows(spark.read.parquet(f"{root}/out"))
    assert out == want and len(want) > 20
    batch = lifecycle.unsettled(spark.createDataFrame(data, CHANGES), "9 hours", F.lit(limit).cast("timestamp_ntz"))
    assert rows(batch) == want
    # repeats of the first half that come again after the watermark, and the planted row
    assert late_rows(query) >= 1


def test_unsettled_without_any_settled_row(spark, root):
    data = [("a", "PENDING", ts("2024-01-01")), ("b", "APPROVED", ts("2024-01-05"))]
    spark.createDataFrame(data, CHANGES).write.parquet(f"{root}/feed")
    found = unsettled_stream(spark.readStream.schema(CHANGES).parquet(f"{root}/feed"), "1 hour", "1 hour")
    query = found.writeStream.outputMode("append").option("checkpointLocation", f"{root}/cp")
    query.trigger(availableNow=True).format("parquet").start(f"{root}/out").awaitTermination()
    assert rows(spark.read.schema(found.schema).parquet(f"{root}/out")) == [("a", ts("2024-01-01"))]
