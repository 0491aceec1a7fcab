"""Merchant days from a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from pursewatch.functions.timing import as_utc_instant, day_of, from_utc_instant
from pursewatch.sources.managed import path_or_none


def stream_daily_parts(tx: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write each micro-batch's sums per merchant and day into a folder of its own.

    Sums merge when read, so no row is ever too late and no state is held; a batch that is
    repeated after a failure replaces its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        parts = batch.groupBy("merchant_id", day_of(F.col("transaction_time")).alias("date")).agg(
            F.sum("amount_myr").cast("decimal(38,2)").alias("volume"),
            F.sum("risk_score").alias("risk"),
            F.count("risk_score").alias("risk_rows"),
        )
        parts.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = tx.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


_PARTS = "merchant_id bigint, date timestamp_ntz, volume decimal(38,2), risk double, risk_rows bigint"


def _sums(parts: DataFrame) -> DataFrame:
    return parts.groupBy("merchant_id", "date").agg(
        F.sum("volume").alias("volume"),
        F.sum("risk").alias("risk"),
        F.sum("risk_rows").alias("risk_rows"),
    )


def _finished(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """The sums of the newest fold and of the batches after it, and the last of these batches."""
    batches = spark.read.schema(f"{_PARTS}, batch_id bigint").parquet(path)
    folded = path_or_none(spark, f"{path.rstrip('/')}_folded", T.StructType.fromDDL(f"{_PARTS}, upto bigint"))
    upto = folded.agg(F.max("upto")).first()[0] if folded is not None else None
    if upto is not None:
        rest = batches.where(F.col("batch_id") > upto).drop("batch_id")
        parts = folded.where(F.col("upto") == upto).drop("upto").unionByName(rest)
    else:
        parts = batches.drop("batch_id")
    return parts, batches.agg(F.max("batch_id")).first()[0]


def fold_daily_parts(spark: SparkSession, path: str) -> None:
    """Add up all finished batches into one folder, which later reads begin with.

    Run it while no batch is being written. A fold that fails is not seen, one that is repeated
    replaces itself; the folders that it stands for are no longer read and may be deleted.
    """
    parts, last = _finished(spark, path)
    if last is not None:
        where = f"{path.rstrip('/')}_folded/upto={last}"
        # all days of a merchant are few rows; the sums have one type whatever they are sums of
        sums = _sums(parts).withColumn("volume", F.col("volume").cast("decimal(38,2)"))
        sums.write.mode("overwrite").parquet(where)


def read_daily_summary(spark: SparkSession, path: str) -> DataFrame:
    """The summary as of the last finished batch."""
    return _sums(_finished(spark, path)[0]).select(
        "merchant_id",
        "date",
        F.col("volume").alias("total_volume"),
        F.try_divide("risk", "risk_rows").alias("avg_risk_score"),
    )


def closed_days(tx: DataFrame, lateness: str) -> DataFrame:
    """Streaming aggregate that emits a merchant day once, after ``lateness`` has passed.

    For consumers that want each day once. Rows later than ``lateness`` are not in it, as
    with any event-time watermark; the parts above do include them, and ``unsettled.late_rows``
    counts them in a query's progress. Event time must carry a zone, so it passes through UTC and
    days begin at midnight in any session zone.
    """
    return (
        tx.withColumn("event_time", as_utc_instant(F.col("transaction_time")))
        .withWatermark("event_time", lateness)
        .groupBy("merchant_id", F.window("event_time", "1 day").alias("day"))
        .agg(
            F.sum("amount_myr").alias("total_volume"),
            F.avg("risk_score").alias("avg_risk_score"),
        )
        .select(
            "merchant_id",
            from_utc_instant(F.col("day.start")).alias("date"),
            "total_volume",
            "avg_risk_score",
        )
    )
