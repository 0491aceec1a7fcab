"""What became of every increment: which may be merged, which are held back and why.

An increment is *extracted* when its rows are in bronze. A check finds it *clean* or *stopped*; a
stopped one stays out of silver and gold until somebody has it *released* or *rejected*. Merging
passes through *imaged* (its changes are stored as a feed) to *merged*.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from pursewatch.model import BATCH_SCHEMA, BATCH_STATE_SCHEMA
from pursewatch.sources.managed import append_rows, path_or_none

EXTRACTED, CLEAN, STOPPED, RELEASED, REJECTED, IMAGED, MERGED = (
    "extracted", "clean", "stopped", "released", "rejected", "imaged", "merged",
)
#: A batch is in the state furthest on of those noted for it, so a note may be repeated.
ORDER = (EXTRACTED, CLEAN, STOPPED, RELEASED, REJECTED, IMAGED, MERGED)
#: May be merged; were or are being merged; must not be read by silver.
READY, TAKEN, HELD = (CLEAN, RELEASED), (IMAGED, MERGED), (EXTRACTED, STOPPED, REJECTED)


@dataclass(frozen=True)
class Batch:
    partner: str
    table: str
    batch_id: str
    ingest_date: date
    rows: int
    state: str
    rule: str | None
    released: bool
    feed: int | None


def note_extracted(spark: SparkSession, root: str, batches: Iterable[tuple]) -> None:
    """Note increments as (partner, table, batch id, day, rows)."""
    rows = list(batches)
    if rows:
        append_rows(spark.createDataFrame(rows, BATCH_SCHEMA).coalesce(1), f"{root}/batches")


def note_states(spark: SparkSession, root: str, folder: str, notes: Iterable[tuple], at: datetime) -> None:
    """Note (batch id, state, rule, feed) rows. Jobs that run side by side note in folders of their
    own, such as one per table."""
    rows = [(*n, at) for n in notes]
    if rows:
        noted = spark.createDataFrame(rows, BATCH_STATE_SCHEMA)
        append_rows(noted.coalesce(1), f"{root}/batch_states/of={folder}")


def batch_states(spark: SparkSession, root: str) -> DataFrame | None:
    """Every batch with its state, the rules that stopped it, whether it was ever released, and the
    feed that holds its changes. None before the first batch."""
    batches = path_or_none(spark, f"{root}/batches", BATCH_SCHEMA)
    if batches is None:
        return None
    noted = path_or_none(spark, f"{root}/batch_states", BATCH_STATE_SCHEMA)
    if noted is None:
        noted = spark.createDataFrame([], BATCH_STATE_SCHEMA)
    rank = F.array_position(F.array(*map(F.lit, ORDER)), F.col("state"))
    last = noted.groupBy("batch_id").agg(
        F.max_by("state", rank).alias("state"),
        F.max("rule").alias("rule"),
        F.max(F.col("state") == RELEASED).alias("released"),
        F.max("feed").alias("feed"),
    )
    return batches.join(last, "batch_id", "left").select(
        "partner",
        "table_name",
        "batch_id",
        "ingest_date",
        "row_count",
        F.coalesce("state", F.lit(EXTRACTED)).alias("state"),
        "rule",
        F.coalesce("released", F.lit(False)).alias("released"),
        "feed",
    )


def batches_in(spark: SparkSession, root: str, *states: str) -> list[Batch]:
    """The batches in some states; those are a few per run, unless merged ones are asked for."""
    every = batch_states(spark, root)
    found = [] if every is None else [Batch(*r) for r in every.where(F.col("state").isin(*states)).collect()]
    return sorted(found, key=lambda b: (b.table, b.ingest_date, b.batch_id))


def without_held(spark: SparkSession, root: str, bronze: DataFrame) -> DataFrame:
    """Bronze rows but those of batches that silver must not read. Rows that no batch names stay:
    they are of a run that died, and come again as a batch of their own."""
    every = batch_states(spark, root)
    if every is None or "batch_id" not in bronze.columns:
        return bronze
    held = every.where(F.col("state").isin(*HELD)).select("batch_id")
    return bronze.join(held, "batch_id", "left_anti")


def _decide(spark: SparkSession, root: str, ids: Sequence[str], state: str, at: datetime) -> None:
    known = {b.batch_id: b for b in batches_in(spark, root, *ORDER)}
    for i in ids:
        if i not in known:
            raise ValueError(f"no such batch: {i}")
        if known[i].state not in (STOPPED, state):
            raise ValueError(f"batch {i} is {known[i].state}, not {STOPPED}")
    note_states(spark, root, "decisions", [(i, state, None, None) for i in ids], at)


def release_batches(spark: SparkSession, root: str, ids: Sequence[str], at: datetime) -> None:
    """Let stopped batches pass as they are; their rows without a key are set aside."""
    _decide(spark, root, ids, RELEASED, at)


def reject_batches(spark: SparkSession, root: str, ids: Sequence[str], at: datetime) -> None:
    """Keep stopped batches out for good; bronze still holds their rows."""
    _decide(spark, root, ids, REJECTED, at)
