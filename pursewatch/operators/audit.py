"""Counts per layer, the ledger built from them, and the rules that stop a run.

Counting is one grouped aggregate over the union of all layers and tables involved, so each
layer is scanned once and a task sends on one row per group.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pursewatch.functions.predicates import has_keys, missing_key
from pursewatch.model import LEDGER_SCHEMA, STAGE_BRONZE, STAGE_SILVER

METRICS = [f.name for f in LEDGER_SCHEMA if f.name.endswith("_count")]


@dataclass(frozen=True)
class Layer:
    """One table's rows at one layer. ``df`` is None where the layer could not be opened.

    ``keys`` are counted where NULL. With ``distinct`` the distinct non-null values of those
    columns are counted as well, in the same scan.
    """

    table: str
    layer: str
    df: DataFrame | None
    keys: tuple[str, ...]
    error: str | None = None
    distinct: tuple[str, ...] = ()
    #: Rows that were counted elsewhere, such as by the source itself; they are added.
    counted: int | None = None


def _asked(layers: Sequence[Layer]) -> DataFrame:
    """A row per table and layer asked for, so that an empty layer counts as 0."""
    entries = [
        F.struct(
            F.lit(x.table).alias("table_name"),
            F.lit(x.layer).alias("layer"),
            F.lit(x.counted if x.df is None else x.counted or 0).cast("bigint").alias("rows"),
            F.lit(0).cast("bigint").alias("null_pk"),
        )
        for x in layers
    ]
    return SparkSession.active().range(0, 1, 1, 1).select(F.inline(F.array(*entries)))


def _scanned(x: Layer, composite: bool) -> DataFrame:
    columns = [
        F.lit(x.table).alias("table_name"),
        F.lit(x.layer).alias("layer"),
        F.lit(1).cast("bigint").alias("rows"),
        F.when(missing_key(*x.keys), 1).otherwise(0).cast("bigint").alias("null_pk"),
    ]
    if not x.distinct:
        return x.df.select(*columns)
    parts = [F.col(k).cast("string") for k in x.distinct]
    key = F.when(has_keys(*x.distinct), F.array(*parts) if composite else parts[0])
    return x.df.select(*columns, key.alias("key"))


def layer_counts(layers: Sequence[Layer]) -> DataFrame:
    """table_name, layer, rows, null_pk_count, distinct_keys, error.

    ``rows`` is NULL for an unreadable layer. A table may have several frames in one layer; a key
    that is in more than one of them counts once. Only a layer with ``distinct`` shuffles more
    than a row per task: its distinct keys, each with its number of rows.
    """
    composite = any(len(x.distinct) > 1 for x in layers)
    frames = [_scanned(x, composite) for x in layers if x.df is not None]
    together = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [_asked(layers), *frames]
    )
    if "key" not in together.columns:
        together = together.withColumn("key", F.lit(None).cast("string"))
    by_key = together.groupBy("table_name", "layer", "key").agg(
        F.sum("rows").alias("rows"), F.sum("null_pk").alias("null_pk")
    )
    counts = by_key.groupBy("table_name", "layer").agg(
        F.sum("rows").alias("rows"),
        F.sum("null_pk").alias("null_pk_count"),
        F.count("key").alias("distinct_keys"),
    )
    return counts.withColumn("error", _errors(layers))


def _errors(layers: Sequence[Layer]) -> Column:
    """What each table and layer could not be opened for. Texts among the sums would have every
    task sort its rows."""
    error = F.lit(None).cast("string")
    for x in sorted((x for x in layers if x.error is not None), key=lambda x: x.error):
        here = (F.col("table_name") == x.table) & (F.col("layer") == x.layer)
        error = F.when(here, F.lit(x.error)).otherwise(error)
    return error


def _at(layer: str, value: str) -> Column:
    return F.max(F.when(F.col("layer") == layer, F.col(value)))


def source_to_bronze(layers: Sequence[Layer], run_ts: datetime | str) -> DataFrame:
    """Ledger rows with source_count, target_count and null_pk_count, plus the read error."""
    rows = (
        layer_counts(layers)
        .groupBy("table_name")
        .agg(
            _at("source", "rows").alias("source_count"),
            _at("bronze", "rows").alias("target_count"),
            _at("bronze", "null_pk_count").alias("null_pk_count"),
            F.max("error").alias("error"),
        )
    )
    return _ledger_rows(rows, STAGE_BRONZE, run_ts)


def bronze_to_silver(layers: Sequence[Layer], run_ts: datetime | str) -> DataFrame:
    """Ledger rows with bronze_raw_count, silver_deduped_count and null_pk_count.

    Where the bronze layers ask for distinct keys, ``expected_silver`` holds their number.
    """
    columns = [
        _at("bronze", "rows").alias("bronze_raw_count"),
        _at("silver", "rows").alias("silver_deduped_count"),
        _at("bronze", "null_pk_count").alias("null_pk_count"),
        F.max("error").alias("error"),
    ]
    extra = []
    if any(x.distinct for x in layers):
        extra = ["expected_silver"]
        columns.append(_at("bronze", "distinct_keys").alias(*extra))
    rows = layer_counts(layers).groupBy("table_name").agg(*columns)
    return _ledger_rows(rows, STAGE_SILVER, run_ts, *extra)


def _ledger_rows(
    rows: DataFrame, stage: str, run_ts: datetime | str, *extra: str
) -> DataFrame:
    given = {
        "execution_time": F.lit(str(run_ts)).cast("timestamp"),
        "pipeline_stage": F.lit(stage),
    }
    columns = []
    for f in LEDGER_SCHEMA:
        value = given.get(f.name, F.col(f.name) if f.name in rows.columns else F.lit(None))
        columns.append(value.cast(f.dataType).alias(f.name))
    return rows.select(*columns, "error", *extra)


def breaches(audit: DataFrame) -> DataFrame:
    """One row per ledger row and rule: rule, breached, detail.

    Rules: no null key; every layer readable; the rows extracted were written; silver holds
    one row per distinct non-null key (where the audit carries ``expected_silver``). A
    ``batch_id`` of the audit is told as well. Where the
    audit carries them: no partner failed (``failed_partners``), no present value was lost to
    its cast (``type_mismatches``), no source row lacked its change time (``unversioned_rows``).
    """
    parity = F.col("source_count") != F.col("target_count")
    rules = [
        ("null_key", F.col("null_pk_count") > 0, F.col("null_pk_count")),
        ("row_parity", parity, F.col("target_count") - F.col("source_count")),
    ]
    if "expected_silver" in audit.columns:
        gap = F.col("silver_deduped_count") - F.col("expected_silver")
        rules.append(("silver_parity", gap != 0, gap))
    if "error" in audit.columns:
        rules.append(("unreadable", F.col("error").isNotNull(), F.lit(None)))
    counted = (
        ("partner_failed", "failed_partners"),
        ("type_mismatch", "type_mismatches"),
        ("unversioned", "unversioned_rows"),
    )
    for rule, column in counted:
        if column in audit.columns:
            rules.append((rule, F.col(column) > 0, F.col(column)))
    told = ["pipeline_stage", "table_name", *[c for c in ("batch_id",) if c in audit.columns]]
    entries = [
        F.struct(
            F.lit(name).alias("rule"),
            F.coalesce(cond, F.lit(False)).alias("breached"),
            F.coalesce(detail.cast("bigint"), F.lit(0)).cast("bigint").alias("detail"),
        )
        for name, cond, detail in rules
    ]
    return audit.select(*told, F.explode(F.array(*entries)).alias("r")).select(
        *told, "r.rule", "r.breached", "r.detail"
    )


def batch_audit(
    bronze: DataFrame, batches: DataFrame, keys: Sequence[str], casts: Mapping[str, Column], stage: str = STAGE_BRONZE
) -> DataFrame:
    """Per batch of one table what the rules ask: rows noted and found, rows without a key, and
    present values that their casts lose.

    ``batches`` has table_name, batch_id and row_count; one without rows in bronze counts as 0. A
    task sends one row per batch.
    """
    lost = [F.when(F.col(c).isNotNull() & cast.isNull(), 1).otherwise(0) for c, cast in casts.items()]
    wrong = reduce(lambda a, b: a + b, lost) if lost else F.lit(0)
    found = bronze.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("target_count"),
        F.count(F.when(missing_key(*keys), 1)).alias("null_pk_count"),
        F.sum(wrong).cast("bigint").alias("type_mismatches"),
    )
    none = F.lit(0).cast("bigint")
    return batches.join(found, "batch_id", "left").select(
        F.lit(stage).alias("pipeline_stage"),
        "table_name",
        "batch_id",
        F.col("row_count").alias("source_count"),
        *[F.coalesce(c, none).alias(c) for c in ("target_count", "null_pk_count", "type_mismatches")],
    )


class CircuitOpen(RuntimeError):
    """Data quality stopped the run."""

    @classmethod
    def of(cls, found: Iterable[str]) -> CircuitOpen:
        return cls(f"stopped by audit rules: {', '.join(found)}")


def enforce(audit: DataFrame) -> None:
    """Raise when a rule is breached; at most a row per table and rule reaches the driver."""
    broken = breaches(audit).where("breached").collect()
    if broken:
        raise CircuitOpen.of(f"{r.table_name}: {r.rule} ({r.detail})" for r in broken)


def reconcile(layers: Sequence[Layer]) -> DataFrame:
    """One row per table with the counts of all four layers and whether neighbours agree.

    Silver is expected to hold one row per distinct non-null bronze key, gold one per silver
    key; a table without a gold product has NULL there.
    """
    keyed = [replace(x, distinct=x.distinct or x.keys) if x.layer == "bronze" else x for x in layers]
    wide = (
        layer_counts(keyed)
        .groupBy("table_name")
        .agg(
            *[_at(x, "rows").alias(f"{x}_count") for x in ("source", "bronze")],
            _at("bronze", "distinct_keys").alias("bronze_keys_count"),
            *[_at(x, "rows").alias(f"{x}_count") for x in ("silver", "gold")],
        )
    )
    return wide.withColumns(
        {
            "bronze_parity": F.col("source_count") == F.col("bronze_count"),
            "silver_parity": F.col("bronze_keys_count") == F.col("silver_count"),
            "gold_parity": F.col("silver_count") == F.col("gold_count"),
        }
    )


def ledger_trend(ledger: DataFrame) -> DataFrame:
    """Every ledger row beside the change of its counts since the run before."""
    # rows of one time, such as a run and its repetition, go by their counts
    before = Window.partitionBy("pipeline_stage", "table_name").orderBy("execution_time", *METRICS)
    deltas = {f"{m}_change": F.col(m) - F.lag(m).over(before) for m in METRICS}
    share = F.col("null_pk_count") / F.coalesce(
        F.col("bronze_raw_count"), F.col("target_count")
    ).cast("double")
    return ledger.withColumns({**deltas, "null_pk_share": share})
