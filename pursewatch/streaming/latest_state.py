"""Change feed to current state."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pursewatch.operators.dedup import latest_per_key
from pursewatch.operators.projection import require_keys, split_rejects
from pursewatch.plans.silver import VERSION, typed_rows
from pursewatch.sources.bronze import stream_bronze
from pursewatch.sources.managed import upsert_partitions
from pursewatch.sources.tables import TableSpec


def stream_latest_state(
    changes: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    ties: Sequence[str],
    partition: str,
    rejects: str | None = None,
) -> StreamingQuery:
    """Keep one row per key under ``path``, newest by ``order_by`` and then ``ties``.

    Takes what is available and stops; the next run goes on from the checkpoint. Within a
    micro-batch the newest row per key is taken, across batches a stored newer row stays, so
    late rows and repeated batches leave the same table. Only folders with changes are
    rewritten, and no state is kept between batches beyond the table itself. A row without a
    key fails the query, or goes to the folder ``rejects`` where one is given.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        if rejects is None:
            keyed = require_keys(batch, keys)
        else:
            keyed, lacking = split_rejects(batch, keys)
            lacking.write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")
        latest = latest_per_key(keyed, keys, order_by, ties).persist()
        try:
            upsert_partitions(
                batch.sparkSession,
                path,
                latest,
                keys,
                partition,
                newer_by=[*order_by, *ties],
                schema=latest.schema,
            )
        finally:
            latest.unpersist()

    writer = changes.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def stream_silver(
    spark: SparkSession,
    bronze_root: str,
    spec: TableSpec,
    path: str,
    checkpoint: str,
    run_ts: datetime | str,
    rejects: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Bronze files that are new since the last run, typed and merged into day folders.

    The version column stays in the table, as later runs compare against it.
    """
    bronze = stream_bronze(spark, bronze_root, spec.table, spec.bronze_columns(), **options)
    rows = typed_rows(bronze, spec, run_ts).withColumn("event_date", F.to_date(spec.event_time))
    ties = [c for c in rows.columns if c not in (*spec.keys, VERSION, "event_date", "ingest_ts")]
    return stream_latest_state(
        rows, path, checkpoint, spec.keys, [VERSION], ties, "event_date", rejects=rejects
    )
