"""One run over all layers: bronze, audit, silver, audit, gold."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.utils import AnalysisException

from pursewatch.functions.predicates import has_keys
from pursewatch.functions.timing import moment
from pursewatch.model import EPOCH, LEDGER_SCHEMA, WATERMARK_SCHEMA
from pursewatch.operators.audit import (
    CircuitOpen,
    Layer,
    batch_audit,
    breaches,
    bronze_to_silver,
    enforce,
    reconcile,
    source_to_bronze,
)
from pursewatch.operators.changes import change_images, image_schema
from pursewatch.operators.dedup import latest_per_key
from pursewatch.operators.incremental import changed_since, current_watermarks
from pursewatch.operators.projection import first_of_duplicates, require_keys, split_rejects
from pursewatch.operators.quality import freshness, volume_anomalies
from pursewatch.operators.upsert import upsert
from pursewatch.plans import batches as held
from pursewatch.plans.batches import Batch
from pursewatch.plans.gold import keyed_profile, user_risk_profile
from pursewatch.plans.profile_parts import maintained_profile
from pursewatch.plans.silver import VERSION, typed_rows
from pursewatch.sources.bronze import Written, read_bronze, write_increment
from pursewatch.sources.managed import (
    append_rows,
    apply_images,
    conform,
    create_namespace,
    name_view,
    path_or_none,
    publish,
    stored_rows,
)
from pursewatch.sources.tables import TableSpec, load_tables

LEDGER_WITH_ERROR = T.StructType([*LEDGER_SCHEMA.fields, T.StructField("error", T.StringType())])


@dataclass(frozen=True)
class Run:
    """Where a run keeps its data and how it behaves.

    ``run_ts`` is in whole seconds, like the ingest time it is written as. View names are
    ``<silver><table>`` and ``<gold>user_risk_profile``, for example with prefix ``silver.``.

    A run stops on a row without a key, a present value that its cast loses, a source row without
    a change time and a partner that fails; ``rejects`` sets rows without a key aside instead,
    ``lenient`` lets the others pass, and ``partial`` goes on without the failed partner. All of
    it is in the ledger either way. ``keep`` is the number of old snapshots that stay. With
    ``report`` a run that reaches gold also logs freshness, volume and the layers' agreement.

    A stop holds: the batches that caused it stay out of silver and gold, and later runs stop as
    well, until they are released or rejected (``batches.release_batches``, ``reject_batches``).
    With ``past_held`` a run goes on without them.
    """

    root: str
    run_ts: datetime
    tables: Mapping[str, TableSpec] = field(default_factory=load_tables)
    silver: str = "silver_"
    gold: str = "gold_"
    temporary: bool = True
    look_back: timedelta = timedelta(0)
    parallel: int = 2
    rejects: bool = False
    lenient: bool = False
    partial: bool = False
    keep: int = 3
    report: bool = False
    past_held: bool = False

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])


#: A source's rows, or how to read those that changed after a mark (None: all of them).
Source = DataFrame | Callable[[datetime | None], DataFrame]
Sources = Mapping[str, Mapping[str, Source]]


def ingest(spark: SparkSession, sources: Sources, run: Run) -> tuple[dict, dict[str, str]]:
    """Write each partner's increments; a partner that fails does not hold up the others.

    Every increment has an id of its own, which its rows carry. The rows are written first, then
    noted as a batch, then the mark rises: a run that dies in between reads them again, and rows
    that no batch names are never merged. Returns what was written per (partner, table), and the
    error of each failed partner.
    """
    history = path_or_none(spark, run.path("watermarks"), WATERMARK_SCHEMA)
    # one row per partner and table
    standing = [] if history is None else current_watermarks(history).collect()
    marks = {(r.partner, r.table_name): r.watermark for r in standing}
    written: dict[tuple[str, str], Written] = {}

    def one_partner(partner: str) -> None:
        for table, given in sources[partner].items():
            spec, name = run.tables[table], partner.lower()
            since = marks.get((name, table)) if spec.watermark else None
            df = first_of_duplicates(given(since) if callable(given) else given)
            if spec.watermark:
                df = changed_since(df, spec.watermark, since or EPOCH, run.look_back, untimed=True)
            batch = f"{run.run_ts:%Y%m%dT%H%M%S}-{uuid.uuid4().hex}"
            done = write_increment(
                df, run.path("bronze"), name, table, run.run_ts, spec.watermark, batch_id=batch
            )
            if spec.watermark and hasattr(given, "untimed"):
                done = replace(done, unversioned=given.untimed())
            written[name, table] = done

    with ThreadPoolExecutor(run.parallel) as pool:
        jobs = {p: pool.submit(one_partner, p) for p in sources}
    errors = {
        p.lower(): str(job.exception()).splitlines()[0]
        for p, job in jobs.items()
        if job.exception() is not None
    }
    day = run.run_ts.date()
    held.note_extracted(spark, run.path(), [(*at, w.batch_id, day, w.rows) for at, w in written.items() if w.rows])
    risen = [
        (*at, w.newest, run.run_ts)
        for at, w in written.items()
        if w.newest is not None and w.newest > marks.get(at, datetime.min)
    ]
    if risen:
        rows = spark.createDataFrame(risen, WATERMARK_SCHEMA)
        append_rows(rows.coalesce(1), run.path("watermarks"))
    return written, errors


def _bronze(spark: SparkSession, run: Run, spec: TableSpec, extracted: bool = False) -> DataFrame:
    """A table's bronze rows. Where it was extracted but has never had a row, there are none."""
    columns = spec.bronze_columns()
    try:
        return read_bronze(spark, run.path("bronze"), spec.table, columns)
    except AnalysisException as e:
        if not extracted or columns is None or e.getCondition() != "PATH_NOT_FOUND":
            raise
    fields = [T.StructField(c, T.StringType()) for c in [*columns, "partner", "table"]]
    return spark.createDataFrame([], T.StructType([*fields, T.StructField("ingest_date", T.DateType())]))


def _of_batches(bronze: DataFrame, batches: Sequence[tuple[str, date]]) -> DataFrame:
    """The rows of some increments; the day folders are pruned to."""
    ids, days = [b for b, _ in batches], sorted({d for _, d in batches})
    return bronze.where(F.col("ingest_date").isin(days) & F.col("batch_id").isin(ids))


def _layer(table: str, name: str, keys: tuple[str, ...], read: Callable[[], DataFrame]) -> Layer:
    """A layer to count; one that cannot be opened is counted as unknown, with the reason."""
    try:
        return Layer(table, name, read(), keys)
    except AnalysisException as e:
        return Layer(table, name, None, keys, str(e).splitlines()[0])


def _log(audit: DataFrame, run: Run) -> None:
    append_rows(conform(audit, LEDGER_WITH_ERROR), run.path("ledger"))


def check_batches(spark: SparkSession, run: Run) -> None:
    """Find every batch that nobody has looked at yet clean or stopped, by the rules for its rows.

    All new batches are one job, which reads them alone; a row per broken rule reaches the driver.
    """
    new = held.batches_in(spark, run.path(), held.EXTRACTED)
    asked = []
    for table, spec in run.tables.items():
        own = [b for b in new if b.table == table]
        if not own:
            continue
        known = spark.createDataFrame(
            [(table, b.batch_id, b.rows) for b in own], "table_name string, batch_id string, row_count long"
        )
        casts = {r.source: r.build(F.lit(None)) for r in spec.rules if r.source and r.kind != "string"}
        rows = _of_batches(_bronze(spark, run, spec, True), [(b.batch_id, b.ingest_date) for b in own])
        asked.append(batch_audit(rows, known, _raw_keys(spec), {} if run.lenient else casts))
    if not asked:
        return
    checked = reduce(DataFrame.unionByName, asked)
    if run.rejects:
        checked = checked.withColumn("null_pk_count", F.lit(0))
    broken: dict[str, list[str]] = {}
    for r in breaches(checked).where("breached").collect():
        broken.setdefault(r.batch_id, []).append(f"{r.rule} ({r.detail})")
    looked = [b.batch_id for b in new if b.table in run.tables]
    notes = [(b, held.STOPPED, ", ".join(sorted(broken[b])), None) if b in broken else (b, held.CLEAN, None, None) for b in looked]
    held.note_states(spark, run.path(), "checks", notes, run.run_ts)


def stop_if_held(batches: Sequence[Batch], run: Run) -> None:
    """Raise while a stopped batch waits for a decision."""
    waiting = [b for b in batches if b.state == held.STOPPED]
    if waiting and not run.past_held:
        raise CircuitOpen.of(f"{b.table}: {b.rule} in batch {b.batch_id}" for b in waiting)


def audit_bronze(
    spark: SparkSession,
    sources: Sources,
    written: Mapping,
    errors: Mapping,
    run: Run,
    incremental: bool = False,
) -> list[Batch]:
    """Log the counts, check the batches, and stop on what the rules forbid; returns the batches
    that are to be merged.

    Logged are the totals of source and bronze, or of this run's rows alone when incremental. The
    rules for rows hold per batch; those for sources and layers hold for this run.
    """
    here = {name for _, name in written}
    day = run.run_ts.date()

    def arrived(spec: TableSpec) -> DataFrame:
        ids = [(w.batch_id, day) for (_, name), w in written.items() if name == spec.table]
        return _of_batches(_bronze(spark, run, spec, spec.table in here), ids)

    this_run = [
        _layer(table, "bronze", _raw_keys(spec), lambda s=spec: arrived(s))
        for table, spec in run.tables.items()
    ]
    extracted, unversioned = (F.lit(None).cast("bigint") for _ in range(2))
    for table in run.tables:
        of_table = [w for (_, name), w in written.items() if name == table]
        is_table = F.col("table_name") == table
        extracted = F.when(is_table, F.lit(sum(w.rows for w in of_table))).otherwise(extracted)
        unversioned = F.when(is_table, F.lit(sum(w.unversioned for w in of_table))).otherwise(unversioned)
    failed = "; ".join(f"{p}: {e}" for p, e in sorted(errors.items())) or None
    checked = source_to_bronze(this_run, run.run_ts).withColumns(
        {
            "source_count": extracted,
            "unversioned_rows": unversioned,
            "failed_partners": F.lit(0 if run.partial else len(errors)),
        }
    )
    said = F.concat_ws(
        "; ",
        "error",
        F.lit(failed),
        F.when(F.col("unversioned_rows") > 0, F.concat("unversioned_rows", F.lit(" rows without a change time"))),
    )
    checked = checked.persist()
    try:
        if incremental:
            _log(checked.withColumn("error", F.when(said != "", said)), run)
        else:
            totals = []
            for table, spec in run.tables.items():
                totals += _source_layers(sources, spec, failed)
                read = lambda s=spec: _bronze(spark, run, s, s.table in here)
                totals.append(_layer(table, "bronze", _raw_keys(spec), read))
            _log(source_to_bronze(totals, run.run_ts), run)
        check_batches(spark, run)
        # what a batch is stopped for is told with the batch
        asked = checked.withColumns({"null_pk_count": F.lit(0), "source_count": F.col("target_count")})
        asked = asked.drop("unversioned_rows") if run.lenient else asked
        found = [f"{r.table_name}: {r.rule} ({r.detail})" for r in breaches(asked).where("breached").collect()]
    finally:
        checked.unpersist()
    if found:
        raise CircuitOpen.of(found)
    open_ = held.batches_in(spark, run.path(), held.STOPPED, *held.READY, held.IMAGED)
    stop_if_held(open_, run)
    return [b for b in open_ if b.state != held.STOPPED]


def _source_layers(sources: Sources, spec: TableSpec, failed: str | None) -> list[Layer]:
    """A table's rows at the sources: counted here, or by the source where it can count itself. A
    reader that cannot is left out."""
    found = []
    for tables in sources.values():
        given, keys = tables.get(spec.table), _raw_keys(spec)
        if isinstance(given, DataFrame):
            found.append(Layer(spec.table, "source", first_of_duplicates(given), keys, failed))
        elif hasattr(given, "total"):
            found.append(Layer(spec.table, "source", None, keys, failed, counted=given.total()))
    return found


def _raw_keys(spec: TableSpec) -> tuple[str, ...]:
    """Source columns behind the keys; the partner is no source column and is never missing."""
    source = {r.name: r.source or r.name for r in spec.rules}
    named = tuple(source.get(k, k) for k in spec.keys)
    return tuple(k for k in named if k != "source_partner") or named


def _typed(spark: SparkSession, run: Run, spec: TableSpec, bronze: DataFrame, batches: Sequence[Batch]) -> tuple[DataFrame, DataFrame | None]:
    """Typed rows with their version, and those set aside because they lack a key.

    Without ``rejects`` only released batches may have such rows; any other fails the job.
    """
    if run.rejects:
        return split_rejects(typed_rows(bronze, spec, run.run_ts), spec.keys)
    passed = [b.batch_id for b in batches if b.released]
    if not passed:
        return typed_rows(bronze, spec, run.run_ts), None
    free = F.coalesce(F.col("batch_id").isin(passed), F.lit(False))
    # bronze is read once, and not apart for released batches
    typed = typed_rows(bronze, spec, run.run_ts, free.alias("_free"))
    _, rejected = split_rejects(typed.where("_free").drop("_free"), spec.keys)
    return typed.where(~F.col("_free") | has_keys(*spec.keys)).drop("_free"), rejected


def refresh_silver(
    spark: SparkSession, spec: TableSpec, run: Run, open_: Sequence[Batch] = (), extracted: bool = False
) -> DataFrame:
    """Rebuild a silver table from all of bronze but held batches; its view gets the new snapshot."""
    bronze = held.without_held(spark, run.path(), _bronze(spark, run, spec, extracted))
    name = f"{run.silver}{spec.table}"
    passed = [] if run.rejects else held.batches_in(spark, run.path(), *held.READY, *held.TAKEN)
    typed, rejected = _typed(spark, run, spec, bronze, [b for b in passed if b.table == spec.table])
    if rejected is not None:
        rejects = run.path("rejects", spec.table)
        publish(rejected.drop(VERSION), rejects, f"{name}_rejects", temporary=run.temporary, keep=run.keep)
    latest = require_keys(latest_per_key(typed, spec.keys, [VERSION]).drop(VERSION), spec.keys)
    rows, folders = _by_event_day(latest, spec)
    return publish(rows, run.path("silver", spec.table), name, folders, run.temporary, run.keep)


def _by_event_day(rows: DataFrame, spec: TableSpec) -> tuple[DataFrame, list[str]]:
    if spec.event_time is None:
        return rows, []
    return rows.withColumn("event_date", F.to_date(spec.event_time)), ["event_date"]


def _here(run: Run, name: str) -> str:
    """A view's name that no other root of the session shares."""
    return f"{name}_{zlib.crc32(run.root.rstrip('/').encode()):08x}"


def feed_path(run: Run, table: str, feed: int | None = None) -> str:
    """The folder of one feed of changes, or that of all."""
    return run.path("changes", table, *([] if feed is None else [f"feed={feed}"]))


def advance_silver(
    spark: SparkSession, spec: TableSpec, run: Run, open_: Sequence[Batch], extracted: bool = False
) -> DataFrame:
    """Merge the increments that the silver table does not hold yet, whenever they were written.

    ``open_`` are the batches of all tables that are not held back and not merged. Versions are compared as a full refresh compares them: by the declared
    order, then by all other columns. To merge an increment twice changes nothing.
    """
    own = [b for b in open_ if b.table == spec.table]
    ready = [b for b in own if b.state != held.IMAGED]
    if spec.event_time:
        result, rejected = _advance_days(spark, spec, run, ready, [b for b in own if b.state == held.IMAGED], extracted)
    else:
        result, rejected = _advance_dimension(spark, spec, run, ready, extracted)
    if rejected is not None:
        where = run.path("rejects", spec.table, "live")
        kept = rejected.drop(VERSION)
        if ready:
            append_rows(kept, where)
        aside = path_or_none(spark, where, kept.schema)
        name_view(aside if aside is not None else kept.limit(0), f"{run.silver}{spec.table}_rejects")
    held.note_states(spark, run.path(), spec.table, [(b.batch_id, held.MERGED, None, None) for b in own], run.run_ts)
    return result


def _latest_updates(
    spark: SparkSession, spec: TableSpec, run: Run, batches: Sequence[Batch], extracted: bool
) -> tuple[DataFrame, DataFrame | None, list[str]]:
    """One typed row per key of some batches, the rows set aside, and what versions compare by."""
    rows = _of_batches(_bronze(spark, run, spec, extracted), [(b.batch_id, b.ingest_date) for b in batches])
    typed, rejected = _typed(spark, run, spec, rows, batches)
    # the version stays in the table: later increments compare with it
    latest = require_keys(latest_per_key(typed, spec.keys, [VERSION]), spec.keys)
    ties = [f.name for f in latest.schema if f.name not in (*spec.keys, VERSION, "ingest_ts")]
    return latest, rejected, [VERSION, *ties]


def _advance_days(
    spark: SparkSession, spec: TableSpec, run: Run, ready: Sequence[Batch], started: Sequence[Batch], extracted: bool
) -> tuple[DataFrame, DataFrame | None]:
    """A table with an event time: one set of day folders, of which only those with changes are
    rewritten. What changes is first stored as a feed, then applied; a run that died between the
    two is ended by the next one from the stored feed."""
    name, live = f"{run.silver}{spec.table}", run.path("silver", spec.table, "live")
    latest, rejected, newer_by = _latest_updates(spark, spec, run, ready, extracted)
    updates, (day,) = _by_event_day(latest, spec)
    declared = updates.schema if spec.rules else None
    kind = updates.schema[day]
    for feed in sorted({b.feed for b in started}):
        images = stored_rows(spark, feed_path(run, spec.table, feed), schema=declared and image_schema(declared))
        apply_images(spark, live, images, spec.keys, day, declared)
    if ready:
        feed = 1 + last_feed(spark, run, spec.table)
        target = stored_rows(spark, live, kind, declared)
        if target is not None:
            # into an empty table the rows go once
            latest.persist()
        where = feed_path(run, spec.table, feed)
        images = change_images(target, updates, spec.keys, newer_by)
        images.write.mode("overwrite").parquet(where)
        notes = [(b.batch_id, held.IMAGED, None, feed) for b in ready]
        held.note_states(spark, run.path(), spec.table, notes, run.run_ts)
        apply_images(spark, live, spark.read.schema(images.schema).parquet(where), spec.keys, day, declared)
    latest.unpersist()
    merged = stored_rows(spark, live, kind, declared)
    merged = merged if merged is not None else updates.limit(0)
    if run.temporary:
        name_view(merged.drop(VERSION), name)
    else:
        columns = ", ".join(f"`{c}`" for c in merged.columns if c != VERSION)
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{live}`")
    return merged.drop(VERSION), rejected


def last_feed(spark: SparkSession, run: Run, table: str) -> int:
    """The number of a table's last stored feed, 0 before the first."""
    every = held.batch_states(spark, run.path())
    asked = None if every is None else every.where(F.col("table_name") == table).agg(F.max("feed")).first()[0]
    return asked or 0


def read_feeds(
    spark: SparkSession, run: Run, table: str, rows: T.StructType, after: int = 0, last: int | None = None
) -> DataFrame | None:
    """Stored feeds of a table past a number, with ``feed``; those that no batch names are left out."""
    last = last_feed(spark, run, table) if last is None else last
    if last <= after:
        return None
    schema = T.StructType([*image_schema(rows).fields, T.StructField("feed", T.LongType())])
    feeds = spark.read.schema(schema).parquet(feed_path(run, table))
    return feeds.where((F.col("feed") > after) & (F.col("feed") <= last))


def _advance_dimension(
    spark: SparkSession, spec: TableSpec, run: Run, ready: Sequence[Batch], extracted: bool
) -> tuple[DataFrame, DataFrame | None]:
    """A table without an event time: a new snapshot, which keeps the rows' versions, and a view of
    its other columns. Where no snapshot is known it is rebuilt from all batches but held ones."""
    name, versions = f"{run.silver}{spec.table}", _here(run, f"{run.silver}{spec.table}_versions")
    known = spark.catalog.tableExists(versions)
    earlier = [] if known else [b for b in held.batches_in(spark, run.path(), *held.TAKEN) if b.table == spec.table]
    batches = [*ready, *earlier]
    latest, rejected, newer_by = _latest_updates(spark, spec, run, batches, extracted)
    if batches or not known:
        rows = upsert(spark.table(versions), latest, spec.keys, newer_by) if known else latest
        # apart from the snapshots of full refreshes, which are retired by themselves
        publish(rows, run.path("silver", spec.table, "versions"), versions, (), run.temporary, run.keep)
        columns = ", ".join(f"`{c}`" for c in rows.columns if c != VERSION)
        kind = "TEMPORARY VIEW" if run.temporary else "VIEW"
        spark.sql(f"CREATE OR REPLACE {kind} {name} AS SELECT {columns} FROM {versions}")
    return spark.table(name), rejected


def audit_silver(
    spark: SparkSession, run: Run, incremental: bool = False, merged: Sequence[Batch] = (), here: frozenset[str] = frozenset()
) -> None:
    """Log the counts, then stop unless silver has one row per distinct typed bronze key.

    When incremental, this is asked of the keys of the batches merged just now, not of all history.
    Held batches are in neither; rows without a key are left to the rules for batches.
    """
    layers = []
    for table, spec in run.tables.items():
        raw = _raw_keys(spec)
        rules = {r.name: r.build(moment(run.run_ts)) for r in spec.rules}
        typed = [rules.get(k, F.col(k)).alias(f"typed_{k}") for k in spec.keys]
        bronze = _bronze(spark, run, spec, table in here)
        silver = spark.table(f"{run.silver}{table}").select(*spec.keys)
        if not incremental:
            bronze = held.without_held(spark, run.path(), bronze)
        else:
            bronze = _of_batches(bronze, [(b.batch_id, b.ingest_date) for b in merged if b.table == table])
            came = bronze.select(*[t.alias(k) for t, k in zip(typed, spec.keys)])
            silver = silver.join(came, list(spec.keys), "left_semi")
        distinct = tuple(f"typed_{k}" for k in spec.keys)
        layers.append(Layer(table, "bronze", bronze.select(*raw, *typed), raw, distinct=distinct))
        layers.append(Layer(table, "silver", silver, spec.keys))
    audit = bronze_to_silver(layers, run.run_ts).persist()
    try:
        _log(audit, run)
        enforce(audit.withColumn("null_pk_count", F.lit(0)))
    finally:
        audit.unpersist()


def report_day(
    spark: SparkSession,
    sources: Sources,
    run: Run,
    silver: Mapping[str, DataFrame],
    profile: DataFrame,
) -> None:
    """Append to ``quality/…`` how late this run's transactions came, how many came per partner
    today, and whether the four layers of each table agree. Nothing here stops the run."""
    tx, now = silver["transactions"], moment(run.run_ts).alias("run_ts")
    fresh = freshness(tx.where(F.col("ingest_ts") == moment(run.run_ts)))
    names = [p.lower() for p in sources]
    volume = volume_anomalies(tx, run.run_ts.date(), days=1, partners=names)
    here = {t for given in sources.values() for t in given}
    layers = []
    for table, spec in run.tables.items():
        keys, raw = spec.keys, _raw_keys(spec)
        rules = {r.name: r.build(moment(run.run_ts)).alias(r.name) for r in spec.rules}
        bronze = _bronze(spark, run, spec, table in here)
        typed = bronze.select(*[rules.get(k, F.col(k)) for k in keys])
        frames = [given[table] for given in sources.values() if isinstance(given.get(table), DataFrame)]
        layers += [Layer(table, "source", first_of_duplicates(f), raw) for f in frames]
        layers += [Layer(table, "bronze", typed, keys), Layer(table, "silver", silver[table], keys)]
    layers.append(Layer("users", "gold", profile, run.tables["users"].keys))
    for name, rows in (("freshness", fresh), ("volume", volume), ("layers", reconcile(layers))):
        append_rows(rows.select(now, "*"), run.path("quality", name))


def _maintained(spark: SparkSession, run: Run, silver: Mapping[str, DataFrame], within: Sequence[str]) -> DataFrame:
    """The profile from its parts, brought up to date by the feeds they do not hold yet."""
    tx = silver["transactions"]
    spec = run.tables["transactions"]
    last = last_feed(spark, run, spec.table)
    return maintained_profile(
        silver["users"],
        silver["cards"],
        tx,
        run.run_ts,
        within,
        feeds=lambda after: read_feeds(spark, run, spec.table, tx.schema, after, last),
        last=last,
        base=run.path("gold", "profile_parts"),
        name=_here(run, f"{run.gold}profile_parts"),
        temporary=run.temporary,
        keep=run.keep,
    )


def run_day(
    spark: SparkSession, sources: Sources, run: Run, incremental: bool = False
) -> DataFrame:
    """All layers in order; returns the gold profile. ``sources`` is partner → table → rows.

    Incremental runs read only what silver does not hold yet. A run may be repeated, with the
    same time or an older one: what it had written is merged, and nothing is merged twice.
    Gold is replaced only if no rule stops the run. Where users and cards have the partner in
    their keys, so has the profile.
    """
    if not run.temporary:
        for prefix in {p.rsplit(".", 1)[0] for p in (run.silver, run.gold) if "." in p}:
            create_namespace(spark, prefix)
    written, errors = ingest(spark, sources, run)
    # with them what a run that died had begun to merge
    open_ = audit_bronze(spark, sources, written, errors, run, incremental)
    step = advance_silver if incremental else refresh_silver
    here = frozenset(name for _, name in written)
    with ThreadPoolExecutor(run.parallel) as pool:
        jobs = {
            t: pool.submit(step, spark, spec, run, open_, t in here) for t, spec in run.tables.items()
        }
    silver = {t: job.result() for t, job in jobs.items()}
    audit_silver(spark, run, incremental, open_, here)
    within = [k for k in run.tables["users"].keys if k != "user_id"]
    if incremental:
        profile = _maintained(spark, run, silver, within)
    else:
        profile = user_risk_profile(silver["users"], silver["cards"], silver["transactions"], run.run_ts, within)
    gold = publish(
        keyed_profile(profile, within),
        run.path("gold", "user_risk_profile"),
        f"{run.gold}user_risk_profile",
        temporary=run.temporary,
        keep=run.keep,
    )
    if run.report:
        report_day(spark, sources, run, silver, gold)
    return gold
