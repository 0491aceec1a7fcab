"""Table declarations: key, order of versions, and how each silver column is derived.

A column is declared as ``{"from": source, "as": type}`` with a type of ``casts.CASTS``, as
``{"run_ts": true}`` for the run's time, or as a text holding any Spark SQL expression.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, functions as F

from pursewatch.functions.casts import CASTS
from pursewatch.model import DEFAULT_KEY

LINEAGE = ("ingest_ts", "source_partner", "batch_table", "batch_id")


@dataclass(frozen=True)
class ColumnRule:
    name: str
    source: str | None = None
    kind: str | None = None
    sql: str | None = None

    def build(self, run_ts: Column) -> Column:
        if self.sql is not None:
            column = F.expr(self.sql)
        elif self.source is not None:
            column = CASTS[self.kind](F.col(self.source))
        else:
            column = run_ts
        return column.alias(self.name)


@dataclass(frozen=True)
class TableSpec:
    table: str
    keys: tuple[str, ...]
    rules: tuple[ColumnRule, ...] = ()
    order_by: str | None = None  # bronze column that tells the newer version
    watermark: str | None = None  # source column for increments; None means full snapshots
    event_time: str | None = None  # silver column that gives the day folder
    source_columns: tuple[str, ...] | None = field(default=None)

    def bronze_columns(self) -> list[str] | None:
        """Bronze columns the rules read, or None where only the files can tell."""
        if not self.rules:
            return None
        if self.source_columns is not None:
            names = list(self.source_columns)
        elif any(r.sql is not None for r in self.rules):
            return None
        else:
            names = [r.source for r in self.rules if r.source]
        extra = [c for c in (self.order_by, self.watermark) if c]
        return list(dict.fromkeys([*names, *extra, *LINEAGE]))


def _rule(table: str, name: str, given: object) -> ColumnRule:
    if isinstance(given, str):
        return ColumnRule(name, sql=given)
    if isinstance(given, Mapping):
        if given.get("run_ts"):
            return ColumnRule(name)
        if "from" in given and given.get("as") in CASTS:
            return ColumnRule(name, source=given["from"], kind=given["as"])
    raise ValueError(f"{table}.{name}: no valid column rule: {given!r}")


def table_from_payload(payload: Mapping) -> TableSpec:
    """One declaration; ``columns`` may be absent, then all bronze columns pass through."""
    if not payload.get("table"):
        raise ValueError("a table declaration needs 'table'")
    pk = payload.get("pk") or DEFAULT_KEY
    columns = payload.get("columns") or {}
    spec = TableSpec(
        table=payload["table"],
        keys=tuple([pk] if isinstance(pk, str) else pk),
        rules=tuple(_rule(payload["table"], n, g) for n, g in columns.items()),
        order_by=payload.get("order_by"),
        watermark=payload.get("watermark"),
        event_time=payload.get("event_time"),
        source_columns=tuple(payload["source_columns"]) if payload.get("source_columns") else None,
    )
    missing = [k for k in spec.keys if columns and k not in columns]
    if missing:
        raise ValueError(f"{spec.table}: key columns {missing} are not declared")
    return spec


def load_tables(path: str | os.PathLike | None = None) -> dict[str, TableSpec]:
    """All declarations of a JSON list; the package's own when no path is given.

    Table, key and column names of the package's own list are fixed values, and so are the names
    of the environment variables below.
    """
    text = Path(path or Path(__file__).with_name("default_tables.json")).read_text()
    specs = [table_from_payload(p) for p in json.loads(text)]
    names = [s.table for s in specs]
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate table declarations in {names}")
    return {s.table: s for s in specs}


def table_from_env(env: Mapping[str, str] = os.environ) -> TableSpec:
    """A declaration handed over as JSON in TASK_PAYLOAD, else TABLE_NAME and PRIMARY_KEY."""
    if env.get("TASK_PAYLOAD"):
        return table_from_payload(json.loads(env["TASK_PAYLOAD"]))
    return table_from_payload({"table": env.get("TABLE_NAME"), "pk": env.get("PRIMARY_KEY")})


def key_of(specs: Mapping[str, TableSpec], table: str) -> tuple[str, ...]:
    return specs[table].keys if table in specs else (DEFAULT_KEY,)
