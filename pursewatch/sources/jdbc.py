"""Increments from a relational source, read in parallel slices."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from pursewatch.model import EPOCH


def time_slices(column: str, since: datetime, until: datetime, slices: int) -> list[str]:
    """Predicates that together cover ``since < column <= until`` without overlap."""
    if until <= since or slices < 1:
        raise ValueError("need since < until and at least one slice")
    step = (until - since) / slices
    edges = [since + step * i for i in range(slices)] + [until]
    return [
        f"{column} > '{a.isoformat(sep=' ')}' AND {column} <= '{b.isoformat(sep=' ')}'"
        for a, b in zip(edges, edges[1:])
    ]


def key_slices(key: str, slices: int, condition: str | None = None) -> list[str]:
    """Predicates that deal rows out by a numeric key, evenly however uneven their times are.

    A key may be negative or NULL; every row is in one slice.
    """
    if slices < 1:
        raise ValueError("need at least one slice")
    dealt = [f"ABS(MOD({key}, {slices})) = {i}" for i in range(slices)]
    dealt[0] = f"({dealt[0]} OR {key} IS NULL)"
    return [f"{condition} AND {d}" if condition else d for d in dealt]


def increment_predicates(
    column: str, since: datetime | None, until: datetime, slices: int, key: str | None = None
) -> list[str]:
    """How the rows changed in ``(since, until]`` are dealt over connections.

    By the key where the table has a numeric one. Otherwise by time, which is even only where
    changes are: give ``since`` and ``until`` from the source's own smallest and largest time.
    """
    start = since or datetime.fromisoformat(EPOCH)
    if key is None:
        return time_slices(column, start, until, slices)
    return key_slices(key, slices, time_slices(column, start, until, 1)[0])


def _options(properties: Mapping[str, str] | None) -> dict[str, str]:
    return {"preferTimestampNTZ": "true", "fetchsize": "10000", **(properties or {})}


def changed_between(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    since: datetime | None,
    properties: Mapping[str, str] | None = None,
) -> tuple[datetime | None, datetime | None]:
    """Smallest and largest change time past a mark; the source counts, one row comes back."""
    start = (since or datetime.fromisoformat(EPOCH)).isoformat(sep=" ")
    asked = f"(SELECT MIN({column}) AS a, MAX({column}) AS b FROM {table} WHERE {column} > '{start}') bounds"
    return tuple(spark.read.jdbc(url, asked, properties=_options(properties)).first())


def read_increment(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    since: datetime | None,
    until: datetime,
    slices: int = 8,
    properties: Mapping[str, str] | None = None,
    key: str | None = None,
) -> DataFrame:
    """Rows changed in ``(since, until]``; one connection per slice, filtered in the source."""
    return _read(spark, url, table, increment_predicates(column, since, until, slices, key), properties)


def read_snapshot(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    bounds: tuple[int, int],
    slices: int = 8,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A whole table without a change column, split on a numeric column."""
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=slices,
        properties=_options(properties),
    )


def _read(
    spark: SparkSession, url: str, table: str, predicates: list[str], properties: Mapping | None
) -> DataFrame:
    return spark.read.jdbc(url, table, predicates=predicates, properties=_options(properties))


def counted(
    spark: SparkSession, url: str, table: str, condition: str | None = None, properties: Mapping[str, str] | None = None
) -> int:
    """Rows of a table, or those a condition holds for; the source counts, one row comes back."""
    where = f" WHERE {condition}" if condition else ""
    return spark.read.jdbc(url, f"(SELECT COUNT(*) AS n FROM {table}{where}) counted", properties=_options(properties)).first()[0]


@dataclass(frozen=True)
class Reader:
    """A table as a source of ``run_day``: given a mark, its rows that changed since.

    Without a change column every run reads the whole table. Time slices span the source's own
    times past the mark; where nothing is new the one slice is empty. Rows without a change time
    are in no slice, so ``untimed`` has the source count them, and ``total`` all of its rows.
    """

    spark: SparkSession
    url: str
    table: str
    column: str | None = None
    key: str | None = None
    slices: int = 8
    properties: Mapping[str, str] | None = None
    bounds: Callable = changed_between
    read: Callable = _read
    count: Callable = counted

    def total(self) -> int:
        return self.count(self.spark, self.url, self.table, None, self.properties)

    def untimed(self) -> int:
        if self.column is None:
            return 0
        return self.count(self.spark, self.url, self.table, f"{self.column} IS NULL", self.properties)

    def __call__(self, since: datetime | None) -> DataFrame:
        asked = (self.spark, self.url, self.table)
        if self.column is None:
            if self.key is None:
                return self.spark.read.jdbc(self.url, self.table, properties=_options(self.properties))
            return self.read(*asked, key_slices(self.key, self.slices), self.properties)
        low, high = self.bounds(*asked, self.column, since, self.properties)
        if high is None:
            nothing = f"(SELECT * FROM {self.table} WHERE 1 = 0) nothing"
            return self.spark.read.jdbc(self.url, nothing, properties=_options(self.properties))
        # the first slice is open below: the smallest time itself belongs to it
        even = low is not None and low < high and self.key is None
        predicates = increment_predicates(self.column, since, high, self.slices if self.key else 1, self.key)
        if even:
            predicates = time_slices(self.column, low, high, self.slices)
            first = predicates[0].replace(f"{self.column} > ", f"{self.column} >= ", 1)
            predicates = [first, *predicates[1:]]
        return self.read(*asked, predicates, self.properties)


def reader(spark: SparkSession, url: str, table: str, column: str | None = None, **options: object) -> Reader:
    """A ``Reader``; ``options`` are its other fields."""
    return Reader(spark, url, table, column, **options)
