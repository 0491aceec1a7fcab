"""Keys that keep rows together which are near in several columns at once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pursewatch.functions.timing import moment
from pursewatch.model import EPOCH

#: Bits per column of a clustering key, and of the sample's quantiles that values are ranked by.
BITS = 8


def interleaved(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of several whole numbers in turn, the highest first: a place on the Z-order curve."""
    n = len(ranks)
    parts = []
    for bit in range(bits):
        for k, rank in enumerate(ranks):
            one = F.shiftright(rank.cast("long"), bit).bitwiseAND(F.lit(1))
            parts.append(F.shiftleft(one, bit * n + n - 1 - k))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def ranked(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> list[Column]:
    """Each column's rank among 2**bits ranges of about equally many rows; NULL is lowest.

    The ranges' borders are approximate quantiles, at most 2**bits numbers per column.
    """
    n = 1 << bits
    numbers = {c: _number(df, c) for c in columns}
    at = [i / n for i in range(1, n)]
    found = df.agg(*[F.percentile_approx(x, at, 4 * n).alias(c) for c, x in numbers.items()]).first()
    ranks = []
    for c, x in numbers.items():
        borders = sorted(set(found[c] or []))
        place = _count_below(x, borders)
        ranks.append(F.when(x.isNull(), F.lit(0)).otherwise(place))
    return ranks


def _number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.simpleString()
    c = F.col(column)
    if kind.startswith("timestamp"):
        since = F.unix_micros(c) if kind == "timestamp" else F.timestamp_diff("MICROSECOND", moment(EPOCH), c)
        return since.cast("double")
    return (F.datediff(c, F.lit("1970-01-01")) if kind == "date" else c).cast("double")


def _count_below(x: Column, borders: Sequence[float]) -> Column:
    """How many of the sorted borders are at or below a number, by halving."""

    def within(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(x < F.lit(borders[middle]), within(low, middle)).otherwise(within(middle + 1, high))

    return within(0, len(borders))


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = BITS, mode: str = "errorifexists"
) -> None:
    """Write rows in files that each hold a small range of every one of the columns.

    Rows are dealt by ranges of the clustering key and sorted by it in a file, so Parquet's own
    smallest and largest values let a filter on any of the columns skip most files and row groups. A
    value that holds a third of all rows is still dealt over many files by the other columns.
    Spark compares no timestamp without a zone with a file's values: filter by its date, which the
    order of the times keeps together as well.
    """
    key = "_place"
    names = [f"_rank_{k}" for k in range(len(columns))]
    # ranks are columns of their own, as the key takes each of them once per bit
    with_ranks = df.withColumns(dict(zip(names, ranked(df, columns, bits), strict=True)))
    placed = with_ranks.withColumn(key, interleaved([F.col(c) for c in names], bits)).drop(*names)
    sorted_ = placed.repartitionByRange(files, key, *columns).sortWithinPartitions(key, *columns)
    sorted_.drop(key).write.mode(mode).parquet(path)
