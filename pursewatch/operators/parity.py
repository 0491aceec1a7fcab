"""Whether two layers hold the same rows, and which keys differ, from sums that do not depend on order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

#: Keys are dealt into 16**DEPTH buckets, the leaves of a tree in which a node has 16 children.
DEPTH = 3
FAN_BITS = 4


def _told(c: str) -> Column:
    """A value as text that NULL and no other value has as such."""
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))


def _bucket(keys: Sequence[str], depth: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("bucket"), *map(_told, keys)), F.lit(1 << (FAN_BITS * depth)))


def _marks(keys: Sequence[str], columns: Sequence[str]) -> list[Column]:
    """Two hashes of a row, of 64 bits each."""
    values = [_told(c) for c in (*keys, *columns)]
    return [F.xxhash64(F.lit(salt), *values).alias(salt) for salt in ("a", "b")]


def bucket_sums(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], depth: int = DEPTH) -> DataFrame:
    """bucket, n, a, b: per bucket of keys the rows and the sums of their hashes.

    Sums of whole numbers: rows may come in any order and any number of times, and a row twice is
    not the same as none. One scan; a task sends one row per bucket. Sums of two days or two parts
    may be added up, so those of a layer can be kept beside it.
    """
    each = rows.select(_bucket(keys, depth).alias("bucket"), *_marks(keys, columns))
    sums = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("a", "b")]
    return each.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *sums)


def tree_of(sums: DataFrame, depth: int = DEPTH) -> DataFrame:
    """level, node, n, a, b: the buckets' sums and those of every node above them, root at level 0."""
    levels = F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level")
    up = sums.select(levels, "*")
    node = F.expr(f"shiftright(bucket, {FAN_BITS} * ({depth} - level))")
    return up.groupBy("level", node.alias("node")).agg(*[F.sum(c).alias(c) for c in ("n", "a", "b")])


def differing_buckets(left: DataFrame, right: DataFrame, depth: int = DEPTH) -> list[int]:
    """Buckets whose sums differ in two trees, found from the root down.

    On each level only the children of differing nodes are looked at: 16 rows a side and node, so
    two sites need to send each other little where they agree.
    """
    nodes = [0]
    for level in range(depth + 1):
        a, b = (
            t.where((F.col("level") == level) & F.col("node").isin(nodes)).select("node", *[F.col(c).alias(f"{s}{c}") for c in "nab"])
            for s, t in (("l", left), ("r", right))
        )
        unlike = reduce(or_, [~F.col(f"l{c}").eqNullSafe(F.col(f"r{c}")) for c in "nab"])
        found = [r.node for r in a.join(b, "node", "full").where(unlike).select("node").collect()]
        if not found or level == depth:
            return sorted(found)
        nodes = [n << FAN_BITS | k for n in found for k in range(1 << FAN_BITS)]
    return []


def differing_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str], depth: int = DEPTH
) -> DataFrame:
    """Keys whose rows are not the same on both sides: the keys, left_rows, right_rows and difference.

    ``difference`` is ``missing`` (no row on the right), ``added`` (none on the left) or ``changed``.
    Both sides are first folded to sums per bucket of keys. Where all agree nothing else is read;
    otherwise the rows of differing buckets alone are compared by key. NULL is a value like any
    other, also in keys; a key may have several rows on either side.
    """
    a, b = (tree_of(bucket_sums(df, keys, columns, depth), depth).persist() for df in (left, right))
    try:
        buckets = differing_buckets(a, b, depth)
    finally:
        a.unpersist()
        b.unpersist()
    inside = _bucket(keys, depth).isin(buckets) if buckets else F.lit(False)

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.where(inside).select(*keys, *_marks(keys, columns), F.lit(sign).alias("sign"))

    both = side(left, 1).unionByName(side(right, -1))
    sums = [F.sum(F.col(c).cast("decimal(38,0)") * F.col("sign")).alias(c) for c in ("a", "b")]
    held = [
        F.count(F.when(F.col("sign") == sign, 1)).alias(name) for sign, name in ((1, "left_rows"), (-1, "right_rows"))
    ]
    found = both.groupBy(*keys).agg(*held, *sums)
    unlike = (F.col("left_rows") != F.col("right_rows")) | (F.col("a") != 0) | (F.col("b") != 0)
    kind = F.when(F.col("right_rows") == 0, "missing").when(F.col("left_rows") == 0, "added").otherwise("changed")
    return found.where(unlike).select(*keys, "left_rows", "right_rows", kind.alias("difference"))
