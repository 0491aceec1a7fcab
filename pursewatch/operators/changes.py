"""What an upsert changes, as before and after images, and the table that images add up to."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: The column that tells an image's kind, and its values.
IMAGE, BEFORE, AFTER = "image", "before", "after"


#: Keys of a batch that are looked up one by one at most.
LOOKUP = 256


def rows_of_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str], most: int = LOOKUP) -> DataFrame:
    """The target's rows whose keys a batch has.

    Up to ``most`` keys go to the scan as literals, where files and row groups whose key range or
    Bloom filter has none of them are skipped; ``write_balanced`` writes both. More keys are met by
    a join, of which the batch is the small side. Only that many keys reach the driver.
    """
    asked = batch.select(*keys)
    if len(keys) == 1:
        found = [r[0] for r in asked.distinct().limit(most + 1).collect()]
        if len(found) <= most:
            target = target.where(_any_of(keys[0], [k for k in found if k is not None]))
    return target.join(asked, list(keys), "left_semi")


def _any_of(column: str, values: list) -> Column:
    """Equal to one of some values, as a balanced tree: a long IN list is sent to files as a range."""
    if len(values) < 2:
        return F.col(column) == F.lit(values[0]) if values else F.lit(False)
    half = len(values) // 2
    return _any_of(column, values[:half]) | _any_of(column, values[half:])


def change_images(
    target: DataFrame | None,
    updates: DataFrame,
    keys: Sequence[str],
    newer_by: str | Sequence[str] | None = None,
    ignore: Sequence[str] = ("ingest_ts",),
) -> DataFrame:
    """Per key that the updates change: the stored row as ``before``, if there is one, and the
    row that replaces it as ``after``.

    Both sides hold one row per key. With ``newer_by`` an update that is older than the stored row
    changes nothing. Nor does one that repeats it in all columns but those to ``ignore``.
    """
    names = list(dict.fromkeys([*(target.columns if target is not None else []), *updates.columns]))
    if target is None:
        return updates.select(F.lit(AFTER).alias(IMAGE), *names)
    order = [newer_by] if isinstance(newer_by, str) else list(newer_by or [])

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.struct(*df.columns).alias(name), *keys)

    known = rows_of_keys(target, updates, keys)
    pairs = side(updates, "new").join(side(known, "old"), list(keys), "left")

    def value(of: str, df: DataFrame, name: str) -> Column:
        kind = updates.schema[name] if name in updates.columns else target.schema[name]
        return (F.col(of)[name] if name in df.columns else F.lit(None)).cast(kind.dataType)

    def row(kind: str, of: str, df: DataFrame) -> Column:
        return F.struct(F.lit(kind).alias(IMAGE), *[value(of, df, c).alias(c) for c in names])

    new_here = F.col("old").isNull()
    if order:
        # structs compare field by field with NULL lowest, as the newest-first order has it
        new, old = (F.struct(*[value(of, df, c) for c in order]) for of, df in (("new", updates), ("old", target)))
        pairs = pairs.where(new_here | (new >= old))
    asked = [c for c in names if c not in ignore]
    unlike = [~value("new", updates, c).eqNullSafe(value("old", target, c)) for c in asked]
    changed = pairs.where(new_here | reduce(or_, unlike))
    after = row(AFTER, "new", updates)
    # no function of each element, which Spark would not compile
    images = F.when(new_here, F.array(after)).otherwise(F.array(row(BEFORE, "old", target), after))
    return changed.select(F.inline(images))


def signed() -> Column:
    """What an image counts for in a sum over a feed: 1 or -1."""
    return F.when(F.col(IMAGE) == AFTER, 1).otherwise(-1)


def replay(images: DataFrame, feed: str = "feed") -> DataFrame:
    """The table that whole feeds, taken from the first on, leave behind.

    Each image adds its row or takes it away, so the order of the feeds does not matter and rows
    are counted by content: feeds are folded inside the tasks, and no key's history is gathered.
    """
    columns = [c for c in images.columns if c not in (IMAGE, feed)]
    total = images.groupBy(*columns).agg(F.sum(signed()).alias("_n"))
    return total.where(F.col("_n") > 0).drop("_n")


def image_schema(rows: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(IMAGE, T.StringType()), *rows.fields])
