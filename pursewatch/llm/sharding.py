"""Placement of rows on shards by a lookup table that shards fill in turns."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from pursewatch.llm.common import key60

#: A prime over a hundred times the number of shards keeps the shards' shares within about 1 %.
TABLE_SIZE = 2039


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """For each slot the index of its shard.

    Each shard prefers the slots in the order offset, offset + step, … modulo the prime size,
    both taken from its name; shards take turns claiming the first slot they prefer that is free.
    So shares differ by one slot at most, and taking a shard away moves few slots of the others.
    """
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shards must be distinct, at least one, and no more than the slots")
    if size < 2 or any(size % k == 0 for k in range(2, int(size**0.5) + 1)):
        raise ValueError("the table's size must be prime")
    at = [_number(f"{s}#offset") % size for s in shards]
    step = [_number(f"{s}#step") % (size - 1) + 1 for s in shards]
    table = [-1] * size
    for turn in range(size):
        k = turn % len(shards)
        while table[at[k]] >= 0:
            at[k] = (at[k] + step[k]) % size
        table[at[k]] = k
    return table


def place(
    docs: DataFrame, shards: Sequence[str], key_col: str = "doc_id", size: int = TABLE_SIZE
) -> DataFrame:
    """The rows with their ``slot`` and ``shard``.

    The slot is the hash of the key modulo the table's size. The table has ``size`` rows whatever
    the input is, so it is broadcast; no row is shuffled. Equal keys meet on one shard, a null key
    counts as the empty text, an empty table gives no rows. Columns of the input that are named
    slot or shard are replaced.
    """
    table = lookup_table(shards, size)
    spark = docs.sparkSession
    owners = F.split(F.lit(",".join(shards[k] for k in table)), ",")
    if any("," in s for s in shards):
        raise ValueError("a shard's name has a comma")
    slots = spark.range(0, size, 1, 1).select(
        F.col("id").alias("slot"), F.element_at(owners, (F.col("id") + 1).cast("int")).alias("shard")
    )
    rows = docs.drop("slot", "shard").withColumn("slot", key60(F.col(key_col)) % size)
    columns = [c for c in rows.columns if c != "slot"]
    return rows.join(F.broadcast(slots), "slot").select(*columns, "slot", "shard")


def write_shards(placed: DataFrame, path: str, key_col: str = "doc_id", files: int = 8) -> None:
    """One folder per shard with about ``files`` files each, so that no task writes a whole shard."""
    part = F.pmod(F.xxhash64(key_col), F.lit(files))
    placed.repartition("shard", part).write.partitionBy("shard").parquet(path)
