"""Exact duplicates by content, combined in three steps that a huge group cannot clog."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from pursewatch.llm.common import SPACE, stored


def sha256(normal: Column) -> Column:
    return F.sha2(normal, 256)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = 64,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """Every row with the row of equal text that stays.

    Texts are equal when identical after their white space is deleted; a null text counts as
    empty. Of equal texts the one with the most code points stays, then the smallest id.
    Returns doc_id, keep_id, group_size, kept, text_sha256.

    Rows are folded by digest, salt and content inside each task, then merged per salt, then the
    salts' winners are merged: content is compared in each step, so two contents of one digest
    stay apart, and a group of any size reaches the last step as at most ``salts`` rows. The salt
    is the task's number, so that a task sends one row per content. Winners go back to the rows
    by digest and a salt of the row's id; only if some digest has several contents, its rows are
    matched by content as well.

    An empty table gives no rows; a null id stays only where no equal text of that length has an
    id; rows that repeat an id and a text share its answer. Other columns are ignored.
    """
    content = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACE, "")
    rows = (
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.char_length(F.coalesce(F.col(text_col), F.lit(""))).alias("n_chars"),
            content.alias("content"),
        )
        .withColumn("digest", digest(F.col("content")))
        .withColumn("task_salt", F.spark_partition_id() % salts)
    )
    # ~id falls as the id rises and cannot overflow; a null id sorts below all others
    rank = F.struct(F.col("n_chars"), F.bitwise_not("doc_id").alias("inverted_id"))
    per_salt = rows.groupBy("digest", "task_salt", "content").agg(
        F.max(rank).alias("best"), F.count(F.lit(1)).alias("n")
    )
    per_content = per_salt.groupBy("digest", "content").agg(
        F.max("best").alias("best"), F.sum("n").alias("group_size")
    )
    winner = [
        "digest",
        F.bitwise_not("best.inverted_id").alias("keep_id"),
        "group_size",
    ]
    winners = stored(per_content.select(*winner), "winners")
    ids = stored(
        rows.select("doc_id", "digest", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt")),
        "digests",
    )
    several = winners.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    several = several.select("digest")

    clashes = not several.isEmpty()
    plain_winners = winners.join(several, "digest", "left_anti") if clashes else winners
    per_id_salt = ids.select("digest", "salt").distinct().join(plain_winners, "digest")
    found = ids.join(per_id_salt, ["digest", "salt"])
    found = found.select("doc_id", "keep_id", "group_size", "digest")
    if clashes:
        by_content = per_content.join(several, "digest", "left_semi").select(*winner, "content")
        clashing = rows.join(several, "digest", "left_semi").join(by_content, ["digest", "content"])
        found = found.unionByName(clashing.select(*found.columns))
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
