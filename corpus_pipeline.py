"""The text operators in a row: what of a corpus is kept, how often, and on which shard."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pursewatch.llm import decontamination, line_quality, mixing, near_dedup, sharding
from pursewatch.llm.common import WORD, free_name, stored
from pursewatch.llm.queries import SHARDS, remainder, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose lines the quality model holds good on the whole; it learns as op7 does.

    A null or empty text is scored as one empty line. Without labels all rows stay.
    """
    model = line_quality.fit_on(docs, table(spark, sf_dir, "labels"), remainder(3) != 1)
    score = free_name(docs, "quality_score")
    scored = line_quality.score_quality(docs, model, out=score)
    return scored.where(F.col(score) >= 0.5).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles, 80 % alike: the smallest id.

    Rows with a null id stay, as do documents without words. Rows that share an id are documents of
    their own, in the order of their texts: near copies among them go, unlike ones stay.
    """
    again = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 and doc_id is not null")
    if again.isEmpty():
        return _smallest_of_groups(docs, "doc_id").select(*docs.columns)
    row = free_name(docs, "row")
    by = ["doc_id", "text"]
    dealt = docs.where("doc_id is not null").repartitionByRange(*by).sortWithinPartitions(*by)
    numbered = stored(dealt.withColumn(row, F.monotonically_increasing_id()), "numbered")
    rows = _smallest_of_groups(numbered, row).select(*docs.columns)
    return rows.unionByName(docs.where("doc_id is null"))


def _smallest_of_groups(docs: DataFrame, key: str) -> DataFrame:
    found = near_dedup.near_dedup(docs, id_col=key)
    gone = stored(found.where("not kept").select(F.col("doc_id").alias(key)).distinct(), "gone")
    # few ids go to every task instead of all texts going through a shuffle
    sent = F.broadcast(gone) if gone.count() <= near_dedup.SENT_IDS else gone
    return docs.join(sent, key, "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item. Null and empty texts hold none."""
    leaks = free_name(docs, "leaks")
    found = decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark"), out=leaks)
    return found.where(F.size(leaks) == 0).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it; the row at a source's cut once with fewer words.

    Each copy is a row. A cut text is its first words joined by one space, and its n_chars
    follows. Rows beyond their source's budget go; rows without words stay with whole rounds.
    """
    mixed = mixing.mix(docs, keep=docs.columns)
    cut = (F.col("part") > 0) & (F.col("part") < F.col("size"))
    copies = F.transform(
        F.sequence(F.lit(1), F.col("epochs") + (F.col("part") > 0).cast("long")), lambda i: i <= F.col("epochs")
    )
    rows = mixed.where("epochs > 0 or part > 0").withColumn("whole", F.explode(copies))
    short = F.array_join(F.slice(F.regexp_extract_all("kept.text", F.lit(WORD), F.lit(0)), 1, F.col("part").cast("int")), " ")
    text = F.when(cut & ~F.col("whole"), short).otherwise(F.col("kept.text"))
    out = rows.withColumn("cut text", text)
    columns = {
        "text": F.col("cut text"),
        "n_chars": F.when(cut & ~F.col("whole"), F.char_length("cut text").cast("long")).otherwise(
            F.col("kept.n_chars") if "n_chars" in docs.columns else F.lit(None)
        ),
    }
    return out.select(*[columns.get(c, F.col("kept").getField(c)).alias(c) for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its slot and shard."""
    return sharding.place(docs, SHARDS)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("source mix", mix),
    ("sharding", shard),
]

#: The first stage is a trained model, so no SQL gives the rows; tests compare each stage with a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's rows stored and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
