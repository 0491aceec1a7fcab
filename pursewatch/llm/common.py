"""Helpers that several of the text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pursewatch.scratch import scratch_path

#: What separates words, and a word, as the operators' contracts spell them.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def key60(value: Column) -> Column:
    """A uniform number below 2**60 from a value's text; null counts as the empty text.

    From MD5, so that any engine can repeat it.
    """
    digest = F.md5(F.coalesce(value.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    Later steps do not recompute it, and it outlives any executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """The name, or a longer one that no column of the frame has in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
