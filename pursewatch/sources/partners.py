"""Source tables of several partners."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

SUFFIXES = {"partner_a": "", "partner_b": "_partner_b"}  # fixed values


def source_name(table: str, partner: str, suffixes: Mapping[str, str] = SUFFIXES) -> str:
    return table + suffixes.get(partner.lower(), "")


def partner_frames(
    read: Callable[[str], DataFrame],
    table: str,
    partners: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Partner → source frame, where ``read`` opens a source table by name."""
    suffixes = SUFFIXES if partners is None else partners
    return {p.lower(): read(source_name(table, p, suffixes)) for p in suffixes}


def union_partners(frames: Mapping[str, DataFrame]) -> DataFrame:
    """All partners' rows with the partner's name; a column one partner lacks is NULL there."""
    tagged = [df.withColumn("source_partner", F.lit(p.lower())) for p, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
