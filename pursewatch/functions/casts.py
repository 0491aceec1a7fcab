"""Casts from untrusted text: a value that does not parse becomes NULL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from pursewatch.model import MONEY, MYR_RATE


def to_text(c: Column) -> Column:
    return c.cast("string")


def _rounded(c: Column) -> Column:
    # '1.5' and '1e3' count as whole numbers after rounding half away from zero; decimals past the
    # tenth are cut and not rounded, as they cannot lift a fraction to one half
    cut = F.regexp_replace(c.cast("string"), r"^(\s*[+-]?\d*\.\d{10})\d+(\s*)$", "$1$2")
    return F.round(cut.try_cast("decimal(38,10)"))


def _whole(c: Column, kind: str) -> Column:
    # text that a whole number is written as needs no decimals, which cost several times as much
    text = c.cast("string")
    plain = text.try_cast(kind)
    return F.when(plain.cast("string") == text, plain).otherwise(_rounded(text).try_cast(kind))


def to_bigint(c: Column) -> Column:
    return _whole(c, "bigint")


def to_int(c: Column) -> Column:
    return _whole(c, "int")


def to_double(c: Column) -> Column:
    # Spark also reads the Java suffixes of '1.5d' and '2f'; those are not numbers here
    java_literal = c.cast("string").rlike(r"[0-9.][dDfF]\s*$")
    return F.when(~java_literal, c.try_cast("double"))


def to_money(c: Column) -> Column:
    return F.round(c.try_cast(MONEY), 2).cast(MONEY)


def to_myr(amount: Column) -> Column:
    """Amount in MYR; decimal throughout, so no binary rounding."""
    return F.round(to_money(amount) * F.lit(MYR_RATE), 2).try_cast(MONEY)


def to_boolean(c: Column) -> Column:
    return c.try_cast("boolean")


def to_timestamp(c: Column) -> Column:
    """Timestamp without zone. Bare years and months, which Spark would accept, are not."""
    text, time = c.cast("string"), c.try_cast("timestamp_ntz")
    # what parses with dashes at these places begins with a whole date, as 2024-01-31 does
    usual = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    return F.when(usual, time).when(text.rlike(r"^\s*[+-]?\d+-\d{1,2}-\d{1,2}"), time)


CASTS: dict[str, Callable[[Column], Column]] = {
    "string": to_text,
    "bigint": to_bigint,
    "int": to_int,
    "double": to_double,
    "money": to_money,
    "myr": to_myr,
    "boolean": to_boolean,
    "timestamp": to_timestamp,
}
