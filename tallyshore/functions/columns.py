"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

# Redaction blocks with the digits and slashes that follow them,
# and runs of whitespace. The legacy pair is what a doubled backslash in a raw string means to the regex
# engine; it reproduces results computed that way.
REDACTION, SPACES = r"X{2,}[\d/]*", r"\s+"
LEGACY_REDACTION, LEGACY_SPACES = r"X{2,}[\\d/]*", r"\\s+"


def stable_hash(salt: str, *keys: str | Column) -> Column:
    """Hex md5 of salt and keys: the same on any partitioning and any engine."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", F.lit(salt), *[p.cast("string") for p in parts]))


def in_sample(salt: str, key: str | Column, fraction: float) -> Column:
    """True for a fixed ``fraction`` of keys: 60 bits of the hash stay below that share of 2^60."""
    head = F.substring(stable_hash(salt, key), 1, 15)
    return F.conv(head, 16, 10).cast("long") < int(exact_share(fraction) * 2**60)


def exact_share(share: float) -> Fraction:
    """The decimal number that ``share`` is written as."""
    found = Fraction(repr(float(share)))
    if not 0 <= found <= 1:
        raise ValueError(f"a share must be from 0 to 1, not {share}")
    return found


def rank_at(share: Fraction, count: str) -> Column:
    """``ceil(share * count)``, in whole numbers."""
    up, down = share.numerator, share.denominator
    return F.expr(f"cast((cast({count} as decimal(19, 0)) * {up}BD + {down - 1}BD) div {down}BD as long)")


def squeeze_text(text: str | Column, legacy_regex: bool = False) -> Column:
    """Redaction blocks become a space, then whitespace runs become one space."""
    redaction, spaces = (LEGACY_REDACTION, LEGACY_SPACES) if legacy_regex else (REDACTION, SPACES)
    text = F.col(text) if isinstance(text, str) else text
    # a plain search is cheaper than the regex for texts without any block
    stripped = F.when(F.contains(text, F.lit("XX")), F.regexp_replace(text, redaction, " "))
    return F.regexp_replace(stripped.otherwise(text), spaces, " ")


def iso_date(text: str | Column) -> Column:
    """Date of an ISO timestamp or date; null for anything else."""
    return F.to_date(F.try_to_timestamp(text))


def age_group(age: str | Column) -> Column:
    age = F.col(age) if isinstance(age, str) else age
    return (
        F.when(age < 25, "under 25").when(age < 35, "25-34").when(age < 50, "35-49")
        .when(age.isNull(), "unknown").otherwise("50 plus")
    )


def date_key(day: str | Column) -> Column:
    """Smart integer key, 20230721 for 2023-07-21."""
    return (F.year(day) * 10_000 + F.month(day) * 100 + F.day(day)).cast("int")


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """1-based bin of ``value``; the last bin is closed, and a zero range is bin 1."""
    spot = F.floor((value - low) * bins / F.nullif(high - low, F.lit(0.0))) + 1
    return F.least(F.coalesce(spot, F.lit(1)), F.lit(bins)).cast("int")


def search_tree(value: Column, bounds: Sequence) -> Column:
    """How many of the sorted ``bounds`` are <= value, by binary search in one literal array.

    log2(n) steps per row; the generated code has the same size for any n.
    """
    if not bounds:
        return F.pmod(F.hash(value), F.lit(1))  # 0, but no constant, so that it can be a join key
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    listed = F.lit(list(bounds)) if not hasattr(bounds[0], "isoformat") else F.array(*map(F.lit, bounds))
    return F.aggregate(
        F.lit(steps), F.lit(0),
        lambda at, step: F.when(
            (at + step <= len(bounds)) & (F.get(listed, at + step - 1) <= value), at + step).otherwise(at))
