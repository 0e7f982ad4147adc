"""Complaint texts: cleaning, deduplication, sampling and monthly counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshore.functions.columns import in_sample, squeeze_text, stable_hash
from tallyshore.schemas import PRODUCT_RENAMES, US_STATES

SALT = "42"
MIN_CHARS = 100


def usable(complaints: DataFrame, states: Sequence[str] | None = None) -> DataFrame:
    """Rows with a text, a product and a known state code."""
    return complaints.filter(
        F.col("narrative").isNotNull() & F.col("product").isNotNull()
        & F.col("state").isin(*(states or US_STATES)))


def newest_per_key(df: DataFrame, key: str, newest: str) -> DataFrame:
    """One row per key: the newest, then the one with the largest content hash.

    An aggregate, so copies of one key are merged before the shuffle and never
    gather in one task.
    """
    rest = [c for c in df.columns if c != key]
    content = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rest]))
    return (
        df.groupBy(key)
        .agg(F.max(F.struct(F.col(newest).alias("_newest"), content.alias("_content"),
                            F.struct(*rest).alias("_row"))).alias("_best"))
        .select(key, "_best._row.*")
        .select(*df.columns)
    )


def clean_complaints(
    complaints: DataFrame,
    states: Sequence[str] | None = None,
    min_chars: int = MIN_CHARS,
    legacy_regex: bool = False,
) -> DataFrame:
    """Usable rows with tidied text of at least ``min_chars``, one per complaint_id.

    Tidying never lengthens a text, so short ones leave before it. The tidied
    text comes out of an explode because a filter is not pushed through that:
    over a plain column the regexes would run in the filter and again after it.
    """
    long_enough = F.length("narrative") >= min_chars
    others = [c for c in complaints.columns if c != "narrative"]
    tidy = (
        usable(complaints, states).filter(long_enough)
        .select(*others, F.explode(F.array(squeeze_text("narrative", legacy_regex)))
                .alias("narrative"))
        .filter(long_enough)
        .select(*complaints.columns)
    )
    return newest_per_key(tidy, "complaint_id", "date_received")


def complaint_sample(cleaned: DataFrame, fraction: float = 0.10, salt: str = SALT) -> DataFrame:
    """A fixed share of complaints, chosen by the hash of the id: no shuffle."""
    return cleaned.filter(in_sample(salt, "complaint_id", fraction)).select(
        "complaint_id", "product", "state", "narrative")


def monthly_counts(cleaned: DataFrame) -> DataFrame:
    """state, product, month, complaint_count."""
    return cleaned.groupBy(
        "state", "product", F.date_trunc("month", "date_received").alias("month")
    ).agg(F.count("complaint_id").alias("complaint_count"))


def recode_products(df: DataFrame, renames: Mapping[str, str] = PRODUCT_RENAMES) -> DataFrame:
    """Old product names become the current ones."""
    return df.replace(dict(renames), subset=["product"])


def peek(sample: DataFrame, rows: int = 3, chars: int = 400, salt: str = "7") -> DataFrame:
    """A few random texts, shortened for display; the same ones every time."""
    return (
        sample.orderBy(stable_hash(salt, "complaint_id")).limit(rows)
        .select("complaint_id", "product", "state",
                F.substring("narrative", 1, chars).alias("narrative"))
    )
