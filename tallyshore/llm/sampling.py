"""Bounded samples of labelled and unlabelled rows, for fitting models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshore.llm.common import held_out

SAMPLE = 20_000  # rows of a kind that a model is fitted on, about


def _share(seed: str) -> Column:
    return (F.xxhash64(F.lit(seed), "doc_id") / F.lit(2.0 ** 64)) + 0.5


def thin(rows: DataFrame, bound: int, seed: str) -> DataFrame:
    """All rows, or about ``bound`` of them by a hash of their id; counts them once."""
    count = rows.count()
    return rows if count <= bound else rows.filter(_share(seed) < bound / count)


def labelled(labels: DataFrame, column: str, bound: int = SAMPLE) -> DataFrame:
    """``doc_id, label`` of the learning fold, one row per id, at most about ``bound``.

    Null ids and labels are left out, and so are labels other than 0 and 1; of
    several labels of an id the larger one counts. The bound makes it safe to
    broadcast: 12 bytes a row.
    """
    usable = labels.select("doc_id", F.col(column).cast("int").alias("label")).filter(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("doc_id"))
    return thin(usable.groupBy("doc_id").agg(F.max("label").alias("label")), bound, column)
