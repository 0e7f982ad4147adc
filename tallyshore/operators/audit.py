"""Row counts, value counts, ranges and null audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, rows."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    counts = df.groupBy(column).agg(F.count("*").alias("rows"))
    ordered = counts.orderBy(F.desc("rows"), column)
    return ordered if top is None else ordered.limit(top)


def date_range(df: DataFrame, column: str = "created_at") -> DataFrame:
    return df.agg(F.min(column).alias("first_order"), F.max(column).alias("last_order"))


def null_audit(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """table_name, column_name, rows, nulls; one scan per table."""
    parts = []
    for name, (df, columns) in tables.items():
        counts = df.agg(F.count("*").alias("rows"),
                        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls"))
                          for c in columns])
        parts.append(counts.select(F.lit(name).alias("table_name"), "rows", F.inline(cells)))
    return reduce(DataFrame.unionByName, parts).select(
        "table_name", "column_name", "rows", "nulls")


def coverage(df: DataFrame, column: str = "narrative") -> DataFrame:
    """rows, and rows in which the column has a value."""
    return df.agg(F.count("*").alias("rows"), F.count(column).alias("with_value"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias("distinct_values"))
