"""Sinks: parquet layers, served tables, JSON metrics."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whichever file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """Overwrites ``path`` and returns what was written, read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def parquet_once(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Builds and writes ``path`` unless an earlier run has completed it."""
    if not exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_tables(tables: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Writes named tables in the given order, dimensions before facts."""
    return {name: write_parquet(df, f"{folder}/{name}") for name, df in tables.items()}


def read_tables(spark: SparkSession, folder: str, names) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def write_jdbc(tables: Mapping[str, DataFrame], url: str, mode: str = "append",
               writers: int = 8, **properties: str) -> None:
    """Loads named tables into a database in the given order, 1000 rows per batch.

    At most ``writers`` connections are opened at a time.
    """
    for name, df in tables.items():
        (df.write.mode(mode).option("batchsize", 1000).option("numPartitions", writers)
         .jdbc(url, name, properties=properties))


def register(tables: Mapping[str, DataFrame]) -> None:
    """Makes tables readable by name in SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def write_json(df: DataFrame, path: str) -> None:
    """Small reports such as model metrics: one file of JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)
