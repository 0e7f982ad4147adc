"""CSV and parquet readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshore.functions.columns import iso_date
from tallyshore.operators.features import home_users
from tallyshore.schemas import COMPLAINT_COLUMNS, complaint_schema, shop_schema

CORRUPT = "_corrupt_record"


def read_shop_csv(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A raw shop table. A row that does not fit the schema fails the job, and
    so does a header whose names differ."""
    df = spark.read.csv(path, schema=shop_schema(name), header=True, mode="FAILFAST",
                        enforceSchema=False)
    return repair_ids(df) if name == "events" else df


def repair_ids(df: DataFrame, column: str = "user_id") -> DataFrame:
    """Ids written as decimal text ("15495.0") become longs; null stays null."""
    return df.withColumn(column, F.col(column).cast("double").cast("long"))


def read_home_users(spark: SparkSession, path: str) -> DataFrame:
    return home_users(read_shop_csv(spark, "users", path))


def read_complaints_csv(
    spark: SparkSession, path: str, keep_corrupt: bool = False
) -> DataFrame:
    """Complaints with quoted texts that contain commas, newlines and doubled quotes.

    Rows that do not parse are kept with nulls; ``keep_corrupt`` adds their raw
    text. One task reads one file: see ``sources.multiline`` for large files.
    """
    schema = complaint_schema()
    if keep_corrupt:
        schema = schema.add(CORRUPT, "string")
    df = spark.read.csv(path, schema=schema, header=True, multiLine=True, quote='"', escape='"',
                        mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
                        enforceSchema=False)
    return name_complaint_columns(df)


def name_complaint_columns(df: DataFrame) -> DataFrame:
    """Our column names, and the received date as a date."""
    return df.withColumnsRenamed(COMPLAINT_COLUMNS).withColumn(
        "date_received", iso_date("date_received"))


def quarantine(complaints: DataFrame) -> DataFrame:
    """Raw text of the rows that did not parse (read with ``keep_corrupt``)."""
    return complaints.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def load_check(df: DataFrame) -> DataFrame:
    """rows and a fingerprint that does not depend on row order.

    The fingerprint reads every column, so a FAILFAST source really parses every
    value; a bare count would not.
    """
    return df.agg(F.count("*").alias("rows"),
                  F.bit_xor(F.xxhash64(*df.columns)).alias("fingerprint"))


def missing_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows without a key, which the CSV reader lets through."""
    return df.filter(F.col(key).isNull())
