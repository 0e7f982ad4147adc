"""Parallel reading of CSV files whose quoted texts contain newlines.

Spark's own reader gives such a file to one task. Here lines are read in
splits. What a line does to the state, inside or outside of quotes, follows from
the line alone: it leaves it, flips it, or sets it. The last line that sets it and
the flips since then tell which lines start a record. Each split is judged for both
states by itself; the splits before it then pick the right one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyshore.schemas import COMPLAINT_COLUMNS
from tallyshore.sources.readers import CORRUPT, name_complaint_columns


# A quoted field: it opens where a field starts, and closes before a comma or the end of the line.
_QUOTED = r'(^|,)"(?:[^"]++|""|"(?!,|\r?$))*+"(?=,|\r?$)'
_OPEN = '(^|,)"'


def _inside_after(line: Column) -> Column:
    """1 if a line that starts outside of quotes ends inside of them, else 0."""
    return F.regexp_like(F.regexp_replace(line, _QUOTED, "$1"), F.lit(_OPEN)).cast("int")


def stage_lines(spark: SparkSession, path: str, staging: str) -> DataFrame:
    """Writes the lines once, with their split and position, and reads them back.

    Later steps read this table, so they cannot see other splits than the first
    pass did. ``sets`` is the state behind a line that doesn't depend on the one
    before it, else null; ``flips`` is 1 if the line changes the state.
    """
    from_outside = _inside_after(F.col("line"))
    from_inside = _inside_after(F.concat(F.lit('"'), F.col("line")))
    (
        spark.read.option("lineSep", "\n").text(path)
        .select(F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("seq"),
                F.col("value").alias("line"))
        .withColumns({"out": from_outside, "in": from_inside})
        .withColumn("sets", F.when(F.col("out") == F.col("in"), F.col("out")))
        .withColumn("flips", (F.col("out") > F.col("in")).cast("int")).drop("out", "in")
        .write.mode("overwrite").parquet(staging)
    )
    return spark.read.parquet(staging)


def _state(order: Window, start: Column) -> Column:
    """The state before each row: the last one set earlier, or ``start``, and the flips since then."""
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    return (F.coalesce(F.last("_set", ignorenulls=True).over(earlier), start)
            + F.coalesce(F.sum("flips").over(earlier), F.lit(0))) % 2


def csv_records(lines: DataFrame) -> DataFrame:
    """file, record, text: one row per CSV record, without each file's header.

    Raises ValueError if a file ends inside of quotes.
    """
    here = ["file", "block"]
    in_block = Window.partitionBy(*here).orderBy("seq")
    upto = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # what a line sets, less the flips so far, so that later flips can be added from the start
    local = lines.withColumn("_set", (F.col("sets") + F.sum("flips").over(upto)) % 2)
    local = local.withColumns({"state_0": _state(in_block, F.lit(0)), "state_1": _state(in_block, F.lit(1))})

    in_file = Window.partitionBy("file").orderBy("block")
    blocks_before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    blocks_upto = in_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = (  # one row per split
        local.groupBy(*here).agg(
            F.max_by("_set", F.when(F.col("_set").isNotNull(), F.col("seq"))).alias("_own"),
            F.sum("flips").alias("flips"), F.min("seq").alias("_first"),
            F.max(F.when(F.col("state_0") == 0, F.col("seq"))).alias("_start_if_0"),
            F.max(F.when(F.col("state_1") == 0, F.col("seq"))).alias("_start_if_1"))
        .withColumn("_so_far", F.coalesce(F.sum("flips").over(blocks_before), F.lit(0)))
        .withColumn("_set", (F.col("_own") + F.col("_so_far")) % 2)
        .withColumn("start", _state(in_file, F.lit(0)))
        .withColumn("end", (F.coalesce(F.last("_set", ignorenulls=True).over(blocks_upto), F.lit(0))
                            + F.col("_so_far") + F.col("flips")) % 2)
        .withColumn("_last_start", F.when(F.col("start") == 0, F.col("_start_if_0"))
                    .otherwise(F.col("_start_if_1")))
        .select(*here, "start", "end",
                F.last("_last_start", ignorenulls=True).over(blocks_before).alias("carried"),
                F.first("_first").over(in_file).alias("header"))
    )
    unclosed = blocks.groupBy("file").agg(F.max_by("end", "block").alias("end")).filter("end = 1").first()
    if unclosed:
        raise ValueError(f"{unclosed['file']} ends inside of quotes: read it with the one-task reader")
    outside = F.when(F.col("start") == 0, F.col("state_0")).otherwise(F.col("state_1")) == 0
    starts = F.when(outside, F.col("seq"))
    parts = F.array_sort(F.collect_list(F.struct("block", "seq", "line")))
    return (
        local.join(blocks, here)
        .withColumn("record", F.coalesce(F.max(starts).over(upto), F.col("carried")))
        .filter("record <> header")
        .groupBy("file", "record")
        .agg(F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("text"))
        .withColumn("text", F.regexp_replace("text", "\r$", ""))
        .filter("text <> ''")
    )


def parse_records(
    records: DataFrame, columns: Sequence[str], types: Sequence[str], keep_corrupt: bool = False
) -> DataFrame:
    """Fields of the records by position; unreadable ones become null."""
    fields = [f"`{c}` {t}" for c, t in zip(columns, types)] + [f"`{CORRUPT}` string"]
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true",
               "columnNameOfCorruptRecord": CORRUPT}
    parsed = records.select(F.from_csv("text", ", ".join(fields), options).alias("row")).select("row.*")
    return parsed if keep_corrupt else parsed.drop(CORRUPT)


def wrong_headers(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``file, header`` of the files whose first line doesn't name exactly ``columns``, in their order.

    Every file is judged by itself and where its lines are. A byte order mark, a
    carriage return at the end, and quotes around names make no difference.
    """
    first = lines.groupBy("file").agg(F.min_by("line", "seq").alias("header"))
    plain = F.regexp_replace(F.regexp_replace("header", "^\ufeff", ""), "\r$", "")
    # a word behind the last name shows that there is none more, also no empty one
    expected = [*columns, "end"]
    fields = ", ".join(f"_{i} string" for i in range(len(expected)))
    parsed = F.from_csv(F.concat(plain, F.lit(",end")), fields, {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    same = F.lit(True)
    for i, column in enumerate(expected):
        same = same & parsed[f"_{i}"].eqNullSafe(F.lit(column))
    return first.filter(~F.coalesce(same, F.lit(False)))


def read_complaints_split(
    spark: SparkSession, path: str, staging: str, keep_corrupt: bool = False
) -> DataFrame:
    """Like ``read_complaints_csv``, with all executors on one file.

    A quote counts as one only where a field starts or ends, as in Spark's own
    reader, so that bare quotes inside of fields do no harm. The header of every
    file is compared with the expected one.
    """
    lines = stage_lines(spark, path, staging)
    wrong = wrong_headers(lines, list(COMPLAINT_COLUMNS)).orderBy("file").first()
    if wrong:
        raise ValueError(f"unexpected header in {wrong['file']}: {wrong['header']}")
    types = ["bigint" if c == "Complaint ID" else "string" for c in COMPLAINT_COLUMNS]
    return name_complaint_columns(
        parse_records(csv_records(lines), list(COMPLAINT_COLUMNS), types, keep_corrupt))
