"""Cutoff, churn label, and the evidence for the window length.

The cutoff lies ``window_days`` before the newest purchase in the data. A
customer with a purchase at or before it is in scope, and has churned if none
follows it. The scope and the label come from one pass: a customer's first
purchase decides the one, the last purchase the other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyshore.operators.ordered import pin_value
from tallyshore.schemas import ACTIVE_STATUSES

WINDOW_DAYS = 180


def purchases(orders: DataFrame, statuses: Sequence[str] = ACTIVE_STATUSES) -> DataFrame:
    """Orders that count as activity; an unknown or missing status does not."""
    return orders.filter(F.col("status").isin(*statuses))


def cutoff_frame(orders: DataFrame, window_days: int = WINDOW_DAYS) -> DataFrame:
    """One row: newest purchase minus the window, computed in the session time zone."""
    newest = F.max("created_at")
    return purchases(orders).agg(
        (newest - F.make_dt_interval(F.lit(window_days))).alias("cutoff"))


def cutoff_date(orders: DataFrame, window_days: int = WINDOW_DAYS) -> Column:
    """Runs ``cutoff_frame`` and returns a literal, which the scans can push down."""
    return pin_value(cutoff_frame(orders, window_days))


def first_and_last(orders: DataFrame) -> DataFrame:
    """First and last purchase per known customer."""
    return (
        purchases(orders).filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at"))
    )


def churned_flag(last_at: Column, cutoff: Column) -> Column:
    return F.when(last_at > cutoff, 0).otherwise(1)


def label_churn(orders: DataFrame, cutoff: Column) -> DataFrame:
    """user_id, churned: one row per customer with a purchase up to the cutoff."""
    return (
        first_and_last(orders).filter(F.col("first_at") <= cutoff)
        .select("user_id", churned_flag(F.col("last_at"), cutoff).alias("churned"))
    )


def window_sweep(orders: DataFrame, windows: Sequence[int] = (90, 180, 365)) -> DataFrame:
    """window_days, churned, retained, churn_rate: all windows from one pass."""
    latest = pin_value(purchases(orders).agg(F.max("created_at").alias("latest")))
    candidates = F.explode(F.array(*[F.lit(int(days)) for days in windows]))
    return (
        first_and_last(orders)
        .select("first_at", "last_at", candidates.alias("window_days"))
        .withColumn("cutoff", latest - F.make_dt_interval(F.col("window_days")))
        .filter("first_at <= cutoff")
        .groupBy("window_days")
        .agg(F.count_if(F.col("last_at") <= F.col("cutoff")).alias("churned"),
             F.count_if(F.col("last_at") > F.col("cutoff")).alias("retained"))
        .withColumn("churn_rate", F.try_divide("churned", F.col("churned") + F.col("retained")))
    )


def order_gaps(orders: DataFrame, slice_unit: str = "hour") -> DataFrame:
    """user_id, created_at, prev_order_at, gap_days: one row per repeat purchase.

    Orders of one customer and moment are first merged, and a customer's moments
    are cut into time slices: the moment before is found within the slice, or is
    the newest of the customer's last slice before it. So no window holds more
    than a slice's moments, or one row per slice. Of several orders at one moment
    the lowest id follows the moment before, and the others follow each other.
    """
    known = purchases(orders).filter(F.col("user_id").isNotNull()).select(
        "user_id", "created_at", "order_id")
    moments = (
        known.groupBy("user_id", "created_at").agg(F.min("order_id").alias("_first"))
        .withColumn("_slice", F.date_trunc(slice_unit, "created_at"))
    )
    carried = (
        moments.groupBy("user_id", "_slice").agg(F.max("created_at").alias("_newest"))
        .select("user_id", "_slice", F.lag("_newest").over(
            Window.partitionBy("user_id").orderBy("_slice")).alias("_carried"))
    )
    inside = Window.partitionBy("user_id", "_slice").orderBy("created_at")
    before = (
        moments.join(carried, ["user_id", "_slice"])
        .select("user_id", "created_at", "_first",
                F.coalesce(F.lag("created_at").over(inside), F.col("_carried")).alias("_before"))
    )
    follows = F.when(F.col("order_id") == F.col("_first"), F.col("_before"))
    return (
        known.join(before, ["user_id", "created_at"])
        .withColumn("prev_order_at", follows.otherwise(F.col("created_at")))
        .filter(F.col("prev_order_at").isNotNull())
        .select("user_id", "created_at", "prev_order_at",
                F.datediff("created_at", "prev_order_at").alias("gap_days"))
    )


def gap_counts(orders: DataFrame) -> DataFrame:
    """gap_days, gaps: how often each gap length occurs.

    A gap counts calendar days, so orders of one day lie 0 days apart and only
    the order of days matters: n orders on a day give n - 1 zero gaps and one gap
    to the day before. No window holds more than one row per customer and day,
    and the result has at most one row per day of the data's time span.
    """
    days = (
        purchases(orders).filter(F.col("user_id").isNotNull())
        .groupBy("user_id", F.to_date("created_at").alias("day"))
        .agg(F.count("*").alias("orders"))
    )
    before = F.lag("day").over(Window.partitionBy("user_id").orderBy("day"))
    return (
        days.withColumn("gap", F.datediff("day", before))
        .select(F.inline(F.array(
            F.struct(F.col("gap").alias("gap_days"),
                     F.when(F.col("gap").isNotNull(), 1).otherwise(0).cast("long").alias("n")),
            F.struct(F.lit(0).alias("gap_days"), (F.col("orders") - 1).alias("n")))))
        .filter("n > 0")
        .groupBy("gap_days").agg(F.sum("n").alias("gaps"))
    )


def gap_percentiles(
    orders: DataFrame, percents: Sequence[int] = (25, 50, 75, 80, 90, 95)
) -> DataFrame:
    """One row p25, p50, ...: the smallest gap that at least p percent do not exceed."""
    upto = Window.partitionBy(F.lit(0)).orderBy("gap_days").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = gap_counts(orders).select(  # one row per gap length
        "gap_days", F.sum("gaps").over(upto).alias("_upto"),
        F.sum("gaps").over(Window.partitionBy(F.lit(0))).alias("_all"))
    return ranked.agg(*[
        F.min(F.when(F.col("_upto") * 100 >= F.col("_all") * p, F.col("gap_days"))).alias(f"p{p}")
        for p in percents])


def gap_histogram(orders: DataFrame, bins: int = 80) -> DataFrame:
    """bin, low, high, gaps: equal-width bins over the range, empty ones too."""
    from tallyshore.operators.metrics import histogram

    return histogram(gap_counts(orders), "gap_days", bins, weight="gaps").select(
        "bin", "low", "high", F.col("rows").alias("gaps"))
