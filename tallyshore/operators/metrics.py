"""Exact model metrics as grouped aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyshore.functions.columns import equal_width_bin
from tallyshore.operators.ordered import pin_small, running_totals


def ranking_metrics(
    scored: DataFrame,
    label: str = "label",
    score: str = "probability",
    by: Sequence[str] = (),
    digits: int | None = 4,
) -> DataFrame:
    """roc_auc and pr_auc (average precision), one row per group of ``by``.

    Rows are counted per distinct score first, so tied scores form one step of
    the curve. The rank sum is kept in whole numbers. With one class only,
    roc_auc is null; without positives pr_auc is 0.
    """
    by = list(by)
    steps = scored.groupBy(*by, score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    curve = running_totals(steps, score, ["pos", "neg"], by=by, descending=True, raw=scored)
    whole = "decimal(38,0)"
    pairs = F.col("neg").cast(whole) * (2 * F.col("cum_pos") - F.col("pos")).cast("decimal(19,0)")
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    gain = F.try_divide(F.col("pos"), F.col("all_pos"))
    result = curve.groupBy(*by).agg(
        F.sum(pairs.cast(whole)).alias("_pairs"), F.sum(gain * precision).alias("_ap"),
        F.max("all_pos").alias("_p"), F.max("all_neg").alias("_n"))
    auc = F.try_divide(
        F.col("_pairs").cast("double"), 2 * F.col("_p").cast("double") * F.col("_n").cast("double"))
    ap = F.coalesce(F.col("_ap"), F.lit(0.0))
    if digits is not None:
        auc, ap = F.round(auc, digits), F.round(ap, digits)
    return result.select(*by, auc.alias("roc_auc"), ap.alias("pr_auc"))


def confusion_counts(
    predicted: DataFrame, label: str = "label", prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """actual, predicted, rows: one row per pair that occurs."""
    return predicted.groupBy(
        *by, F.col(label).alias("actual"), F.col(prediction).alias("predicted")
    ).agg(F.count("*").alias("rows"))


def classification_report(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """precision, recall, f1, support per class, then accuracy, macro and weighted rows.

    Works on the confusion counts, so it never touches the predictions again.
    Undefined ratios count as 0. Accuracy is repeated in the three ratio columns.
    """
    by = list(by)
    names = F.inline(F.array(
        F.struct(F.col("actual").cast("string").alias("name"), F.col("rows").alias("support"),
                 F.lit(0).cast("long").alias("guessed"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("rows"))
                 .otherwise(0).cast("long").alias("hits")),
        F.struct(F.col("predicted").cast("string").alias("name"),
                 F.lit(0).cast("long").alias("support"),
                 F.col("rows").alias("guessed"), F.lit(0).cast("long").alias("hits"))))

    def ratio(a, b):
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))

    classes = (
        confusion.select(*by, names).groupBy(*by, "name")
        .agg(*[F.sum(c).alias(c) for c in ("support", "guessed", "hits")])
        .withColumn("precision", ratio("hits", "guessed"))
        .withColumn("recall", ratio("hits", "support"))
        .withColumn("f1", F.coalesce(F.try_divide(
            2 * F.col("precision") * F.col("recall"),
            F.col("precision") + F.col("recall")), F.lit(0.0)))
    )
    scores = ("precision", "recall", "f1")
    totals = classes.groupBy(*by).agg(
        *[F.avg(c).alias(f"macro_{c}") for c in scores],
        *[F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"weighted_{c}")
          for c in scores],
        F.try_divide(F.sum("hits"), F.sum("support")).cast("double").alias("accuracy"),
        F.sum("support").alias("support"))

    def total(name, columns):
        return F.struct(F.lit(name).alias("name"),
                        *[F.col(source).alias(c) for source, c in zip(columns, scores)],
                        F.col("support"))

    summary = totals.select(*by, F.inline(F.array(
        total("accuracy", ["accuracy"] * 3),
        total("macro avg", [f"macro_{c}" for c in scores]),
        total("weighted avg", [f"weighted_{c}" for c in scores]))))
    return classes.select(*by, "name", *scores, "support").unionByName(summary)


def macro_f1(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    report = classification_report(confusion, by)
    return report.filter("name = 'macro avg'").select(*by, F.col("f1").alias("macro_f1"))


def histogram(
    df: DataFrame, value: str, bins: int, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """bin, low, high, rows, density: equal-width bins over each group's own range.

    Empty bins are listed too. A group with a single value gets a bin range of
    one around it. Runs one job for the ranges.
    """
    by = list(by)
    amount = F.sum(weight) if weight else F.count("*")
    x = F.col(value).cast("double")
    ranges = df.groupBy(*by).agg(F.min(x).alias("_low"), F.max(x).alias("_high"),
                                 amount.alias("_all")).filter(F.col("_low").isNotNull())
    flat = F.col("_low") == F.col("_high")
    ranges = pin_small(ranges.select(
        *by, "_all",
        F.when(flat, F.col("_low") - 0.5).otherwise(F.col("_low")).alias("_low"),
        F.when(flat, F.col("_high") + 0.5).otherwise(F.col("_high")).alias("_high")))
    place = equal_width_bin(x, F.col("_low"), F.col("_high"), bins).alias("bin")
    if by:
        placed = df.join(ranges, by)
    else:
        low, high = (ranges.select("_low", "_high").first() or (None, None))
        placed = df.withColumns({"_low": F.lit(low).cast("double"), "_high": F.lit(high).cast("double")})
    counted = placed.withColumn("bin", place).groupBy(*by, "bin").agg(amount.alias("rows"))
    width = (F.col("_high") - F.col("_low")) / bins
    grid = ranges.select(*by, "_low", "_high", "_all",
                         F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    return grid.join(counted, [*by, "bin"], "left").select(
        *by, "bin",
        (F.col("_low") + (F.col("bin") - 1) * width).alias("low"),
        (F.col("_low") + F.col("bin") * width).alias("high"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
        (F.coalesce("rows", F.lit(0)) / (F.col("_all") * width)).alias("density"))


def held_out(scores: DataFrame, part: str = "test") -> DataFrame:
    return scores.filter(F.col("split") == part)


def ordered_report(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Classes by name, summary rows last."""
    last = F.col("name").isin("accuracy", "macro avg", "weighted avg")
    return report.orderBy(*by, last, "name")


def best_model(metrics: DataFrame, baseline: str) -> DataFrame:
    """The row with the highest roc_auc, the baseline left out; ties by name."""
    return metrics.filter(F.col("model") != baseline).orderBy(
        F.desc_nulls_last("roc_auc"), "model").limit(1)
