"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyshore.llm.common import Scratch

WORD = r"[^\x20\x09-\x0D]+"
CYCLE, EPOCHS = 3, 3  # weights 1, 2, 3, repeating; a source counts three times at most


def word_count(text: str | Column) -> Column:
    """Runs without ASCII white space; null has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """Adds ``weight`` and ``target`` to one row per source (``source, source_size``).

    Sources in the order of their code points, null last, weigh 1, 2, 3, 1, ...
    and share the sum of all sizes. A target stops at ``epochs`` times its
    source; what is over goes to the others by weight. Sources reach their
    limit in the order of size per weight. Taking one more source to be full
    raises the level as long as it is, and lowers it from the first one on that
    isn't, so the water level is the highest of them. The windows hold one row
    per source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weighed = sizes.withColumn("weight", ((F.row_number().over(order) - 1) % CYCLE + 1).cast("long"))
    # size per weight in whole numbers: weights divide 6
    full = Window.orderBy(F.expr("source_size * 6 div weight"), F.col("source").isNull(), "source")
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("source_size").over(everything)
    capped = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * epochs
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = (total - capped).cast("double") / weights
    found = weighed.withColumn("level", level).withColumn("highest", F.max("level").over(everything))
    return found.select(
        "source", "source_size", "weight",
        F.least(F.col("highest") * F.col("weight"), (epochs * F.col("source_size")).cast("double")).alias("target"))


def draw(seed: str = "mix") -> Column:
    """A document's place in the seeded order in which its source is sampled."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def sized(docs: DataFrame, seed: str = "mix") -> DataFrame:
    return docs.select("doc_id", "source", word_count("text").alias("size"), draw(seed).alias("draw"))


def _running(rows: DataFrame, key: str) -> DataFrame:
    """Sizes per source and key, with the sum of those before."""
    so_far = Window.partitionBy("source").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.groupBy("source", key).agg(F.sum("size").alias("here"))
    return summed.withColumn("before", F.coalesce(F.sum("here").over(so_far), F.lit(0)))


def plan(sizes: DataFrame, scratch: Scratch, epochs: int = EPOCHS) -> DataFrame:
    """Per source: target, whole repetitions, and the draw ``cut`` with the rest.

    ``sizes`` is read several times and should be a written table. Documents
    that come before ``cut`` in the seeded order are taken once more; of those
    at ``cut``, ``part`` of ``cut_size`` words. The cut is found in two steps,
    by the first digits of the draws and then within the one prefix that
    holds it, either with about the square root of the rows of a source.
    """
    by_source = targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), epochs)
    words = F.round("target").cast("long")
    sources = scratch.keep(
        by_source.withColumn("words", words)
        .withColumn("whole", F.coalesce(F.expr("words div nullif(source_size, 0)"), F.lit(0)).cast("long"))
        .withColumn("rest", F.col("words") - F.col("whole") * F.col("source_size")), "sources")
    digits = 1
    while 16 ** (2 * digits) < sizes.count():
        digits += 1
    heads = sizes.withColumn("head", F.substring("draw", 1, digits))
    wanted = sources.select(F.col("source").alias("of"), "rest").filter("rest > 0")
    inside = (F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("here"))
    prefix = scratch.keep(
        _running(heads, "head").join(wanted, F.col("source").eqNullSafe(F.col("of")))
        .filter(inside).select("of", F.col("head").alias("at"), F.col("before").alias("passed"), "rest"),
        "prefixes")
    near = heads.join(prefix, F.col("source").eqNullSafe(F.col("of")) & (F.col("head") == F.col("at")))
    cuts = (
        _running(near.select("source", "draw", "size"), "draw")
        .join(prefix, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("before", F.col("before") + F.col("passed")).filter(inside)
        .select("of", F.col("draw").alias("cut"), (F.col("rest") - F.col("before")).alias("part"),
                F.col("here").alias("cut_size"))
    )
    return scratch.keep(
        sources.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left")
        .select(F.col("source").alias("_of"), "source_size", "target", "whole", "cut", "part", "cut_size"),
        "plan")


def take(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Adds the plan and ``taken`` to rows with ``source``, ``size`` and ``draw``; no shuffle while the plan is small."""
    extra = (
        F.when(F.col("draw") < F.col("cut"), F.col("size"))
        .when(F.col("draw") == F.col("cut"), F.expr("size * part div cut_size")).otherwise(0)
    )
    joined = rows.join(planned, F.col("source").eqNullSafe(F.col("_of")))
    return joined.withColumn("taken", (F.col("whole") * F.col("size") + extra).cast("long")).drop("_of")


def mix(docs: DataFrame, epochs: int = EPOCHS, seed: str = "mix") -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every document.

    Size counts words; a null text has none and is never taken. A source's
    taken words add up to its rounded target: all its documents are repeated
    as often as fits as a whole, the first ones in a seeded order once more,
    and the one document at the end of those for the fraction that is left.
    Rows that share an id share its place and split that fraction, rounded
    down. Null is a source of its own. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    rows = scratch.keep(sized(docs, seed), "sizes")
    return take(rows, plan(rows, scratch, epochs)).select(
        "doc_id", "source", "size", "source_size", "target", "taken")


def materialize(docs: DataFrame, epochs: int = EPOCHS, seed: str = "mix", whole: bool = False) -> DataFrame:
    """The mixed documents themselves, with the columns of ``docs``.

    A document stands once per whole repetition. A fractional one has the first
    ``taken mod size`` words of the text, joined by single spaces. With ``whole`` no
    text is cut: it stands once more if at least half of it is wanted, so that a
    source misses its target by half a document at most. ``n_chars``, if
    there, follows the text.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    rows = scratch.keep(sized(docs, seed), "sizes")
    keyed = docs.select(
        "source", word_count("text").alias("size"), draw(seed).alias("draw"), F.struct("*").alias("doc"))
    more = F.when(F.col("draw") < F.col("cut"), 1).when(
        (F.col("draw") == F.col("cut")) & (2 * F.col("part") >= F.col("cut_size")), 1).otherwise(0)
    copies = F.col("whole") + more if whole else F.ceil(F.col("taken") / F.nullif(F.col("size"), F.lit(0)))
    taken = take(keyed, plan(rows, scratch, epochs)).filter("size > 0").withColumn("copies", copies).filter("copies > 0")
    each = taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    left = F.col("taken") - (F.col("copy") - 1) * F.col("size")
    words = F.regexp_extract_all(F.col("doc.text"), F.lit(WORD), 0)
    text = F.col("doc.text") if whole else F.when(left >= F.col("size"), F.col("doc.text")).otherwise(
        F.array_join(F.slice(words, 1, left.cast("int")), " "))
    columns = {c: F.col(f"doc.`{c}`") for c in docs.columns} | {"text": text}
    if "n_chars" in columns:
        columns["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return each.select(*[column.alias(c) for c, column in columns.items()])
