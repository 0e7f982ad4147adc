"""Exact stratified splits, balanced weights and budget targeting."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyshore.functions.columns import exact_share, rank_at, stable_hash
from tallyshore.operators.ordered import hash_cuts, pin_small, values_at_ranks

SALT = "42"
CHURN_SHARES = {"train": 0.6, "validation": 0.2, "test": 0.2}
TOPIC_SHARES = {"train": 0.8, "test": 0.2}


def stratified_split(
    df: DataFrame,
    id_col: str,
    stratum: str,
    shares: Mapping[str, float] = CHURN_SHARES,
    salt: str = SALT,
) -> DataFrame:
    """Adds ``split``. Within each stratum, ids are ranked by hash and cut at the shares.

    Part sizes are exact to one row (each cut is rounded up) for any shares that
    add up to 1, and depend on the ids alone. Runs three small jobs for the cut points;
    the returned frame then compares hashes and does not shuffle the rows.
    """
    names = list(shares)
    exact = [exact_share(shares[name]) for name in names]
    if sum(exact) != 1:
        raise ValueError(f"shares must add up to 1, not {float(sum(exact))}")
    cuts = {name: rank_at(sum(exact[:i + 1]), "n") for i, name in enumerate(names[:-1])}
    hashed = df.withColumn("_hash", stable_hash(salt, id_col))
    limits = pin_small(hash_cuts(hashed.select(stratum, "_hash"), "_hash", stratum, cuts))
    limits = limits.select(F.col(stratum).alias("_stratum"),
                           *[F.col(name).alias(f"_upto_{name}") for name in cuts])
    part = F.lit(names[-1])
    for name in reversed(names[:-1]):
        part = F.when(F.col("_hash") <= F.col(f"_upto_{name}"), name).otherwise(part)
    joined = hashed.join(limits, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    return joined.select(*df.columns, part.alias("split"))


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """label, rows, weight, where weight = n / (classes * rows), so classes weigh the same."""
    counts = pin_small(df.groupBy(label).agg(F.count("*").alias("rows")))
    whole = Window.partitionBy(F.lit(0))  # one row per class
    total, classes = F.sum("rows").over(whole), F.count("*").over(whole)
    return counts.withColumn("weight", total / (classes * F.col("rows")))


def with_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Adds the balanced class weight of each row."""
    weights = pin_small(balanced_weights(df, label).select(label, F.col("weight").alias(name)))
    return df.join(weights, label)


def top_share(
    scored: DataFrame, id_col: str, score: str, share: float = 0.2, salt: str = SALT
) -> DataFrame:
    """The ``ceil(share * n)`` rows with the highest score; ties go by hashed id.

    The limit is found by bracketing its rank, without a sort; if the score there is
    shared, so is the limit among the hashes of its rows. The rows are then only compared.
    """
    share_, found = exact_share(share), {}

    def rank(n: int) -> list[int]:
        found["n"] = n
        found["wanted"] = -(-share_.numerator * n // share_.denominator)
        return [n - found["wanted"] + 1] if found["wanted"] else []

    (limits,) = values_at_ranks(scored.select(score), {score: rank}).values()
    if not limits:
        return scored.limit(0)
    limit = F.lit(limits[0])
    hashed = scored.withColumn("_hash", stable_hash(salt, id_col))
    above, at = scored.agg(F.count_if(F.col(score) > limit), F.count_if(F.col(score) == limit)).first()
    need = found["wanted"] - above
    if need == at:
        return scored.filter(F.col(score) >= limit)
    tied = hashed.filter(F.col(score) == limit).select(
        "_hash", F.conv(F.substring("_hash", 1, 15), 16, 10).cast("long").alias("_head"))
    (heads,) = values_at_ranks(tied, {"_head": lambda n: [need]}).values()
    earlier = tied.filter(F.col("_head") < heads[0]).count()
    # rows that share 60 bits of their hash: one, but for chance
    last = tied.filter(F.col("_head") == heads[0]).orderBy("_hash").limit(need - earlier).agg(F.max("_hash")).first()[0]
    chosen = (F.col(score) > limit) | ((F.col(score) == limit) & (F.col("_hash") <= last))
    return hashed.filter(chosen).drop("_hash")
