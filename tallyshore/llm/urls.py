"""URL filter rules, matched by an equi-join on short hash prefixes. SQL functions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORT = 8  # hex digits of the digest that the join compares


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains if the URL's path starts with ``path``."""

    verdict: str
    host: str
    path: str


def split_url(url: str | Column) -> tuple[Column, Column]:
    """Host, A-Z lowered, and path as they stand; both empty without ``://``."""
    url = F.col(url) if isinstance(url, str) else url
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    # what is up to ? or # cannot hold either; the host then ends at the first slash
    clean = F.regexp_extract(rest, r"^[^?#]*", 0)
    host = F.substring_index(clean, "/", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, F.substring(clean, F.length(host) + 1, F.length(clean))


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = "allow",
          url: str = "url") -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` to every row.

    A URL's expressions are the last labels of its host with the first
    characters of its path, for the label counts and path lengths that occur in
    the rules, so that a long URL has no more of them than a short one. Each
    distinct host and path head is looked up once, however many pages share
    it: its expressions meet the rules on the first hex digits of their SHA-256,
    and whole digests confirm. The longest rule wins, then the longer host,
    then ``block``. Null URLs, and those without ``://``, have an empty host and get
    ``default``; repeated rows each keep their verdict, and an empty table gives
    an empty result. Columns named like the new ones are replaced.
    """
    spark = pages.sparkSession
    host, path = split_url(url)
    rows = pages.withColumns({"host": host, "path": path})
    rows = rows.drop("rule", "verdict")
    shapes = sorted({(r.host.count(".") + 1, len(r.path)) for r in rules})
    head = F.substring(F.col("path"), 1, max((n for _, n in shapes), default=0))
    units = rows.select("host", head.alias("head")).distinct()
    labels = F.size(F.split("host", r"\."))
    expressions = F.filter(F.array(*[
        F.when((labels >= k) & (F.length("head") >= n),
               F.concat(F.substring_index("host", ".", -k), F.substring("head", 1, n)))
        for k, n in shapes]), lambda e: e.isNotNull())
    probes = units.select("host", "head", F.explode(expressions).alias("expression"))
    probes = probes.withColumn("digest", F.sha2("expression", 256)).drop("expression")
    listed = spark.createDataFrame(
        [(r.host + r.path, len(r.host), r.verdict) for r in rules],
        "rule string, host_size int, verdict string")
    listed = listed.withColumn("rule_digest", F.sha2("rule", 256))
    # one number per rule, so that the best one is a maximum over longs: length, host, block first
    rank = (F.length("rule") * 1_000_000 + F.col("host_size") * 10
            + (F.col("verdict") == "block").cast("int")).cast("long")
    listed = listed.withColumn("rank", rank)
    found = (
        probes.join(listed, F.substring("digest", 1, SHORT) == F.substring("rule_digest", 1, SHORT))
        .filter("digest = rule_digest")
        .groupBy("host", "head")
        .agg(F.max_by("rule", "rank").alias("rule"), F.max_by("verdict", "rank").alias("verdict"))
        .select(F.col("host").alias("__host"), F.col("head").alias("__head"), "rule", "verdict",
                F.xxhash64("host", "head").alias("__hash"))
    )
    # the hash as a further key has both sides shuffled for the join, so that
    # adaptive execution can split the pages of a frequent host
    same = ((F.xxhash64(F.col("host"), head) == F.col("__hash"))
            & (F.col("host") == F.col("__host")) & (head == F.col("__head")))
    return rows.join(found, same, "left").select(
        *[F.col(f"`{c}`") for c in rows.columns], "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"))
