"""Exact ranks and running totals over a whole table, without one global window.

Rows are put into buckets by a rule that depends on the row alone (literal
bounds, or the first digits of a hash). Bucket totals are few, so their running
sum is cheap; the rest is local to a bucket. A retried task finds the same
buckets again, so nothing has to be pinned in place between the steps.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyshore.functions.columns import search_tree

PIN_ROWS = 50_000


def pin_small(df: DataFrame, max_rows: int = PIN_ROWS) -> DataFrame:
    """Runs ``df`` and returns it as a local relation if it has at most ``max_rows``.

    Catalyst then knows the exact size and picks the broadcast itself. A larger
    result comes back as it was, for an ordinary shuffled join.
    """
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows:
        return df
    return df.sparkSession.createDataFrame(table, df.schema)


def pin_value(df: DataFrame) -> Column:
    """Runs a one-row, one-column query and returns its value as a typed literal.

    The text form keeps wall-clock values out of the Python process's time zone.
    """
    (field,) = df.schema.fields
    row = df.select(F.col(field.name).cast("string")).first()
    return F.lit(row[0] if row else None).cast(field.dataType)


def bucket_count(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def quantile_bounds(df: DataFrame, column: str, buckets: int) -> list:
    """Runs one scan; bounds that cut ``df`` into about equal buckets."""
    shares = [i / buckets for i in range(1, buckets)]
    (found,) = df.agg(F.percentile_approx(column, shares, max(10_000, 10 * buckets))).first()
    return sorted(set(found)) if found else []


def text_bounds(df: DataFrame, column: str, buckets: int, each: int = 50) -> list[str]:
    """Runs two scans; bounds that cut distinct texts into about equal buckets.

    They come from about ``each`` texts a bucket, chosen by hash, so that the same ones
    are chosen every time.
    """
    count = df.count()
    share = min(1.0, each * buckets / max(1, count))
    some = df.filter((F.xxhash64(column) / F.lit(2.0**64)) + 0.5 < share) if share < 1 else df
    found = sorted((r[0] for r in some.select(column).distinct().collect() if r[0] is not None),
                   key=lambda text: text.encode())
    return sorted({found[len(found) * i // buckets] for i in range(1, buckets)}, key=lambda t: t.encode()) if found else []


def values_at_ranks(
    df: DataFrame, ranks: Mapping[str, Callable[[int], Sequence[int]]], most: int = 100_000, margin: float = 0.0005,
) -> dict[str, list]:
    """The exact values at some 1-based ranks of the sorted non-null values of each column.

    ``ranks`` maps a column to its ranks, as a function of how many values there are. Each
    round brackets the ranks of all columns by a mergeable quantile sketch, then
    counts what lies below and inside; no more than ``most`` distinct values of the last
    bracket, with their counts, reach the driver. There is no sort and no window.
    """
    counts = df.agg(*[F.count(c).alias(c) for c in ranks]).first()
    wanted = {c: list(of(counts[c])) if counts[c] else [] for c, of in ranks.items()}
    low: dict[str, object] = {}
    high: dict[str, object] = {}
    below, inside = dict.fromkeys(ranks, 0), {c: counts[c] for c in ranks}
    open_ = [c for c in ranks if wanted[c] and inside[c] > most]

    def within(c: str) -> Column:
        held = F.col(c).isNotNull()
        if c in low:
            held = held & (F.col(c) >= F.lit(low[c])) & (F.col(c) <= F.lit(high[c]))
        return held

    while open_:
        shares = {c: (max(0.0, (min(wanted[c]) - below[c]) / inside[c] - margin),
                      min(1.0, (max(wanted[c]) - below[c]) / inside[c] + margin)) for c in open_}
        spans = df.agg(*[F.percentile_approx(F.when(within(c), F.col(c)), list(shares[c]), 10_000).alias(c)
                         for c in open_]).first()
        cells = []
        for c in open_:
            a, b = F.lit(spans[c][0]), F.lit(spans[c][1])
            held = F.col(c).between(a, b)
            cells.append(F.struct(F.count_if(F.col(c) < a).alias("below"), F.count_if(held).alias("inside"),
                                  F.approx_count_distinct(F.when(held, F.col(c))).alias("different")).alias(c))
        found, left = df.agg(*cells).first(), []
        for c in open_:
            n, m = found[c]["below"], found[c]["inside"]
            if not (n < min(wanted[c]) and max(wanted[c]) <= n + m):
                margin *= 4  # beside the bracket, which the sketch's error makes next to impossible
                left.append(c)
                continue
            shrunk = m < inside[c]
            low[c], high[c], below[c], inside[c] = spans[c][0], spans[c][1], n, m
            if found[c]["different"] > most and shrunk and spans[c][0] != spans[c][1]:
                left.append(c)
        open_ = left
    usable = [c for c in ranks if wanted[c]]
    result: dict[str, list] = {c: [] for c in ranks}
    for c in usable:
        table = df.filter(within(c)).groupBy(c).agg(F.count("*").alias("rows")).toArrow()
        pairs = sorted(zip(table.column(0).to_pylist(), table.column(1).to_pylist()))
        upto, at = below[c], 0
        reached = []
        for value, rows in pairs:
            upto += rows
            reached.append((upto, value))
        for rank in wanted[c]:
            at = next(i for i, (n, _) in enumerate(reached) if n >= rank)
            result[c].append(reached[at][1])
    return result


def bucket_offsets(
    df: DataFrame, order_by: str, sums: Sequence[str], by: Sequence[str] = (),
    descending: bool = False, buckets: int | None = None, raw: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows with their ``_bucket``, and per bucket ``_before_<c>``, ``_in_<c>``, ``all_<c>``.

    ``raw`` may give the rows that ``df`` aggregates: their quantiles bound the
    distinct values per bucket as well, and need no shuffle.
    """
    source = df if raw is None else raw
    count = buckets or bucket_count(df.sparkSession)
    kind = dict(source.dtypes)[order_by]
    bounds = (text_bounds if kind == "string" else quantile_bounds)(source, order_by, count)
    tagged = df.withColumn("_bucket", search_tree(F.col(order_by), bounds))
    keys = list(by) or [F.lit(0)]
    order = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = (  # one row per bucket
        tagged.groupBy(*by, "_bucket").agg(*[F.sum(c).alias(f"_in_{c}") for c in sums])
        .select(*by, "_bucket", *[f"_in_{c}" for c in sums],
                *[F.coalesce(F.sum(f"_in_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}")
                  for c in sums],
                *[F.sum(f"_in_{c}").over(whole).alias(f"all_{c}") for c in sums])
    )
    return tagged, offsets


def running_totals(
    df: DataFrame,
    order_by: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    buckets: int | None = None,
    raw: DataFrame | None = None,
) -> DataFrame:
    """Adds ``cum_<c>`` and ``all_<c>`` for each column in ``sums``.

    ``order_by`` must be numeric, a date/time or a text, distinct within each group of
    ``by`` (aggregate first), so that equal values cannot pile up in a bucket.
    Runs ``df``, or ``raw`` (see ``bucket_offsets``), once for the bounds.
    """
    tagged, offsets = bucket_offsets(df, order_by, sums, by, descending, buckets, raw)
    order = F.col(order_by).desc() if descending else F.col(order_by).asc()
    local = Window.partitionBy(*by, "_bucket").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return tagged.join(offsets, [*by, "_bucket"]).select(
        *df.columns,
        *[(F.col(f"_before_{c}") + F.sum(c).over(local)).alias(f"cum_{c}") for c in sums],
        *[f"all_{c}" for c in sums],
    )


def number_rows(df: DataFrame, key: str, name: str, buckets: int | None = None) -> DataFrame:
    """Adds ``name``: 1, 2, 3, ... in the order of the unique ``key``, a number or a text."""
    counted = running_totals(df.withColumn("_one", F.lit(1)), key, ["_one"], buckets=buckets)
    return counted.select(F.col("cum__one").alias(name), *df.columns)


def hash_cuts(
    keyed: DataFrame,
    hash_col: str,
    stratum: str,
    cuts: Mapping[str, Column],
    digits: int | None = None,
) -> DataFrame:
    """For each stratum and cut, the hash at that rank, in one row per stratum.

    ``cuts`` maps a name to a rank, an expression over ``n`` (rows in the
    stratum). Rows are counted by hash prefix; only the one bucket that holds a
    cut is ever sorted, so a stratum with most of the rows costs no more than
    a small one. Hashes must be unique within a stratum. A rank of 0 gives null,
    or no row if all are 0. ``digits`` of the hash make a prefix; by default so many
    that there are about as many prefixes as rows in one.
    """
    if digits is None:
        rows, digits = keyed.count(), 1
        while 16 ** (2 * digits) < rows:
            digits += 1
    prefixed = keyed.select(
        stratum, hash_col, F.substring(hash_col, 1, digits).alias("_prefix"))
    so_far = Window.partitionBy(stratum).orderBy("_prefix").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    targets = (
        prefixed.groupBy(stratum, "_prefix").agg(F.count("*").alias("_rows"))
        .withColumn("_upto", F.sum("_rows").over(so_far))
        .withColumn("n", F.sum("_rows").over(Window.partitionBy(stratum)))
        .withColumn("_cut", F.explode(F.array(*[
            F.struct(F.lit(name).alias("name"), rank.cast("long").alias("rank"))
            for name, rank in cuts.items()])))
        .withColumn("_rank", F.col("_cut.rank") - (F.col("_upto") - F.col("_rows")))
        .filter("_rank between 1 and _rows")
        .select(F.col(stratum).alias("_stratum"), F.col("_prefix").alias("_target"),
                F.col("_cut.name").alias("_name"), "_rank")
    )
    inside = prefixed.join(
        pin_small(targets),
        F.col(stratum).eqNullSafe(F.col("_stratum")) & (F.col("_prefix") == F.col("_target")))
    place = Window.partitionBy("_stratum", "_target", "_name").orderBy(hash_col)
    found = inside.withColumn("_place", F.row_number().over(place)).filter("_place = _rank")
    return (
        found.groupBy("_stratum")
        .agg(*[F.max(F.when(F.col("_name") == name, F.col(hash_col))).alias(name)
               for name in cuts])
        .withColumnRenamed("_stratum", stratum)
    )
