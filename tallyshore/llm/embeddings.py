"""Near-duplicate embeddings by Int8 tile products with error bounds."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshore.llm.common import Scratch, components

TILE = 4096  # vectors in a tile, while there are few tiles
TILE_BYTES = 1 << 25  # of doubles in a tile at most
CELLS = 1 << 20  # cosines that are bounded at a time


def quantize(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as whole numbers from -127 to 127, their scales, and bounds of what that loses.

    The bound is the length of the difference between a vector and its
    quantized form, plus a margin for the double arithmetic in between.
    """
    scale = np.abs(unit).max(axis=1, keepdims=True) / 127.0
    whole = np.rint(unit / scale)
    lost = np.sqrt(((unit - whole * scale) ** 2).sum(axis=1)) + 1e-12
    return whole.astype(np.int8), scale[:, 0], lost


def close_pairs(a: np.ndarray, b: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows with cosine >= threshold, a few rows at a time.

    With unit x = x' + e and y = y' + f, where x', y' are the quantized vectors,
    x.y = x'.y' + e.y + x'.f, so x.y <= x'.y' + |e| + |f| (1 + |e|). Sums of products
    of whole numbers below 2^24 are exact in single precision. Only pairs whose
    bound reaches the threshold are computed again, in double precision.
    """
    norm_a, norm_b = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    qa, sa, ea = quantize(a / norm_a[:, None])
    qb, sb, eb = quantize(b / norm_b[:, None])
    exact = np.float32 if a.shape[1] * 127 * 127 < 1 << 24 else np.float64
    right = qb.astype(exact).T.copy()
    rows = max(1, CELLS // max(1, len(b)))
    for start in range(0, len(a), rows):
        part = slice(start, start + rows)
        bound = (qa[part].astype(exact) @ right).astype(np.float64)
        bound *= sa[part, None] * sb[None, :]
        bound += ea[part, None] + eb[None, :] * (1 + ea[part, None])
        i, j = np.nonzero(bound >= threshold)
        i += start
        for k in range(0, len(i), 1 << 15):
            x, y = i[k:k + (1 << 15)], j[k:k + (1 << 15)]
            sure = (a[x] * b[y]).sum(axis=1) / (norm_a[x] * norm_b[y]) >= threshold
            yield x[sure], y[sure]


def merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Gives what the links i-j connect the smallest of its labels, in place."""
    while len(i):
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        np.minimum.at(label, label[i], low)
        label[:] = label[label]
        left = label[i] != label[j]
        i, j = i[left], j[left]


def _compare(group: pa.Table, threshold: float) -> pa.Table:
    """Links of one pair of tiles: counts per vector, and what they connect as a star per part."""
    ids, copies = group["rep"].to_numpy(), group["copies"].to_numpy()
    flat = group["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    vectors = flat.astype(np.float64).reshape(len(ids), -1)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no square can overflow
    own = np.flatnonzero(group["tile"].to_numpy() == group["one"].to_numpy())
    other = np.flatnonzero(group["tile"].to_numpy() == group["two"].to_numpy())
    same = group["one"][0].as_py() == group["two"][0].as_py()
    links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
    if len(own) and len(other):
        for i, j in close_pairs(vectors[own], vectors[other], threshold):
            i, j = own[i], other[j]
            i, j = i[i != j], j[i != j]
            np.add.at(links, i, copies[j])
            if not same:  # within a tile each pair is met in both orders
                np.add.at(links, j, copies[i])
            merge(label, i, j)
    counted, tied = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(ids)))
    return pa.table({
        "a": np.concatenate([ids[counted], ids[tied]]),
        "b": pa.array(np.concatenate([ids[counted], ids[label[tied]]])),
        "links": np.concatenate([links[counted], np.zeros(len(tied), np.int64)])})


def tiles(vectors: int, width: int, tile: int, tasks: int) -> int:
    """How many tiles to deal vectors into, each being sent to as many tasks as there are tiles.

    No more than give every one of ``tasks`` some pairs of tiles, however many vectors there
    are, until a tile would have more than ``TILE_BYTES``.
    """
    enough = min(-(-vectors // tile), math.isqrt(6 * tasks) + 1)
    return max(1, enough, -(-vectors * 8 * width // TILE_BYTES))


def near_duplicates(embeddings: DataFrame, threshold: float = 0.95, tile: int = TILE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``embeddings``.

    All vectors are compared: equal ones are one vector with a number of
    copies, those are dealt into tiles by a hash, and each pair of tiles is one
    group with bounded memory. A group returns counts and a forest, never
    pairs, so that a group of near copies with a third of all rows costs no
    more output than any other. The work grows with the square of the number
    of different vectors, as no bound below it is known for this threshold.

    Null, empty or zero vectors, those with a null or a component that isn't
    finite, and rows without id link with nothing; vectors of different length
    don't link. Rows that repeat an id are one node but count as vectors. A row
    without id has no component and is kept.
    """
    scratch = Scratch(embeddings.sparkSession, "embeddings")
    rows = embeddings.select("vec_id", F.col("embedding").alias("vector"))
    usable = (
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists("vector", lambda v: v != 0)
    )
    rows = scratch.keep(rows.select(
        "vec_id", F.coalesce(usable, F.lit(False)).alias("usable"), "vector",
        F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2")), "rows")
    classes = scratch.keep(
        rows.filter("usable").groupBy("h1", "h2").agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("copies"),
            F.any_value("vector").alias("vector")), "classes")
    found = classes.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width")).first()
    count = tiles(found.n, found.width, tile, int(embeddings.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = F.pmod(F.xxhash64("rep", "h1"), F.lit(count))
    numbered = classes.select(
        "rep", "copies", "vector", F.size("vector").alias("dim"), spread.cast("int").alias("tile"))
    partners = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda t: F.struct(
        F.least(F.col("tile"), t).alias("one"), F.greatest(F.col("tile"), t).alias("two")))
    pairs = numbered.withColumn("pair", F.explode(partners)).select(
        "rep", "copies", "vector", "dim", "tile", "pair.one", "pair.two")
    found = scratch.keep(
        pairs.groupBy("dim", "one", "two").applyInArrow(
            lambda group: _compare(group, threshold), "a long, b long, links long"), "found")
    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    parts = components(found.select("a", "b"), scratch)
    judged = scratch.keep(
        classes.select("h1", "h2", "rep", "copies").join(links, "rep", "left")
        .join(parts.withColumnRenamed("node", "rep"), "rep", "left")
        .select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id")), "judged")
    joined = rows.join(judged.withColumn("usable", F.lit(True)), ["h1", "h2", "usable"], "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
