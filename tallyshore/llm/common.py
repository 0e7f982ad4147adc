"""Steps that several operators share: tables in the shared folder, words, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshore.session import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLICE_BYTES = 1 << 20  # of text that a vectorized step works on at a time
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20

_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Scratch:
    """Tables of one run, written to the folder that all executors share.

    Writing cuts the lineage: what an executor loses later is read again, and
    never worked out from the start.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bounds what goes to Python tasks at a time in bytes, for the session, unless that is set.

    10,000 whole texts are tens of megabytes, of which an executor and its workers hold several copies a task.
    """
    if spark.conf.get(BATCH_KEY, None) is None:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or that with as many underscores as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_nodes(docs: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``docs`` with a number that tells all rows apart: ``doc_id``, or one from 2^62 on for repeated and null ids.

    Ids that are there once need no more than a count of the ids. Otherwise the rows
    are written with their numbers, so that every later step sees the same ones.
    """
    key = F.col("doc_id").cast("long")
    repeats = docs.groupBy(key.alias("__of")).agg(F.count("*").alias("__n")).filter("__n > 1 or __of is null")
    if repeats.isEmpty():
        return docs.withColumn(name, key)
    number = F.lit(1 << 62) + F.monotonically_increasing_id()
    marked = docs.join(repeats, key.eqNullSafe(F.col("__of")), "left")
    return scratch.keep(
        marked.withColumn(name, F.when(F.col("__n").isNotNull(), number).otherwise(key)).select(
            *[F.col(f"`{c}`") for c in docs.columns], name), "numbered")


def ascii_lower(text: str | Column) -> Column:
    return F.translate(F.col(text) if isinstance(text, str) else text, UPPER, LOWER)


def held_out(doc_id: str | Column) -> Column:
    """True for the fold that no model learns from: crc32 of the id as text, modulo 5, is 0."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and where each text begins; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8, at[-1] - at[0], at[0]), at - at[0]


def slices(batch: pa.RecordBatch, text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of about ``most`` bytes of text; a longer text is a run of its own."""
    if batch.num_rows == 0:
        return
    _, at = text_bytes(batch.column(text))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(at, at[start] + most, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, count: int) -> np.ndarray:
    found = _powers.get(int(base))
    if found is None or len(found) < count:
        room = np.full(max(count, SLICE_BYTES + 1), base, np.uint64)
        room[0] = 1
        found = np.cumprod(room)
        if count <= 4 * SLICE_BYTES:
            _powers[int(base)] = found
    return found[:count]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads each bit of a 64-bit hash over all others; one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, wherever it stands."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _power(_INVERSE, len(data) + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words (runs without ASCII white space), and where each text's begin."""
    word = ~_SPACE[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    before[at[:-1][at[:-1] < len(data)]] = False
    after[at[1:][at[1:] > 0] - 1] = False
    starts = np.flatnonzero(word & ~before)
    return starts, np.flatnonzero(word & ~after) + 1, np.searchsorted(starts, at)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, A-Z lowered, and where each text's words begin."""
    data, at = text_bytes(texts)
    data = _LOWERED[data]
    starts, ends, first = word_spans(data, at)
    return span_hashes(data, starts, ends), first


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``size`` words.

    A text of fewer words has one shingle, its whole sequence; one without
    words has none.
    """
    words, first = word_hashes(texts)
    with np.errstate(over="ignore"):
        factors = mix(np.arange(1, size + 1, dtype=np.uint64) * _BASE) | np.uint64(1)
        runs = np.zeros(max(0, len(words) - size + 1), np.uint64)
        for i, factor in enumerate(factors):
            runs += words[i:i + len(runs)] * factor
        runs = mix(runs)
        found = []
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= size:
                found.append(np.unique(runs[a:b - size + 1]))
            elif b > a:
                short = (words[a:b] * factors[:b - a]).sum(dtype=np.uint64)
                found.append(mix(np.array([short + np.uint64(b - a)], np.uint64)))
            else:
                found.append(np.zeros(0, np.uint64))
    return found


def shingles(text: str | None, size: int) -> set:
    """The shingles themselves, for exact comparisons."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z and ASCII white space only
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(size)]))


def _shuffled(node: str) -> Column:
    """A one-to-one scramble of a long, so that hooking follows no natural order."""
    x = F.col(node)
    x = x.bitwiseXOR(F.shiftleft(x, 13))
    x = x.bitwiseXOR(F.shiftrightunsigned(x, 7))
    return x.bitwiseXOR(F.shiftleft(x, 17))


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """``node, component`` for the nodes of ``edges`` (a, b): the smallest node reachable.

    Each round hooks every node to the first of its neighbors in a scrambled
    order, replaces both ends of each edge and drops those that have become
    loops, so that the edges shrink by a constant factor a round. Each round
    is written to the shared folder. Nothing but a row count reaches the driver.
    """
    rest = scratch.keep(
        edges.filter("a <> b").select(_shuffled("a").alias("a"), _shuffled("b").alias("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        f"{name}-edges-0")
    nodes = edges.filter("a <> b").select(F.explode(F.array("a", "b")).alias("node")).distinct()
    roots = nodes.select("node", _shuffled("node").alias("root"))
    step = 0
    while not rest.isEmpty():
        step += 1
        hooks = scratch.keep(
            rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
            .groupBy("a").agg(F.min("b").alias("b"))
            .select(F.col("a").alias("old"), F.least("a", "b").alias("new")),
            f"{name}-hooks-{step}")
        roots = scratch.keep(
            roots.join(hooks, roots["root"] == hooks["old"], "left")
            .select("node", F.coalesce("new", "root").alias("root")), f"{name}-roots-{step}")
        left = rest.join(hooks, rest["a"] == hooks["old"]).select(F.col("new").alias("a"), "b")
        both = left.join(hooks, left["b"] == hooks["old"]).select("a", F.col("new").alias("b"))
        rest = scratch.keep(
            both.filter("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            f"{name}-edges-{step}")
    smallest = scratch.keep(roots.groupBy("root").agg(F.min("node").alias("component")),
                            f"{name}-smallest")
    return roots.join(smallest, "root").select("node", "component")
