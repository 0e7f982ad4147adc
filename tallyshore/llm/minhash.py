"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard similarity.

One permutation scatters the shingles over a ring of places, a second one gives
each place a value. Coordinate k of a signature is the least value of the set
after k turns of the ring, so that all coordinates of a shingle stand side by
side in the second permutation, and two permutations serve for all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshore.llm.common import Scratch, components, mix, shingle_sets, shingles, slices

BLOCK = 256  # members a leader is compared with in one task
SKETCH_BLOCK = (256, 4096)  # members of a block of sketches, at least and at most
REST_BLOCK = (128, 1024, 1 << 20)  # the same of a block of texts, and their shingles together
SALTS = 32  # tasks that the members of a family are spread over to learn its size
NEAR = 30  # percent; two texts that link but meet in no bucket with a leader as near as this are next to impossible


@dataclass(frozen=True)
class Settings:
    """A pair with similarity 0.8 misses all bands with probability (1 - 0.8^rows)^bands, 5e-6 here.

    ``sure_below``: pairs whose share of equal coordinates is lower aren't compared
    any further in the second search. For a true pair it is lower with
    probability 5e-6 or less, as for the bands.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 6
    ring_bits: int = 20
    seed: int = 1

    @property
    def sure_below(self) -> float:
        share = self.percent / 100
        return share - 5 * (share * (1 - share) / (self.bands * self.rows)) ** 0.5


def ring_values(settings: Settings) -> np.ndarray:
    """Row i holds the values of place i after 0, 1, 2, ... turns."""
    size, turns = 1 << settings.ring_bits, settings.bands * settings.rows
    values = np.random.default_rng(settings.seed).permutation(size).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([values, values[:turns - 1]]), turns)


def signature(shingle_hashes: np.ndarray, ring: np.ndarray, settings: Settings) -> np.ndarray:
    """Least value of each coordinate over a non-empty set."""
    places = (mix(shingle_hashes ^ np.uint64(settings.seed)) >> np.uint64(64 - settings.ring_bits)).astype(np.int64)
    return np.min([ring[places[i:i + 2048]].min(axis=0) for i in range(0, len(places), 2048)], axis=0)


def band_hashes(sign: np.ndarray, settings: Settings) -> np.ndarray:
    """One 64-bit hash per band, which holds the number of the band as well."""
    with np.errstate(over="ignore"):
        parts = sign.reshape(settings.bands, settings.rows).astype(np.uint64)
        h = mix(np.arange(1, settings.bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        for row in range(settings.rows):
            h = mix(h * np.uint64(31) + parts[:, row])
    return h.view(np.int64)


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """``doc_id, n_shingles, set_key, sketch, bands`` per row; the last three are null for an empty set.

    Equal sets have equal keys: 128 bits over the sorted 64-bit hashes of the
    shingles. The sketch has the low byte of each coordinate.
    """
    schema = "doc_id long, n_shingles long, set_key binary, sketch binary, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ring = ring_values(settings)
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column("text"), settings.shingle)
                signs = [signature(s, ring, settings) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                              for s in sets], pa.binary()),
                    pa.array([None if s is None else s.astype(np.uint8).tobytes() for s in signs], pa.binary()),
                    pa.array([None if s is None else band_hashes(s, settings) for s in signs],
                             pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "set_key", "sketch", "bands"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _confirm(pairs: DataFrame, pool: DataFrame, settings: Settings) -> DataFrame:
    """``a, b, linked`` for those of ``pairs`` (a, b) with similarity ``NEAR`` or more, on full sets.

    The pairs of a document b are cut into blocks of bounded size, and its text
    goes to each of them. Texts are then met in order, b's first, so that a
    task holds one set and one batch at a time.
    """
    sizes = pairs.groupBy("b").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    first = sizes.select(F.col("b").alias("doc"), "b", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
    rest = pairs.join(sizes, "b").select(
        F.col("a").alias("doc"), "b", F.pmod(F.xxhash64("a"), blocks).cast("int").alias("block"))
    texts = (
        first.unionByName(rest).join(pool, F.col("doc") == pool["doc_id"])
        .select("b", "block", "doc", "text"))
    dealt = texts.repartition("b", "block").sortWithinPartitions("b", "block", F.col("doc") != F.col("b"))
    size, percent = settings.shingle, settings.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, own = None, set()
        for batch in batches:
            found = []
            for b, doc, text in zip(*(batch.column(c).to_pylist() for c in ("b", "doc", "text"))):
                if doc == b:
                    leader, own = b, shingles(text, size)
                elif leader == b:
                    other = shingles(text, size)
                    both = len(own & other)
                    all_ = len(own) + len(other) - both
                    if 100 * both >= min(NEAR, percent) * all_:
                        found.append((doc, b, 100 * both >= percent * all_))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("a", "b", "linked"), x)) for x in found],
                pa.schema({"a": pa.int64(), "b": pa.int64(), "linked": pa.bool_()}))

    return dealt.mapInArrow(run, "a long, b long, linked boolean")


def _dealt(members: DataFrame, least: int, most: int, shingles_: int | None = None) -> DataFrame:
    """``members`` once for each pair of blocks (``one``, ``two``) of their family that theirs (``block``) is in.

    Families of one part have no rows. There are at most eight blocks, if none holds ``most`` members or
    ``shingles_`` shingles then, about; more only as full ones need it. Members of a family are spread
    over tasks where they learn its size.
    """
    sizes = members.groupBy("family").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("weight"), F.min("part").alias("low"),
        F.max("part").alias("high")).filter("low <> high")
    rows = F.least(F.lit(most), F.greatest(F.lit(least), F.ceil(F.col("n") / 8)))
    blocks = F.ceil(F.col("n") / rows)
    if shingles_:
        blocks = F.greatest(blocks, F.ceil(F.col("weight") / shingles_))
    salted = sizes.select(
        "family", blocks.cast("int").alias("blocks"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    told = members.withColumn("salt", F.pmod(F.xxhash64(F.lit("salt"), "doc"), F.lit(SALTS)).cast("int")).join(
        salted, ["family", "salt"]).withColumn("block", F.pmod(F.xxhash64("doc"), "blocks").cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda t: F.struct(
        F.least("block", t).alias("one"), F.greatest("block", t).alias("two")))
    return told.withColumn("pair", F.explode(pairs)).select(
        "doc", "family", "part", "block", "n_shingles", "sketch", "pair.one", "pair.two")


def _near(block: pa.Table, settings: Settings) -> Iterator[tuple[int, np.ndarray]]:
    """Each member of block ``one`` with those of ``two`` of another part whose sizes and sketches allow a link."""
    parts, sizes, own, one, two = (block[c].to_numpy() for c in ("part", "n_shingles", "block", "one", "two"))
    sketches = np.frombuffer(b"".join(block["sketch"].to_pylist()), np.uint8).reshape(len(parts), -1)
    least = int(np.ceil(settings.sure_below * settings.bands * settings.rows))
    right = np.flatnonzero(own == two)
    right = right[np.argsort(sizes[right], kind="stable")]
    for i in np.flatnonzero(own == one):
        low = np.searchsorted(sizes[right], -(-settings.percent * sizes[i] // 100))
        high = np.searchsorted(sizes[right], 100 * sizes[i] // settings.percent, "right")
        some = right[low:high]
        some = some[parts[some] != parts[i]]
        yield i, some[(sketches[some] == sketches[i]).sum(axis=1) >= least]


def _across(block: pa.Table, settings: Settings) -> pa.Table:
    """What the links between two blocks of a family connect, as ``a`` and ``b``.

    Of the pairs that sizes and sketches allow, none is compared that earlier links have connected.
    Shared shingles are counted by their hashes, all candidates of a text at once, and
    links confirmed on the shingles themselves.
    """
    block = block.take(pa.array(np.argsort(block["doc"].to_numpy(), kind="stable")))
    docs, texts = block["doc"].to_numpy(), block["text"].combine_chunks()
    hashed = shingle_sets(texts, settings.shingle)
    at = np.concatenate([[0], np.cumsum([len(h) for h in hashed])])
    names = np.unique(np.concatenate(hashed), return_inverse=True)[1]
    label = np.unique(block["part"].to_numpy(), return_inverse=True)[1].astype(np.int64)
    sets, linked, marked = {}, [], np.zeros(at[-1] + 1, bool)

    def whole(i: int) -> set:
        if i not in sets:
            sets[i] = shingles(texts[i].as_py(), settings.shingle)
        return sets[i]

    for i, near in _near(block, settings):
        near = near[(label[near] != label[i]) & (at[near + 1] > at[near])]
        if not len(near):
            continue
        sizes = at[near + 1] - at[near]
        marked[names[at[i]:at[i + 1]]] = True
        ends = np.cumsum(sizes)
        shared = marked[names[np.arange(ends[-1]) + np.repeat(at[near] - (ends - sizes), sizes)]]
        marked[names[at[i]:at[i + 1]]] = False
        both = np.add.reduceat(shared, ends - sizes, dtype=np.int64)
        for j in near[100 * both >= settings.percent * (at[i + 1] - at[i] + sizes - both)]:
            if label[i] == label[j]:
                continue
            both = len(whole(i) & whole(j))
            if 100 * both >= settings.percent * (len(sets[i]) + len(sets[j]) - both):
                linked.append((docs[i], docs[j]))
                label[label == label[j]] = label[i]
    return pa.table({"a": pa.array([a for a, _ in linked], pa.int64()),
                     "b": pa.array([b for _, b in linked], pa.int64())})


def _rest(families: DataFrame, parts: DataFrame, sketches: DataFrame, pool: DataFrame,
          scratch: Scratch, settings: Settings) -> DataFrame:
    """Links between the parts of a family, at most one for each text of a pair of blocks.

    Blocks of sizes and sketches alone tell which members may link with one of another part.
    Only their texts are dealt into blocks again, bounded by rows and by shingles, so that a
    task holds little whatever the texts' lengths, and no pair leaves it
    but those that connect what wasn't.
    """
    known = scratch.keep(
        families.withColumnsRenamed({"node": "doc", "component": "family"}).join(
            parts.withColumnsRenamed({"node": "doc", "component": "part"}), "doc", "left")
        .join(sketches, "doc").select("doc", "family", F.coalesce("part", "doc").alias("part"), "n_shingles", "sketch"),
        "known")

    def able(block: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64)]
        for i, near in _near(block, settings):
            if len(near):
                found += [[i], near]
        docs = block["doc"].to_numpy()[np.unique(np.concatenate(found)).astype(np.int64)]
        return pa.table({"doc": pa.array(docs)})

    group = ("family", "one", "two")
    may = scratch.keep(
        _dealt(known, *SKETCH_BLOCK).groupBy(*group).applyInArrow(able, "doc long").distinct(), "may")
    rows = _dealt(known.join(may, "doc", "left_semi"), *REST_BLOCK).join(pool.withColumnRenamed("doc_id", "doc"), "doc")
    return rows.groupBy(*group).applyInArrow(lambda block: _across(block, settings), "a long, b long")


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    1. Documents with equal sets are one class, with its smallest id.
    2. Classes that share a band form a bucket. Its leader, the class that
       meets the most others, is compared with all members on whole sets.
    3. Classes with similarity ``NEAR`` or more to a leader are one family. Families
       that fall into several parts are searched again, in blocks, for links
       between the parts: on sizes and sketches alone first, and then, for the members
       that those allow a link, on whole sets.

    So a group of near copies gives a star, and more only where the star falls
    apart. Documents of null, empty or blank text link with nothing. A row
    without id has no component and is kept. Ids should be unique: rows that
    repeat one are judged by their own text, and are one node. An empty table
    gives an empty result; other columns are left out.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    rows = scratch.keep(signatures(docs, settings), "signatures")
    usable = rows.filter("set_key is not null and doc_id is not null")
    classes = scratch.keep(
        usable.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "classes")
    reps = usable.join(classes.filter("n > 1").select("set_key", "rep"), "set_key", "left").filter(
        "rep is null or rep = doc_id")
    members = reps.select(F.col("doc_id").alias("doc"), F.explode("bands").alias("key")).distinct()
    buckets = scratch.keep(
        members.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    members = scratch.keep(members.join(buckets, "key"), "members")
    # the rank of a class: how many it meets, then a hash
    ranks = scratch.keep(members.groupBy("doc").agg(
        (F.sum("n") * 1_048_576 + F.pmod(F.xxhash64("doc"), F.lit(1_048_576))).alias("rank")), "ranks")
    leaders = scratch.keep(
        members.join(ranks, "doc").groupBy("key").agg(F.max_by("doc", "rank").alias("b")), "leaders")
    pairs = scratch.keep(
        members.join(leaders, "key").filter("doc <> b").select(F.col("doc").alias("a"), "b").distinct(), "pairs")
    pool = scratch.keep(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(ranks.select(F.col("doc").alias("doc_id")), "doc_id", "left_semi"), "pool")
    compared = scratch.keep(_confirm(pairs, pool, settings), "compared")
    links = compared.filter("linked").select("a", "b")
    parts = scratch.keep(components(links, scratch, "first"), "first")
    if not compared.filter("not linked").isEmpty():
        families = components(compared.select("a", "b"), scratch, "families")
        sketches = usable.join(ranks, usable["doc_id"] == ranks["doc"], "left_semi").select(
            F.col("doc_id").alias("doc"), "n_shingles", "sketch")
        more = scratch.keep(_rest(families, parts, sketches, pool, scratch, settings), "more")
        if not more.isEmpty():
            parts = components(links.unionByName(more), scratch, "last")
    found = scratch.keep(
        classes.join(parts, classes["rep"] == parts["node"], "left")
        .select("set_key", F.coalesce("component", "rep").alias("component_id"), "n", "rep")
        .filter("n > 1 or component_id <> rep").select("set_key", "component_id"), "found")
    component = F.coalesce("component_id", "doc_id")
    return rows.join(found, "set_key", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
