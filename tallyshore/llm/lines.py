"""Near-duplicate lines by a segment-partition edit join.

Of lines within ``edits`` of each other, one that is cut into edits + 1 segments
keeps at least one of them whole, and the other line has it at nearly the same
place. So each line is indexed by its segments, and looks up those of its
substrings that may be a segment of a line of its own or a slightly smaller
length. Edits and lengths are of characters (code points).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshore.llm.common import Scratch, components, fresh, mix, slices, span_hashes, text_bytes, with_nodes

SEEN = 1_000_000  # lines that a task remembers so as not to send them again
FILTER_BITS = 24
CELLS = 1 << 22  # pairs of lines whose parities a task compares at a time
_OTHER = np.random.default_rng(7).permutation(1 << 16).astype(np.uint32)


@dataclass(frozen=True)
class Settings:
    """Lines shorter than ``least`` characters have no rows; those shorter than ``near`` are alike only if they are equal.

    ``hot``: rows of a key that one task holds; with more, they are dealt into
    blocks of about ``block`` rows.
    """

    edits: int = 2
    least: int = 24
    near: int = 1
    hot: int = 1 << 16
    block: int = 1 << 15

    @property
    def joined(self) -> int:
        """The least length of lines that are compared with others; one that the edits can wholly replace, too."""
        return max(1, self.least, self.near)


#: Every line that isn't empty, and every pair of lines.
ALL = Settings(least=1)
#: What texts lose: lines of 24 characters that are near an earlier one, shorter ones only if an earlier one is equal.
LOST = Settings(least=1, near=24)


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Characters of a string array and where each text begins; null is empty."""
    data, at = text_bytes(texts)
    if not (data & 0x80).any():
        return data.astype(np.uint32), at
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # a character starts with such a byte
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32), before[at]


def spans(texts: pa.Array, least: int) -> tuple[np.ndarray, ...]:
    """Characters, starts and ends of the lines of at least ``least``, their texts and numbers in them."""
    data, at = code_points(texts)
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([at[:-1][at[:-1] < at[1:]], breaks + 1]))
    starts = starts[starts < len(data)]
    inside = np.ones(len(starts), bool)
    inside[1:] = starts[1:] != starts[:-1]  # a break at the end of a text opens nothing
    starts = starts[inside]
    owner = np.searchsorted(at, starts, "right") - 1
    stops = np.minimum(np.append(breaks, len(data))[np.searchsorted(breaks, starts)], at[owner + 1])
    number = np.searchsorted(breaks, starts) - np.searchsorted(breaks, at[owner])
    long = stops - starts >= least
    return data, starts[long], stops[long], owner[long], number[long]


def segments(length: np.ndarray, edits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Start and size of each segment of lines of some lengths; the last ones are a character longer."""
    size, rest = length // (edits + 1), length % (edits + 1)
    found, start = [], np.zeros_like(length)
    for i in range(edits + 1):
        own = size + (i >= edits + 1 - rest)
        found.append((start, own))
        start = start + own
    return found


def lookups(length: np.ndarray, settings: Settings) -> Iterator[tuple[np.ndarray, ...]]:
    """What lines of some lengths look up: which line, a length, a segment's number, start and size.

    A line that is ``gap`` longer than another has segment i of that one shifted by
    at most i to the left of it and edits - i to the right of where it ends up, or one of
    the other segments matches as well.
    """
    edits = settings.edits
    for gap in range(edits + 1):
        shorter = length - gap
        for i, (start, size) in enumerate(segments(shorter, edits)):
            low = max(-i, gap - (edits - i))
            high = min(i, gap + (edits - i))
            for shift in range(low, high + 1):
                place = start + shift
                ok = np.flatnonzero((place >= 0) & (place + size <= length) & (shorter >= settings.joined))
                yield ok, shorter[ok], i, place[ok], size[ok], gap == 0 and shift == 0


def parity(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64 bits, each the parity of how many neighboring characters of a line hash to it; an edit flips four at most."""
    pair = data[:-1].astype(np.uint64) << np.uint64(32) | data[1:].astype(np.uint64)
    bit = np.uint64(1) << (mix(pair) >> np.uint64(58))
    sums = np.concatenate([[np.uint64(0)], np.bitwise_xor.accumulate(bit)]) if len(bit) else np.zeros(1, np.uint64)
    return sums[np.maximum(stops - 1, starts)] ^ sums[starts]


def edit_distance(a: str, b: str, most: int) -> int:
    """Edit distance, or ``most`` + 1 if it is larger, in a band of 2 * most + 1 diagonals.

    Bit k of state e says that the first j of b's characters and the first j + k - most of
    a's can be matched with e edits.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << (i + most)
    mask = (1 << (2 * most + 1)) - 1
    states = [1 << most]
    for _ in range(most):
        states.append((states[-1] | states[-1] << 1) & mask)
    for j, c in enumerate(b):
        same = places.get(c, 0) >> j & mask
        new = [states[0] & same]
        for e in range(1, most + 1):
            new.append((states[e] & same | states[e - 1] | states[e - 1] >> 1 | new[-1] << 1) & mask)
        states = new
        if not states[-1]:
            return most + 1
    end = 1 << (len(a) - len(b) + most)
    return next((e for e, state in enumerate(states) if state & end), most + 1)


def occurrences(docs: DataFrame, settings: Settings) -> DataFrame:
    """``doc_id, line_no, node, other``: the lines of each text, with two hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, starts, stops, owner, number = spans(part.column("text"), settings.least)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(owner)), pa.array(number),
                    pa.array(span_hashes(data, starts, stops).view(np.int64)),
                    pa.array(span_hashes(_OTHER[data & 0xFFFF] | data & 0xFFFF0000, starts, stops).view(np.int64))],
                    ["doc_id", "line_no", "node", "other"])

    return docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id is not null").mapInArrow(
        run, "doc_id long, line_no long, node long, other long")


def _keys(docs: DataFrame, settings: Settings) -> DataFrame:
    """``key, node, sign, indexed``: what each line is indexed by and looks up; a task sends a line once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch):
                data, starts, stops, *_ = spans(part.column("text"), settings.joined)
                nodes = span_hashes(data, starts, stops)
                first = np.sort(np.unique(nodes, return_index=True)[1])
                fresh = np.array([i for i in first if int(nodes[i]) not in seen], np.int64)
                starts, stops, nodes = starts[fresh], stops[fresh], nodes[fresh]
                if len(seen) + len(nodes) > SEEN:
                    seen.clear()
                seen.update(nodes.tolist())
                sign = parity(data, starts, stops)
                for which, length, i, place, size, own in lookups(stops - starts, settings):
                    begin = starts[which] + place
                    tag = length.astype(np.uint64) * np.uint64(settings.edits + 1) + np.uint64(i)
                    key = mix(span_hashes(data, begin, begin + size) ^ mix(tag))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key.view(np.int64)), pa.array(nodes[which].view(np.int64)),
                        pa.array(sign[which].view(np.int64)), pa.array(np.full(len(which), own))],
                        ["key", "node", "sign", "indexed"])

    return docs.select("text").filter("text is not null").mapInArrow(
        run, "key long, node long, sign long, indexed boolean")


def _near(node: np.ndarray, sign: np.ndarray, left: np.ndarray, right: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Pairs ``a < b`` of two lists of places whose signs differ in ``most`` bits or fewer, some rows at a time."""
    rows = max(1, CELLS // max(1, len(right)))
    for start in range(0, len(left), rows):
        own = left[start:start + rows]
        near = np.bitwise_count((sign[own, None] ^ sign[None, right]).view(np.uint64)) <= most
        i, j = np.nonzero(near & (node[own, None] != node[None, right]))
        if len(i):
            both = np.unique(np.sort(np.stack([node[own[i]], node[right[j]]]), axis=0), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "b"])


def _blocks(hot: DataFrame, settings: Settings) -> DataFrame:
    """``_meet`` for the rows of keys that very many lines share: each pair of blocks of a key is a group."""
    blocks = F.ceil(F.col("n") / settings.block).cast("int")
    dealt = hot.join(hot.groupBy("key").agg(F.count("*").alias("n")), "key").withColumn(
        "block", F.pmod(F.xxhash64("a"), blocks).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda t: F.struct(
        F.least("block", t).alias("one"), F.greatest("block", t).alias("two")))
    rows = dealt.withColumn("pair", F.explode(pairs)).select(
        "key", "a", "sign", "indexed", "block", "pair.one", "pair.two")
    most = 4 * settings.edits

    def compare(group: pa.Table) -> pa.Table:
        node, sign, indexed, own, one, two = (
            group[c].to_numpy() for c in ("a", "sign", "indexed", "block", "one", "two"))
        first, second = np.flatnonzero(own == one), np.flatnonzero(own == two)
        sides = [(first, second)] if one[0] == two[0] else [(first, second), (second, first)]
        found = [batch for left, right in sides for batch in _near(node, sign, left[indexed[left]], right, most)]
        return pa.Table.from_batches(found, pa.schema({"a": pa.int64(), "b": pa.int64()}))

    return rows.groupBy("key", "one", "two").applyInArrow(compare, "a long, b long")


def _meet(keys: DataFrame, scratch: Scratch, settings: Settings) -> DataFrame:
    """Pairs ``a < b`` of lines that share a key and whose parities are near enough.

    Rows of a key stand together after one shuffle and a sort, and a task holds
    one key's rows at a time. A key with more than ``hot`` rows isn't held: its rows
    are passed on as they come, and compared in blocks by other tasks.
    """
    most = 4 * settings.edits
    names = ["key", "a", "b", "sign", "indexed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        hot = None  # the key whose rows are passed on

        def out(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
            key, node, sign, indexed = (np.concatenate(x) for x in zip(*parts))
            edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            for a, b in zip(edges[:-1][np.diff(edges) > 1], edges[1:][np.diff(edges) > 1]):
                if (node[a:b] != node[a]).any():
                    for found in _near(node[a:b], sign[a:b], np.flatnonzero(indexed[a:b]), np.arange(b - a), most):
                        none = pa.nulls(len(found), pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [none, *found.columns, none, pa.nulls(len(found), pa.bool_())], names)

        def passed(part: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            key, node, sign, indexed = (pa.array(c) for c in part)
            return pa.RecordBatch.from_arrays([key, node, pa.nulls(len(key), pa.int64()), sign, indexed], names)

        for batch in batches:
            columns = tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if hot is not None:
                more = int(np.searchsorted(columns[0], hot, "right"))
                yield passed(tuple(c[:more] for c in columns))
                columns = tuple(c[more:] for c in columns)
            if not len(columns[0]):
                continue
            hot = None
            last = int(np.searchsorted(columns[0], columns[0][-1]))  # the last key may go on in the next batch
            if last:
                yield from out([*held, tuple(c[:last] for c in columns)])
                held = []
            held.append(tuple(c[last:] for c in columns))
            if sum(len(part[0]) for part in held) > settings.hot:
                hot = columns[0][-1]
                yield from map(passed, held)
                held = []
        if held:
            yield from out(held)

    met = scratch.keep(keys.repartition("key").sortWithinPartitions("key").mapInArrow(
        run, "key long, a long, b long, sign long, indexed boolean").distinct(), "candidates")
    pairs, rest = met.filter("key is null").select("a", "b"), met.filter("key is not null")
    if rest.isEmpty():
        return pairs
    return scratch.keep(pairs.unionByName(_blocks(rest, settings)).distinct(), "all-candidates")


def _filter(pairs: DataFrame) -> np.ndarray:
    """A bit array of fixed size with a bit for each line of the pairs."""
    place = F.shiftrightunsigned("node", 64 - FILTER_BITS)
    words = (
        pairs.select(F.explode(F.array("a", "b")).alias("node"))
        .select(place.alias("place")).select(
            F.shiftright("place", 5).alias("word"), F.expr("shiftleft(1L, cast(place % 32 as int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
    bits = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return bits


def _texts(docs: DataFrame, pairs: DataFrame, settings: Settings) -> DataFrame:
    """``node, line`` for the lines of the pairs, and a few others, found by a bit filter without a shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(_filter(pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = sent.value, set()
        for batch in batches:
            for part in slices(batch):
                data, starts, stops, *_ = spans(part.column("text"), settings.joined)
                nodes = span_hashes(data, starts, stops)
                place = (nodes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                found = []
                for k in np.flatnonzero(bits[place >> 5] >> (place & 31).astype(np.uint32) & np.uint32(1)):
                    if int(nodes[k]) not in seen:
                        seen.add(int(nodes[k]))
                        found.append(k)
                if len(seen) > SEEN:
                    seen.clear()
                yield pa.RecordBatch.from_arrays([
                    pa.array(nodes[found].view(np.int64)),
                    pa.array([data[starts[k]:stops[k]].tobytes().decode("utf-32-le") for k in found], pa.string())],
                    ["node", "line"])

    return docs.select("text").filter("text is not null").mapInArrow(run, "node long, line string").dropDuplicates(["node"])


def links(docs: DataFrame, scratch: Scratch, settings: Settings) -> DataFrame:
    """Pairs ``a < b`` of hashes of different lines within ``edits`` of each other."""
    pairs = _meet(_keys(docs, settings), scratch, settings)
    texts = scratch.keep(_texts(docs, pairs, settings), "texts")
    one = texts.select(F.col("node").alias("a"), F.col("line").alias("one"))
    two = texts.select(F.col("node").alias("b"), F.col("line").alias("two"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [edit_distance(x, y, settings.edits) <= settings.edits for x, y in zip(
                batch.column("one").to_pylist(), batch.column("two").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return scratch.keep(pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two").mapInArrow(
        run, "a long, b long"), "links")


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, line_no, class_doc_id, class_line_no, n_links, kept`` for every line of ``least`` characters.

    Lines are numbered from 0 within their text. Equal lines and lines that are
    linked, directly or by others, are one class, named by its first line in
    the order of doc_id and line_no, which is kept. ``n_links`` counts the different
    lines within ``edits`` of the line. Empty and shorter lines, null texts and
    documents without id have no rows; rows that repeat an id are one document.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    rows = scratch.keep(occurrences(docs, settings), "lines")
    linked = links(docs, scratch, settings)
    counts = linked.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    parts = scratch.keep(components(linked, scratch).join(counts, "node"), "parts")
    tagged = rows.join(parts, "node", "left").withColumns({
        "part": F.coalesce("component", "node"), "n_links": F.coalesce("n_links", F.lit(0)),
        # lines of a part are told from others of an equal hash by the second one
        "mark": F.when(F.col("component").isNull(), F.col("other")).otherwise(0)})
    tagged = scratch.keep(tagged.select("doc_id", "line_no", "part", "mark", "n_links"), "tagged")
    classes = scratch.keep(
        tagged.groupBy("part", "mark").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "line_no")).alias("first"))
        .filter("n > 1").select("part", "mark", "first"), "classes")
    first = F.coalesce("first", F.struct("doc_id", "line_no"))
    named = tagged.join(classes, ["part", "mark"], "left").withColumn("first", first)
    return named.select(
        "doc_id", "line_no", F.col("first.doc_id").alias("class_doc_id"),
        F.col("first.line_no").alias("class_line_no"), "n_links",
        (F.col("first") == F.struct("doc_id", "line_no")).alias("kept"))


def remove(docs: DataFrame, settings: Settings = LOST) -> DataFrame:
    """``docs`` without the lines that aren't kept, and without documents that have no text left.

    Short lines are within two edits of very many others, so of those below ``near``
    characters only equal ones are removed; if they are white space, they stay as empty lines do.
    All columns stay; ``n_chars``, if there, follows the text. Documents that
    have no line to lose are untouched. Rows that repeat an id, or have none, lose lines by
    their own texts. The work is linear in the lines of a text.
    """
    scratch, node = Scratch(docs.sparkSession, "remove"), fresh(docs, "__node")
    rows = with_nodes(docs, scratch, node)
    judged = near_duplicates(rows.select(F.col(node).alias("doc_id"), "text"), settings)
    gone = judged.filter("not kept").groupBy(F.col("doc_id").alias("__of")).agg(
        F.collect_set("line_no").alias("__gone"))

    def cut(texts: pd.Series, gone: pd.Series) -> pd.Series:
        left = []
        for text, numbers in zip(texts, gone):
            drop = set() if numbers is None else set(numbers.tolist())
            left.append(text and "\n".join(
                line for i, line in enumerate(text.split("\n"))
                if i not in drop or len(line) < settings.near and not line.strip()))
        return pd.Series(left, dtype=object)

    # as nondeterministic it is worked out once, not in the filter as well
    kept = F.pandas_udf(cut, "string").asNondeterministic()(F.when(F.col("__gone").isNotNull(), F.col("text")), "__gone")
    joined = rows.join(gone, F.col(node) == F.col("__of"), "left")
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept)
    rest = joined.withColumn("text", text).filter("__gone is null or trim(text) <> ''")
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        rest = rest.withColumn("n_chars", F.when(F.col("__gone").isNull(), F.col("n_chars")).otherwise(length))
    return rest.select(*[F.col(f"`{c}`") for c in docs.columns])
