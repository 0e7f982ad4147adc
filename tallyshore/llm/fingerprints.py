"""Document fingerprints: invertible Bloom lookup tables of paragraph cells.

A text is cut into lines and, within them, behind words whose hash says so, so
that an edit changes the pieces around it and no others. The digests of the
pieces go to three cells each of a small table, which keeps a count and an
exclusive-or per cell. The difference of two tables holds the digests of the
pieces that differ: a cell with one of them gives it away, it is taken from its
other cells, and so on. Where that gets stuck, larger tables are tried.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshore.functions.columns import search_tree
from tallyshore.llm.common import SLICE_BYTES, mix, slices, span_hashes, text_bytes, word_spans

CELLS, HASHES = 24, 3  # of a fingerprint; HASHES divides CELLS
RETRIES = 12  # with larger tables; after that digests are compared directly
_CHECK = np.uint64(0xFFFF)


def digests(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Self-checking 64-bit digests of all pieces, and the number of the text of each.

    A piece that occurs again in its text has another digest for each time. The
    low 16 bits are a checksum of the others.
    """
    data, at = text_bytes(texts)
    starts, ends, first = word_spans(data, at)
    opens = np.zeros(len(starts), bool)
    opens[first[:-1][first[:-1] < first[1:]]] = True
    if len(starts):
        cut = span_hashes(data, starts, ends) & np.uint64(3) == 0
        lines = np.cumsum(data == 10)
        opens[1:] |= cut[:-1] | (lines[starts[1:] - 1] != lines[ends[:-1] - 1])
    begins = starts[opens]
    begins[np.searchsorted(begins, at[:-1][first[:-1] < first[1:]])] = at[:-1][first[:-1] < first[1:]]
    blank = at[:-1][(first[:-1] == first[1:]) & (at[:-1] < at[1:])]
    begins = np.sort(np.concatenate([begins, blank]))
    owner = np.searchsorted(at, begins, "right") - 1
    stops = np.append(begins[1:], len(data)) if len(begins) else begins
    hashes = span_hashes(data, begins, stops) if len(begins) else np.zeros(0, np.uint64)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    place = np.arange(len(order))
    times = place - np.maximum.accumulate(np.where(fresh, place, 0))
    return _checked(mix(hashes + times.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(16)), owner


def _checked(core: np.ndarray) -> np.ndarray:
    return core << np.uint64(16) | mix(core) & _CHECK


def _cells(keys: np.ndarray, sizes: np.ndarray, start: np.ndarray, seed: int) -> list[np.ndarray]:
    """The cells of each key, one in each part of a table of ``sizes`` cells from ``start``."""
    part = sizes // HASHES
    return [start + i * part + (mix(keys + np.uint64(seed * HASHES + i + 1)) % part.astype(np.uint64)).astype(np.int64)
            for i in range(HASHES)]


def tables(keys: np.ndarray, owner: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts and exclusive-ors of the fingerprints of ``count`` texts, a row each."""
    number, total = np.zeros(count * CELLS, np.int64), np.zeros(count * CELLS, np.uint64)
    sizes = np.full(len(keys), CELLS)
    for cell in _cells(keys, sizes, owner * CELLS, 0):
        np.add.at(number, cell, 1)
        np.bitwise_xor.at(total, cell, keys)
    return number.reshape(count, CELLS), total.reshape(count, CELLS)


def packed(number: np.ndarray, total: np.ndarray) -> list[str]:
    """Each row of tables as a string: two bytes of count and eight of exclusive-or a cell."""
    both = [number.astype("<u2").view(np.uint8), np.ascontiguousarray(total, "<u8").view(np.uint8)]
    return [base64.b64encode(row.tobytes()).decode() for row in np.concatenate(both, axis=1)]


def peel(number: np.ndarray, total: np.ndarray, sizes: np.ndarray,
         seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The digests that tables of differences held, the table and side of each, and which tables that emptied.

    The tables stand one behind the other in ``number`` and ``total``, which are used up. The side is
    1 for a digest of the text that was added, -1 for one of the text that was subtracted. A sum of several
    digests may look like one, be taken out, and come back on the other side: such pairs cancel out, and a
    table that gives more digests than it has cells is given up.
    """
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    table = np.repeat(np.arange(len(sizes)), sizes)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    given = np.zeros(len(sizes), np.int64)
    look = np.arange(len(number))
    while len(look):
        look = look[(np.abs(number[look]) == 1) & (given[table[look]] <= sizes[table[look]])]
        keys = total[look]
        good = mix(keys >> np.uint64(16)) & _CHECK == keys & _CHECK
        look, keys = look[good], keys[good]
        order = np.lexsort((keys, table[look]))
        look, keys = look[order], keys[order]
        once = np.ones(len(look), bool)
        once[1:] = (keys[1:] != keys[:-1]) | (table[look[1:]] != table[look[:-1]])
        look, keys = look[once], keys[once]
        own, sign = table[look], number[look]
        cells = _cells(keys, sizes[own], begins[own], seed)
        right = np.any([cell == look for cell in cells], axis=0)
        own, sign, keys = own[right], sign[right], keys[right]
        found.append((keys, own, sign))
        np.add.at(given, own, 1)
        touched = []
        for cell in cells:
            np.subtract.at(number, cell[right], sign)
            np.bitwise_xor.at(total, cell[right], keys)
            touched.append(cell[right])
        look = np.unique(np.concatenate(touched))
    left = np.bincount(table, (number != 0) | (total != 0), len(sizes))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), left == 0
    keys, own, sign = (np.concatenate(part) for part in zip(*found))
    order = np.lexsort((keys, own))
    keys, own, sign = keys[order], own[order], sign[order]
    begin = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (own[1:] != own[:-1]))) if len(keys) else order
    net = np.add.reduceat(sign, begin) if len(begin) else sign
    return keys[begin][net != 0], own[begin][net != 0], net[net != 0], (left == 0) & (given <= sizes)


def recovered(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray],
              count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The digests that differ in ``count`` pairs of texts: digest, pair, and 1 if the first text has it, else -1.

    Tables of the fingerprint's size first; the pairs that these are too small for are tried again with larger ones.
    """
    parts, pending = [], np.arange(count)
    amounts = np.bincount(one[1], minlength=count) + np.bincount(two[1], minlength=count)
    for attempt in range(RETRIES):
        # the fingerprint's own size, then one that holds two texts without anything in common, then doubled
        wanted = amounts[pending] * 3 // 2 * 2 ** max(0, attempt - 1)
        sizes = np.full(len(pending), CELLS) if attempt == 0 else np.maximum(CELLS, -(-wanted // HASHES) * HASHES + 6)
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
        slot = np.full(count, -1)
        slot[pending] = np.arange(len(pending))
        number, total = np.zeros(int(sizes.sum()), np.int64), np.zeros(int(sizes.sum()), np.uint64)
        for (keys, owner), sign in ((one, 1), (two, -1)):
            here = slot[owner]
            keys, here = keys[here >= 0], here[here >= 0]
            for cell in _cells(keys, sizes[here], begins[here], attempt):
                np.add.at(number, cell, sign)
                np.bitwise_xor.at(total, cell, keys)
        keys, own, sign, done = peel(number, total, sizes, attempt)
        whole = done[own]
        parts.append((keys[whole], pending[own[whole]], sign[whole]))
        pending = pending[~done]
        if not len(pending):
            break
    for i in pending:
        mine, other = one[0][one[1] == i], two[0][two[1] == i]
        for keys, sign in ((np.setdiff1d(mine, other), 1), (np.setdiff1d(other, mine), -1)):
            parts.append((keys, np.full(len(keys), i), np.full(len(keys), sign)))
    return tuple(np.concatenate(part) for part in zip(*parts))


def differing(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray], count: int) -> np.ndarray:
    """How many digests differ in each of ``count`` pairs of texts, by their tables."""
    return np.bincount(recovered(one, two, count)[1], minlength=count)


def likeness(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray], count: int) -> np.ndarray:
    """1 - differing / all digests of both; 1 if neither text has any."""
    amounts = np.bincount(one[1], minlength=count) + np.bincount(two[1], minlength=count)
    return 1 - differing(one, two, count) / np.maximum(amounts, 1)


def edited(text: str, following: str) -> str:
    """The last third of the characters replaced by the first as many of the following text."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def _compare(texts: list[str], following: str) -> dict[str, pa.Array]:
    count = len(texts)
    changed = [edited(t, n) for t, n in zip(texts, [*texts[1:], following])]
    keys, owner = digests(pa.array([*texts, following], pa.string()))
    own = keys[owner < count], owner[owner < count]
    after = keys[owner > 0], owner[owner > 0] - 1
    new = digests(pa.array(changed, pa.string()))
    return {
        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
        "fingerprint": pa.array(packed(*tables(*own, count))),
        "edited_fingerprint": pa.array(packed(*tables(*new, count))),
        "near_edited": pa.array(likeness(own, new, count)),
        "near_next": pa.array(likeness(own, after, count)),
    }


def with_following(docs: DataFrame) -> DataFrame:
    """``doc_id, text, bucket, guest``, dealt and sorted so that each row's next one follows it.

    Documents are in descending order of id, null ids last, and then of text.
    Buckets are ranges of ids, from one pass over the ids. Behind a bucket
    stands, as a guest, the first document of the next one, and behind the last
    bucket that of the first; so texts are shuffled once, and no task needs
    the order of more than its own buckets.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    count = max(8, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / count for i in range(1, count)]
    bounds = rows.agg(F.percentile_approx("doc_id", shares, 10 * count)).first()[0] or []
    # the highest ids are in bucket 0; null ids are in the last one
    bounds = sorted(set(bounds))
    last = len(bounds) + 1
    bucket = F.when(F.col("doc_id").isNull(), last).otherwise(
        F.lit(len(bounds)) - search_tree(F.col("doc_id"), bounds)).cast("int")
    tagged = rows.withColumn("bucket", bucket)
    tops = sorted(tagged.groupBy("bucket").agg(F.max("doc_id").alias("top")).collect())
    before = [b for b, _ in tops[-1:] + tops[:-1]]
    guests = spark.createDataFrame(
        [(b, t, to) for (b, t), to in zip(tops, before)], "bucket int, top long, before int")
    invited = (  # the guests are broadcast, one row a bucket at most; of equal ids the first text is invited
        tagged.join(F.broadcast(guests), "bucket").filter(F.col("doc_id").eqNullSafe(F.col("top")))
        .groupBy("doc_id", F.col("before").alias("bucket")).agg(F.min("text").alias("text"))
        .select("doc_id", "text", "bucket", F.lit(True).alias("guest")))
    return (
        tagged.withColumn("guest", F.lit(False)).unionByName(invited).repartition("bucket")
        .sortWithinPartitions("bucket", "guest", F.col("doc_id").desc_nulls_last(), "text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    One row for every row of ``docs``; a null text is empty, an empty text has a
    table of zeros. Each text is compared with its edited form and with the
    next document: see ``edited`` and ``with_following``. Rows that repeat an id
    follow each other in the order of their texts. The only document follows
    itself.
    """
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows whose following one hasn't come yet, all of one bucket but the last

        def out(rows: list[tuple], following: str) -> pa.RecordBatch:
            columns = _compare([r[1] for r in rows], following)
            return pa.RecordBatch.from_pydict(
                {"doc_id": pa.array([r[0] for r in rows], pa.int64())} | columns)

        for batch in batches:
            for part in slices(batch, most=SLICE_BYTES // 2):
                for row in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "bucket", "guest"))):
                    if row[3]:  # ends its bucket; of several guests the first one counts
                        if held:
                            yield out(held, row[1])
                            held = []
                    else:
                        held.append(row)
                if len(held) > 1:
                    yield out(held[:-1], held[-1][1])
                    held = held[-1:]

    return with_following(docs).mapInArrow(run, schema)
