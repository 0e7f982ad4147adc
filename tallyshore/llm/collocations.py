"""Phrase collocations by prefix-free parsing.

A text is parsed into chunks that begin and end with a triggering run of words,
one word shorter than the longest phrase, and that overlap by that run. Equal
passages give equal chunks wherever they stand, so the chunks form a dictionary
with frequencies, and phrases are counted inside of its entries, each times the
frequency. Every phrase belongs to the one chunk in which its first word stands
before the closing run.

Phrases below the least frequency are left out exactly: a phrase is no more
frequent than the pairs in it. Pairs are counted by 64-bit hashes, where a
collision can only add to a count; longer phrases are spelled out if all
their pairs may be frequent, and counted by their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyshore.llm.common import SLICE_BYTES, Scratch, mix, slices, span_hashes, text_bytes

LONGEST = 4  # words of a phrase
OVERLAP = LONGEST - 1  # words of a trigger
UNKNOWN = "und"
FILTER_BITS = 26  # of the filter of pairs at most (8 MB); a fuller one lets more phrases through to be counted
SALTS = 16  # tasks per language that look for its first phrases


@dataclass(frozen=True)
class Settings:
    least: int = 30  # occurrences of a candidate
    scale: int = 2_000_000
    inside: int = 80  # percent of a phrase's occurrences that a longer one takes over
    top: int = 2_000
    trigger: int = 32  # one run of words in so many ends a chunk


_KIND = np.zeros(256, np.uint8)  # 0: part of a word, 1: between words, 2: between pieces
_KIND[[9, 32]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\v\f\r"]] = 2
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
_MARK = 9  # before the closing run of a chunk; no word holds it


def _runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words, by the hashes of the words."""
    with np.errstate(over="ignore"):
        factors = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        found = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
        for i, factor in enumerate(factors):
            found += hashes[i:i + len(found)] * factor
        return mix(found)


def _words(data: np.ndarray, at: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the words of texts that begin at ``at``."""
    word = kinds == 0
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    inner = at[:-1][at[:-1] < len(data)]
    before[inner] = False
    after[at[1:][at[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def chunks(texts: pa.Array, trigger: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The chunks of all texts, the number of the text and of the words that belong to each.

    In a chunk a space stands between words of a piece, a line end between pieces,
    and a tab before the closing run, whose words belong to the next chunk.
    """
    data, at = text_bytes(texts)
    if not len(data):
        return [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = _LOWERED[data]
    kinds = _KIND[data]
    starts, ends, owner = _words(data, at, kinds)
    if not len(starts):
        return [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.ones(len(starts), bool)
    first[1:] = owner[1:] != owner[:-1]
    breaks = np.cumsum(kinds == 2)
    opens = first.copy()
    opens[1:] |= breaks[starts[1:] - 1] != breaks[ends[:-1] - 1]
    runs = _runs(span_hashes(data, starts, ends), OVERLAP)
    begins = first.copy()
    cut = runs % np.uint64(trigger) == 0
    cut &= owner[:len(runs)] == owner[OVERLAP - 1:]
    begins[:len(cut)] |= cut
    # all words with one byte before each, which then says how it is joined to the last one
    kept = kinds == 0
    joins = starts[~first] - 1
    kept[joins] = True
    data[joins] = np.where(opens[~first], 10, 32)
    place = np.concatenate([[0], np.cumsum(kept)])
    out = data[kept].tobytes()
    begin = np.flatnonzero(begins)
    after = np.append(begin[1:], len(starts))
    closing = np.zeros(len(begin), bool)
    closing[:-1] = ~first[begin[1:]]
    own = place[ends[after - 1]]
    last = np.where(closing, place[ends[np.minimum(after + OVERLAP, len(starts)) - 1]], own)
    found = [out[a:b] + b"\t" + out[b:c] if c > b else out[a:b]
             for a, b, c in zip(place[starts[begin]].tolist(), own.tolist(), last.tolist())]
    return found, owner[begin], after - begin


def dictionary(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``lang, chunk, own, times``: the distinct chunks of each language, their own words, how often they occur."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found, owner, own = chunks(part.column("text"), settings.trigger)
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang").take(pa.array(owner)), pa.array(found, pa.string()), pa.array(own, pa.int32())],
                    ["lang", "chunk", "own"])

    return rows.mapInArrow(run, "lang string, chunk string, own int").groupBy("lang", "chunk", "own").agg(
        F.count("*").alias("times"))


class _Parsed:
    """The words of the chunks of a batch: hashes, where they stand, and which phrases begin at each."""

    def __init__(self, batch: pa.RecordBatch):
        data, at = text_bytes(batch.column("chunk"))
        mark = data == _MARK
        removed = np.concatenate([[0], np.cumsum(mark)])
        self.data, self.at = data[~mark], at - removed[at]
        self.starts, self.ends, self.chunk = _words(self.data, self.at, _KIND[self.data])
        langs = batch.column("lang").dictionary_encode()
        self.langs, self.lang = langs.dictionary, langs.indices.to_numpy().astype(np.int64)[self.chunk]
        self.times = batch.column("times").to_numpy()[self.chunk]
        self.hashes = span_hashes(self.data, self.starts, self.ends)
        place = np.arange(len(self.starts))
        first = np.searchsorted(self.chunk, np.arange(len(self.at) - 1))
        self.counted = place < (first + batch.column("own").to_numpy())[self.chunk]
        # the number of the piece of each word, of all chunks
        opens = np.ones(len(self.starts), bool)
        opens[1:] = (self.chunk[1:] != self.chunk[:-1]) | (self.data[self.starts[1:] - 1] == 10)
        self.piece = np.cumsum(opens)
        seeds = span_hashes(*_spans(self.langs)) if len(self.langs) else np.zeros(0, np.uint64)
        self.seed = mix(seeds)[self.lang]

    def phrases(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Where phrases of ``size`` words begin, as numbers of their first words, and their hashes with the language."""
        runs = _runs(self.hashes, size)
        good = np.flatnonzero(self.counted[:len(runs)] & (self.piece[:len(runs)] == self.piece[size - 1:]))
        with np.errstate(over="ignore"):
            return good, mix(runs[good] + self.seed[good])


def _spans(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, at = text_bytes(texts)
    return (data if len(data) else np.zeros(1, np.uint8)), at[:-1], at[1:]


def _added(hashes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, the place of one of each, and the sums of ``times``, in whole numbers."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    begin = np.flatnonzero(fresh)
    sums = np.add.reduceat(times[order], begin) if len(begin) else np.zeros(0, np.int64)
    return ordered[begin], order[begin], sums


def frequent_pairs(chunked: DataFrame, settings: Settings) -> DataFrame:
    """``hash`` of every pair of words of a language with at least ``settings.least`` occurrences, and of few others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "chunk", most=8 * SLICE_BYTES):
                parsed = _Parsed(part)
                at, hashes = parsed.phrases(2)
                found, _, times = _added(hashes, parsed.times[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(times, pa.int64())], ["hash", "times"])

    return chunked.mapInArrow(run, "hash long, times long").groupBy("hash").agg(
        F.sum("times").alias("times")).filter(F.col("times") >= settings.least).select("hash")


def _cells(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Two cells of a filter of 2^bits for each hash."""
    other = (hashes * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)
    return [(hashes >> np.uint64(64 - bits)).astype(np.int64), other.astype(np.int64)]


def pair_filter(pairs: DataFrame) -> np.ndarray:
    """A filter that holds all hashes of ``pairs``, 16 bits for each up to 2^FILTER_BITS bits in all.

    Tasks mark cells, so no hash reaches the driver; it gets at most 2^FILTER_BITS / 32 words.
    """
    bits = int(min(FILTER_BITS, max(10, pairs.count().bit_length() + 4)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("hash").to_numpy().view(np.uint64)
            cells = np.unique(np.concatenate(_cells(hashes, bits)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells >> 5), pa.array(1 << (cells & 31))], ["word", "marks"])

    words = pairs.mapInArrow(run, "word long, marks long").groupBy("word").agg(
        F.bit_or("marks").alias("marks")).toArrow()
    found = np.zeros(1 << (bits - 5), np.uint32)
    found[words.column("word").to_numpy()] = words.column("marks").to_numpy().astype(np.uint32)
    return found


def _holds(found: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = len(found).bit_length() + 4
    held = np.ones(len(hashes), bool)
    for cells in _cells(hashes, bits):
        held &= (found[cells >> 5] >> (cells & 31).astype(np.uint32)) & 1 == 1
    return held


def counted_phrases(chunked: DataFrame, pairs: np.ndarray) -> DataFrame:
    """``lang, phrase, words, times``: exact counts of all words, and of the phrases whose pairs the filter holds."""
    sent = chunked.sparkSession.sparkContext.broadcast(pairs)

    def rows(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        parsed = _Parsed(part)
        raw = parsed.data.tobytes()
        likely = np.zeros(len(parsed.starts) + 1, bool)  # a frequent pair begins here, in or behind the counted part
        runs = _runs(parsed.hashes, 2)
        same = np.flatnonzero(parsed.piece[:len(runs)] == parsed.piece[1:])
        with np.errstate(over="ignore"):
            likely[same] = _holds(sent.value, mix(runs[same] + parsed.seed[same]))
        for size in range(1, LONGEST + 1):
            at, hashes = parsed.phrases(size)
            for i in range(size - 1):
                good = likely[at + i]
                at, hashes = at[good], hashes[good]
            a, b = parsed.starts[at], parsed.ends[at + size - 1]
            # a second, independent hash: phrases are told apart by 128 bits within a batch
            check = span_hashes(parsed.data[::-1], len(parsed.data) - b, len(parsed.data) - a)
            order = np.argsort(hashes)
            other = hashes[order][1:] != hashes[order][:-1]
            if (check[order][1:] != check[order][:-1])[~other].any():
                order = np.lexsort((check, hashes))
                other = (hashes[order][1:] != hashes[order][:-1]) | (check[order][1:] != check[order][:-1])
            begin = np.flatnonzero(np.append(True, other)) if len(order) else order
            if not len(begin):
                continue
            one = order[begin]
            yield pa.RecordBatch.from_arrays([
                parsed.langs.take(pa.array(parsed.lang[at[one]])),
                pa.array([raw[x:y] for x, y in zip(a[one].tolist(), b[one].tolist())], pa.string()),
                pa.array(np.full(len(one), size), pa.int32()),
                pa.array(np.add.reduceat(parsed.times[at][order], begin), pa.int64())],
                ["lang", "phrase", "words", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "chunk", most=8 * SLICE_BYTES):
                yield from rows(part)

    return chunked.mapInArrow(run, "lang string, phrase string, words int, times long").groupBy(
        "lang", "phrase", "words").agg(F.sum("times").alias("times"))


def _between(phrase: str, start: Column, count: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), start, count), " ")


def scored(frequent: DataFrame, settings: Settings) -> DataFrame:
    """``lang, phrase, words, a, l, r, score`` of all candidates, by their weakest cut."""
    candidates = frequent.filter("words > 1").select("lang", "phrase", "words", F.col("times").alias("a"))
    known = frequent.filter(F.col("words") < LONGEST).select("lang", F.col("phrase").alias("part"), "times")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).withColumns({
        "first": _between("phrase", F.lit(1), F.col("k")),
        "rest": _between("phrase", F.col("k") + 1, F.col("words") - F.col("k"))})
    found = (
        cuts.join(known.withColumnsRenamed({"part": "first", "times": "l"}), ["lang", "first"])
        .join(known.withColumnsRenamed({"part": "rest", "times": "r"}), ["lang", "rest"])
        .withColumn("score", F.expr(
            f"cast((cast(a as decimal(19, 0)) * {settings.scale}BD) div (cast(l as decimal(19, 0)) + r) as long)")))
    return found.groupBy("lang", "phrase", "words", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def maximal(candidates: DataFrame, settings: Settings) -> DataFrame:
    """Candidates that don't stand inside a longer one with nearly all of their occurrences."""
    places = F.expr("""flatten(transform(sequence(2, words - 1), size -> transform(
        sequence(1, words - size + 1), start -> array_join(slice(split(phrase, ' '), start, size), ' '))))""")
    longer = candidates.filter("words > 2").select("lang", F.explode(places).alias("phrase"), "a").groupBy(
        "lang", "phrase").agg(F.max("a").alias("_longer"))
    taken = F.expr(f"cast(_longer as decimal(19, 0)) * 100BD >= cast(a as decimal(19, 0)) * {settings.inside}BD")
    return candidates.join(longer, ["lang", "phrase"], "left").filter(
        F.col("_longer").isNull() | ~taken).drop("_longer")


def best(candidates: DataFrame, settings: Settings) -> DataFrame:
    """The first candidates of each language with their ``rank``, found among the first ones of a few shares of it."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = Window.partitionBy("lang", "_salt").orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    some = candidates.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn(
        "rank", F.row_number().over(share)).filter(F.col("rank") <= settings.top)
    return some.withColumn("rank", F.row_number().over(whole).cast("long")).filter(
        F.col("rank") <= settings.top).drop("_salt")


def mine(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the strongest phrases of each language.

    A to Z are lowered; texts end pieces at ``. , ; : ! ?`` and line ends, and pieces
    words at spaces and tabs. A null language is ``und``, a null or empty text has no
    words; repeated rows count as often as they occur, other columns don't matter.
    A language without candidates has no rows. The dictionary and the frequent pairs
    and phrases are written to the shared folder.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    chunked = scratch.keep(dictionary(docs, settings), "dictionary")
    pairs = scratch.keep(frequent_pairs(chunked, settings), "pairs")
    counts = counted_phrases(chunked, pair_filter(pairs))
    frequent = scratch.keep(counts.filter(F.col("times") >= settings.least), "frequent")
    words = chunked.groupBy("lang").agg(F.sum(F.col("own") * F.col("times")).alias("n"))  # one row per language
    candidates = scratch.keep(scored(frequent, settings), "candidates")
    found = best(maximal(candidates, settings), settings)
    return found.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
