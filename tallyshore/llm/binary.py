"""Token ids in ORC files: sorted by document id, in stripes that tasks read apart.

ORC stores ids as integer runs, keeps the least and greatest document id of every
file, stripe and row group, and a Bloom filter of the ids of each row group. So a
query for a few documents reads a few row groups, and one for all of them is dealt
to tasks by stripes.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyshore.llm.common import SLICE_BYTES, slices, text_bytes
from tallyshore.llm.tokens import _spans, worker_kept

PIECES_KEPT = 800_000  # encodings that a worker keeps; beyond that the older half goes
END = 2  # the id that ends a document in the query


@dataclass(frozen=True)
class Format:
    """How files are laid out: a stripe is what one task reads at least, a row group what an index entry covers."""

    stripe_bytes: int = 16 << 20
    row_group: int = 1_000
    bloom_fpp: float = 0.01
    compression: str = "zstd"

    def options(self) -> dict[str, str]:
        return {"orc.stripe.size": str(self.stripe_bytes), "orc.row.index.stride": str(self.row_group),
                "orc.create.index": "true", "orc.bloom.filter.columns": "doc_id",
                "orc.bloom.filter.fpp": str(self.bloom_fpp), "orc.compress": self.compression}


# The pattern that common tokenizers of lowered text split by, and the Latin letters that are composed already and
# become one letter each when lowered.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
_WORD = re.compile(f"[{_LETTERS}]+").fullmatch
_IS_LETTER = np.array([_WORD(chr(c)) is not None for c in range(0x800)])  # for what has up to two bytes
# What a byte is in a Latin piece, where beyond ASCII all are of letters, and in one that is left whole.
_SPACE, _LETTER, _DIGIT, _MARK, _STRANGE = range(5)
_KIND = bytes([_SPACE if c in "\t\n\x0b\x0c\r " else _LETTER if c.isalpha() else _DIGIT if c.isdigit()
               else _MARK if c.isprintable() else _STRANGE for c in map(chr, range(128))] + [_LETTER] * 128)
_WHOLE = bytes([_SPACE if c in b"\t\n\r " else _LETTER for c in range(256)])
_AT_ONCE = 200  # words that are encoded as one text


class PieceEncoder:
    """Encodes texts piece by piece, each different piece once.

    Pieces are what stands between ASCII white space: right for tokenizers that drop
    white space, so that no token reaches across it. If the tokenizer lowers, splits by
    the pattern above and marks the last token of a word, then pieces of ASCII and Latin
    letters are split by that pattern as well, and distinct words, which need neither
    its normalizer nor its pattern, are encoded by the hundred in one call, as the marks
    tell their ids apart. The pieces of all texts are cut and numbered in arrays; only
    distinct ones become strings.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self._tokenizer = Tokenizer.from_str(definition)
        #: pieces by number; the ids of all of them, one piece behind another, and where each one's begin
        self._numbers, self._ids, self._starts = {}, np.zeros(0, np.int32), np.zeros(1, np.int64)
        parts = json.loads(definition)
        normal = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
        steps = (parts["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        mark = parts["model"].get("end_of_word_suffix")
        self._special = [t["content"] for t in parts["added_tokens"]]
        self._last = None  # by id, whether it ends a word
        if (mark and normal == ["NFC", "Replace", "Lowercase"] and steps[0].get("pattern", {}).get("Regex") == _PATTERN
                and not any(_WORD(content.replace(" ", "")) for content in self._special)):
            vocabulary = self._tokenizer.get_vocab()
            self._last = np.zeros(max(vocabulary.values()) + 1, bool)
            self._last[[i for token, i in vocabulary.items() if token.endswith(mark)]] = True
            parts["normalizer"] = None
            parts["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, *steps[1:]]}
            self._of_words = Tokenizer.from_str(json.dumps(parts))

    def _left_whole(self, texts: pa.Array, raw: bytes, at: np.ndarray) -> np.ndarray | None:
        """Whether a byte is in a piece with other than ASCII and Latin letters, or in a text with a special token;
        None if no byte is."""
        data = np.frombuffer(raw, np.uint8)
        lead = np.flatnonzero(data >= 0xC0)
        first = data[lead]
        letter = _IS_LETTER[(first & 0x1F).astype(np.int32) << 6 | data[lead + 1] & 0x3F] & (first < 0xE0)
        strange = [lead[~letter], np.flatnonzero(np.frombuffer(raw.translate(_KIND), np.uint8) == _STRANGE)]
        for content in self._special:
            if content.encode() in raw:
                rows = pc.match_substring(texts, content).fill_null(False).to_numpy(zero_copy_only=False)
                strange += [np.arange(at[row], at[row + 1]) for row in np.flatnonzero(rows)]
        strange = np.concatenate(strange)
        if not len(strange):
            return None
        edge = np.frombuffer(raw.translate(_WHOLE), np.uint8) == _SPACE
        edge[at[:-1][at[:-1] < len(data)]] = True
        edges = np.append(np.flatnonzero(edge), len(data))
        hit = np.unique(np.searchsorted(edges, strange, "right"))
        steps = np.zeros(len(data) + 1, np.int8)
        steps[edges[hit - 1]] += 1
        steps[edges[hit]] -= 1
        return np.cumsum(steps[:-1], dtype=np.int8).view(bool)

    def _split(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All pieces, and where each text's begin. A-Z is lowered in pieces that aren't left whole."""
        data, at = text_bytes(texts)
        raw = data.tobytes()
        whole = self._left_whole(texts, raw, at) if self._last is not None else True
        kind = np.frombuffer(raw.translate(_WHOLE if whole is True else _KIND), np.uint8)
        if whole is not True:
            lowered = np.frombuffer(raw.lower(), np.uint8)  # of bytes: A-Z only
            if whole is None:
                data = lowered
            else:
                kind = np.where(whole, np.frombuffer(raw.translate(_WHOLE), np.uint8), kind)
                data = np.where(whole, data, lowered)
        solid = kind != _SPACE
        begins = solid.copy()
        begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        begin = at[:-1][at[:-1] < len(data)]
        begins[begin] = solid[begin]
        # 's, 't, 'm, 'd, 're, 've and 'll are pieces where they follow no mark; other letters begin behind them
        quotes = np.flatnonzero(begins & (kind == _MARK) & (data == ord("'")))
        room = at[np.searchsorted(at, quotes, "right")] - quotes
        one, two = (data[np.minimum(quotes + k, len(data) - 1)] for k in (1, 2))
        size = np.where((room > 1) & np.isin(one, list(b"stmd")), 2, 0)
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        size[(room > 2) & pair] = 3
        quotes, size = quotes[size > 0], size[size > 0]
        begins[quotes + 1] = False
        behind = (quotes + size)[quotes + size < len(data)]
        begins[behind] = solid[behind]
        first = np.searchsorted(np.flatnonzero(begins), at)
        data, begin = data[solid], np.flatnonzero(begins[solid])
        offsets = np.append(begin, len(data)).astype(np.int64)
        return pa.Array.from_buffers(
            pa.large_string(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(data)]), first

    def _learn(self, pieces: list[str]) -> None:
        """Encodes pieces, which have the next numbers."""
        words = [k for k, p in enumerate(pieces) if _WORD(p)] if self._last is not None else []
        single, order, found, sizes = set(range(len(pieces))).difference(words), [], [], []
        for start in range(0, len(words), 50 * _AT_ONCE):
            some = words[start:start + 50 * _AT_ONCE]
            runs = [some[at:at + _AT_ONCE] for at in range(0, len(some), _AT_ONCE)]
            lowered = [" ".join([pieces[k] for k in run]).lower() for run in runs]
            for run, e in zip(runs, self._of_words.encode_batch_fast(lowered, add_special_tokens=False)):
                ids = np.array(e.ids, np.int32)
                ends = np.flatnonzero(self._last[ids]) + 1
                if len(ends) != len(run):  # no mark behind a word that the vocabulary can't spell
                    single.update(run)
                    continue
                order += run
                found.append(ids)
                sizes.append(np.diff(ends, prepend=0))
        rest = sorted(single)
        for start in range(0, len(rest), 10_000):
            some = rest[start:start + 10_000]
            batch = self._tokenizer.encode_batch_fast([pieces[k] for k in some], add_special_tokens=False)
            ids = [e.ids for e in batch]
            order += some
            found.append(np.fromiter(chain.from_iterable(ids), np.int32))
            sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
        order, sizes = np.argsort(order), np.concatenate(sizes)
        ids = _spans(np.concatenate(found), (np.cumsum(sizes) - sizes)[order], sizes[order])
        self._ids = np.concatenate([self._ids, ids])
        self._starts = np.concatenate([self._starts, self._starts[-1] + np.cumsum(sizes[order])])

    def _forget(self) -> None:
        """Forgets the older half of the pieces; what is asked for again is worked out again."""
        cut = len(self._numbers) // 2
        self._numbers = {piece: n - cut for piece, n in islice(self._numbers.items(), cut, None)}
        self._ids, self._starts = self._ids[self._starts[cut]:], self._starts[cut:] - self._starts[cut]

    def encode_rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind another, and where each text's begin."""
        if len(self._numbers) > PIECES_KEPT:
            self._forget()
        pieces, first = self._split(texts)
        pieces, known = pieces.dictionary_encode(), len(self._numbers)
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(self._numbers.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            numbers[new] = np.arange(known, known + len(new))
            learned = [distinct[k] for k in new.tolist()]
            self._learn(learned)
            self._numbers.update(zip(learned, range(known, known + len(new))))
        numbers = numbers[pieces.indices.to_numpy()]
        begin = self._starts[numbers]
        sizes = self._starts[numbers + 1] - begin
        return _spans(self._ids, begin, sizes), np.concatenate([[0], np.cumsum(sizes)])[first]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, four bytes each, the lowest first."""
        ids, at = self.encode_rows(pa.array(texts, pa.large_string()))
        data = ids.astype("<u4").tobytes()
        return [data[4 * a:4 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def _ordered(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` in ranges of ascending ids, null first; rows that share an id in the order of their texts.

    The hash of the text is part of the range key, so that an id with very many rows is spread as well.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["doc_id", "_hash", "text"]
    return (rows.withColumn("_hash", F.xxhash64("text")).repartitionByRange("doc_id", "_hash")
            .sortWithinPartitions(*order).select("doc_id", "text"))


def encode_ordered(docs: DataFrame, tokenizer_path: str, end: int | None = END) -> DataFrame:
    """``doc_id, before, token_ids`` of every whole text, in ascending order of ``doc_id``.

    ``before`` counts the ids of the partition's earlier documents. ``end`` is appended
    to each document, also to an empty or null text. Repeated rows stay, other columns
    are left out. The tokenizer's file, of fixed size, is read on the driver; a
    worker keeps tokenizer and encoded runs for its life.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    sent = docs.sparkSession.sparkContext.broadcast(definition)
    digest = hashlib.sha256(definition.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # as for the other tokenizer: many small objects and no cycles
        encoder = worker_kept(("pieces", digest), lambda: PieceEncoder(sent.value))
        before = 0
        for batch in batches:
            for part in slices(batch, most=4 * SLICE_BYTES):
                ids, at = encoder.encode_rows(part.column("text"))
                if end is not None:
                    ids, at = np.insert(ids, at[1:], end), at + np.arange(len(at))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(before + at[:-1]),
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids))], ["doc_id", "before", "token_ids"])
                before += int(at[-1])

    return _ordered(docs).mapInArrow(run, "doc_id long, before long, token_ids array<int>")


def write(encoded: DataFrame, path: str, layout: Format = Format()) -> None:
    """Writes what ``encode_ordered`` returns, a file for each of its partitions."""
    encoded.write.options(**layout.options()).orc(path)


def read(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """``doc_id, before, token_ids``, of all documents or of a few listed ids.

    The ids are pushed down to the files: stripes and row groups whose range or
    Bloom filter excludes them are not read.
    """
    stored = spark.read.schema("doc_id long, before long, token_ids array<int>").orc(path)
    return stored if doc_ids is None else stored.filter(F.col("doc_id").isin([int(i) for i in doc_ids]))


def _part() -> Column:
    """The number of the partition that wrote a row, from the name of its file."""
    return F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("long")


def starts(stored: DataFrame) -> DataFrame:
    """``part, offset``: how many ids stand before each written partition.

    Partitions are numbered in the order of their ids. The window holds one row for each that has rows.
    """
    parts = stored.groupBy(_part().alias("part")).agg(F.max(F.col("before") + F.size("token_ids")).alias("ids"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("offset"))


def digests(stored: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every stored document; tasks read stripes apart.

    ``start`` is the number of ids of all documents before it, and the checksum is
    that of the ids as unsigned 32-bit integers, the lowest byte first.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("token_ids")
            at = ids.offsets.to_numpy() - ids.offsets[0].as_py() if len(ids) else np.zeros(1, np.int64)
            data = memoryview(ids.flatten().to_numpy().astype("<u4").tobytes())
            crcs = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("doc_id"), batch.column("before"),
                 pa.array(np.diff(at), pa.int64()), pa.array(crcs, pa.int64())],
                ["part", "doc_id", "before", "n_tokens", "ids_crc32"])

    rows = stored.select(_part().alias("part"), "doc_id", "before", "token_ids").mapInArrow(
        run, "part long, doc_id long, before long, n_tokens long, ids_crc32 long")
    # one row of two numbers for each task that wrote: small enough to broadcast
    return rows.join(F.broadcast(starts(stored)), "part").select(
        "doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
