"""Fill-in-the-middle: documents rearranged by secondary sort.

Each document is cut into prefix, middle and suffix, and these into pieces of a
bounded number of code points, keyed by the document and the place of the piece
in the output. Documents are dealt to partitions and their pieces sorted by
place there, so that a task sees every output as a stream, however long, and
keeps one piece and a digest at a time. Restoring reads the outputs that way,
finds the parts by their marks alone, and sorts the same partitions again by
where a piece stood in the text, without another shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshore.llm.common import SLICE_BYTES, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
_PLACE_IN_TEXT = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
_SHIFT = 40  # of the part's number in a place; below are the numbers of its pieces


@dataclass(frozen=True)
class Settings:
    seed: str = "1"
    rate: int = 90  # percent of the documents that are rearranged
    spm: int = 20  # percent of those that start with the suffix
    piece: int = 1 << 16  # code points of a piece at most


@dataclass(frozen=True)
class Cut:
    form: str
    prefix: int = 0
    middle: int = 0


def cut(doc_id: int | None, text: str, settings: Settings = Settings()) -> Cut:
    """Form and part sizes of one document, from the hash of its id; a null id counts as ``null``."""
    key = f"{settings.seed}:{'null' if doc_id is None else doc_id}"
    h = hashlib.sha256(key.encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= settings.rate:
        return Cut("plain")
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    return Cut("spm" if h4 % 100 < settings.spm else "psm", a, b - a)


def output_pieces(text: str, found: Cut, size: int) -> Iterator[str]:
    """The output in order, each part's mark at the head of its first piece."""
    if found.form == "plain":
        for i in range(0, max(1, len(text)), size):
            yield text[i:i + size]
        return
    second = found.prefix + found.middle
    parts = {PREFIX: (0, found.prefix), MIDDLE: (found.prefix, second), SUFFIX: (second, len(text))}
    for mark in ORDERS[found.form]:
        start, end = parts[mark]
        yield mark + text[start:min(end, start + size)]
        for i in range(start + size, end, size):
            yield text[i:min(end, i + size)]


_KEYS = "doc_id long, text_key long, row long"
_FACTS = "n long, form string, prefix_chars long, middle_chars long"
_KEY, _FACT = ["doc_id", "text_key", "row"], ["n", "form", "prefix_chars", "middle_chars"]


def pieces(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The outputs as rows: ``doc_id, text_key, row, place, piece``, and ``n, form, prefix_chars, middle_chars``.

    Keys tell a row of ``docs`` apart: its id, a hash of its text, and its number
    among the rows that the task read, for those that repeat both. ``place``
    orders a document's pieces. Every row has at least one, also that of an empty or null text.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row")).withColumn("text_key", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=4 * SLICE_BYTES):
                out: list[tuple] = []
                for doc_id, text_key, row, text in zip(*(part.column(c).to_pylist() for c in (*_KEY, "text"))):
                    found = cut(doc_id, text, settings)
                    sizes = (None, None) if found.form == "plain" else (found.prefix, found.middle)
                    for place, piece in enumerate(output_pieces(text, found, settings.piece)):
                        out.append((doc_id, text_key, row, place, piece, len(text), found.form, *sizes))
                yield _batch(out, schema)

    schema = f"{_KEYS}, place long, piece string, {_FACTS}"
    return rows.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)], [name for name, _ in fields])


def assembled(outputs: DataFrame) -> DataFrame:
    """Pieces dealt by document and sorted by place within their partitions."""
    return outputs.repartition("doc_id", "text_key").sortWithinPartitions(*_KEY, "place")


def texts(outputs: DataFrame) -> DataFrame:
    """``doc_id, form, output`` with whole outputs as values, for those who want rows and not streams."""
    return outputs.groupBy(*_KEY).agg(
        F.first("form").alias("form"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "piece"))), lambda p: p["piece"]), "")
        .alias("output")).select("doc_id", "form", "output")


def _streams(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        for part in slices(batch, "piece", most=4 * SLICE_BYTES):
            yield from zip(*(part.column(c).to_pylist() for c in columns))


def _flushed(rows: Iterator[tuple], schema: str, piece: int) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about four million characters in the column numbered ``piece``."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[piece] or "") + 100
        if chars > 4 * SLICE_BYTES:
            yield _batch(held, schema)
            held, chars = [], 0
    if held:
        yield _batch(held, schema)


def digests(outputs: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256``, a row per document.

    Both digests are worked out piece by piece. The restored text is rebuilt from
    the pieces of the output and the form alone.
    """
    middle_schema = f"{_KEYS}, spot long, piece string, {_FACTS}, output_sha256 string"
    last_schema = f"doc_id long, {_FACTS}, output_sha256 string, restored_sha256 string"

    def read_outputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            key = facts = digest = None
            for *now, piece, n, form, prefix, middle in _streams(batches, [*_KEY, "piece", *_FACT]):
                if now != key:
                    if key is not None:
                        yield *key, 1 << 62, None, *facts, digest.hexdigest()
                    key, facts, digest, spot = now, (n, form, prefix, middle), hashlib.sha256(), 0
                digest.update(piece.encode())
                mark = piece[:3]
                if form != "plain" and mark in _PLACE_IN_TEXT:  # no text of this form has a mark itself
                    spot, piece = _PLACE_IN_TEXT[mark] << _SHIFT, piece[3:]
                yield *key, spot, piece, None, None, None, None, None
                spot += 1
            if key is not None:  # behind its pieces: what is known of the document
                yield *key, 1 << 62, None, *facts, digest.hexdigest()

        yield from _flushed(rows(), middle_schema, 4)

    def read_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            digest = hashlib.sha256()
            for doc_id, piece, *facts in _streams(batches, ["doc_id", "piece", *_FACT, "output_sha256"]):
                if piece is None:
                    yield doc_id, *facts, digest.hexdigest()
                    digest = hashlib.sha256()
                else:
                    digest.update(piece.encode())

        yield from _flushed(rows(), last_schema, 2)

    streamed = assembled(outputs).mapInArrow(read_outputs, middle_schema)
    return streamed.sortWithinPartitions(*_KEY, "spot").mapInArrow(read_texts, last_schema)
