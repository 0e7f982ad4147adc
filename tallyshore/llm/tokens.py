"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string there is one token that can end its encoding.
It is found from left to right: a token may follow the last token of the rest
if the two, joined, encode to just that pair. With the last token of every
prefix stored, appending bytes only extends the table, cutting is reading an
earlier row, and an edit works out the rows behind it until they agree with the
old ones again. The tables of many short pieces are worked out side by side, a
row of all of them at a time.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
import sys
import types
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyshore.llm.common import slices

PIECES_KEPT, PAIRS_KEPT = 300_000, 500_000  # entries of a worker's caches; beyond them the oldest half goes
NEVER = 1 << 60
_RANK_BITS = 32
SHORT, SIDE_BY_SIDE = 64, 1 << 14  # bytes of a piece, and pieces, whose tables are worked out together
_FIT_BITS = 20  # of the places where answers on pairs are kept, 8 bytes each
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
# The common pattern, and its equal for texts of ASCII and Latin letters only, in the
# standard library's faster terms.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LATIN = re.compile(r"""'(?:[stmd]|re|ve|ll)| ?[A-Za-z\xc0-\u024f]+| ?[0-9]+| ?[!-/:-@\[-`{-~]+|\s+(?!\S)|\s+""").findall
_BEYOND_LATIN = re.compile("[^\t-\r\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\u024f]").search


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks from lines of a base64 token and its number."""
    lines = (line.split() for line in data.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in lines}


def _thin(kept: dict, most: int) -> None:
    """Forgets the older half of a cache that is full; what is asked for again is worked out again."""
    if len(kept) >= most:
        for key in list(islice(kept, len(kept) // 2)):
            del kept[key]


class Vocabulary:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self._edges: tuple[dict, dict] = {}, {}
        self._pairs: dict[int, bool] = {}
        #: the tokens read from the end: the node behind a node and a byte, in one dict, as one
        #: for each node takes three times the memory; and the rank of a node's token, or -1
        self.endings: dict[int, int] = {}
        self.ends = [-1]
        for token, rank in ranks.items():
            node = 0
            for byte in reversed(token):
                step = node << 8 | byte
                node = self.endings.get(step, 0)
                if not node:
                    node = self.endings[step] = len(self.ends)
                    self.ends.append(-1)
            self.ends[node] = rank

    def merge(self, piece: bytes, down_to: int = 1) -> list[bytes]:
        """The definition: join the neighbors of lowest rank, first ones first, while any join is a token."""
        parts, ranks = [piece[i:i + 1] for i in range(len(piece))], self.ranks.get
        joins = [ranks(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while len(parts) > down_to:
            rank = min(joins)
            if rank == NEVER:
                break
            i = joins.index(rank)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del joins[i]
            for at in range(max(0, i - 1), min(i + 1, len(joins))):
                joins[at] = ranks(parts[at] + parts[at + 1], NEVER)
        return parts

    def edges(self, token: bytes, side: int) -> list[tuple[bytes, int]] | None:
        """What stands at the left (0) or right (1) end while the token is put
        together, each with the rank of the join that ends it; None if its
        bytes never merge to the token."""
        known = self._edges[side]
        if token not in known:
            if len(token) == 1:
                known[token] = [(token, NEVER)]
            else:
                parts = self.merge(token, 2)
                inner = self.edges(parts[-side], side) if len(parts) == 2 else None
                known[token] = inner and [
                    *inner[:-1], (parts[-side], self.ranks[token]), (token, NEVER)]
        return known[token]

    def fits(self, a: int, b: int) -> bool:
        """Whether the token of rank b may follow that of rank a."""
        pair = a << _RANK_BITS | b
        found = self._pairs.get(pair)
        if found is None:
            _thin(self._pairs, PAIRS_KEPT)
            found = self._pairs[pair] = self._stay_apart(self.tokens[a], self.tokens[b])
        return found

    def _stay_apart(self, a: bytes, b: bytes) -> bool:
        """No join across the border comes before those that build a and b."""
        left, right, ranks = self.edges(a, 1), self.edges(b, 0), self.ranks
        if not left or not right:
            return False
        i = j = 0
        while True:
            (end, ended), (start, starts) = left[i], right[j]
            across = ranks.get(end + start, NEVER)
            if across < ended and across <= starts and across < NEVER:
                return False
            if ended == starts == NEVER:
                return True
            if ended <= starts:  # of equal ranks the first in the text is joined first
                i += 1
            else:
                j += 1


class PrefixTable:
    """The rank of the last token of every prefix of ``data``; ``last[0]``, for the empty one, is -1."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def extend(self, size: int) -> None:
        """Works out the rows up to the prefix of ``size`` bytes, each from the tokens that can end it."""
        v, data, last = self.vocabulary, self.data, self.last
        behind, ends, pairs, fits = v.endings.get, v.ends, v._pairs, v.fits
        for i in range(len(last), size + 1):
            node, j, found = 0, i, []
            while j:
                node = behind(node << 8 | data[j - 1])
                if node is None:
                    break
                j -= 1
                rank = ends[node]
                if rank >= 0:
                    found.append((j, rank))
            for j, rank in reversed(found):  # the longest first
                if j:
                    fit = pairs.get(last[j] << _RANK_BITS | rank)
                    if fit is None:
                        fit = fits(last[j], rank)
                else:
                    fit = v.edges(data[:i], 0)
                if fit:
                    last.append(rank)
                    break
            else:
                raise ValueError(f"no token ends the first {i} bytes; the ranks lack a byte")

    def append(self, more: bytes) -> None:
        self.data += more
        self.extend(len(self.data))

    def cut(self, size: int) -> None:
        """Keeps the first ``size`` bytes."""
        self.data = self.data[:size]
        del self.last[size + 1:]

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Puts ``new`` in place of ``data[start:end]``; returns how many rows were worked out.

        Rows up to ``start`` stay. Behind the edit, once the rows of a whole
        longest token equal the old ones, all later rows do too, as a row
        depends on no more than so many bytes and rows before it.
        """
        old_last, shift = self.last, len(new) - (end - start)
        old_size = len(self.data)
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old_last[:start + 1]
        same = worked = 0
        for i in range(start + 1, len(self.data) + 1):
            self.extend(i)
            worked += 1
            same = same + 1 if i - shift > end and self.last[i] == old_last[i - shift] else 0
            if same >= self.vocabulary.longest and i - shift - same >= end:
                self.last += old_last[i - shift + 1:old_size + 1]
                break
        return worked

    def tokens(self, size: int | None = None) -> list[int]:
        """Encoding of the whole, or of the first ``size`` bytes."""
        i, found, last, token = len(self.data) if size is None else size, [], self.last, self.vocabulary.tokens
        while i:
            found.append(last[i])
            i -= len(token[last[i]])
        return found[::-1]


class NumberTable:
    """Distinct numbers from 0 on, and what stands for each, looked up many at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = (2 * len(keys) + 1).bit_length()
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int32)
        at, rest = _places(keys, self.bits), np.arange(len(keys))
        while len(rest):  # of those that meet at a free place one gets it, the others go on to the next
            free = rest[self.keys[at[rest]] == -1]
            self.keys[at[free]] = keys[free]
            placed = self.keys[at[rest]] == keys[rest]
            self.values[at[rest[placed]]] = values[rest[placed]]
            rest = rest[~placed]
            at[rest] = (at[rest] + 1) % len(self.keys)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 for an unknown number."""
        at = _places(keys, self.bits)
        there, found = self.keys[at], self.values[at]
        rest = np.flatnonzero((there != keys) & (there != -1))
        while len(rest):
            at[rest] = (at[rest] + 1) % len(self.keys)
            there = self.keys[at[rest]]
            found[rest] = self.values[at[rest]]
            rest = rest[(there != keys[rest]) & (there != -1)]
        return found


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * _SPREAD) >> np.uint64(64 - bits)).astype(np.int64)


class ShortPieces:
    """Last tokens of all prefixes of many short pieces; a token is known by its place in the order of ranks."""

    def __init__(self, vocabulary: Vocabulary):
        self.ranks = np.array(sorted(vocabulary.tokens), np.int64)
        tokens = [vocabulary.tokens[rank] for rank in self.ranks.tolist()]
        place = {token: k for k, token in enumerate(tokens)}
        self.sizes = np.array([len(token) for token in tokens], np.int32)
        # the two parts that the last join of a token puts together; -1 for a byte and what never comes about
        self.first, self.rest = np.full((2, len(tokens)), -1, np.int32)
        keys, values = [], []
        for k, token in enumerate(tokens):
            for cut in range(1, len(token)):
                a = place.get(token[:cut])
                b = place.get(token[cut:]) if a is not None else None
                if b is not None:
                    keys.append(a << 31 | b)
                    values.append(k)
            if len(token) > 1:
                parts = vocabulary.merge(token, 2)
                if len(parts) == 2:
                    self.first[k], self.rest[k] = place[parts[0]], place[parts[1]]
        self.joins = NumberTable(np.array(keys, np.int64), np.array(values, np.int32))
        self.joined = np.where(self.first >= 0, np.arange(len(tokens), dtype=np.int32), np.int32(-1))
        self.comes = (self.sizes == 1) | (self.first >= 0)
        made = self.first >= 0
        #: joins come in the order of ranks, as they do where ranks were learned join by join
        self.ordered = bool((self.joined[self.first[made]] < self.joined[made]).all()
                            and (self.joined[self.rest[made]] < self.joined[made]).all())
        # the longest token that ends with what a node of the endings has read, and for a token the next shorter one
        longest = np.full(len(vocabulary.ends), -1, np.int32)
        self.shorter = np.full(len(tokens), -1, np.int32)
        for step, node in vocabulary.endings.items():  # a node comes behind the one it hangs on
            before, rank = longest[step >> 8], vocabulary.ends[node]
            if rank >= 0:
                longest[node] = place[vocabulary.tokens[rank]]
                self.shorter[longest[node]] = before
            else:
                longest[node] = before
        self.longest = longest
        count = len(vocabulary.endings)
        self.endings = NumberTable(np.fromiter(vocabulary.endings, np.int64, count),
                                   np.fromiter(vocabulary.endings.values(), np.int32, count))
        self._fits = np.full(1 << _FIT_BITS, -1, np.int64)  # the latest pairs, each with its answer as last bit

    def fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether token b may follow token a, for each pair."""
        pairs = a.astype(np.int64) << 31 | b
        at = _places(pairs, _FIT_BITS)
        kept = self._fits[at]
        fit = (kept & 1).astype(bool)
        new = np.flatnonzero(kept >> 1 != pairs)
        if len(new):
            fit[new] = self._stay_apart(a[new], b[new])
            self._fits[at[new]] = pairs[new] << 1 | fit[new]
        return fit

    def _stay_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undoes the joins of both from the last one on: what then meets at the border must not join before the undone."""
        apart = np.zeros(len(a), bool)
        rows = np.flatnonzero(self.comes[a] & self.comes[b])
        a, b = a[rows], b[rows]
        limit = np.full(len(rows), np.iinfo(np.int32).max, np.int32)
        while len(rows):
            across = self.joins.get(a.astype(np.int64) << 31 | b)
            left, right = self.joined[a], self.joined[b]
            stay = (across < 0) | (across >= limit)
            more = (left >= 0) | (right >= 0)
            apart[rows[stay & ~more]] = True
            go = stay & more
            rows, a, b, left, right = rows[go], a[go], b[go], left[go], right[go]
            behind = right >= left  # of equal ranks the first in the text is joined first
            limit = np.where(behind, right + 1, left)
            a, b = np.where(behind, a, self.rest[a]), np.where(behind, self.first[b], b)
        return apart

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of all pieces, one behind another, and how many each has; pieces are in byte order and not empty.

        A prefix that a piece shares with the one before is worked out once.
        """
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width, rows = int(sizes.max()), np.arange(len(pieces))
        data = np.array(pieces, f"S{width}").view(np.uint8).reshape(len(pieces), width)
        inside = np.arange(width) < sizes[:, None]
        own = inside.copy()  # where a prefix is not that of the piece before
        own[1:] &= ~np.logical_and.accumulate((data[1:] == data[:-1]) & inside[:-1], axis=1)
        data, own = np.ascontiguousarray(data.T), np.ascontiguousarray(own.T)
        ends, who = np.nonzero(own)
        longest = self.longest[self._walk(data, ends, who)]
        levels = np.searchsorted(ends, np.arange(width + 1))
        last = np.zeros((width + 1, len(pieces)), np.int32)
        for i in range(width):
            begin, end = levels[i], levels[i + 1]
            mine, token = who[begin:end], longest[begin:end]
            rest = np.arange(end - begin)
            while len(rest):
                tried = token[rest]
                if (tried < 0).any():
                    raise ValueError("no token ends a prefix; the ranks lack a byte")
                before = i + 1 - self.sizes[tried]
                fit = self.comes[tried]
                inner = np.flatnonzero(before)
                fit[inner] = self.fits(last[before[inner], mine[rest[inner]]], tried[inner])
                rest = rest[~fit]
                token[rest] = self.shorter[token[rest]]
            last[i + 1, mine] = token
            last[i + 1] = last[i + 1, np.maximum.accumulate(np.where(own[i], rows, 0))]
        found, left = [], sizes.copy()
        while len(rows):
            token = last[left[rows], rows]
            column = np.full(len(pieces), -1, np.int32)
            column[rows] = token
            found.append(column)
            left[rows] -= self.sizes[token]
            rows = rows[left[rows] > 0]
        table = np.stack(found[::-1], axis=1)
        return self.ranks[table[table >= 0]], (table >= 0).sum(axis=1)

    def _walk(self, data: np.ndarray, ends: np.ndarray, who: np.ndarray) -> np.ndarray:
        """The node of the endings that is reached from each byte towards the start of its piece."""
        reached, rows = np.zeros(len(ends), np.int64), np.arange(len(ends))
        node = reached
        for back in range(len(data)):
            node = self.endings.get(node << 8 | data[ends[rows] - back, who[rows]]).astype(np.int64)
            on = node >= 0
            rows, node = rows[on], node[on]
            reached[rows] = node
            on = ends[rows] > back
            rows, node = rows[on], node[on]
            if not len(rows):
                break
        return reached


def _spans(values: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``sizes`` values from each of ``begin`` on, one span behind another."""
    ahead = np.cumsum(sizes) - sizes
    return values[np.arange(sizes.sum()) + np.repeat(begin - ahead, sizes)]


class _Numbers(dict):
    """A number for every piece asked for, from 0 on."""

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


class Encoder:
    """Encodes texts, each match of ``pattern`` separately; no special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary, self._any = Vocabulary(ranks), regex.compile(pattern).findall
        self._latin = _LATIN if pattern == PATTERN else None
        self._short = ShortPieces(self.vocabulary)
        order = self._short.ranks
        self._tokens = pa.array([self.vocabulary.tokens[rank] for rank in order.tolist()], pa.binary())
        self._gaps = int(order[-1]) != len(order) - 1
        #: pieces by number; the ids of all of them, one piece behind another, and where each one's begin
        self._numbers, self._ids, self._starts = _Numbers(), np.zeros(0, np.int32), np.zeros(1, np.int64)

    def split(self, text: str) -> list[str]:
        return (self._latin if self._latin and not _BEYOND_LATIN(text) else self._any)(text)

    def learn(self, pieces: list[str]) -> None:
        """Encodes pieces, which have the next numbers: short ones side by side, long ones in byte order,
        where each keeps the rows of the prefix it shares with the last."""
        ranks, known, short, long = self.vocabulary.ranks, [], [], []
        for k, piece in enumerate(pieces):
            data = piece.encode()
            rank = ranks.get(data)
            if rank is not None:  # a match that is a token is that token
                known.append((rank, k))
            else:
                (short if 0 < len(data) <= SHORT and self._short.ordered else long).append((data, k))
        short.sort()
        found, sizes = [[rank for rank, _ in known]], [np.ones(len(known), np.int64)]
        for begin in range(0, len(short), SIDE_BY_SIDE):
            ids, size = self._short.encode([data for data, _ in short[begin:begin + SIDE_BY_SIDE]])
            found.append(ids)
            sizes.append(size)
        table, before = PrefixTable(self.vocabulary), b""
        for data, _ in sorted(long):
            same, most = 0, min(len(before), len(data))
            while same < most and before[same] == data[same]:
                same += 1
            del table.last[same + 1:]
            table.data = before = data
            table.extend(len(data))
            found.append(table.tokens())
            sizes.append([len(found[-1])])
        sizes = np.concatenate(sizes).astype(np.int64)
        order = np.argsort([k for _, k in [*known, *short, *sorted(long)]])
        ids = _spans(np.concatenate(found).astype(np.int32), (np.cumsum(sizes) - sizes)[order], sizes[order])
        self._ids = np.concatenate([self._ids, ids])
        self._starts = np.concatenate([self._starts, self._starts[-1] + np.cumsum(sizes[order])])

    def _forget(self) -> None:
        """Forgets the older half of the pieces; what is asked for again is worked out again."""
        cut = len(self._numbers) // 2
        self._numbers = _Numbers((piece, n - cut) for piece, n in islice(self._numbers.items(), cut, None))
        self._ids, self._starts = self._ids[self._starts[cut]:], self._starts[cut:] - self._starts[cut]

    def encode_rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind another, and where each text's begin; what all their pieces
        need is worked out once a call."""
        if len(self._numbers) > PIECES_KEPT:
            self._forget()
        known, number, rows = len(self._numbers), self._numbers.__getitem__, []
        for text in texts:
            part = self.split(text)
            rows.append(np.fromiter(map(number, part), np.int32, len(part)))
        if len(self._numbers) > known:
            self.learn(list(islice(self._numbers, known, None)))
        pieces = np.concatenate([np.zeros(0, np.int32), *rows])
        begin = self._starts[pieces]
        sizes = self._starts[pieces + 1] - begin
        at = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *map(len, rows)])]
        return _spans(self._ids, begin, sizes), at

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        ids, at = self.encode_rows(texts)
        return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]

    def decode_rows(self, ids: np.ndarray, at: np.ndarray) -> pa.Array:
        """The bytes of each text's ids."""
        tokens = self._tokens.take(pa.array(np.searchsorted(self._short.ranks, ids) if self._gaps else ids))
        _, offsets, data = tokens.buffers()
        ends = np.frombuffer(offsets, np.int32, len(ids) + 1)[at] if len(ids) else np.zeros(len(at), np.int32)
        return pa.Array.from_buffers(
            pa.binary(), len(at) - 1, [None, pa.py_buffer(ends), data if data is not None else pa.py_buffer(b"")])

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


def worker_kept(key: tuple, build):
    """What ``build`` returns, kept for the life of a Python worker and shared by its tasks.

    Functions are sent to workers by value, each time with new globals, so it is
    kept beside the modules, of one kind at a time.
    """
    kept = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")).__dict__
    if key not in kept:
        for other in [k for k in kept if isinstance(k, tuple) and k[0] == key[0]]:
            del kept[other]
        kept[key] = build()
    return kept[key]


def encode_batches(batches: Iterator[pa.RecordBatch], encoder: Encoder, decode: bool) -> Iterator[pa.RecordBatch]:
    """Ids, and their bytes if asked, in place of the last column, ``text``.

    A step has 1 MB of text, as new pieces, a string each, and ids take many times that, which
    a worker doesn't give back.
    """
    for batch in batches:
        for part in slices(batch):
            ids, at = encoder.encode_rows([t or "" for t in part.column("text").to_pylist()])
            columns = part.columns[:-1] + [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids))]
            if decode:
                columns.append(encoder.decode_rows(ids, at))
            yield pa.RecordBatch.from_arrays(
                columns, part.schema.names[:-1] + ["token_ids"] + ["decoded"] * decode)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, decode: bool = False,
                     keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Adds ``token_ids`` to the columns of ``keep``, and ``decoded``, the bytes of the ids, if asked.

    Every whole text is encoded, row by row: repeated rows stay, other columns
    are left out, and a null or empty text has no ids. Ids are those of the
    merge rule, and a piece without white space of any length takes time in
    proportion to it. The ranks, a file of fixed size, are read on the driver
    and sent to the executors. A worker keeps vocabulary and pieces for its life. Works
    without a shuffle.
    """
    with open(ranks_path, "rb") as file:
        data = file.read()
    sent, digest = docs.sparkSession.sparkContext.broadcast(data), hashlib.sha256(data).hexdigest()
    kept = docs.select(*keep, "text")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]]
    schema = ", ".join(fields + ["token_ids array<int>"] + ["decoded binary"] * decode)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # caches of many small objects and no cycles: looking for some takes a third of the time
        encoder = worker_kept(("bpe", digest, pattern), lambda: Encoder(parse_ranks(sent.value), pattern))
        return encode_batches(batches, encoder, decode)

    return kept.mapInArrow(run, schema)
