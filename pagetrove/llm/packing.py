"""Packing of token sequences by bounded-space online best fit.

Every task keeps a fixed number of open bins. A bitset has a bit for every amount of free space that
some open bin has; the lowest bit at or above a piece's length names the bin that it fills best. When one
bin too many is open, the fullest is closed. What is in bins still open at the end of a task is packed
again, longest pieces first, by fewer tasks.
"""

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrove.llm import word_ids
from pagetrove.llm.common import in_slices, utf8
from pagetrove.session import settled

OPEN = 512  # bins
AGAIN = 20_000  # pieces that a task of the second round is to get, about


class BestFit:
    """Open bins of one task. A closed bin is a list of (piece, offset)."""

    def __init__(self, capacity: int, most_open: int = OPEN):
        self.capacity, self.most_open = capacity, most_open
        self.free = 0  # bit f: an open bin has f places left
        self.bins: dict[int, list[list]] = {}
        self.count = 0

    def add(self, piece, length: int) -> list | None:
        """Put a piece into a bin; returns the bin that this closes, if any."""
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            held = self._take(space)
        else:
            space, held = self.capacity, []
        held.append((piece, self.capacity - space))
        left = space - length
        if not left:
            return held
        self.bins.setdefault(left, []).append(held)
        self.free |= 1 << left
        self.count += 1
        if self.count > self.most_open:
            return self._take((self.free & -self.free).bit_length() - 1)
        return None

    def _take(self, space):
        stack = self.bins[space]
        held = stack.pop()
        if not stack:
            del self.bins[space]
            self.free ^= 1 << space
        self.count -= 1
        return held

    def rest(self) -> Iterator[list]:
        """All bins still open, which then are no more."""
        while self.free:
            yield self._take(self.free.bit_length() - 1)


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_OUT = _PIECE + ", sequence_id long, offset long, open boolean"
_NAMES = [part.split()[0] for part in _OUT.split(", ")]
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
_BATCH = 8192


def cut_ids(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of the pieces of one document's ids."""
    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
        part = ids[at:at + 4 * capacity]
        yield piece, at // 4, len(part) // 4, zlib.crc32(part)


def _packed(pieces, capacity, most_open, round_number, keep_open):
    """Rows of the bins into which a task's pieces go."""
    task = TaskContext.get()
    number = round_number << 62 | (task.partitionId() if task else 0) << 32
    fit, rows = BestFit(capacity, most_open), []

    def put(held, is_open):
        nonlocal number
        rows.extend((*piece, number, offset, is_open) for piece, offset in held)
        number += 1

    for piece in pieces:
        closed = fit.add(piece, piece[3])
        if closed:
            put(closed, False)
        if len(rows) >= _BATCH:
            yield _batch(rows)
            rows.clear()
    for held in fit.rest():
        put(held, keep_open)
        if len(rows) >= _BATCH:
            yield _batch(rows)
            rows.clear()
    if rows:
        yield _batch(rows)


def _batch(rows):
    return pa.RecordBatch.from_arrays(
        [pa.array(list(values), type=kind) for values, kind in zip(zip(*rows), _TYPES)], names=_NAMES)


def pack(docs: DataFrame, capacity: int = 2048, end_id: int = 0, vocabulary: str = word_ids.VOCABULARY,
         most_open: int = OPEN) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every document of ``docs`` (doc_id,
    text, any others) in sequences of at most ``capacity`` tokens.

    A document is its ids and ``end_id``; a null or blank text is the end alone. Only documents longer
    than a sequence are cut, into pieces of ``capacity`` and a rest. The pieces in a sequence lie one
    after the other from offset 0. Rows that repeat are packed each for itself; an empty table gives no
    rows. Texts are not shuffled.
    """
    end = end_id.to_bytes(4, "little")

    def first(batches):
        encoder = word_ids.loaded(vocabulary)

        def pieces():
            for ids, texts in in_slices(batches):
                for doc_id, tokens in zip(ids, encoder.encode(texts)):
                    for part in cut_ids(tokens + end, capacity):
                        yield doc_id, *part

        return _packed(pieces(), capacity, most_open, 0, True)

    def second(batches):
        pieces = (row for columns in in_slices(batches) for row in zip(*columns))
        return _packed(pieces, capacity, most_open, 1, False)

    packed = settled(docs.select("doc_id", utf8("text")).mapInArrow(first, _OUT), "packed")
    loose = packed.where("open")
    tasks = max(1, loose.count() // AGAIN)
    names = [part.split()[0] for part in _PIECE.split(", ")]
    again = (
        loose.select(names).repartition(tasks, "doc_id", "piece")
        .sortWithinPartitions(F.desc("length"), "doc_id", "piece")
        .mapInArrow(second, _OUT)
    )
    return packed.where("not open").unionByName(again).drop("open")
