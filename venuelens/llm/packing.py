"""Best-fit packing of token sequences with a bounded number of open bins.

A document is its token ids and one end id. Only documents longer than a sequence are cut, into pieces of the full
length; the first piece takes what is left over and may be shorter. Each task encodes its documents and packs their
pieces online: open bins stand in a bitset keyed by free space, a piece goes to the bin with the least space that
holds it, and when all bins are open the fullest one closes. Pieces of bins still open at the end of a task aren't
placed yet; some tasks' leftovers together go through the same packing in the next level, in ever fewer tasks, until
one task with a bounded number of pieces closes all, and packs those still open at its end once more by size. So the
bins that stay partly empty don't grow with the tasks.

Defined results: a null or empty text is the end id alone; repeated rows are packed each for itself; an empty table
gives no rows; columns other than id and text are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoding import encoder
from .shared import stage

LENGTH = 2048
OPEN_BINS = 4096
#: Leftovers of so many tasks meet in one task of the next level.
MERGE = 16

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
PLACED = f"{PIECE}, sequence_id long, offset long"
_NAMES = [field.split()[0] for field in PLACED.split(", ")]
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]


class BestFit:
    """Online best-fit over at most ``bins`` open bins of ``length``; items are (size, value)."""

    def __init__(self, length: int, bins: int):
        self.length, self.bins = length, bins
        self.free = 0  # bit f is set if a bin with f free places is open
        self.by_free: dict[int, list[list]] = {}
        self.open = 0

    def _take(self, space: int) -> list:
        stack = self.by_free[space]
        found = stack.pop()
        if not stack:
            self.free &= ~(1 << space)
        self.open -= 1
        return found

    def add(self, size: int, value) -> list | None:
        """Places an item; gives the bin that closes with it, if any."""
        fitting = self.free >> size
        closed = None
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            held = self._take(space)
        else:
            space, held = self.length, []
            if self.open >= self.bins and size < self.length:
                closed = self._take((self.free & -self.free).bit_length() - 1)
        held.append((size, value))
        space -= size
        if not space:
            return held  # never together with another closed bin: that one made room for a bin that stays open
        self.by_free.setdefault(space, []).append(held)
        self.free |= 1 << space
        self.open += 1
        return closed

    def rest(self) -> Iterator[list]:
        for stack in self.by_free.values():
            yield from stack


def pieces(raw: bytes, length: int) -> Iterator[tuple[int, int, bytes]]:
    """(piece, start, ids) of a document's ids in bytes of four each."""
    n = len(raw) // 4
    start, piece = 0, 0
    while start < n:
        size = n % length or length if n > length and not start else min(length, n)
        yield piece, start, raw[4 * start : 4 * (start + size)]
        start, piece = start + size, piece + 1


def _packed(items: Iterable[tuple], level: int, length: int, bins: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Rows of closed bins with their places, then the rows of open bins: without a place unless this level is the last."""
    packer = BestFit(length, bins)
    base = level << 56 | TaskContext.get().partitionId() << 32
    rows: list[tuple] = []
    done = 0

    def flush() -> pa.RecordBatch:
        arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), _TYPES)]
        rows.clear()
        return pa.RecordBatch.from_arrays(arrays, _NAMES)

    def close(held: list) -> None:
        nonlocal done
        offset = 0
        for size, row in held:
            rows.append((*row, base + done, offset))
            offset += size
        done += 1

    for row in items:
        if (held := packer.add(row[3], row)) is not None:
            close(held)
        if len(rows) >= 8192:
            yield flush()
    left = list(packer.rest())
    if last:
        # What is still open at the very end is packed once more, the largest pieces first.
        packer = BestFit(length, bins)
        pieces_left = sorted((piece for held in left for piece in held), key=lambda piece: -piece[0])
        closed = [held for size, row in pieces_left if (held := packer.add(size, row)) is not None]
        left = min(left, closed + list(packer.rest()), key=len)
    for held in left:
        if last:
            close(held)
        else:
            rows.extend((*row, None, None) for _, row in held)
        if len(rows) >= 8192:
            yield flush()
    if rows:
        yield flush()


def pack(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    end_id: int = 0, bins: int = OPEN_BINS, keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers if ``keep_ids``, else null.
    """
    end = end_id.to_bytes(4, "little")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def items() -> Iterator[tuple]:
            coder = encoder(vocabulary)
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for piece, start, raw in pieces(coder.ids(text.as_py() or "") + end, length):
                        yield doc_id, piece, start, len(raw) // 4, zlib.crc32(raw), raw if keep_ids else None

        yield from _packed(items(), 1, length, bins, False)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tasks = max(1, rows.rdd.getNumPartitions())
    placed = stage(rows.mapInArrow(first, PLACED), "packed")
    level = 1
    found = placed.filter("sequence_id IS NOT NULL")
    while True:
        level, tasks = level + 1, -(-tasks // MERGE)

        def again(batches: Iterator[pa.RecordBatch], level=level, last=tasks == 1) -> Iterator[pa.RecordBatch]:
            items = (row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(6))))
            yield from _packed(items, level, length, bins, last)

        left = placed.filter("sequence_id IS NULL").drop("sequence_id", "offset").repartition(tasks)
        placed = stage(left.mapInArrow(again, PLACED), "packed")
        found = found.union(placed.filter("sequence_id IS NOT NULL"))
        if tasks == 1:
            return found


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from rows that kept their ids: sequence_id, length, ids. A group is one sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda held, part: F.concat(held, part["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
