"""Token ids in files of patched frame-of-reference blocks.

Documents are sorted by id over the whole table; each task encodes its range and writes one file. A file is

    magic, then blocks, then the block index, then the document table, then a footer of fixed size.

A block holds up to 128 ids: their minimum, the width that a set share of the differences to it fit, the differences
packed at that width, and an exception list (place, high bits) for those that need more. The index has the start of
every block, so a reader can go to any of them. The document table has id, whether it is null, and count of each
document. Task attempts write under names of their own; a manifest written by Spark lists one file per successful
task, with its place in the order, and readers go by the manifest alone.

Defined results: a null or empty text is the end id alone; null ids come first; rows of one id come in order of their
texts' hashes; an empty table gives no rows; columns other than id and text are not looked at.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from .encoding import encoder
from .shared import stage, text_key

BLOCK = 128
PERCENTILE = 0.9
MAGIC = b"PFOR0001"
_HEAD = 8  # minimum u32, width u8, exceptions u8, ids u16
_FOOTER = struct.Struct("<QQQQ8s")  # start of index, blocks, start of table, documents, magic
#: Ids packed or unpacked at once.
_RUN = 8192 * BLOCK


def pack_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """The blocks of some ids, and where each starts."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    full = np.empty(blocks * BLOCK, np.int64)
    full[:n] = ids
    full[n:] = ids[-1] if n else 0
    table = full.reshape(blocks, BLOCK)
    low = table.min(axis=1)
    delta = table - low[:, None]
    rank = min(BLOCK - 1, max(0, int(np.ceil(percentile * BLOCK)) - 1))
    typical = np.partition(delta, rank, axis=1)[:, rank]
    width = np.ceil(np.log2(typical + 1)).astype(np.int64)
    high = delta >> width[:, None]
    row, place = np.nonzero(high)
    patches = np.bincount(row, minlength=blocks)
    size = _HEAD + width * (BLOCK // 8) + 5 * patches
    start = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(int(start[-1]), np.uint8)
    head = np.zeros(blocks, np.dtype([("low", "<u4"), ("width", "u1"), ("patches", "u1"), ("ids", "<u2")]))
    head["low"], head["width"], head["patches"], head["ids"] = low, width, patches, BLOCK
    if blocks:
        head["ids"][-1] = n - (blocks - 1) * BLOCK
    out[start[:-1, None] + np.arange(_HEAD)] = head.view(np.uint8).reshape(blocks, _HEAD)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        bits = (delta[rows][:, :, None] >> np.arange(w) & 1).astype(np.uint8)
        packed = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")
        out[start[rows, None] + _HEAD + np.arange(packed.shape[1])] = packed
    if len(row):
        nth = np.arange(len(row)) - np.repeat(np.cumsum(patches) - patches, patches)
        at = start[row] + _HEAD + width[row] * (BLOCK // 8) + 5 * nth
        out[at] = place
        out[at[:, None] + 1 + np.arange(4)] = high[row, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    return out.tobytes(), start[:-1]


def unpack_blocks(raw: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The ids of the blocks that start at the given places of some bytes."""
    if not len(start):
        return np.zeros(0, "<u4")
    head = np.ascontiguousarray(raw[start[:, None] + np.arange(_HEAD)]).view(np.dtype([("low", "<u4"), ("width", "u1"), ("patches", "u1"), ("ids", "<u2")]))[:, 0]
    width, patches = head["width"].astype(np.int64), head["patches"].astype(np.int64)
    delta = np.zeros((len(start), BLOCK), np.int64)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        packed = raw[start[rows, None] + _HEAD + np.arange(w * BLOCK // 8)]
        bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(rows), BLOCK, w)
        whole = np.zeros((len(rows), BLOCK), np.int64)
        for b in range(w):
            whole |= bits[:, :, b].astype(np.int64) << b
        delta[rows] = whole
    if patches.any():
        row = np.repeat(np.arange(len(start)), patches)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(patches) - patches, patches)
        at = start[row] + _HEAD + width[row] * (BLOCK // 8) + 5 * nth
        high = np.ascontiguousarray(raw[at[:, None] + 1 + np.arange(4)]).view("<u4")[:, 0].astype(np.int64)
        delta[row, raw[at]] |= high << width[row]
    table = delta + head["low"].astype(np.int64)[:, None]
    keep = np.arange(BLOCK) < head["ids"].astype(np.int64)[:, None]
    return table[keep].astype("<u4")


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class FileWriter:
    """Writes one file; ids are packed as they come."""

    def __init__(self, sink, percentile: float = PERCENTILE):
        self.sink, self.percentile, self.at = sink, percentile, len(MAGIC)
        self.held: list[bytes] = []
        self.waiting = self.total = 0
        self.starts: list[np.ndarray] = []
        self.docs: list[tuple[int, bool, int]] = []
        sink.write(MAGIC)

    def add(self, doc_id: int | None, raw: bytes) -> None:
        self.docs.append((doc_id or 0, doc_id is None, len(raw) // 4))
        self.held.append(raw)
        self.waiting += len(raw) // 4
        self.total += len(raw) // 4
        if self.waiting >= _RUN:
            self._pack(_RUN)

    def _pack(self, step: int) -> None:
        ids = np.frombuffer(b"".join(self.held), "<u4")
        while len(ids) >= step and len(ids):
            packed, start = pack_blocks(ids[:_RUN], self.percentile)
            self.starts.append(start + self.at)
            self.sink.write(packed)
            self.at += len(packed)
            ids = ids[_RUN:]
        self.held, self.waiting = [ids.tobytes()], len(ids)

    def close(self) -> None:
        self._pack(0)
        starts = np.concatenate([np.zeros(0, np.int64), *self.starts]).astype("<u8")
        ids, none, counts = zip(*self.docs) if self.docs else ((), (), ())
        table = np.array(ids, "<i8").tobytes() + np.array(none, "u1").tobytes() + np.array(counts, "<u8").tobytes()
        self.sink.write(starts.tobytes())
        self.sink.write(table)
        self.sink.write(_FOOTER.pack(self.at, len(starts), self.at + starts.nbytes, len(self.docs), MAGIC))


def read_file(source) -> Iterator[tuple[int | None, int, bytes]]:
    """(doc_id, start, ids) of each document in the order written, from an open random-access file."""
    size = source.size()
    source.seek(size - _FOOTER.size)
    index_at, blocks, table_at, docs, magic = _FOOTER.unpack(source.read(_FOOTER.size))
    if magic != MAGIC:
        raise ValueError("not a token file, or a broken one")
    source.seek(index_at)
    starts = np.frombuffer(source.read(8 * blocks), "<u8").astype(np.int64)
    source.seek(table_at)
    table = source.read(17 * docs)
    ids, none = np.frombuffer(table, "<i8", docs), np.frombuffer(table, "u1", docs, 8 * docs)
    counts = np.frombuffer(table, "<u8", docs, 9 * docs)
    held, at, begin = b"", 0, 0
    step = _RUN // BLOCK

    def runs() -> Iterator[bytes]:
        for first in range(0, blocks, step):
            part = starts[first : first + step]
            upto = int(starts[first + step]) if first + step < blocks else index_at
            source.seek(int(part[0]))
            raw = np.frombuffer(source.read(upto - int(part[0])), np.uint8)
            yield unpack_blocks(raw, part - part[0]).tobytes()

    more = runs()
    for doc_id, is_none, n in zip(ids.tolist(), none.tolist(), counts.tolist()):
        while len(held) - at < 4 * n:
            held, at = held[at:] + next(more), 0
        yield None if is_none else doc_id, begin, held[at : at + 4 * n]
        at, begin = at + 4 * n, begin + n


def write_files(docs: DataFrame, vocabulary: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", percentile: float = PERCENTILE) -> DataFrame:
    """Writes the files to a new folder of the shared one; gives the manifest: file, place, n_docs, n_ids, start."""
    folder = shared_dir(docs.sparkSession, "token-files")
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        coder, place = encoder(vocabulary), TaskContext.get().partitionId()
        files, root = store(folder)
        files.create_dir(root, recursive=True)
        name = f"part-{place:06d}-{uuid.uuid4().hex}.pfor"
        with files.open_output_stream(f"{root}/{name}") as sink:
            writer = FileWriter(sink, percentile)
            while first is not None:
                for doc_id, text in zip(first.column(0).to_pylist(), first.column(1)):
                    writer.add(doc_id, coder.ids(text.as_py() or "") + end)
                first = next(batches, None)
            writer.close()
        yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "place": [place], "n_docs": [len(writer.docs)], "n_ids": [writer.total]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), text_key(text_col).alias("text_key"))
    # Ranges over both columns, so that rows of one id can fall into several.
    ranged = rows.repartitionByRange(F.asc_nulls_first("doc_id"), "text_key").sortWithinPartitions(F.asc_nulls_first("doc_id"), "text_key")
    manifest = stage(ranged.select("doc_id", "text").mapInArrow(run, "file string, place long, n_docs long, n_ids long"), "token-manifest")
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_files(manifest: DataFrame, keep_ids: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32, ids (null unless kept)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                files, path = store(file)
                with files.open_input_file(path) as source:
                    rows = []
                    for doc_id, at, raw in read_file(source):
                        rows.append((doc_id, start + at, len(raw) // 4, zlib.crc32(raw), raw if keep_ids else None))
                        if len(rows) == 4096:
                            yield _batch(rows)
                            rows = []
                    if rows:
                        yield _batch(rows)

    listed = stage(manifest.select("file", "start"), "token-starts")
    # A task for each file: without the number adaptive execution would put these few small rows into one task.
    spread = listed.repartition(max(1, listed.count()), "file")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.binary()]
    arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
