"""Ranked lexical search with per-term geometric blocking.

A first pass takes the terms of whole texts and keeps, for each document, its length and the terms of the items with
their counts; corpus statistics and weights come from all documents. A second pass reads these rows in shards of
bounded size. A shard has a posting list for each term; a long list is cut into blocks of similar documents: every
document is a short signed projection of its weighted terms and goes to the nearest of centres taken from the list.
A block keeps the coordinatewise maximum of its documents' impacts. The product of an item with that summary bounds
the score of each document in the block, so a block is skipped only if the bound is below the item's 20th score so
far, and a document that is in skipped blocks only cannot be among the best: results are exact. Blocks that stay are
scored in whole numbers, best bounds first, so that the 20th score rises early.

Summaries have ``COORDINATES`` cells of one byte. Terms beyond that share cells, and impacts are rounded up; both
only raise a bound. Lists up to ``SHORT`` documents are scored whole. A task carries its best scores from shard to
shard and gives at most ``top`` rows an item. Items are the query set, taken in blocks of bounded text size; each
block is a pass over the documents, and one block at a time is on the driver.

Defined results: a null text has no terms; items without terms, and items that no document shares a term with, give
no rows; each item row is ranked by itself, also if ids repeat; repeated documents are ranked each with a row of its
own; null document ids rank behind others of equal score. Empty tables give no rows. Other columns are not looked at.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stage, text_bytes

#: Bytes of item text in a block of items; bounds the vocabulary that tasks hold.
ITEM_BYTES = 2_000_000
#: Documents and postings in a shard at most (a single document may hold more postings, but never over the vocabulary).
SHARD, POSTINGS = 4096, 400_000
#: Documents in a block on average, and lists that get no summaries.
BLOCK, SHORT = 64, 32
COORDINATES = 4096
#: An impact is below 1,000,000; a summary counts in steps of this.
STEP = 4096
_PROJECTIONS = 32

_TERM = bytes(
    32 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if 0x41 <= b <= 0x5A else b
    for b in range(256)
)


def terms(raw: bytes) -> list[bytes]:
    """Letters and digits and all beyond ASCII; only A-Z are lower-cased."""
    return raw.translate(_TERM).split()


class Batch:
    """A block of items on its way to the tasks: distinct terms, and each item's terms with their counts."""

    def __init__(self, items: list[tuple[int | None, bytes]]):
        self.ids = [i for i, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        self.items = []
        for _, raw in items:
            counts = Counter(self.vocabulary.setdefault(term, len(self.vocabulary)) for term in terms(raw))
            self.items.append((np.fromiter(counts.keys(), np.int64, len(counts)), np.fromiter(counts.values(), np.int64, len(counts))))


def batches(items: DataFrame) -> Iterator[Batch]:
    held, size = [], 0
    for row in items.select(F.col("item_id").cast("long"), text_bytes("text")).toLocalIterator():
        if held and size + len(row[1]) > ITEM_BYTES:
            yield Batch(held)
            held, size = [], 0
        held.append((row[0], bytes(row[1])))
        size += len(row[1])
    if held:
        yield Batch(held)


def count_terms(parts: Iterator[pa.RecordBatch], known: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """(id, text bytes) to (doc_id, n, terms, tfs); documents without a term are left out."""
    for part in parts:
        ids, sizes, offsets, found, counts = [], [], [0], [], []
        for doc_id, raw in zip(part.column(0).to_pylist(), part.column(1)):
            words = terms(raw.as_py())
            if not words:
                continue
            ids.append(doc_id)
            sizes.append(len(words))
            hits = [(known[word], n) for word, n in Counter(words).items() if word in known]
            found += [t for t, _ in hits]
            counts += [n for _, n in hits]
            offsets.append(len(found))
        ends = pa.array(offsets, pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(values, kind)) for values, kind in ((found, pa.int32()), (counts, pa.int64()))]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])


def term_counts(docs: DataFrame, batch: Batch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents with at least one term: id, n terms with repeats, and the batch's terms with their counts."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(batch.vocabulary)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("raw"))
    return rows.mapInArrow(lambda parts: count_terms(parts, vocabulary.value), "doc_id long, n long, terms array<int>, tfs array<long>")


def weights(counted: DataFrame, batch: Batch) -> tuple[int, int, np.ndarray]:
    """N, L and the weight of every term of the batch, from all documents."""
    n_docs, length = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(batch.vocabulary), np.int64)
    # One row a term of the batch, which is bounded.
    for term, n in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[term] = n
    return n_docs, length, np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) for n in df], np.int64)


def _signs(n: int) -> np.ndarray:
    """One 64-bit mix for each term; its bits are the signs of the projections."""
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shard:
    """Posting lists of some documents, cut into blocks with summaries."""

    def __init__(self, ids, missing, sizes, ends, found, tfs, n_docs, length, weight):
        self.ids, self.missing, self.starts, self.terms = ids, missing, ends[:-1], found
        self.ends = ends
        m = 75 + (25 * sizes * n_docs) // length
        doc = np.repeat(np.arange(len(ids)), np.diff(ends))
        self.impacts = (1_000_000_000 * tfs) // (1000 * tfs + 12 * m[doc])
        order = np.argsort(found, kind="stable")
        self.posting_docs = doc[order]
        self.listed, first = np.unique(found[order], return_index=True)
        self.lists = np.append(first, len(order))
        self._cut(doc, weight)

    def _cut(self, doc, weight) -> None:
        cells = np.minimum(COORDINATES, len(weight))
        steps = -(-self.impacts // STEP)
        grid = np.zeros((len(self.ids), cells), np.uint8)
        np.maximum.at(grid.reshape(-1), doc * cells + self.terms % cells, steps.astype(np.uint8))
        mixed, heavy = _signs(len(weight))[self.terms], (self.impacts * weight[self.terms]).astype(np.float64)
        sketch = np.empty((len(self.ids), _PROJECTIONS), np.float32)
        for b in range(_PROJECTIONS):
            signed = np.where(mixed >> np.uint64(b) & np.uint64(1), heavy, -heavy)
            sketch[:, b] = np.bincount(doc, signed, len(self.ids))
        sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-30)
        members, bounds, owner, summaries = [], [0], [], []
        self.blocks_of = np.zeros((len(self.listed), 2), np.int64)
        self.short = np.diff(self.lists) <= SHORT
        for i in np.flatnonzero(~self.short):
            docs = self.posting_docs[self.lists[i] : self.lists[i + 1]]
            centres = docs[:: max(1, len(docs) // max(1, len(docs) // BLOCK))][: max(1, len(docs) // BLOCK)]
            nearest = np.argmax(sketch[docs] @ sketch[centres].T, axis=1)
            order = np.argsort(nearest, kind="stable")
            docs, nearest = docs[order], nearest[order]
            cuts = np.flatnonzero(np.diff(nearest, prepend=-1))
            summaries.append(np.maximum.reduceat(grid[docs], cuts, axis=0))
            self.blocks_of[i] = len(owner), len(owner) + len(cuts)
            owner += [i] * len(cuts)
            bounds += (bounds[-1] + np.append(cuts[1:], len(docs))).tolist()
            members.append(docs)
        self.members = np.concatenate(members) if members else np.zeros(0, np.int64)
        self.bounds = np.array(bounds)
        self.summaries = np.concatenate(summaries) if summaries else np.zeros((0, cells), np.uint8)
        self.cells = cells

    def scores(self, docs: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Exact scores; ``share`` has the item's weight for every term."""
        sizes = self.ends[docs + 1] - self.ends[docs]
        stops = np.cumsum(sizes)
        at = np.arange(stops[-1]) + np.repeat(self.starts[docs] - (stops - sizes), sizes)
        return np.add.reduceat(share[self.terms[at]] * self.impacts[at], stops - sizes)

    def search(self, best: Best, found: np.ndarray, share: np.ndarray) -> tuple[int, int]:
        """Offers the shard's documents to one item's best; returns the blocks scored and all its blocks."""
        place = np.searchsorted(self.listed, found)
        place = place[(place < len(self.listed)) & (self.listed[np.minimum(place, len(self.listed) - 1)] == found)] if len(self.listed) else place[:0]
        seen = np.zeros(len(self.ids), bool)
        for i in place[self.short[place]]:
            seen[self.posting_docs[self.lists[i] : self.lists[i + 1]]] = True
        if seen.any():
            self._offer(best, np.flatnonzero(seen), share)
        ranges = self.blocks_of[place[~self.short[place]]]
        blocks = np.concatenate([np.arange(a, b) for a, b in ranges]) if len(ranges) else np.zeros(0, np.int64)
        if not len(blocks):
            return 0, 0
        cells = np.unique(found % self.cells)
        # Terms that share a cell are bounded by the cell together.
        price = np.bincount(found % self.cells, share[found], self.cells)[cells] * STEP
        bound = self.summaries[blocks[:, None], cells[None, :]] @ price
        order = np.argsort(-bound)
        blocks, bound, done, width = blocks[order], bound[order], 0, 8
        while done < len(blocks) and bound[done] >= best.least:
            upto = min(done + width, len(blocks))
            upto = done + int(np.searchsorted(-bound[done:upto], -best.least, "right"))
            fresh = np.zeros(len(self.ids), bool)
            for b in blocks[done:upto]:
                fresh[self.members[self.bounds[b] : self.bounds[b + 1]]] = True
            fresh &= ~seen
            seen |= fresh
            if fresh.any():
                self._offer(best, np.flatnonzero(fresh), share)
            done, width = upto, width * 2
        return done, len(blocks)

    def _offer(self, best: Best, docs: np.ndarray, share: np.ndarray) -> None:
        scores = self.scores(docs, share)
        docs = docs[scores >= max(1, best.least)]
        if len(docs):
            best.offer(scores[scores >= max(1, best.least)], self.missing[docs], self.ids[docs])


class Best:
    """The best rows of one item so far, ties by id."""

    def __init__(self, top: int):
        self.top, self.least = top, 0
        self.scores, self.missing, self.ids = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def offer(self, scores, missing, ids) -> None:
        scores, missing, ids = np.append(self.scores, scores), np.append(self.missing, missing), np.append(self.ids, ids)
        keep = np.lexsort((ids, missing, -scores))[: self.top]
        self.scores, self.missing, self.ids = scores[keep], missing[keep], ids[keep]
        if len(keep) == self.top:
            self.least = int(self.scores[-1])


def shards(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows of ``term_counts`` in groups of bounded size: ids, which are null, sizes, ends, terms, counts."""
    held, docs, size = [], 0, 0
    for part in parts:
        lengths = np.diff(part.column(2).offsets.to_numpy())
        at = 0
        while at < part.num_rows:
            room = np.searchsorted(np.cumsum(lengths[at:]), POSTINGS - size, "right")
            upto = min(part.num_rows, at + max(1 if not docs else 0, min(int(room), SHARD - docs)))
            if upto > at:
                held.append(part.slice(at, upto - at))
                docs, size, at = docs + upto - at, size + int(lengths[at:upto].sum()), upto
            if docs >= SHARD or size >= POSTINGS or upto == at and at < part.num_rows:
                yield _arrays(held)
                held, docs, size = [], 0, 0
    if held:
        yield _arrays(held)


def _arrays(held: list[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
    rows = pa.Table.from_batches(held).combine_chunks()
    column = lambda i: rows.column(i).combine_chunks() if rows.column(i).num_chunks != 1 else rows.column(i).chunk(0)
    ids, found, tfs = column(0), column(2), column(3)
    ends = found.offsets.to_numpy().astype(np.int64)
    return (
        ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False),
        column(1).to_numpy(zero_copy_only=False), ends - ends[0],
        found.flatten().to_numpy(zero_copy_only=False).astype(np.int64), tfs.flatten().to_numpy(zero_copy_only=False),
    )


def search(parts: Iterator[pa.RecordBatch], told: tuple, top: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``term_counts`` to at most ``top`` rows an item; ``told`` has ids and items of a batch, N, L and weights."""
    ids, items, n_docs, length, weight = told
    best = [Best(top) for _ in items]
    share = np.zeros(len(weight), np.int64)
    for group in shards(parts):
        shard = Shard(*group, n_docs, length, weight)
        for (found, times), mine in zip(items, best):
            share[found] = times * weight[found]
            shard.search(mine, found, share)
            share[found] = 0
    for i, mine in enumerate(best):
        n = len(mine.scores)
        if n:
            column = [pa.array([i] * n, pa.int64()), pa.array([ids[i]] * n, pa.int64()), pa.array(mine.ids, pa.int64(), mask=mine.missing)]
            yield pa.RecordBatch.from_arrays([*column, pa.array(mine.scores)], ["item", "item_id", "doc_id", "score"])


def _searched(docs: DataFrame, batch: Batch, top: int, id_col: str, text_col: str) -> DataFrame:
    counted = stage(term_counts(docs, batch, id_col, text_col), "term-counts")
    told = counted.sparkSession.sparkContext.broadcast((batch.ids, batch.items, *weights(counted, batch)))
    rows = counted.mapInArrow(lambda parts: search(parts, told.value, top), "item long, item_id long, doc_id long, score long")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return rows.withColumn("rank", place).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def best_documents(docs: DataFrame, items: DataFrame, top: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each item's ``top`` best documents with score above 0: item_id, rank from 1, doc_id, score."""
    found = [stage(_searched(docs, batch, top, id_col, text_col), "ranked") for batch in batches(items)]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return functools.reduce(DataFrame.unionAll, found)
