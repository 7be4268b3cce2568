"""Benchmark passages in documents: CGK embedding, bit-sampling LSH over item-sized windows, exact edit verification.

Texts are sequences of words (runs of ASCII letters and digits and of bytes beyond ASCII) without regard to case, by
Unicode case folding, so that capitals with accents and sharp s are the same words. An item of m words is found where a stretch of the document is within ``edits * m`` word edits of it.

1. A window of m words near an item has at most so many words outside the words of the items of m words, and lacks
   at most as many of an item's different words. A sliding count finds such windows and loses none.
2. Windows and items of m words are embedded by the CGK random walk into 3m symbols: the walk shows a symbol at each
   step and moves on by a random bit of it, so few edits become few differing places. A key is the symbols at a few
   sampled places, and equal keys are candidates. Agreement falls with the number of edits, so the walks that reach the
   target recall are counted for each size on made pairs at the very limit of edits. Where more than ``MOST`` would be
   needed, no walk is taken: an item within k edits shows one of any k + 1 pieces unchanged, and windows that show a
   piece are candidates, which loses none.
3. A candidate counts if the edit distance of the item to some stretch around the window is within the limit.

The items are the query set and go to the tasks in blocks of ``BLOCK``; each block is one pass over the documents
without a shuffle. Defined results: a null or empty text has no words; an item without words is never found; items of
fewer than ``FUZZY_FROM`` words, of which edits leave too little, are found unchanged only; repeated rows are each searched; equal items are each reported;
empty tables give no rows; further columns are not looked at, and ``clean`` keeps them.
"""

from __future__ import annotations

import functools
import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import release, stage, text_bytes

EDITS = 0.2
FUZZY_FROM = 8
RECALL = 0.95
#: Places sampled for a key, most walks of a size, and made pairs of each kind of edit that walks are counted on.
SAMPLED = 3
MOST = 64
PAIRS = 100
BLOCK = 50_000
_MAP_BITS = 21
_SLOT = np.uint32((1 << _MAP_BITS) - 1)
#: Words of texts that are looked at together.
_TOGETHER = 200_000
#: Words in all windows that wait together.
_WAITING = 3_000_000
_WORD = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def symbols(raw: bytes) -> np.ndarray:
    """One 32-bit symbol per word."""
    folded = raw.lower() if raw.isascii() else raw.decode("utf-8", "surrogateescape").casefold().encode("utf-8", "surrogateescape")
    words = folded.translate(_WORD).split()
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


def walk_keys(windows: np.ndarray, repeat: int, sampled: int = SAMPLED) -> np.ndarray:
    """Keys of the rows of a matrix of symbols under one random walk and its sampled places."""
    n, m = windows.shape
    rng = np.random.default_rng([m, repeat])
    factor, shift = rng.integers(0, 2**32, (2, 3 * m), dtype=np.uint64)
    # Walks end after about 2m steps; places beyond show padding only and would tell nothing apart.
    places = set(rng.choice(2 * m, sampled, replace=False).tolist())
    padded = np.concatenate([windows, np.zeros((n, 1), np.uint32)], axis=1).astype(np.uint64)
    row, at, key = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.uint64)
    for step in range(max(places) + 1):
        seen = padded[row, at]
        if step in places:
            key = (key ^ seen) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        bit = (seen * (factor[step] | np.uint64(1)) + shift[step]) >> np.uint64(40) & np.uint64(1)
        at = np.minimum(at + bit.astype(np.int64), m)
    return key


def piece_keys(rows: np.ndarray, length: int) -> np.ndarray:
    """Keys of all stretches of ``length`` words of the rows."""
    n = rows.shape[1] - length + 1
    key = np.zeros((len(rows), n), np.uint64)
    for i in range(length):
        key = (key ^ rows[:, i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def made_pairs(m: int, edits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Items of m words, the windows that the filter leaves of texts with their passages, and the item of each window.

    Items take turns at passages with words replaced, left out, put in, and all of these.
    """
    rng = np.random.default_rng([m, edits])
    items = rng.integers(1, 2**32, (4 * PAIRS, m), dtype=np.uint64).astype(np.uint32)
    windows, owner = [], []
    for i, item in enumerate(items):
        how = rng.integers(0, 3, edits) if i % 4 == 3 else np.full(edits, i % 4)
        made = dict(zip(rng.permutation(m)[:edits].tolist(), how.tolist()))
        new = rng.integers(1, 2**32, (3, m), dtype=np.uint64).astype(np.uint32)
        kept = {None: lambda j: [item[j]], 0: lambda j: [new[0, j]], 1: lambda j: [], 2: lambda j: [item[j], new[0, j]]}
        text = np.concatenate([new[1], np.array([w for j in range(m) for w in kept[made.get(j)](j)], np.uint32), new[2]])
        count = np.concatenate([[0], np.cumsum(np.isin(text, item))])
        starts = np.flatnonzero(count[m:] - count[:-m] >= m - edits)
        windows.append(text[starts[:, None] + np.arange(m)])
        owner.append(np.full(len(starts), i))
    return items, np.concatenate(windows), np.concatenate(owner)


@functools.lru_cache(maxsize=4096)
def repeats_for(m: int, edits: int, recall: float) -> int | None:
    """The walks after which every kind of edit reaches the recall on made pairs, with a margin; None if over ``MOST``."""
    items, windows, owner = made_pairs(m, edits)
    found, target = np.zeros(len(items), bool), 1 - 0.6 * (1 - recall)
    for repeat in range(MOST):
        found[owner[walk_keys(items, repeat)[owner] == walk_keys(windows, repeat)]] = True
        if min(found[kind::4].mean() for kind in range(4)) >= target:
            return repeat + 1
    return None


def repeats_by_size(sizes: set[int], edits: float, recall: float) -> dict[int, int | None]:
    """The walks of each size, counted at the next multiple of 5; None from the first size on that needs too many."""
    out, enough = {m: None for m in sizes if m < FUZZY_FROM}, True
    for m in sorted(sizes - set(out)):
        upto = -(-m // 5) * 5
        out[m] = repeats_for(upto, min(upto, math.ceil(edits * upto - 1e-9)), recall) if enough else None
        enough = out[m] is not None
    return out


def edit_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """The least word edits from the item to any stretch of the text, and where the first such stretch ends."""
    row, place = np.zeros(len(text) + 1, np.int64), np.arange(len(text) + 1)
    for i, symbol in enumerate(item):
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (text != symbol))
        new[0] = i + 1
        row = np.minimum.accumulate(new - place) + place
    end = int(row.argmin())
    return int(row[end]), end


class Items:
    """A block of items with their keys by size."""

    def __init__(self, items: list[tuple[int, bytes]], edits: float, recall: float, repeats: dict[int, int | None] | None = None):
        self.edits = edits
        by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
        for item_id, raw in items:
            found = symbols(raw)
            if len(found):
                by_size.setdefault(len(found), []).append((item_id, found))
        self.sizes = sorted(by_size)
        self.ids = {m: [i for i, _ in rows] for m, rows in by_size.items()}
        self.rows = {m: np.stack([w for _, w in rows]) for m, rows in by_size.items()}
        self.repeats = repeats_by_size(set(self.sizes), edits, recall) if repeats is None else repeats
        self.keys, self.pieces = {}, {}
        for m, rows in self.rows.items():
            if self.repeats[m] is None:
                # Disjoint stretches, one more than edits: one of them at least is unchanged.
                n = min(self.limit(m) + 1, m)
                begin = np.arange(n) * m // n
                keys = piece_keys(rows, m // n)[:, begin].ravel()
                order = np.argsort(keys, kind="stable")
                self.pieces[m] = keys[order], order // n, begin[order % n]
                continue
            for repeat in range(self.repeats[m]):
                keys = walk_keys(rows, repeat)
                order = np.argsort(keys, kind="stable")
                self.keys[m, repeat] = keys[order], order
        # Bit b of a slot: some item whose size has this bit holds a word of this slot.
        self.held = np.zeros(1 << _MAP_BITS, np.uint64)
        for i, m in enumerate(self.sizes):
            self.held[np.unique(self.rows[m] & _SLOT)] |= np.uint64(1) << np.uint64(i % 64)
        self.distinct = {m: min(len(np.unique(row)) for row in rows) for m, rows in self.rows.items()}

    def limit(self, m: int) -> int:
        return int(self.edits * m + 1e-9) if m >= FUZZY_FROM else 0

    def windows(self, whole: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(size, starts) of the windows of some padded texts that may be near an item of their size.

        A window near an item has at most ``limit`` words that are not the item's, and lacks at most as many of its
        different words.
        """
        held = self.held[whole & _SLOT]
        held[whole == 0] = 0
        for i, m in enumerate(self.sizes):
            own = (held >> np.uint64(i % 64) & np.uint64(1)).astype(np.int32)
            count = np.zeros(len(own) + 1, np.int32)
            np.cumsum(own, out=count[1:])
            starts = np.flatnonzero(count[m:] - count[:-m] >= m - self.limit(m))
            for first in range(0, len(starts), 20_000):
                part = starts[first : first + 20_000]
                table = np.where(own[part[:, None] + np.arange(m)], whole[part[:, None] + np.arange(m)], 0)
                table.sort(axis=1)
                different = ((table[:, 1:] != table[:, :-1]) & (table[:, 1:] != 0)).sum(axis=1) + (table[:, 0] != 0)
                part = part[different >= self.distinct[m] - self.limit(m)]
                if len(part):
                    yield m, part

    def find(self, texts: list[np.ndarray]) -> dict[int, list[tuple[int, int, int, int]]]:
        """For each text with a passage: (item, first word, words, edits) of each item found, at its best place."""
        found: dict[int, dict[tuple[int, int], tuple[int, int, int, int]]] = {}
        if not self.sizes:
            return {}
        # Windows wait until there are many, as a walk takes one step of all of a size at a time. What waits is bounded over
        # all sizes, and places are verified and let go with it.
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        cells = first = 0
        while first < len(texts):
            upto, total = first, 0
            while upto < len(texts) and (upto == first or total + len(texts[upto]) <= _TOGETHER):
                total += len(texts[upto])
                upto += 1
            for m, *rows in self._windows_of(texts, first, upto):
                waiting.setdefault(m, []).append(tuple(rows))
                cells += rows[0].size
                if cells >= _WAITING:
                    self._settle(waiting, texts, found)
                    cells = 0
            first = upto
        self._settle(waiting, texts, found)
        return {t: sorted(hits.values()) for t, hits in found.items()}

    def _settle(self, waiting, texts, found) -> None:
        for m in list(waiting):
            near: dict[tuple[int, int], set[int]] = {}
            self._candidates(m, waiting.pop(m), near)
            for (t, item), places in near.items():
                self._verify(m, t, item, sorted(places), texts[t], found)

    def _windows_of(self, texts, first, upto) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(size, windows, their texts, their first words) of texts put one after the other, with padding between."""
        pad = np.zeros(self.sizes[-1], np.uint32)
        whole = np.concatenate([part for text in texts[first:upto] for part in (text, pad)])
        begins = np.cumsum([0] + [len(text) + len(pad) for text in texts[first:upto]])
        for m, starts in self.windows(whole):
            text = np.searchsorted(begins, starts, "right") - 1
            yield m, whole[starts[:, None] + np.arange(m)], first + text, starts - begins[text]

    def _candidates(self, m, rows, near) -> None:
        windows, owner, place = (np.concatenate(column) for column in zip(*rows))
        if self.repeats[m] is None:
            keys, items, begin = self.pieces[m]
            got = piece_keys(windows, m // min(self.limit(m) + 1, m))
            low, high = np.searchsorted(keys, got, "left"), np.searchsorted(keys, got, "right")
            w, at = np.nonzero(high > low)
            for t, where, first, upto in set(zip(owner[w].tolist(), (place[w] + at).tolist(), low[w, at].tolist(), high[w, at].tolist())):
                for i in range(first, upto):
                    near.setdefault((t, int(items[i])), set()).add(where - int(begin[i]))
            return
        for repeat in range(self.repeats[m]):
            keys, order = self.keys[m, repeat]
            got = walk_keys(windows, repeat)
            low, high = np.searchsorted(keys, got, "left"), np.searchsorted(keys, got, "right")
            for w in np.flatnonzero(high > low).tolist():
                for item in order[low[w] : high[w]].tolist():
                    near.setdefault((int(owner[w]), item), set()).add(int(place[w]))

    def _verify(self, m, t, item, places, text, found) -> None:
        limit, words = self.limit(m), self.rows[m][item]
        at = 0
        while at < len(places):
            upto = at
            while upto + 1 < len(places) and places[upto + 1] - places[upto] <= m:
                upto += 1
            first = max(0, places[at] - limit)
            stretch = text[first : places[upto] + m + limit]
            edits, end = edit_distance(words, stretch)
            if edits <= limit:
                back, length = edit_distance(words[::-1], stretch[:end][::-1])
                hit = (self.ids[m][item], first + end - length, length, edits)
                best = found.setdefault(t, {}).get((m, item))
                if best is None or edits < best[3]:
                    found[t][m, item] = hit
            at = upto + 1


@functools.lru_cache(maxsize=1)
def _built(token: str, held: _Held) -> Items:
    return Items(held.items, held.edits, held.recall, held.repeats)


class _Held:
    """A block of items on its way to the tasks; equal by token, so that a worker builds the keys once."""

    def __init__(self, items, edits, recall):
        self.items, self.edits, self.recall, self.token = items, edits, recall, uuid.uuid4().hex
        sizes = {len(symbols(raw)) for _, raw in items}
        self.repeats = repeats_by_size(sizes - {0}, edits, recall)

    def __hash__(self):
        return hash(self.token)

    def __eq__(self, other):
        return self.token == other.token

    def built(self) -> Items:
        return _built(self.token, self)


def blocks(items: DataFrame, edits: float, recall: float) -> Iterator[_Held]:
    """The query set in blocks; one block at a time is on the driver."""
    held = []
    for row in items.select(F.col("item_id").cast("long"), text_bytes("text")).toLocalIterator():
        held.append((row[0], bytes(row[1])))
        if len(held) == BLOCK:
            yield _Held(held, edits, recall)
            held = []
    yield _Held(held, edits, recall)


def passages(docs: DataFrame, items: DataFrame, edits: float = EDITS, recall: float = RECALL) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, first_word, n_words, edits."""
    schema = "doc_id long, item_id long, first_word long, n_words long, edits long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes("text").alias("raw"))
    found = []
    for held in blocks(items, edits, recall):

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            release()
            names = [field.split()[0] for field in schema.split(", ")]
            for batch in batches:
                hits = held.built().find([symbols(raw.as_py()) for raw in batch.column(1)])
                out = [(batch.column(0)[t].as_py(), *hit) for t, each in hits.items() for hit in each]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)

        found.append(rows.mapInArrow(run, schema))
    # Beyond one block each pass is written, so that the driver need not hold more than a block.
    return found[0] if len(found) == 1 else functools.reduce(DataFrame.union, [stage(f, "passages") for f in found])


def clean(docs: DataFrame, items: DataFrame, edits: float = EDITS, recall: float = RECALL) -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    where = docs.columns.index("text")
    for held in blocks(items, edits, recall):

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            release()
            for batch in batches:
                hits = held.built().find([symbols((text.as_py() or "").encode()) for text in batch.column(where)])
                mask = np.ones(batch.num_rows, bool)
                mask[list(hits)] = False
                yield batch.filter(pa.array(mask))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
