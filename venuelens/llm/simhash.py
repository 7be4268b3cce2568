"""SimHash near-duplicates by bit-sliced comparison.

Documents get a 64-bit fingerprint of their word shingles. Equal fingerprints are one node. Two nodes within the
radius agree on at least two of ``radius + 2`` bit blocks, so each node goes to one bucket for every pair of blocks
and no link is missed. Inside a bucket distances are worked out bit-sliced: bit p of 64 fingerprints lies in one
machine word, counters of a few bits per lane are updated by carry-save additions, and rows of lanes that have all
passed the radius are abandoned. A bucket gives a star of links for each group found in it, never all its pairs.
Buckets over ``BUCKET`` nodes are cut into blocks, and each pair of blocks is compared in its own group.

Defined results: a null text is an empty one and has fingerprint 0; zero fingerprints link like any others; repeated
rows are kept, each with its own row; a group whose ids are all null has a null component; an empty table gives an
empty result; columns other than id and text are not looked at.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import release, stage, text_bytes, text_key

BUCKET = 2048
LANES = 512
_CHUNK = 16384


def fingerprint(raw: bytes, shingle: int, seed: int) -> int:
    """Bit b is 1 if it is set in over half of the shingle hashes. A-Z are lower-cased, words are split at ASCII space."""
    words = raw.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        pieces: Iterator[bytes] = iter([b" ".join(words)])
        n = 1
    else:
        n = len(words) - shingle + 1
        pieces = map(b" ".join, zip(*(itertools.islice(words, i, None) for i in range(shingle))))
    hashes = map(functools.partial(xxhash.xxh64_intdigest, seed=seed), pieces)
    counts = np.zeros(64, np.int64)
    for start in range(0, n, _CHUNK):
        part = np.fromiter(hashes, np.uint64, min(_CHUNK, n - start))
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """One row (doc_id, text_key, fp) per document, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            values = [fingerprint(raw.as_py(), shingle, seed) for raw in batch.column(2)]
            fp = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fp], ["doc_id", "text_key", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("text_key"), text_bytes(text_col).alias("raw"))
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def close_pairs(fps: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of fingerprints with at most ``radius`` differing bits, in chunks."""
    n = len(fps)
    width = -(-n // 64)
    bits = np.unpackbits(fps.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    lanes = np.zeros((64, width * 64), np.uint8)
    lanes[:, :n] = bits.T
    planes = np.packbits(lanes, axis=1, bitorder="little").view(np.uint64)
    spread = bits.astype(np.uint64) * np.uint64(0xFFFFFFFFFFFFFFFF)
    depth = max(1, int(radius).bit_length())
    place = np.arange(width * 64)
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    for first in range(0, n, 256):
        rows = np.arange(first, min(n, first + 256))
        outside = (place[None, :] <= rows[:, None]) | (place[None, :] >= n)
        over = np.packbits(outside, axis=1, bitorder="little").view(np.uint64)
        # The counters start so far up that they overflow with the first bit beyond the radius.
        head = (1 << depth) - 1 - radius
        count = [np.full(over.shape, ones if head >> b & 1 else np.uint64(0)) for b in range(depth)]
        for p in range(64):
            carry = planes[p][None, :] ^ spread[rows, p][:, None]
            for b in range(depth):
                count[b], carry = count[b] ^ carry, count[b] & carry
            over |= carry
            if p % 4 == 3:
                alive = (over != ones).any(axis=1)
                if not alive.all():
                    rows, over, count = rows[alive], over[alive], [c[alive] for c in count]
                    if not len(rows):
                        break
        if len(rows):
            left, right = np.nonzero(np.unpackbits(~over.view(np.uint8), axis=1, bitorder="little"))
            yield rows[left], right


def star_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join each fingerprint to the first one of its group within these fingerprints."""
    label = np.arange(len(fps))
    for i, j in close_pairs(fps, radius):
        while True:
            low = np.minimum(label[i], label[j])
            before = label.copy()
            np.minimum.at(label, label[i], low)
            np.minimum.at(label, label[j], low)
            np.minimum.at(label, i, low)
            np.minimum.at(label, j, low)
            label = label[label]
            if (label == before).all():
                break
    while (label != label[label]).any():
        label = label[label]
    member = np.nonzero(label != np.arange(len(fps)))[0]
    return fps[member], fps[label[member]]


def _link_buckets(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links of sorted rows (bucket columns..., fp); buckets of a few nodes share a block of lanes."""

    def compare(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        edge = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0), [True]]))
        size = np.diff(edge)
        keep = np.repeat(size > 1, size)
        fp, size = fp[keep], size[size > 1]
        at = 0
        while at < len(size):
            upto, total = at + 1, size[at]
            while upto < len(size) and total + size[upto] <= LANES:
                total += size[upto]
                upto += 1
            block, fp, at = fp[:total], fp[total:], upto
            # Lanes of other buckets in the block may be close as well; such links are right too.
            a, b = star_links(np.unique(block), radius)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    held_key, held_fp = np.zeros((4, 0), np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)]
        key = np.concatenate([held_key, np.stack(columns[:4])], axis=1)
        fp = np.concatenate([held_fp, columns[4].view(np.uint64)])
        change = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0))
        done = change[-1] + 1 if len(change) else 0
        if done:
            yield from compare(key[:, :done], fp[:done])
        held_key, held_fp = key[:, done:], fp[done:]
    if len(held_fp):
        yield from compare(held_key, held_fp)


def block_masks(radius: int) -> list[int]:
    """Masks of all pairs of ``radius + 2`` bit blocks, as signed longs."""
    cuts = [64 * i // (radius + 2) for i in range(radius + 3)]
    blocks = [(1 << high) - (1 << low) for low, high in itertools.pairwise(cuts)]
    masks = [a | b for a, b in itertools.combinations(blocks, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(nodes: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect all within the radius of each other."""
    masks = block_masks(radius)
    tables = F.array(*[F.struct(F.lit(i).alias("tab"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(masks)])
    keyed = nodes.select("fp", F.explode(tables).alias("k")).select("fp", "k.tab", "k.part")
    hot = (
        keyed.groupBy("tab", "part").agg(F.count("*").alias("n")).filter(F.col("n") > bucket)
        .select("tab", "part", F.ceil(F.col("n") / bucket).cast("int").alias("cuts"))
    )
    cuts = F.coalesce(F.col("cuts"), F.lit(1))
    placed = (
        keyed.join(hot, ["tab", "part"], "left")
        .withColumn("own", F.pmod(F.xxhash64("fp"), cuts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), cuts - 1)))
        .select("tab", "part", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    )
    grouped = placed.repartition("tab", "part", "i", "j").sortWithinPartitions("tab", "part", "i", "j")
    return grouped.mapInArrow(lambda batches: _link_buckets(batches, radius), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with a link, root the smallest node reachable.

    Alternates the large-star and small-star steps until the links stay the same. Each round is written to the
    shared folder; only a count and a checksum come to the driver.
    """
    now = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = F.struct(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")))
    before = now.select(mark.alias("m")).first()["m"]
    while before[0]:
        both = now.union(now.select("v", "u"))
        lows = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(lows, "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        ends = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(ends, "u").filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        now = stage(small.union(ends.select("u", "low")).distinct(), "links")
        after = now.select(mark.alias("m")).first()["m"]
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3, seed: int = 42
) -> DataFrame:
    """One row per document: doc_id, text_key, fp, component_id, first_key.

    ``component_id`` is the smallest id reachable over links, ``first_key`` the smallest text key among the rows of
    that id in the group, so that (component_id, first_key) names the document that stays.
    """
    found = stage(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    nodes = found.groupBy("fp").agg(first)
    roots = components(links(nodes.select("fp"), radius))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("first").alias("first"))
    classes = rooted.select("fp", "root").join(groups, "root").select(F.col("fp").alias("class_fp"), "first")
    return found.join(classes, found.fp == classes.class_fp).select(
        "doc_id", "text_key", "fp", F.col("first.doc_id").alias("component_id"), F.col("first.text_key").alias("first_key")
    )


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One document of each group of near-duplicates with all its columns: the one with the smallest id."""
    groups = near_duplicates(docs, id_col, text_col, **how)
    stay = groups.filter("doc_id <=> component_id AND text_key = first_key").select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")
    ).distinct()
    mark = docs.withColumn("__text_key", text_key(text_col))
    joined = mark.join(stay, mark[id_col].cast("long").eqNullSafe(stay["__id"]) & (mark["__text_key"] == stay["__key"]))
    return joined.dropDuplicates(["__id", "__key"]).select(*[joined[c] for c in docs.columns])
