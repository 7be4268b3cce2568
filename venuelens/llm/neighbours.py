"""Approximate nearest neighbours by a forest of random-projection trees.

Trees are fitted on a sample of at most ``SAMPLE`` vectors, kept by hash: a node's direction is the difference of two
of its vectors, its threshold the median projection. All vectors are then routed to one leaf of each tree. A search
walks all trees at once with one shared priority queue: going to the far side of a node costs its squared margin, and
leaves come out cheapest first. The number of leaves a query visits is measured, not guessed: for held-out queries,
whose true neighbours come from a pass over all vectors, it is the smallest number that finds ``recall`` of them. Rows
and queries meet by leaf, and every candidate is ranked by its exact cosine in double precision on original vectors.

Equal vectors are one node with its ``k + 1`` smallest ids, picked before the shuffle, which is all that any list of k
nearest can need. A leaf with many rows or queries is cut into blocks of bounded size; each block gives only its best
rows for a query. Leaves hold about ``LEAF`` vectors as long as a sampled leaf keeps eight; beyond that they grow with
the table and are searched block by block, and a larger ``SAMPLE`` makes them small again.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, take no part; a shorter
vector counts as filled up with zeros. A query's own row is left out once, so a repeated row is its neighbour. Ties go
to the smaller id, null ids last; rows of null id are candidates only. With fewer candidates than k all are given; a
lone vector, like an empty table, gives no rows. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import stage

SAMPLE = 131_072
TREES = 4
LEAF = 512
#: Share of the true neighbours of held-out queries that the search must find, and the number of these queries.
RECALL = 0.95
HELD_OUT = 256
#: Rows and queries of a leaf that meet in one group at most.
ROWS, QUERIES = 8192, 2048
_BLOCK = 256

_NEAR = "array<struct<less:double,nameless:boolean,id:bigint,node:bigint,copy:int,same:boolean>>"


def matrix(packed: list[bytes], kind: str, width: int) -> np.ndarray:
    """Packed vectors as rows of doubles, shorter ones filled up with zeros."""
    out = np.zeros((len(packed), width))
    for row, raw in zip(out, packed):
        values = np.frombuffer(raw, kind)
        row[: len(values)] = values
    return out


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times a power of two that keeps squares in range; cosines stay as they are."""
    most = np.abs(vectors).max(axis=1, initial=0, keepdims=True)
    return np.ldexp(vectors, -np.frexp(most)[1])


def units(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def cosines(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact scores of scaled vectors, the same whatever they are grouped with."""
    return (others * one).sum(axis=1) / (np.sqrt((one * one).sum()) * np.sqrt((others * others).sum(axis=1)))


class Forest:
    """Nodes of all trees in one numbering; a child below zero is leaf ``-child - 1``."""

    def __init__(self, vectors: np.ndarray, leaf: int, trees: int = TREES, seed: int = 42):
        self.random, self.leaf = np.random.default_rng(seed), max(1, leaf)
        self.directions, self.cuts, self.children, self.leaves = [], [], [], 0
        self.roots = [self._grow(vectors, np.arange(len(vectors))) for _ in range(trees)]
        self.directions = np.array(self.directions, np.float32).reshape(len(self.cuts), vectors.shape[1])
        self.cuts, self.children = np.array(self.cuts), np.array(self.children, np.int64).reshape(-1, 2)
        del self.random

    def _grow(self, vectors: np.ndarray, top: np.ndarray) -> int:
        root, waiting = None, [(top, None, 0)]
        while waiting:
            rows, above, side = waiting.pop()
            split = self._split(vectors, rows) if len(rows) > self.leaf else None
            if split is None:
                self.leaves += 1
                place = -self.leaves
            else:
                place, (direction, cut, right) = len(self.cuts), split
                self.directions.append(direction)
                self.cuts.append(cut)
                self.children.append([0, 0])
                waiting += [(rows[~right], place, 0), (rows[right], place, 1)]
            if above is None:
                root = place
            else:
                self.children[above][side] = place
        return root

    def _split(self, vectors, rows):
        for _ in range(3):
            a, b = self.random.choice(len(rows), 2, replace=False)
            direction = vectors[rows[a]] - vectors[rows[b]]
            size = np.linalg.norm(direction)
            if size > 0:
                direction = (direction / size).astype(np.float32)
                at = vectors[rows] @ direction
                cut = float(np.median(at))
                right = at > cut
                if right.any() and not right.all():
                    return direction, cut, right
        return None

    def route(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each unit vector in each tree."""
        out = np.empty((len(vectors), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            place = np.full(len(vectors), root, np.int64)
            inside = np.flatnonzero(place >= 0)
            while len(inside):
                node = place[inside]
                at = (vectors[inside] * self.directions[node]).sum(axis=1)
                place[inside] = self.children[node, (at > self.cuts[node]).astype(np.int64)]
                inside = inside[place[inside] >= 0]
            out[:, t] = -place - 1
        return out

    def visit(self, vector: np.ndarray, leaves: int) -> list[int]:
        """The first leaves out of one priority queue over all trees, cheapest first."""
        margins = ((self.directions * vector).sum(axis=1) - self.cuts).tolist()
        children, out = self.children.tolist() if self.leaves < 512 else self.children, []
        queue = [(0.0, root) for root in self.roots]
        heapq.heapify(queue)
        while queue and len(out) < leaves:
            cost, node = heapq.heappop(queue)
            while node >= 0:
                margin, (left, right) = margins[node], children[node]
                near, far = (right, left) if margin > 0 else (left, right)
                heapq.heappush(queue, (cost + margin * margin, int(far)))
                node = near
            out.append(int(-node - 1))
        return out


def packed(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, str]:
    """(id, vec) of the rows that take part, vec as bytes of the column's own precision, and its numpy type."""
    single = isinstance(df.schema[vector_col].dataType.elementType, T.FloatType)
    kind = "<f4" if single else "<f8"
    vec = F.col(vector_col) if single else F.col(vector_col).cast("array<double>")
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    good = F.coalesce(~F.exists(vec, odd) & F.exists(vec, lambda x: x != 0), F.lit(False))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.when(good, vec).alias("vec")).where(F.col("vec").isNotNull())

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lists = part.column(1)
            # Adding zero makes a negative zero a plain one, so that equal vectors are equal bytes.
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False) + 0, lists.offsets.to_numpy() - lists.offsets[0].as_py()
            raw = flat.astype(kind).tobytes()
            size = np.dtype(kind).itemsize
            vecs = [raw[a * size : b * size] for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(vecs, pa.binary())], ["id", "vec"])

    return rows.mapInArrow(run, "id long, vec binary"), kind


def fit(nodes: DataFrame, kind: str, width: int, n: int) -> Forest:
    """Trees from at most ``SAMPLE`` vectors, the first ones by hash."""
    few = nodes.select("vec") if n <= SAMPLE else nodes.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE)
    vectors = units(matrix(few.toArrow().column(0).to_pylist(), kind, width)).astype(np.float32)
    vectors = vectors[np.lexsort(vectors.T[::-1])]  # the same trees whatever the order of the rows
    return Forest(vectors, max(8, LEAF * len(vectors) // max(1, n)) if n > SAMPLE else LEAF)


def leaves_to_visit(nodes: DataFrame, queries: DataFrame, forest, built: Forest, kind: str, width: int, k: int, recall: float) -> int:
    """Leaves that a search must take so that it finds ``recall`` of the true neighbours of held-out queries."""
    held = [bytes(r.vec) for r in queries.orderBy(F.xxhash64("vec"), "vec").limit(HELD_OUT).collect()]
    asked = units(matrix(held, kind, width))
    told = nodes.sparkSession.sparkContext.broadcast((held, asked))

    def nearest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, asked = told.value
        best = [[] for _ in held]
        for part in parts:
            for at in range(0, part.num_rows, 4096):
                vecs = part.column(0).slice(at, 4096).to_pylist()
                vectors = units(matrix(vecs, kind, width))
                scores, leaves = asked @ vectors.T, forest.value.route(vectors).tolist()
                for q, row in enumerate(scores):
                    top = np.argsort(-row)[: k + 1].tolist()
                    found = [(float(row[i]), leaves[i]) for i in top if vecs[i] != held[q]]
                    best[q] = sorted(best[q] + found, reverse=True)[:k]
        rows = [(q, *hit) for q, hits in enumerate(best) for hit in hits]
        if rows:
            q, score, leaves = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(score), pa.array(leaves, pa.list_(pa.int64()))], ["q", "score", "leaves"])

    rows = nodes.select("vec").mapInArrow(nearest, "q long, score double, leaves array<long>")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "leaves"))
    found = rows.withColumn("place", place).where(F.col("place") <= k).collect()
    orders = [{leaf: n for n, leaf in enumerate(built.visit(v, built.leaves))} for v in asked]
    needed = sorted(min(orders[r.q][leaf] for leaf in r.leaves) + 1 for r in found)
    return needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)] if needed else 1


def _best(rows: pa.Table, kind: str, width: int, k: int) -> pa.Table:
    """The best rows of one block of a leaf for each of its queries."""
    table = rows.to_pydict()
    is_row = np.array([ids is not None for ids in table["ids"]], bool)
    vecs = [v for v, there in zip(table["vec"], is_row) if there]
    asked = [v for v, there in zip(table["vec"], is_row) if not there]
    ids, nodes = [i for i in table["ids"] if i is not None], [n for n, there in zip(table["node"], is_row) if there]
    out = []
    if vecs and asked:
        vectors = scaled(matrix(vecs, kind, width))
        fast = units(vectors)
        first = np.array([min((i for i in each if i is not None), default=2**63 - 1) for each in ids])
        for at in range(0, len(asked), _BLOCK):
            mine = scaled(matrix(asked[at : at + _BLOCK], kind, width))
            scores = units(mine) @ fast.T
            for q, row in enumerate(scores):
                near = np.arange(len(row))
                if len(row) > k + 1:
                    # Rounding must not decide at the edge; what is that close is ranked by its exact score.
                    near = np.flatnonzero(row >= np.partition(row, -k - 1)[-k - 1] - 1e-9)
                exact = cosines(mine[q], vectors[near])
                keep = np.lexsort((first[near], -exact))[: k + 1]
                hits = [
                    {"less": float(-exact[j]) + 0.0, "nameless": i is None, "id": i, "node": nodes[near[j]], "copy": c, "same": vecs[near[j]] == asked[at + q]}
                    for j in keep for c, i in enumerate(ids[near[j]])
                ]
                hits.sort(key=lambda h: (h["less"], h["nameless"], h["id"] or 0))
                out.append((asked[at + q], hits[: k + 1]))
    kept = pa.list_(pa.struct([("less", pa.float64()), ("nameless", pa.bool_()), ("id", pa.int64()), ("node", pa.int64()), ("copy", pa.int32()), ("same", pa.bool_())]))
    return pa.table({"vec": pa.array([v for v, _ in out], pa.binary()), "near": pa.array([h for _, h in out], kept)})


def _routed(nodes: DataFrame, forest, kind: str, width: int, visits: int | None) -> DataFrame:
    """Nodes with the leaves they lie in, or, with ``visits``, the leaves they search."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            vectors = units(matrix(part.column(0).to_pylist(), kind, width))
            leaves = forest.value.route(vectors).tolist() if visits is None else [forest.value.visit(v, visits) for v in vectors]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(leaves, pa.list_(pa.int64()))], [*part.schema.names, "leaves"])

    schema = T.StructType([*nodes.schema.fields, T.StructField("leaves", T.ArrayType(T.LongType()))])
    return nodes.mapInArrow(run, schema).withColumn("leaf", F.explode("leaves")).drop("leaves")


def nearest(
    df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = RECALL
) -> DataFrame:
    """The k nearest rows of each query row by cosine: query_id, rank from 1, vec_id, score."""
    spark = df.sparkSession
    df = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows, kind = packed(df, "vec_id", "vector")
    asking, _ = packed(df.where("asks and vec_id is not null"), "vec_id", "vector")
    rows, asking = stage(rows, "vectors"), stage(asking, "queries")
    place = F.row_number().over(Window.partitionBy("vec").orderBy(F.asc_nulls_last("id")))
    few = rows.withColumn("place", place).where(F.col("place") <= k + 1)
    nodes = stage(few.groupBy("vec").agg(F.array_sort(F.collect_list(F.struct("place", "id"))).alias("ids")), "nodes")
    nodes = nodes.select("vec", F.col("ids.id").alias("ids"), F.xxhash64("vec").alias("node"))
    n, width = nodes.agg(F.count("*"), F.max(F.length("vec"))).first()
    width = (width or 0) // np.dtype(kind).itemsize
    queries = asking.select("vec").distinct()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not n or queries.isEmpty():
        return empty
    built = fit(nodes, kind, width, n)
    forest = spark.sparkContext.broadcast(built)
    visits = leaves_to_visit(nodes, queries, forest, built, kind, width, k, recall)

    lying = stage(_routed(nodes, forest, kind, width, None), "leaves")
    looking = stage(_routed(queries, forest, kind, width, visits), "visits")
    # One row a leaf, which the sample bounds: how many blocks its rows and its queries make.
    blocks = {}
    for side, (frame, most) in enumerate(((lying, ROWS), (looking, QUERIES))):
        for leaf, count in frame.groupBy("leaf").count().where(F.col("count") > most).collect():
            blocks.setdefault(leaf, [1, 1])[side] = -(-count // most)
    cut = {leaf: tuple(parts) for leaf, parts in blocks.items()}
    if cut:
        sizes = F.broadcast(spark.createDataFrame([(leaf, *parts) for leaf, parts in cut.items()], "leaf long, of_rows int, of_queries int"))
        lying, looking = (
            frame.join(sizes, "leaf", "left")
            .withColumn("mine", F.pmod(F.xxhash64(F.lit(1), "vec"), F.coalesce(own, F.lit(1))).cast("int"))
            .withColumn("theirs", F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)))
            for frame, own, other in ((lying, F.col("of_rows"), F.col("of_queries")), (looking, F.col("of_queries"), F.col("of_rows")))
        )
    else:
        lying, looking = (frame.withColumns({"mine": F.lit(0), "theirs": F.lit(0)}) for frame in (lying, looking))
    lying = lying.select("leaf", F.col("mine").alias("row_block"), F.col("theirs").alias("query_block"), "vec", "ids", "node")
    looking = looking.select(
        "leaf", F.col("theirs").alias("row_block"), F.col("mine").alias("query_block"), "vec",
        F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("long").alias("node"),
    )
    met = lying.unionByName(looking).groupBy("leaf", "row_block", "query_block")
    found = stage(met.applyInArrow(lambda rows: _best(rows, kind, width, k), f"vec binary, near {_NEAR}"), "near")
    # A query has at most k + 1 rows from each block it visits.
    lists = found.groupBy("vec").agg(F.collect_list("near").alias("near"))
    lists = lists.select("vec", F.slice(F.array_sort(F.array_distinct(F.flatten("near"))), 1, k + 1).alias("near"))
    own = F.array_position(F.transform("near", lambda x: F.coalesce(x["same"] & (x["id"] == F.col("id")), F.lit(False))), True).cast("int")
    met = asking.join(lists, "vec").withColumn("own", own)
    others = F.filter("near", lambda x, i: i + 1 != F.col("own"))
    hits = met.select(F.col("id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("rank", "hit"))
    return hits.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.id").alias("vec_id"), (F.lit(0.0) - F.col("hit.less")).alias("score"))
