import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from venuelens.llm import neighbours

SCHEMA = "vec_id long, embedding array<double>"


def cosine(a, b):
    n = max(len(a), len(b))
    a, b = ([x / max(map(abs, v)) for x in v] + [0.0] * (n - len(v)) for v in (a, b))
    return math.fsum(x * y for x, y in zip(a, b)) / math.sqrt(math.fsum(x * x for x in a) * math.fsum(y * y for y in b))


def brute(rows, k, asks):
    good = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for n, (i, v) in enumerate(good):
        if i is not None and asks(i):
            near = sorted((round(-cosine(v, w), 9), j is None, j or 0) for m, (j, w) in enumerate(good) if m != n)
            out += [(i, rank + 1, None if gone else j, s) for rank, (s, gone, j) in enumerate(near[:k])]
    return sorted(((i, r, j, round(-s, 7) + 0.0) for i, r, j, s in out), key=str)


def ours(df, k=5, every=3, **more):
    got = neighbours.nearest(df, F.col("vec_id") % every == 0, k, **more).collect()
    return sorted(((r.query_id, r.rank, r.vec_id, round(r.score, 7) + 0.0) for r in got), key=str)


def random_rows(seed, n, d=6):
    rng = random.Random(seed)
    return [(i, [rng.choice([-2.0, -1.0, 0.0, 0.5, 1.0, 3.0]) for _ in range(d)]) for i in range(n)]


def test_same_as_brute_force_with_ties_and_odd_vectors(spark):
    rows = random_rows(1, 60)
    rows += [(100, rows[3][1]), (3, rows[3][1]), (3, rows[3][1]), (None, rows[3][1]), (102, [2 * x for x in rows[9][1]]), (105, [-x for x in rows[9][1]])]
    rows += [(108, None), (111, []), (114, [0.0, -0.0]), (117, [1.0, None]), (120, [float("nan"), 1.0]), (123, [float("inf"), 1.0])]
    rows += [(126, [1.0, -0.0]), (129, [1.0]), (132, [1e300, 1e300, 0.0]), (135, [1e-300, 1e-300])]
    rows += [(200 + i, rows[6][1]) for i in range(40)]  # copies that hold a third of the rows
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert ours(df) == brute(rows, 5, lambda i: i % 3 == 0)


def test_few_candidates_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [1.0, 1.0])]
    assert ours(spark.createDataFrame(rows, SCHEMA)) == brute(rows, 5, lambda i: i % 3 == 0)
    assert ours(spark.createDataFrame(rows[:1], SCHEMA)) == []
    assert ours(spark.createDataFrame([], SCHEMA)) == []
    assert ours(spark.createDataFrame([(0, None), (1, [])], SCHEMA)) == []
    assert ours(spark.createDataFrame([(1, [1.0]), (2, [1.0])], SCHEMA)) == []  # no query


def test_other_columns_and_single_precision(spark):
    rows = random_rows(2, 40)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for name in ("id", "vec", "node", "ids", "leaf", "near", "rank", "score", "asks", "place", "mine"):
        df = df.withColumn(name, F.lit("x"))
    assert ours(df) == brute(rows, 5, lambda i: i % 3 == 0)
    named = df.select(F.col("vec_id").alias("k"), F.col("embedding").alias("v"))
    got = neighbours.nearest(named, F.col("k") % 3 == 0, 2, id_col="k", vector_col="v")
    assert sorted({(r.query_id, r.rank) for r in got.collect()}) == [(i, r) for i in range(0, 40, 3) for r in (1, 2)]


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((20, 16))
    points = np.concatenate([centres[rng.integers(0, 20, 1500)] + 0.2 * rng.standard_normal((1500, 16)), rng.standard_normal((300, 16))])
    hot = points[0] + 1e-4 * rng.standard_normal((900, 16))  # near copies, a third of all
    return [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate([points, hot]))]


def found(df, every, **more):
    return {(i, j) for i, _, j, _ in ours(df, every=every, **more)}


def test_recall_with_blocks_and_a_small_sample(spark, clustered, monkeypatch):
    for name, value in {"LEAF": 64, "SAMPLE": 1000, "ROWS": 100, "QUERIES": 10}.items():
        monkeypatch.setattr(neighbours, name, value)  # all of them used on the driver
    ids, vectors = np.arange(len(clustered)), np.array([v for _, v in clustered])
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    scores = units[::10] @ units.T
    scores[np.arange(len(scores)), ids[::10]] = -2
    want = {(10 * q, int(j)) for q, row in enumerate(scores) for j in np.argsort(-row)[:5]}
    df = spark.createDataFrame(clustered, SCHEMA)
    got = found(df, 10)
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)
    assert len(found(df, 10, recall=1.0) & want) >= len(got & want)


def test_search_takes_the_cheapest_leaves_first():
    rng = np.random.default_rng(5)
    vectors = neighbours.units(rng.standard_normal((500, 8)))
    forest = neighbours.Forest(vectors.astype(np.float32), 20)
    for v in vectors[:20]:
        order = forest.visit(v, forest.leaves)
        assert sorted(order) == list(range(forest.leaves))
        assert set(forest.route(v[None])[0].tolist()) == set(order[: len(forest.roots)])  # its own leaves cost nothing
        assert order[:7] == forest.visit(v, 7)


def test_equal_vectors_make_a_leaf():
    forest = neighbours.Forest(np.ones((100, 4), np.float32), 10)
    assert forest.leaves == len(forest.roots) and forest.route(np.ones((3, 4))).shape == (3, neighbours.TREES)
