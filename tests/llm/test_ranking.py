import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from venuelens.llm import ranking


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, top=20):
    held = [(i, Counter(w), len(w)) for i, t in docs if (w := words(t))]
    n_docs, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, counts, n in held:
            m = 100 - 25 + (25 * n * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 12 * m))
                for t in words(text) if t in counts
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        found.sort()
        out += [(item, r + 1, None if gone else doc, -s) for r, (s, gone, doc) in enumerate(found[:top])]
    return sorted(out, key=str)


def random_texts(seed, n, most=60):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(150)] + ["Äpfel", "É", "\U0001f600x", "A1", "b-c", "x'y"]
    weight = [1 / (1 + i) for i in range(len(vocabulary))]
    return [rng.choice([" ", ", ", "\n"]).join(rng.choices(vocabulary, weight, k=rng.randint(1, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def case():
    docs = [(i * 13 % 401, t) for i, t in enumerate(random_texts(1, 400))]
    docs += [(5000 + i, docs[3][1]) for i in range(120)]  # a large group of copies
    docs += [(7, None), (8, ""), (9, " .,-\n"), (None, docs[3][1]), (5, docs[5][1]), (5, docs[5][1]), (10, "W1 " * 20000 + "é")]
    items = [(i, t) for i, t in enumerate(random_texts(2, 25, 30))] + [(3, "w1 w1 W2"), (40, None), (41, ""), (42, "unknown"), (None, "w5 w6")]
    return docs, items


def frames(spark, case):
    return spark.createDataFrame(case[0], "doc_id long, text string").repartition(3), spark.createDataFrame(case[1], "item_id long, text string")


def ours(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_same_as_brute_force(spark, case):
    assert ours(ranking.best_documents(*frames(spark, case))) == brute(*case)


def direct(case, top=20):
    """The tasks' work in this process, over all documents as one task."""
    docs, items = case
    batch = ranking.Batch([(i, (t or "").encode()) for i, t in items])
    raw = pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs], pa.int64()), pa.array([(t or "").encode() for _, t in docs])], ["doc_id", "raw"])
    parts = list(ranking.count_terms([raw.slice(at, 100) for at in range(0, len(docs), 100)], batch.vocabulary))
    rows = pa.Table.from_batches(parts).to_pylist()
    n_docs, length = len(rows), sum(r["n"] for r in rows)
    df = Counter(t for r in rows for t in r["terms"])
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in range(len(batch.vocabulary))])
    out = []
    for found in ranking.search(parts, (batch.ids, batch.items, n_docs, length, weight), top):
        out += [(r["item_id"], n + 1, r["doc_id"], r["score"]) for n, r in enumerate(found.to_pylist())]
    return sorted(out, key=str)


@pytest.mark.parametrize("bounds", [{}, {"SHARD": 50, "POSTINGS": 300}, {"SHARD": 1}, {"COORDINATES": 7}, {"SHORT": 2, "BLOCK": 4}, {"SHORT": 0, "BLOCK": 1}])
def test_bounds_do_not_change_rows(case, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(ranking, name, value)
    assert direct(case) == brute(*case)


def test_blocks_of_items(spark, case, monkeypatch):
    monkeypatch.setattr(ranking, "ITEM_BYTES", 500)  # used on the driver
    docs, items = frames(spark, case)
    assert len(list(ranking.batches(items))) > 1
    assert ours(ranking.best_documents(docs, items)) == brute(*case)


def test_blocks_are_skipped(case, monkeypatch):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choices(["t%d" % t for t in range(20)], k=rng.choice([3, 80]))) + (" rare%d" % (i % 40) * (i % 7 == 0))) for i in range(3000)]
    items = [(1, "t1 t2 rare3"), (2, "t5"), (3, "rare7 t1 t1")]
    seen = []
    whole = ranking.Shard.search

    def counted(self, *given):
        seen.append(whole(self, *given))
        return seen[-1]

    monkeypatch.setattr(ranking.Shard, "search", counted)
    assert direct((docs, items)) == brute(docs, items)
    assert sum(a for a, _ in seen) < 0.5 * sum(b for _, b in seen)


def test_empty_tables_and_other_columns(spark, case):
    docs, items = frames(spark, case)
    none = ranking.best_documents(docs, items.limit(0))
    assert ours(none) == [] and none.columns == ["item_id", "rank", "doc_id", "score"]
    assert ours(ranking.best_documents(docs.limit(0), items)) == []
    assert ours(ranking.best_documents(docs.where("text is null"), items)) == []
    for name in ("n", "terms", "tfs", "raw", "item_id", "item", "score", "rank"):
        docs = docs.withColumn(name, F.lit("x"))
    few = items.withColumn("score", F.lit(1)).withColumn("doc_id", F.lit(2))
    assert ours(ranking.best_documents(docs, few, top=3)) == brute(*case, top=3)
