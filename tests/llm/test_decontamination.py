import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from venuelens.llm import decontamination as dc


def brute_distance(item, words):
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(words):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def prose(rng, n, vocabulary=4000):
    return ["w%d" % min(rng.randrange(vocabulary), rng.randrange(vocabulary)) for _ in range(n)]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        how = rng.random()
        if how < 0.4:
            words[at] = "new%d" % rng.randrange(10**6)
        elif how < 0.7:
            del words[at]
        else:
            words.insert(at, "more%d" % rng.randrange(10**6))
    return words


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(12)
    items = [(i, " ".join(prose(rng, rng.randrange(10, 60)))) for i in range(60)]
    rows = []
    for d in range(500):
        words = prose(rng, rng.randrange(5, 400))
        if d % 5 == 0:
            item = items[rng.randrange(60)][1].split()
            at = rng.randrange(len(words))
            words[at:at] = edited(rng, item, rng.randrange(int(0.2 * len(item)) + 1) if d % 10 else 0)
        rows.append((d, " ".join(words).upper() + "."))
    return items, rows


def brute(items, rows, share):
    out = {}
    for d, text in rows:
        words = (text or "").lower().replace(".", " ").split()
        for i, item in items:
            item = (item or "").split()
            limit = int(share * len(item)) if len(item) >= 8 else 0
            if item and len(set(item) & set(words)) >= len(set(item)) - limit:
                distance = brute_distance(item, words)
                if distance <= limit:
                    out[d, i] = distance
    return out


def test_recall_and_exact_distances(documents, spark, corpus):
    items, rows = corpus
    extra = [(900, None), (901, ""), (902, items[3][1]), (902, items[3][1]), (None, items[4][1]), (903, " ".join(items[5][1].split()[1:]))]
    table = spark.createDataFrame([*items, (100, None), (101, "w1 w2"), (102, items[3][1])], "item_id long, text string")
    got = dc.passages(documents(rows + extra), table).collect()
    found = {(r.doc_id, r.item_id): r.edits for r in got if r.doc_id is not None}
    want = brute([*items, (101, "w1 w2"), (102, items[3][1])], rows + extra[:4] + extra[5:], 0.2)
    assert set(found) <= set(want) and all(found[k] == want[k] for k in found)
    assert len(found) >= 0.95 * len(want)
    assert {k for k, v in want.items() if v == 0} <= set(found)
    assert sum(r.doc_id == 902 and r.item_id == 3 for r in got) == 2 and any(r.doc_id is None and r.item_id == 4 for r in got)
    dirty = {d for d, _ in found}
    kept = dc.clean(documents(rows).withColumnRenamed("source", "raw"), table)
    assert kept.columns == ["doc_id", "text", "lang", "raw", "n_chars"]
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - dirty


def test_places(spark, documents):
    item = "one two three four five six seven eight nine ten"
    table = spark.createDataFrame([(1, item)], "item_id long, text string")
    row = dc.passages(documents([(5, "aa bb " + item.replace("four", "x") + " cc")]), table).first()
    assert (row.first_word, row.n_words, row.edits) == (2, 10, 1)


def test_capitals_with_accents(spark, documents):
    item = "größe été où änderung straße niño año élève über fête çà été señor mañana öl"
    table = spark.createDataFrame([(1, item), (2, item.upper().replace("OÙ", "XX"))], "item_id long, text string")
    docs = documents([(5, "Vorher " + item.upper() + " danach"), (6, item), (7, "été")])
    assert {(r.doc_id, r.item_id, r.edits) for r in dc.passages(docs, table).collect()} == {(d, i, i - 1) for d in (5, 6) for i in (1, 2)}
    assert [r.doc_id for r in dc.clean(docs, table).collect()] == [7]


@pytest.mark.parametrize("size", [40, 60, 120, 200])
@pytest.mark.parametrize("how", ["replaced", "left out", "put in"])
def test_recall_at_the_limit_of_edits(size, how):
    rng = random.Random(size)
    made = iter(range(10**6))
    items = [["i%d" % next(made) for _ in range(size)] for _ in range(120)]
    texts = []
    for item in items:
        at = set(rng.sample(range(size), size // 5))
        new = {"replaced": lambda w: ["n%d" % next(made)], "left out": lambda w: [], "put in": lambda w: [w, "n%d" % next(made)]}[how]
        passage = [x for j, w in enumerate(item) for x in (new(w) if j in at else [w])]
        texts.append(["c%d" % next(made) for _ in range(90)] + passage + ["c%d" % next(made) for _ in range(90)])
    block = dc.Items([(i, " ".join(item).encode()) for i, item in enumerate(items)], 0.2, 0.95)
    hits = block.find([dc.symbols(" ".join(text).encode()) for text in texts])
    assert sum(any(hit[0] == t for hit in rows) for t, rows in hits.items()) >= 0.95 * len(items)
    assert all(hit[3] <= size // 5 for rows in hits.values() for hit in rows)


def test_distance_matches_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        a, b = [rng.randrange(4) for _ in range(rng.randrange(1, 9))], [rng.randrange(4) for _ in range(rng.randrange(12))]
        assert dc.edit_distance(np.array(a), np.array(b, int))[0] == brute_distance(a, b)


def test_blocks_of_items_and_empty_tables(documents, spark, monkeypatch, corpus):
    items, rows = corpus
    table = spark.createDataFrame(items, "item_id long, text string")
    whole = {tuple(r) for r in dc.passages(documents(rows), table).collect()}
    monkeypatch.setattr(dc, "BLOCK", 7)
    assert {tuple(r) for r in dc.passages(documents(rows), table).collect()} == whole
    monkeypatch.undo()
    assert dc.passages(documents([]), table).count() == 0
    assert dc.passages(documents(rows), table.limit(0)).count() == 0
    assert dc.clean(documents(rows), table.limit(0)).count() == len(rows)


def test_short_items_are_found_unchanged(documents, spark):
    rng = random.Random(31)
    items = [(m, " ".join("q%dx%d" % (m, i) for i in range(m))) for m in range(1, 8)] + [(20, "w5"), (21, "w1 w1 w1")]
    rows = []
    for d in range(200):
        words = prose(rng, rng.randrange(1, 200), 30)
        item = items[d % 7][1].split()
        if d % 3 == 0:
            at = rng.randrange(len(words))
            words[at:at] = item if d % 2 else item[:-1] + ["other"]
        rows.append((d, " ".join(words)))
    df = documents(rows)
    for name in ("raw", "item_id", "first_word", "n_words", "edits"):
        df = df.withColumn(name, F.lit("x"))
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("raw", F.lit("x"))
    got = {(r.doc_id, r.item_id): r.edits for r in dc.passages(df, table).collect()}
    want = {}
    for d, text in rows:
        words = text.split()
        for i, item in items:
            item = item.split()
            if any(words[at : at + len(item)] == item for at in range(len(words))):
                want[d, i] = 0
    assert got == want and {i for _, i in want} >= set(range(1, 8))
    assert {r.doc_id for r in dc.clean(df, table).collect()} == {d for d, _ in rows} - {d for d, _ in want}
    assert dc.clean(df, table).columns == df.columns


def test_what_waits_is_bounded_and_gives_the_same(corpus, monkeypatch):
    items, rows = corpus
    texts = [dc.symbols(t.encode()) for _, t in rows]
    whole = dc.Items([(i, t.encode()) for i, t in items], 0.2, 0.95).find(texts)
    monkeypatch.setattr(dc, "_WAITING", 500)
    monkeypatch.setattr(dc, "_TOGETHER", 300)
    assert dc.Items([(i, t.encode()) for i, t in items], 0.2, 0.95).find(texts) == whole
