import itertools
import random
import re

import numpy as np
import xxhash

from venuelens.llm import simhash


def brute_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= 3:
            root[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            groups[find(i)] = min(d, groups.get(find(i), d))
    return sorted(((d, fps[i], groups.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def ours(df):
    got = simhash.near_duplicates(df).collect()
    return sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=str)


def random_rows(seed, n=300):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(400)]
    rows, texts = [], []
    for d in range(n):
        if texts and rng.random() < 0.5:
            base = rng.choice(texts).split(" ")
            base[rng.randrange(len(base))] = rng.choice(words).upper()
            text = " ".join(base)
        else:
            text = " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 80, 300])))
        texts.append(text)
        rows.append((d * 7 % n, text))
    return rows


def test_components_match_brute_force(documents):
    rows = random_rows(1)
    rows += [(1000, None), (1001, ""), (1002, " \n\t "), (5, rows[5][1]), (None, rows[9][1]), (2000, "É é Ü\x0bx" * 5000)]
    assert ours(documents(rows)) == brute_components(rows)


def test_small_buckets_give_the_same(spark, documents):
    df = documents(random_rows(2))
    nodes = simhash.fingerprints(df).select("fp").distinct()
    whole = {tuple(r) for r in simhash.components(simhash.links(nodes)).collect()}
    cut = {tuple(r) for r in simhash.components(simhash.links(nodes, bucket=2)).collect()}
    assert whole == cut and whole


def test_close_pairs_match_popcount():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([base ^ np.uint64(1 << int(b)) ^ np.uint64(1 << int(c)) for b, c in rng.integers(0, 63, (12, 2))] + [base]))
    for radius in (0, 1, 2, 3, 5):
        got = {(int(i), int(j)) for a, b in simhash.close_pairs(fps, radius) for i, j in zip(a, b)}
        want = {(i, j) for i, j in itertools.combinations(range(len(fps)), 2) if bin(int(fps[i]) ^ int(fps[j])).count("1") <= radius}
        assert got == want


def test_empty_table_and_first_of_each(documents):
    assert ours(documents([])) == []
    rows = [(3, "a b c d"), (3, "a b c d"), (1, "a b c d"), (9, "q r s t u v w"), (None, None)]
    df = documents(rows).withColumnRenamed("lang", "fp")
    kept = simhash.first_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 9, None]


def test_long_chain_is_one_component(spark):
    chain = spark.range(60).selectExpr("id AS a", "id + 1 AS b")
    got = {tuple(r) for r in simhash.components(chain).collect()}
    assert got == {(i, 0) for i in range(61)}
