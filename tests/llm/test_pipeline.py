import itertools
import random
import zlib

import corpus_pipeline
import pytest
from test_decontamination import brute_distance
from test_packing import library_ids
from test_pii import brute as brute_pii
from test_quality import brute as brute_quality
from test_simhash import brute_fingerprint


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    words = ["w%d" % i for i in range(3000)]
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, " ".join(prose(rng.randrange(12, 40)))) for i in range(20)] + [(20, "zq1 zq2 zq3")]
    rows = [(d, " ".join(prose(rng.randrange(25, 300))), "en", "s") for d in range(300)]
    rows += [(400 + i, rows[i][1].upper() if i % 2 else rows[i][1], "en", "s") for i in range(20)]
    rows += [(500 + i, " ".join([*prose(30), items[i][1], *prose(30)]), "de", None) for i in range(20)]
    rows += [(600 + i, " ".join([*prose(30), "mail a%d@b.example.com" % i, "+1 (555) 123-4567", *prose(9)]), None, "s") for i in range(10)]
    rows += [(700, None, "en", "s"), (701, "", None, None), (702, "too short", "en", "s"), (703, " ".join(prose(8) * 30), "en", "s"), (704, " ".join(prose(6000)), "fr", "s")]
    rows += [(800, " ".join([*prose(30), "zq1 zq2 zq3", *prose(30)]), "en", "s"), (801, " ".join([*prose(30), "zq1 zq3 zq2", *prose(30)]), "en", "s")]
    rows += [rows[7], rows[7], (None, " ".join(prose(50)), "en", "s")]
    docs = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    at = str(tmp_path_factory.mktemp("tables"))
    docs.repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(d, 1, 0) for d in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at, rows, items


def expected(rows, items):
    """What is left before packing, stage by stage; so few labels certify no cutoff."""
    docs = [(d, t) for d, t, *_ in rows if not brute_quality(t)[-1]]
    fps = [brute_fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))
    for i, j in itertools.combinations(range(len(docs)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= 3:
            a, b = root[i], root[j]
            root = [a if r == b else r for r in root]
    first = {}
    for i, (d, t) in enumerate(docs):
        key = (d is None, d or 0)
        if root[i] not in first or key < first[root[i]][0]:
            first[root[i]] = (key, d, t)
    kept = [(d, t) for _, d, t in first.values()]
    limits = [(item.split(), int(0.2 * len(item.split())) if len(item.split()) >= 8 else 0) for _, item in items]

    def clean(text):
        found = set(text.lower().split())
        return not any(len(set(i) & found) >= len(set(i)) - k and brute_distance(i, text.lower().split()) <= k for i, k in limits)

    out = []
    for d, text in kept:
        if clean(text):
            for start, _, kind, end in reversed(brute_pii(text)):
                text = f"{text[:start]}[{kind.upper()}]{text[end:]}"
            out.append((d, text))
    return sorted(out, key=str)


def test_stages_match_brute_force(spark, folder):
    at, rows, items = folder
    want = expected(rows, items)
    docs = spark.read.parquet(f"{at}/documents.parquet")
    columns, counted = docs.columns, []
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(step(spark, docs, at), "test")
        assert docs.columns == columns
        counted.append(docs.count())
    assert sorted(((r.doc_id, r.text) for r in docs.collect()), key=str) == want
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    assert counted == sorted(counted, reverse=True) and not {800, *range(500, 520)} & {d for d, _ in want} and 801 in {d for d, _ in want}
    placed = corpus_pipeline.run(spark, at).collect()
    ids = {d: raw + bytes(4) for (d, _), raw in zip(want, library_ids("byte_bpe_50k.json", [t for _, t in want]))}
    assert {r.doc_id for r in placed} == set(ids)
    for r in placed:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][4 * r.start : 4 * (r.start + r.length)])
    assert sum(r.length for r in placed) == sum(len(raw) // 4 for raw in ids.values())


def test_empty_tables(spark, folder, tmp_path):
    at, _, _ = folder
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{at}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_extra_columns_stay(spark, folder):
    at, _, _ = folder
    docs = spark.read.parquet(f"{at}/documents.parquet").selectExpr("*", "1 AS m", "2 AS fp", "3 AS doc", "4 AS root", "5 AS half", "6 AS kept")
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(step(spark, docs, at), "test")
        assert docs.columns[-6:] == ["m", "fp", "doc", "root", "half", "kept"]
    assert docs.first().kept == 6
