import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from venuelens.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def way(levels, i):
    out = []
    for level in levels[:-1]:
        a = i // 3 * 3
        out.append(("".join(level[a:i]), "".join(level[i + 1 : a + 3])))
        i //= 3
    return out


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, sha(*map(told, row)), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        trees[name] = tree([x[2] for x in groups[name]])
    top = tree([trees[name][-1][0] for name in names])
    out = []
    for j, name in enumerate(names):
        for i, (_, _, leaf, row) in enumerate(groups[name]):
            path = way(trees[name], i) + way(top, j)
            text = row[4]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            held = sha(*map(told, (*row[:4], text)))
            for left, right in path:
                held = sha(left, held, right)
            root = top[-1][0]
            out.append((row[0], leaf, trees[name][-1][0], root, sha(*[a + b for a, b in path]), held, held == root))
    return sorted(out, key=str)


def ours(df):
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))
    rows = merkle.manifest_check(df, tampered, FIELDS)
    rows = rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r) for r in rows.collect()), key=str)


def random_rows(n, hot):
    rng = random.Random(n)
    rows = []
    for i in range(n):
        source = "hot" if i < hot else rng.choice([None, "", "a", "é", "z\x00", "sole%d" % i])
        text = rng.choice([None, "", "a\nb", "Ünï\n\ncode \U0001f600", "no break", "x" * 5000 + "\n"])
        rows.append((i * 7919 % 10007, source, rng.choice([None, "en"]), rng.choice([None, 3]), text))
    return rows


def test_same_as_brute_force(spark):
    rows = random_rows(400, 250)
    rows += [rows[0], rows[0], (rows[1][0], "hot", "other", 1, "x"), (None, "hot", None, None, None), (None, None, None, None, "\n")]
    assert ours(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_many_rounds_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    rows = random_rows(120, 95)  # blocks of 9: three rounds
    assert ours(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28])
def test_lone_nodes_and_short_runs(spark, n):
    rows = [(i, "s", "en", 1, "t\n%d" % i) for i in range(n)]
    assert ours(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_empty_table_and_clashing_names(spark):
    assert ours(spark.createDataFrame([], SCHEMA)) == []
    rows = random_rows(30, 10)
    df = spark.createDataFrame(rows, SCHEMA)
    more = df
    for name in ("key", "pos", "n", "h", "kids", "part", "block", "path", "leaf", "root", "row", "d0", "copy", "verified"):
        more = more.withColumn(name, F.lit("x"))
    assert ours(more) == ours(df) == brute(rows)
    with pytest.raises(ValueError, match="leaf"):
        merkle.proofs(df, FIELDS, carry={"leaf": F.lit(1)})


def test_proofs_hold_for_other_columns(spark):
    df = spark.createDataFrame([(i, i % 3, "v%d" % i) for i in range(50)], "ord int, grp int, h string")
    rows = merkle.proofs(df, ["h", "ord"], order="ord", group="grp", carry={"v": F.upper("h")})
    rows = rows.withColumn("ok", merkle.fold(F.col("leaf"), F.col("path")) == F.col("root"))
    got = rows.collect()
    assert len(got) == 50 and all(r.ok and r.v == "V%d" % r.ord for r in got)


def test_proofs_need_no_join_below_the_ranks(spark):
    df = spark.createDataFrame(random_rows(60, 30), SCHEMA)
    plan = merkle.proofs(df, FIELDS)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan
