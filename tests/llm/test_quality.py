import random
import re
from math import comb

import pytest
from pyspark.sql import functions as F

from venuelens.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    spots = {}
    for i in range(len(words) - 7):
        spots.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {p for at in spots.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 20 or 100 * len(covered) > 30 * n)


def texts():
    rng = random.Random(4)
    out = [None, "", " \n\t", "a " * 9, "x y\nx y\n\n x y\n", "one # two ** three\x0bfour\x1cfive", "é ü\U0001f600 " * 40, "<|a|>\r\n" * 3]
    for _ in range(60):
        words = ["w%d" % rng.randrange(rng.choice([2, 30, 4000])) for _ in range(rng.randrange(400))]
        out.append("".join(w + rng.choice([" ", " ", "\n", "  ", "\t"]) for w in words))
        if rng.random() < 0.4:
            out[-1] += out[-1][: rng.randrange(len(out[-1]) + 1)]
    return out


def test_measures_match_brute_force(documents, spark):
    rows = list(enumerate(texts())) + [(3, "a b"), (3, "a b"), (None, "c")]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.report(documents(rows).withColumnRenamed("source", "m"), labels).collect()
    ours = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=str)
    assert ours == sorted(((d, *brute(t)) for d, t in rows), key=str)
    assert all(r.kept != r.base_failed for r in got)


def test_repeats_in_a_long_text(spark):
    text = "a b c d e f g h i j k " * 3000
    df = spark.createDataFrame([(text,)], "t string").select(quality.measures(F.col("t"))["words"]["n_repeat_words"].alias("n"))
    assert df.first().n == 33000


@pytest.mark.parametrize("k,n,p", [(0, 10, 0.3), (0, 500, 0.01), (2, 1000, 0.008), (40, 5000, 0.01), (5, 5, 0.5), (0, 0, 0.1), (900, 100000, 0.01)])
def test_binomial_tail_is_exact(spark, k, n, p):
    got = spark.range(1).select(quality.binomial_tail(F.lit(k), F.lit(n), p).alias("x")).first().x
    want = 1.0 if k >= n * p else sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) if n < 9000 else None
    if want is None:
        term = (1 - p) ** n if (1 - p) ** n > 0 else None
        assert term is None and 0 < got < 1e-3
    else:
        assert got == pytest.approx(want, rel=1e-8)


def planted(spark, n, bad_share=0.2):
    rng = random.Random(6)
    rows, labels = [], []
    for d in range(n):
        bad = rng.random() < bad_share
        words = ["word%d" % rng.randrange(5000) + ("###" if bad else "") for _ in range(40)]
        rows.append((d, " ".join(words), rng.choice(["en", "de", None])))
        labels.append((d, 0 if bad else 1, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_cutoffs_hold_the_risk_and_catch_junk(spark):
    docs, labels = planted(spark, 12000)
    got = quality.report(docs, labels).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in got}
    assert kept[1] >= 1 - quality.RISK and kept[0] < 0.05


def test_few_labels_certify_nothing(spark):
    docs, labels = planted(spark, 300)
    assert quality.report(docs, labels).filter("NOT kept").count() == 0
    kept = quality.keep_good(docs.withColumnRenamed("lang", "lang").withColumn("stratum", F.lit(1)), labels)
    assert kept.columns == ["doc_id", "text", "lang", "stratum"] and kept.count() == 300


def brute_levels(text):
    n, chars, symbols, dup, repeats, failed = brute(text)
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    capitals, marks = len(re.findall("[A-Z]", text)), len(re.findall(r"[!-/:-@\[-`{-~]", text))
    scores = (symbols / max(chars, 1), dup / max(len(lines), 1), repeats / max(n, 1), 1 - len(set(words)) / max(n, 1), capitals / max(chars, 1), marks / max(chars, 1))
    return tuple(min(int(x * quality.LEVELS), quality.LEVELS) for x in scores), failed


def brute_kept(docs, labels, half, risk=0.05, delta=0.05):
    """docs: (id, text, lang); labels: {id: quality}; half: {id: 0 or 1}."""
    seen = {d: (*brute_levels(t), lang) for d, t, lang in docs}
    steps, ends, needs, vectors = range(len(quality.SHARES)), {}, {}, {}
    for lang in {x[2] for x in seen.values()}:
        mine = [(d, seen[d][0], labels[d]) for d in seen if seen[d][2] == lang and d in labels and not seen[d][1]]
        good = [v for d, v, q in mine if q == 1 and half[d] == 1]
        if not good:
            continue
        path = []
        for share in quality.SHARES:
            allowed = int(len(good) * share)
            path.append([min(x for x in {v[r] for v in good} if sum(v[r] > x for v in good) <= allowed) for r in range(6)])
        over = lambda v, t: any(a > b for a, b in zip(v, path[t]))
        bad = [v for d, v, q in mine if q == 0 and half[d] == 1]
        gain = [sum(over(v, t) for v in bad) / max(len(bad), 1) - 20 * sum(over(v, t) for v in good) / len(good) for t in steps]
        if max(gain) <= 0:
            continue
        held = [v for d, v, q in mine if q == 1 and half[d] == 0]
        tails = []
        for t in steps[: gain.index(max(gain)) + 1]:
            n, k = len(held), sum(over(v, t) for v in held)
            tails.append(1.0 if k >= n * risk else sum(comb(n, i) * risk**i * (1 - risk) ** (n - i) for i in range(k + 1)))
        needs[lang], vectors[lang] = [max(tails[: t + 1]) for t in range(len(tails))], path
    # Holm, as it is usually stated: the smallest first, each against its share of what is left.
    done = 0
    for p in sorted(x[-1] for x in needs.values()):
        if p > delta / (len(needs) - done):
            break
        done += 1
    level = delta / max(1, len(needs) - done)
    cuts = {lang: vectors[lang][sum(p <= level for p in x) - 1] for lang, x in needs.items() if x[0] <= level}
    return {d: not failed and not (lang in cuts and any(a > b for a, b in zip(v, cuts[lang]))) for d, (v, failed, lang) in seen.items()}, cuts


def test_verdicts_match_brute_force(spark):
    rng = random.Random(11)
    rows, labels = [], {}
    sizes = {"en": 900, "de": 700, "fr": 400, None: 400, "es": 60, "": 400}
    for lang, n in sizes.items():
        for _ in range(n):
            bad, d = rng.random() < 0.25, len(rows)
            words = ["w%d" % rng.randrange(300 if bad and lang != "de" else 4000) + ("#" if rng.random() < (0.2 if bad and lang == "de" else 0.01) else "") for _ in range(rng.randrange(30, 120))]
            rows.append((d, " ".join(words if not (bad and lang == "fr") else [w.upper() for w in words]), lang))
            labels[d] = int(not bad) if rng.random() < 0.995 else int(bad)
    rows += [(5000, "too short", "en"), (5001, None, "xx"), (5002, "### " * 30, "en"), (5003, "### " * 30, "unlabelled")]
    labels[5000] = 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    given = spark.createDataFrame([(d, q, 0) for d, q in labels.items()], "doc_id long, quality int, toxic int")
    half = {r.doc_id: r.h for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).alias("h")).collect()}
    want, cuts = brute_kept(rows, labels, half)
    assert {"en", "de", "fr", None, ""} <= set(cuts) and "es" not in cuts
    assert {r.doc_id: r.kept for r in quality.report(docs, given).collect()} == want
    assert {r.doc_id for r in quality.keep_good(docs, given).collect()} == {d for d, k in want.items() if k}


def test_every_language_is_certified_by_its_own_labels(spark, monkeypatch):
    docs, labels = planted(spark, 1800)
    many = docs.withColumn("lang", F.when(F.col("doc_id") >= 900, F.concat(F.lit("l"), F.col("doc_id"))).otherwise("en"))
    verdicts = lambda df: {r.doc_id: r.kept for r in quality.report(df, labels).filter("doc_id < 900").collect()}
    alone, beside_others = verdicts(docs.withColumn("lang", F.lit("en")).filter("doc_id < 900")), verdicts(many)
    assert sum(alone.values()) < 900  # junk goes
    monkeypatch.setattr(quality, "BROADCAST", 1)
    assert verdicts(many) == beside_others


def test_empty_table(documents, spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.report(documents([]), labels).count() == 0
