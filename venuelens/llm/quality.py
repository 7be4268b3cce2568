"""Quality rules with risk-controlled cutoffs, in DataFrame functions alone.

Each document gets counts and six scores (greater is worse), cut into ``LEVELS`` steps. A rule rejects documents whose
level is over its cutoff. Each stratum (language) has its own vector of six cutoffs, chosen by labelled documents that
pass the base rule, split by a hash of the id: one half proposes, the other certifies.

The proposing half lays out an ordered path of vectors: at step t each cutoff is the smallest level that at most the
share ``SHARES[t]`` of its good documents are over, so the vectors get stricter together. It also says how far to go:
to the step that rejects most bad and least good documents. The certifying half walks the path from the loosest step
on. A step passes if the exact binomial tail shows that the whole vector rejects at most ``risk`` of the good
documents, and the first that fails ends the walk; such a fixed sequence needs no correction for its steps. Over the
strata the level is corrected by Holm's method: a stratum that reaches the end of its path hands its share of
``delta`` on to the others. So with probability ``1 - delta`` no stratum loses more than ``risk`` of its good documents
to all rules together. About 90 good documents in the certifying half of each of four languages can certify a vector.
A stratum without a certified vector never rejects. Every language is a stratum, whatever their number.

Defined results: a null text has no words and fails the base rule; a null language is a stratum of its own; repeated
rows are scored each for itself; repeated labels of an id count as bad if one of them is; an empty table gives an
empty result; without labels only the base rule rejects; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import let, stage

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8
RISK = 0.05
DELTA = 0.05
#: Good documents rejected weigh so much more than bad ones when the end of a path is proposed.
GOOD_WEIGHT = 20
RULES = ("symbols", "lines", "repeats", "monotony", "capitals", "marks")
#: Scores from 0 to 1 are told apart in so many steps; all beyond 1 is the last one.
LEVELS = 200
#: Shares of good documents that a rule alone may be over, step by step along a path.
SHARES = (0.0, 0.0005, 0.001, 0.002, 0.004, 0.007, 0.01, 0.015, 0.02)
#: Strata whose cutoffs are sent to all tasks; more of them are joined by shuffled, salted rows.
BROADCAST = 10_000
SALT = 64


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words inside windows of ``width`` words that occur twice or more, the first occurrence included."""
    size = F.size(words)

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def of_sorted(rows: Column) -> Column:
            same = lambda e, i: (F.get(rows, i - 1)["h"] == e["h"]) | (F.get(rows, i + 1)["h"] == e["h"])
            starts = F.array_sort(F.transform(F.filter(rows, lambda e, i: F.coalesce(same(e, i), F.lit(False))), lambda e: e["i"]))
            begin = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("total"))
            step = lambda held, i: F.struct(i.alias("last"), (held["total"] + F.least(F.lit(width), i - held["last"])).alias("total"))
            return F.aggregate(starts, begin, step, lambda held: held["total"])

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(placed, of_sorted))

    windows = F.transform(F.sequence(F.lit(1), size - width + 1), lambda i: F.xxhash64(F.slice(words, i, width)))
    return F.when(size <= width, 0).otherwise(let(windows, covered))


def _left(text: Column, dropped: str) -> Column:
    """Characters that stay when those of a class are dropped."""
    return F.length(F.regexp_replace(text, dropped, "")).cast("long")


def measures(text: Column) -> Column:
    """A struct of the counts of one text."""
    text = F.coalesce(text, F.lit(""))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            repeated_words(words).cast("long").alias("n_repeat_words"),
            F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
        )

    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    of_lines = let(lines, lambda rows: F.struct(
        F.size(rows).cast("long").alias("n_lines"), (F.size(rows) - F.size(F.array_distinct(rows))).cast("long").alias("n_dup_lines")
    ))
    return F.struct(
        let(F.array_remove(F.split(text, SPACE, -1), ""), of_words).alias("words"),
        of_lines.alias("lines"),
        _left(text, "[^#*$%&|<>]+").alias("n_symbols"),
        _left(text, "[^A-Z]+").alias("n_capitals"),
        _left(text, r"[^!-/:-@\[-`{-~]+").alias("n_marks"),
    )


def scores(m: Column) -> dict[str, Column]:
    words, chars = F.greatest(m["words"]["n_words"], F.lit(1)), F.greatest(m["words"]["word_chars"], F.lit(1))
    return {
        "symbols": m["n_symbols"] / chars,
        "lines": m["lines"]["n_dup_lines"] / F.greatest(m["lines"]["n_lines"], F.lit(1)),
        "repeats": m["words"]["n_repeat_words"] / words,
        "monotony": 1 - m["words"]["n_distinct"] / words,
        "capitals": m["n_capitals"] / chars,
        "marks": m["n_marks"] / chars,
    }


def base_failed(m: Column) -> Column:
    words = m["words"]["n_words"]
    return (words < 20) | (100 * m["words"]["n_repeat_words"] > 30 * words)


def log_gamma(x: Column) -> Column:
    """The logarithm of the gamma function for x >= 1, to about 1e-12."""
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    steps = sum((F.log(x + i) for i in range(1, 8)), F.log(x))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - steps


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p), for k below the mean; 1 from there on, where no bound could hold.

    The terms fall from k downwards; those summed reach far beyond double precision.
    """
    k, n = k.cast("double"), n.cast("double")
    reach = F.least(k, F.ceil(12 * F.sqrt(n * p)) + 50).cast("long")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total"))

    def down(held: Column, j: Column) -> Column:
        ratio = (k - j) * (1 - p) / ((n - k + j + 1) * p)
        return F.struct((held["term"] * ratio).alias("term"), (held["total"] + held["term"]).alias("total"))

    total = F.aggregate(F.sequence(F.lit(0).cast("long"), reach), start, down, lambda held: held["total"])
    first = log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    return F.when(k >= n * p, 1.0).otherwise(F.exp(first + F.log(total)))


def levels(m: Column) -> Column:
    """The levels of the six scores, in the order of ``RULES``."""
    found = scores(m)
    return F.array(*[F.least(F.floor(found[rule] * LEVELS), F.lit(LEVELS)).cast("int") for rule in RULES])


def stratum(lang: Column) -> Column:
    """The language; '' for a null one."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit(""))


def paths(known: DataFrame) -> DataFrame:
    """(stratum, path) from labelled rows: for each rule its cutoff at every step, from good documents of the proposing half."""
    good = known.filter("half = 1 AND quality = 1").select("stratum", F.posexplode("levels").alias("rule", "level"))
    counted = good.groupBy("stratum", "rule", "level").agg(F.count("*").alias("n"))
    # At most LEVELS rows a window, whatever the number of documents.
    over = F.coalesce(F.sum("n").over(Window.partitionBy("stratum", "rule").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(Window.partitionBy("stratum", "rule"))
    placed = counted.withColumn("over", over).withColumn("total", total)
    steps = F.array(*[F.min(F.when(F.col("over") <= F.floor(F.col("total") * share), F.col("level"))) for share in SHARES])
    rules = placed.groupBy("stratum", "rule").agg(steps.alias("steps"))
    return rules.groupBy("stratum").agg(F.array_sort(F.collect_list(F.struct("rule", "steps"))).alias("path"))


def first_step(found: Column, path: Column) -> Column:
    """The first step at which a document is rejected, or the number of steps."""
    rejects = lambda t: F.exists(F.zip_with(path, found, lambda r, level: level > F.get(r["steps"], t)), lambda x: x)
    steps = F.sequence(F.lit(0), F.lit(len(SHARES) - 1))
    return F.coalesce(F.get(F.filter(steps, rejects), F.lit(0)), F.lit(len(SHARES)))


def certified(counted: DataFrame, risk: float, delta: float) -> DataFrame:
    """(stratum, step): the strictest step that is certified, from (stratum, half, quality, first, n)."""
    good, held = F.col("quality") == 1, F.col("half") == 0
    total = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    by_step = lambda test: F.array(*[total(test & (F.col("first") <= t)) for t in range(len(SHARES))])
    rows = counted.groupBy("stratum").agg(
        total(held & good).alias("n"), by_step(held & good).alias("k"), total(~held & good).alias("n_good"), by_step(~held & good).alias("good"),
        total(~held & ~good).alias("n_bad"), by_step(~held & ~good).alias("bad"),
    )
    gain = F.zip_with("bad", "good", lambda b, g: b / F.greatest(F.col("n_bad"), F.lit(1)) - GOOD_WEIGHT * g / F.greatest(F.col("n_good"), F.lit(1)))
    most = F.array_max("gain")
    rows = rows.withColumn("gain", gain).filter(most > 0).withColumn("end", (F.array_position("gain", most) - 1).cast("int"))
    tails = F.transform("k", lambda k: binomial_tail(k, F.col("n"), risk))
    # The level that each step needs: the worst of all steps up to it.
    needs = F.transform(F.sequence(F.lit(0), F.col("end")), lambda t: F.array_max(F.slice("tails", 1, t + 1)))
    rows = stage(rows.withColumn("tails", tails).select("stratum", needs.alias("needs")), "quality-tails")
    n, done = rows.count(), 0
    # Holm's step-down: strata that reach the end of their path free their share for the others, until none follows.
    while n > done:
        more = rows.filter(F.element_at("needs", -1) <= delta / (n - done)).count()
        if more == done:
            break
        done = more
    level = delta / max(1, n - done)
    return rows.select("stratum", (F.size(F.filter("needs", lambda p: p <= level)) - 1).alias("step")).filter("step >= 0")


def cutoffs(rows: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, cuts): the certified cutoffs in the order of ``RULES``, from rows (doc_id, lang, m) and labels."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sound = rows.filter(~base_failed(F.col("m"))).select("doc_id", stratum(F.col("lang")).alias("stratum"), levels(F.col("m")).alias("levels"))
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).alias("half")
    known = stage(sound.join(known, "doc_id").select("stratum", "levels", "quality", half), "quality-labelled")
    ways = stage(paths(known), "quality-paths")
    placed = beside(known, ways).filter("path IS NOT NULL").select("stratum", "half", "quality", first_step(F.col("levels"), F.col("path")).alias("first"))
    counted = placed.groupBy("stratum", "half", "quality", "first").agg(F.count("*").alias("n"))
    steps = certified(counted, risk, delta)
    return stage(
        ways.join(steps, "stratum").select("stratum", F.transform("path", lambda r: F.get(r["steps"], F.col("step"))).alias("cuts")), "quality-cutoffs"
    )


def beside(rows: DataFrame, strata: DataFrame) -> DataFrame:
    """Rows with the columns of their stratum. A hot language does not meet in one task: few strata go to all tasks, and
    many are repeated ``SALT`` times and met by salted rows."""
    if strata.count() <= BROADCAST:
        return rows.join(F.broadcast(strata), "stratum", "left")
    salted = strata.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return rows.withColumn("__salt", (F.rand(7) * SALT).cast("int")).join(salted, ["stratum", "__salt"], "left").drop("__salt")


def judge(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """Adds ``kept`` to rows (stratum, levels, base_failed, ...)."""
    beyond = F.exists(F.zip_with("levels", "cuts", lambda level, cut: level > cut), lambda x: x)
    return beside(rows, chosen).withColumn("kept", ~(F.col("base_failed") | F.coalesce(beyond, F.lit(False)))).drop("cuts", "stratum", "levels")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document with its counts, ``base_failed`` and ``kept``."""
    rows = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", measures(F.col("text")).alias("m")), "quality")
    m = F.col("m")
    wide = rows.select(
        "doc_id", m["words"]["n_words"].alias("n_words"), m["words"]["word_chars"].alias("word_chars"), m["n_symbols"].alias("n_symbols"),
        m["lines"]["n_dup_lines"].alias("n_dup_lines"), m["words"]["n_repeat_words"].alias("n_repeat_words"),
        base_failed(m).alias("base_failed"), stratum(F.col("lang")).alias("stratum"), levels(m).alias("levels"),
    )
    return judge(wide, cutoffs(rows, labels))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns. Verdicts are written beside the documents, so no text is shuffled."""
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), measures(docs["text"]).alias("m"))
    rows = stage(packed.select("doc", "m"), "quality")
    seen = rows.select(F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.lang").alias("lang"), "m")
    chosen = cutoffs(seen, labels)
    judged = rows.select("doc", base_failed(F.col("m")).alias("base_failed"), stratum(F.col("doc.lang")).alias("stratum"), levels(F.col("m")).alias("levels"))
    return judge(judged, chosen).filter("kept").select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
