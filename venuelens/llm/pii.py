"""Personal data by base patterns and gradient-boosted candidates, in DataFrame functions alone.

Base spans are those of four patterns with their checks. Beside them high-recall generators propose overlapping
candidates, also of looser writing: no plus sign, ``(at)``, spaces in an address. Candidates are seen in two views.
The rules' view gives labels: a candidate that overlaps a base span is personal; one of a format that never is (dates,
amounts, numbers named as such, pieces of longer tokens) or that is written as the rules want it and still refused
is not; all others have no label. The other view is context
and weak format, without what the rules look at (plus sign, at sign, check digit, ranges, number of digits, spaces).
Boosted trees on this second view learn what personal data looks like apart from the rules, so they also find what
the rules miss.

The trees learn from the labelled candidates of one half of the documents, equal ones as one row with their number as
its weight. On the other half a threshold per generator is certified by a fixed sequence of bins of
the score, from the highest down: the exact binomial tail must show that at least ``PRECISION`` of the labelled
candidates over it are personal, at confidence ``1 - DELTA`` over all generators. Candidates over it that overlap no
base span are added. The trees become column expressions, so scoring needs neither a shuffle nor a second look at the text.

Defined results: a null text is empty; repeated rows are each searched; without both kinds of candidates nothing is
learned and only base spans are given; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quality import binomial_tail
from .shared import let, stage
from .spans import digits, labelled, running, spans, written

PRECISION = 0.95
DELTA = 0.05
BINS = 50
#: Stretches of a text that are cut out one by one when masking.
FEW = 64
TREES = 8
DEPTH = 3

# The base patterns. Possessive forms and look-behinds match the same spans without long backtracking.
LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"
KINDS = ("email", "ip", "card", "phone")

AT = r"(?:@|\x20?[(\[]\x20?(?:at|AT)\x20?[)\]]\x20?)"
GENERATORS = {
    "email_like": rf"(?<![^\s@(\[<])[^\s@()\[\]<]++{AT}[^\s@]++",
    "ip_like": r"(?<![0-9.])[0-9]++(?:\x20?\.\x20?[0-9]++){3,}+",
    "number_like": r"(?<![0-9])\+?\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+",
}
CUE = r"(?i)(?:mail|contact|phone|tel|fon|call|mobil|card|visa|account|konto|iban|addr|host|ip)[^0-9A-Za-z]*$"
#: What is never personal: dates, amounts, and numbers that are named as something else.
DATE = r"^(?:[12][0-9]{3}[-./\x20][0-9]{1,2}[-./\x20][0-9]{1,2}|[0-9]{1,2}[-./\x20][0-9]{1,2}[-./\x20][12][0-9]{3})(?![0-9])"
AMOUNT = r"[$\u00a3\u00a5\u20ac]\x20?$"
NAMED = r"(?i)(?:\bid|\bno|\bnr|\bref|order|isbn|issn|doi|version|\bv|#)[\x20.:=#]*$"
#: A list's numbers.
COUNTED = r"^[0-9]{1,2}(?:\.\x20[0-9]{1,2})++$"
#: Written as a rule wants it: an at sign, an address without spaces, a plus, bare digits, a card's groups.
STRICT = r"@|^[0-9]++(?:\.[0-9]++)++$|^\+|^[0-9]++$|^[0-9](?:[\x20-]?[0-9]){13,18}+$"
AROUND = 24


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of each kind that pass its check."""
    count = lambda s: F.length(digits(s["found"]))
    return {
        "email": spans(text, EMAIL),
        "ip": F.filter(spans(text, IP), lambda s: s["found"].rlike(OCTETS)),
        "card": F.filter(spans(text, CARD), lambda s: (count(s) <= 19) & F.call_function("luhn_check", digits(s["found"]))),
        "phone": F.filter(spans(text, PHONE), lambda s: count(s).between(10, 15)),
    }


FEATURES = ("generator", "dots", "groups", "longest", "paren", "hyphens", "letters", "dotted_end", "cue", "glued_left", "glued_right")


def features(s: Column, generator: int) -> Column:
    """Context and weak format of a candidate, as an array of doubles in the order of ``FEATURES``.

    Longer runs of digits count as 5, and nothing here tells what the rules check.
    """
    found = s["found"]
    bare = F.regexp_replace(found, AT, "@")
    groups = F.filter(F.split(F.regexp_replace(found, r"^\+[0-9]{1,3}(?=[\x20(.-])", ""), "[^0-9]+"), lambda g: g != "")
    ends = F.regexp_replace(bare, r"[^\p{L}\p{N}]+$", "")
    values = [
        F.lit(generator), F.length(F.regexp_replace(ends, "[^.]+", "")), F.least(F.size(groups), F.lit(6)),
        F.least(F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)), F.lit(5)), found.contains("(").cast("int"),
        F.least(F.length(F.regexp_replace(found, "[^-]+", "")), F.lit(4)), F.least(F.length(F.regexp_replace(bare, r"[^\p{L}]+", "")), F.lit(5)),
        ends.rlike(r"\.[A-Za-z]{2,}$").cast("int"), s["left"].rlike(CUE).cast("int"), s["left"].rlike(r"[\p{L}\p{N}_]$").cast("int"),
        s["right"].rlike(r"^[\p{L}\p{N}_]").cast("int"),
    ]
    return F.array(*[v.cast("double") for v in values])


def never_personal(s: Column) -> Column:
    """What gets the label 0 if no rule takes it: formats that are never personal, and strict writing that fails the rules."""
    glued = s["left"].rlike(r"[\p{L}\p{N}_]$") | s["right"].rlike(r"^[\p{L}\p{N}_]")
    return glued | s["found"].rlike(DATE) | s["found"].rlike(STRICT) | s["found"].rlike(COUNTED) | s["left"].rlike(AMOUNT) | s["left"].rlike(NAMED)


def proposals(text: Column) -> Column:
    """A struct of the base spans by kind and of all candidates with their features."""
    text = F.coalesce(text, F.lit(""))

    def of(name: str, number: int) -> Column:
        def row(s: Column) -> Column:
            return F.struct(
                s["start"].alias("start"), s["end"].alias("end"), F.lit(number).alias("generator"), features(s, number).alias("f"), never_personal(s).alias("never")
            )

        return F.transform(spans(text, GENERATORS[name], AROUND), row)

    short = lambda found: F.transform(found, lambda s: F.struct(s["start"], s["end"]))
    return F.struct(
        F.struct(*[short(found).alias(kind) for kind, found in base_spans(text).items()]).alias("base"),
        F.concat(*[of(name, i) for i, name in enumerate(GENERATORS)]).alias("candidates"),
    )


def overlaps(base: Column, candidate: Column) -> Column:
    any_of = [F.exists(base[kind], lambda s: (s["start"] < candidate["end"]) & (s["end"] > candidate["start"])) for kind in KINDS]
    return any_of[0] | any_of[1] | any_of[2] | any_of[3]


def tree_expression(lines: list[str], feature) -> Column:
    """A decision tree, printed by the library one node per line, as nested conditions."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return F.lit(float(line.split(":")[1]))
    number, bound = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    below = tree_expression(lines, feature)
    lines.pop(0)  # the matching Else
    return F.when(feature(int(number)) <= float(bound), below).otherwise(tree_expression(lines, feature))


def boosted(model, f: Column) -> Column:
    """The probability of the model as a column expression over the array of features."""
    trees, margin = re.split(r"\n  Tree \d+ \(weight (\S+)\):\n", model.toDebugString), F.lit(0.0)
    for weight, body in zip(trees[1::2], trees[2::2]):
        margin = margin + float(weight) * tree_expression(body.strip("\n").split("\n"), lambda i: f[i])
    return 1 / (1 + F.exp(-2 * margin))


def labelled_candidates(rows: DataFrame) -> DataFrame:
    """(half, generator, f, label) of the candidates that the rules' view has a label for."""
    each = rows.select("half", F.explode("p.candidates").alias("c"), "p.base")
    label = F.when(overlaps(F.col("base"), F.col("c")), 1.0).when(F.col("c.never"), 0.0)
    return each.select("half", F.col("c.generator").alias("generator"), F.col("c.f").alias("f"), label.alias("label")).where("label IS NOT NULL")


def learn(rows: DataFrame):
    """(score of a candidate's features, {generator: threshold}) from rows (p), or None if there is nothing to learn."""
    counted = labelled_candidates(rows).groupBy("half", "generator", "f", "label").agg(F.count("*").cast("double").alias("weight"))
    # Few features of few values: one row for each distinct candidate, however large the corpus.
    known = stage(counted.orderBy("half", "generator", "f", "label"), "pii-known")
    half = known.filter("half = 1")
    if half.select("label").distinct().count() < 2:
        return None
    wide = half.select("label", "weight", *[F.col("f")[i].alias(name) for i, name in enumerate(FEATURES)])
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(wide)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, weightCol="weight").fit(vectors)
    score = lambda f: boosted(model, f)
    bins = F.least(F.floor(score(F.col("f")) * BINS), F.lit(BINS - 1))
    binned = known.filter("half = 0").groupBy("generator", bins.alias("bin")).agg(
        F.sum(F.col("weight") * (1 - F.col("label"))).alias("wrong"), F.sum("weight").alias("n")
    )
    down = Window.partitionBy("generator").orderBy(F.desc("bin"))
    above = binned.select("generator", "bin", F.sum("wrong").over(down).alias("wrong"), F.sum("n").over(down).alias("n"))
    # A fixed sequence: from the first bin that could pass at all, which its size alone tells, down to the first that fails.
    level = DELTA / len(GENERATORS)
    tested = above.filter(F.col("n") >= math.ceil(math.log(level) / math.log(PRECISION)))
    proved = (binomial_tail(F.col("wrong"), F.col("n"), 1 - PRECISION) <= level).cast("int")
    passed = tested.withColumn("passed", F.min(proved).over(down)).filter("passed = 1").groupBy("generator").agg(F.min("bin").alias("bin"))
    return score, {r["generator"]: r["bin"] / BINS for r in passed.collect()}  # one row per generator at most


def chosen(p: Column, learned) -> Column:
    """All spans of a row: base ones, then added ones."""
    base = [(kind, p["base"][kind]) for kind in KINDS]
    if not learned or not learned[1]:
        return labelled(base)
    score, thresholds = learned

    def adds(c: Column) -> Column:
        over = F.lit(False)
        for generator, bound in thresholds.items():
            over = over | ((c["generator"] == generator) & (score(c["f"]) >= bound))
        return over & ~c["never"] & ~overlaps(p["base"], c)

    added = F.filter(p["candidates"], adds)
    return let(added, lambda rows: labelled(base + [(name, _of_generator(rows, i)) for i, name in enumerate(GENERATORS)]))


def _of_generator(rows: Column, number: int) -> Column:
    return F.filter(rows, lambda c: c["generator"] == number)


def _half(docs: DataFrame) -> Column:
    return F.pmod(F.xxhash64(docs["doc_id"].cast("long"), F.coalesce(docs["text"], F.lit(""))), F.lit(2))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts of base spans, their digest and all spans."""
    rows = stage(docs.select(docs["doc_id"].cast("long").alias("doc_id"), _half(docs).alias("half"), proposals(docs["text"]).alias("p")), "pii")
    learned, p = learn(rows), F.col("p")
    base = labelled([(kind, p["base"][kind]) for kind in KINDS])
    counts = [F.size(p["base"][kind]).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return rows.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(chosen(p, learned)).alias("spans"))


def masked(text: Column, rows: Column) -> Column:
    """The text with each stretch of overlapping spans replaced by the first span's kind in brackets."""

    def stretches(rows: Column) -> Column:
        """They start where a span begins behind all spans before it."""
        reach = running(F.transform(rows, lambda s: s["end"]), 0, lambda a, b: F.greatest(a, b))
        marked = F.zip_with(rows, reach, lambda s, r: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), r.alias("before")))
        last = F.array_max(F.transform(rows, lambda s: s["end"]))
        firsts = F.filter(marked, lambda s: s["start"] >= s["before"])
        return F.struct(firsts.alias("firsts"), last.alias("last"))

    def rebuilt(found: Column) -> Column:
        firsts = found["firsts"]

        def pieces(stretch: Column, i: Column) -> Column:
            """The text before a stretch, then its kind."""
            after = F.when(i == 0, 0).otherwise(stretch["before"])
            return F.struct(after.alias("at"), (stretch["start"] - after).alias("size"), F.concat(F.lit("["), F.upper(stretch["kind"]), F.lit("]")).alias("said"))

        def few(parts: Column) -> Column:
            body = F.array_join(F.transform(parts, lambda p: F.concat(F.substring(text, p["at"] + 1, p["size"]), p["said"])), "")
            return F.concat(body, F.substring(text, found["last"] + 1, F.length(text)))

        def many(parts: Column) -> Column:
            # Characters of equal width are found without counting from the start of the text again for each part.
            def of(wide: Column) -> Column:
                bit = lambda p: F.concat(F.hex(F.substring(wide, p["at"] * 4 + 1, p["size"] * 4)), F.hex(F.encode(p["said"], "UTF-32")))
                tail = F.hex(F.substring(wide, found["last"] * 4 + 1, F.octet_length(wide)))
                return F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.array_join(F.transform(parts, bit), ""), tail)), "UTF-32")

            return let(F.encode(text, "UTF-32"), of)

        return let(F.transform(firsts, pieces), lambda parts: F.when(F.size(parts) <= FEW, few(parts)).otherwise(many(parts)))

    return F.when(F.size(rows) == 0, text).otherwise(let(let(rows, stretches), rebuilt))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked in ``text`` and ``n_chars``, if there, brought up to date."""
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), _half(docs).alias("half"), proposals(docs["text"]).alias("p"))
    rows = stage(packed, "pii")
    learned = learn(rows.select("half", "p"))
    text = rows.select("doc", masked(F.col("doc.text"), chosen(F.col("p"), learned)).alias("masked"))
    changed = {"text": F.col("masked")}
    if "n_chars" in docs.columns:
        same = F.col("masked").eqNullSafe(F.col("doc.text"))
        changed["n_chars"] = F.when(same, F.col("doc.n_chars")).otherwise(F.length("masked")).cast(docs.schema["n_chars"].dataType)
    return text.select(*[changed.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])
