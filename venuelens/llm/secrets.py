"""Secret scans by a trigram inverted index, in DataFrame functions alone.

From each rule's regular expression a Boolean query of trigrams is derived: every match must hold all trigrams of at
least one of the query's alternatives. The index keeps one posting (trigram, document) for each trigram of the
queries that a document holds, ignoring case. Postings of an alternative are intersected by counting them per
document; documents that hold a whole alternative are candidates, and only their texts are searched with the rule's
expression. Rules without such trigrams are run on every text.

Text is read twice: once for the index and the rules that scan fully, once for the candidates. Rows are told apart
by id and a hash of the text.

Defined results: a null text is empty; a null id is an id like others; repeated rows each get the spans of their
text; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import itertools
import re._constants as sre
import re._parser as parser
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import let, stage, text_key
from .spans import labelled, spans, written

#: Alternatives of a query; an expression with more of them is scanned fully.
ALTERNATIVES = 32


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: Length of a match, or of ``group`` of the pattern, that counts.
    least: int = 1
    group: str = ""


# The base rules as given; the hex rule with its length in the pattern, which gives the same spans.
BASE = (
    Rule(
        "assign",
        r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
        12, r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?""",
    ),
    Rule("access", "AKIA[A-Z0-9]+", 18),
    Rule("hex", "[0-9a-f]{16,}", 16),
)
# Further kinds: published forms of keys that carry a mark of their issuer.
ADDED = (
    Rule("private_key", "-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("login_url", r"[a-z]{2,9}://[A-Za-z0-9._-]+:[^\x20\x09-\x0D@/]{6,}@"),
)


def _joined(left: list[list[str]], right: list[list[str]]) -> list[list[str]]:
    """Runs of text of two parts that follow each other; the last run of one goes on with the first of the other."""
    return [[*a[:-1], a[-1] + b[0], *b[1:]] for a, b in itertools.product(left, right)]


def _runs(items) -> list[list[str]]:
    """Alternatives of an expression, each a list of runs that must occur; the text between two runs is unknown."""
    out = [[""]]
    unknown = [["", ""]]
    for op, value in items:
        if op is sre.LITERAL:
            part = [[chr(value).lower()]]
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in value) and len(value) <= 8:
            part = [[c] for c in sorted({chr(v).lower() for _, v in value})]
        elif op is sre.SUBPATTERN:
            part = _runs(value[3])
        elif op is sre.BRANCH:
            part = [run for branch in value[1] for run in _runs(branch)]
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            low, high, body = value
            if (low, high) == (0, 1):
                part = [[""], *_runs(body)]
            elif low:
                once = _runs(body)
                part = once if (low, high) == (1, 1) else _joined(_joined(once, unknown), unknown)
            else:
                part = unknown
        elif op is sre.AT or op in (sre.ASSERT, sre.ASSERT_NOT):
            part = [[""]]
        else:
            part = unknown
        if len(out) * len(part) > ALTERNATIVES:
            part = unknown
        out = _joined(out, part)
    return out


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives, each a set of trigrams of lower-cased text; None if some match may hold no certain trigram."""
    found = {frozenset(run[i : i + 3] for run in runs for i in range(len(run) - 2)) for runs in _runs(parser.parse(pattern))}
    if not all(found):
        return None
    return sorted((q for q in found if not any(other < q for other in found)), key=sorted)


def rule_spans(text: Column, rule: Rule) -> Column:
    found = spans(text, rule.pattern)
    if rule.group:
        return F.filter(found, lambda s: F.length(F.regexp_replace(s["found"], rule.group, "")) >= rule.least)
    return F.filter(found, lambda s: F.length(s["found"]) >= rule.least)


def _short(rows: Column) -> Column:
    return F.transform(rows, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))


def search(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per document: doc_id and an array of spans (start, end) named by kind for each rule."""
    spark = docs.sparkSession
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = [rule for rule in rules if queries[rule.kind] is not None]
    full = [rule for rule in rules if queries[rule.kind] is None]
    clauses = [(rule.kind, i, gram, len(grams)) for rule in indexed for i, grams in enumerate(queries[rule.kind]) for gram in sorted(grams)]
    grams = sorted({c[2] for c in clauses})

    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_key(docs["text"]).alias("text_key"), text.alias("text"))
    listed = F.array(*map(F.lit, grams)) if grams else F.array().cast("array<string>")
    has = let(F.lower("text"), lambda low: F.filter(listed, lambda gram: F.contains(low, gram)))
    scanned = [_short(rule_spans(F.col("text"), rule)).alias(rule.kind) for rule in full]
    scan = stage(rows.select("doc_id", "text_key", has.alias("grams"), *scanned), "secrets-scan")
    if not indexed:
        return scan.drop("text_key", "grams")
    postings = scan.select("doc_id", "text_key", F.explode("grams").alias("gram"))
    index = stage(postings.distinct().sortWithinPartitions("gram", "doc_id", "text_key"), "secrets-index")
    # As many rows as the rules have trigrams, whatever the documents.
    names = ("kind", "alternative", "gram", "need")
    wanted = F.broadcast(spark.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, c)]) for c in clauses]))))
    hits = (
        index.join(wanted, "gram").groupBy("doc_id", "text_key", "kind", "alternative", "need").count().filter("count = need")
        .groupBy("doc_id", "text_key").agg(F.collect_set("kind").alias("kinds"))
        .select(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key"), "kinds")
    )
    same = rows["doc_id"].eqNullSafe(hits["c_id"]) & (rows["text_key"] == hits["c_key"])
    none = F.array().cast("array<struct<start:int,end:int>>")
    verified = rows.join(hits, same).select(
        "c_id", "c_key",
        *[F.when(F.array_contains("kinds", rule.kind), _short(rule_spans(F.col("text"), rule))).otherwise(none).alias(rule.kind) for rule in indexed],
    )
    held = F.greatest(*[F.size(rule.kind) for rule in indexed], F.lit(0)) > 0
    verified = stage(verified.filter(held), "secrets-found").dropDuplicates(["c_id", "c_key"])
    joined = scan.join(verified, scan["doc_id"].eqNullSafe(verified["c_id"]) & (scan["text_key"] == verified["c_key"]), "left")
    return joined.select("doc_id", *[F.coalesce(F.col(rule.kind), none).alias(rule.kind) for rule in rules])


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts of base spans, their digest and all spans."""
    found = search(docs, [*BASE, *ADDED])
    base = labelled([(rule.kind, F.col(rule.kind)) for rule in BASE])
    every = labelled([(rule.kind, F.col(rule.kind)) for rule in (*BASE, *ADDED)])
    counts = [F.size(rule.kind).cast("long").alias(f"n_{rule.kind}") for rule in BASE]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(every).alias("spans"))
