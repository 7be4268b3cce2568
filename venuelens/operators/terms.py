"""Dictionary terms in comments.

Three ways to the same result:

* plain words only, short list: words of the text are looked up in the list;
* short list with phrases: one alternation, longest term first;
* dictionary as a table of any length: the text is cut at its word boundaries,
  places where no term can start are dropped by the hash of their first pieces,
  runs from the others are joined to the dictionary on equality, then overlaps
  are settled per text.

The first two need no join and no shuffle before the count.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.text import WORD, explode_once, is_present, tokenize, whole_words_pattern

# Longest word list and longest phrase list that go into the query.
WORD_LIST_LIMIT = 2000
PHRASE_LIST_LIMIT = 200
# Largest dictionary that is broadcast, in bytes of text plus row overhead.
BROADCAST_BYTES = 16 * 1024 * 1024
ROW_OVERHEAD = 64
# Bytes of the map that tells which hashes of heads occur in a dictionary.
SLOTS = 1 << 17


def dictionary_terms(items: DataFrame, *columns: str) -> DataFrame:
    """Clean dictionary from a seed table: the first filled column, lower case, trimmed, each term once."""
    name = F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in columns])
    return items.select(F.trim(F.lower(name)).alias("term")).filter(is_present(F.col("term"))).distinct()


def nested_term_match_count(
    df: DataFrame, terms: Iterable[str] = fv.INGREDIENTS, reviews: str = "reviews", comment: str = "comment"
) -> DataFrame:
    """A5 over nested reviews with a short dictionary."""
    exploded = explode_once(df, F.col(f"{reviews}.{comment}"), "_comment")
    return term_match_count(exploded, "_comment", terms)


def term_match_count(df: DataFrame, comment: str, terms: Iterable[str] = fv.INGREDIENTS) -> DataFrame:
    """A5: (term, n), all non-overlapping whole-word matches, the longest term first, dictionary as a Python list.

    Terms are taken in lower case. A list too long for the query itself is joined as a table, with the same rows.
    """
    terms = sorted({t.strip().lower() for t in terms if t and t.strip()})
    text = F.col(comment)
    plain_words = all(re.fullmatch(r"\w+", t) for t in terms)
    if len(terms) > (WORD_LIST_LIMIT if plain_words else PHRASE_LIST_LIMIT):
        dictionary = df.sparkSession.createDataFrame([(t,) for t in terms], "term string")
        return term_match_count_joined(df.withColumn("_row", F.monotonically_increasing_id()), "_row", comment, dictionary)
    if plain_words:
        found = F.filter(tokenize(text), lambda t: t.isin(*terms))
    else:
        found = F.regexp_extract_all(F.lower(text), F.lit(whole_words_pattern(terms)), 1)
    return explode_once(df.filter(is_present(text)), found, "term").groupBy("term").agg(F.count("*").alias("n"))


def _pieces(text: Column) -> Column:
    """A text cut at all its word boundaries: words and what lies between them, in turn."""
    return F.regexp_extract_all(text, F.lit(r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_]+)"), 1)


def _hash(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(SLOTS)).cast("int")


def _lengths_at(long: Column | bool, n: Column) -> Column:
    """The bit for terms of n pieces in a byte of the map; the longest share one. No byte is over 127."""
    return F.when(long, F.least(n - 3, F.lit(6))).otherwise(n - 1)


def _slots(terms: DataFrame) -> tuple[bytes, bytes]:
    """For short and for long terms a map from the hash of a head to the lengths of terms with it: few bytes for any dictionary."""
    maps = (bytearray(SLOTS), bytearray(SLOTS))
    is_long, parts = F.size("p") >= 3, [F.get("p", F.lit(k)) for k in range(3)]
    slot = F.when(is_long, _hash(*parts)).otherwise(_hash(parts[0]))
    for long_term, at, bit in terms.select(is_long, slot, _lengths_at(is_long, F.size("p"))).distinct().collect():
        maps[long_term][at] |= 1 << bit
    return bytes(maps[0]), bytes(maps[1])


def term_match_count_joined(
    df: DataFrame, key: str, comment: str, dictionary: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """A5 with the dictionary as a table (column ``term``) of any length; ``key`` is unique per row.

    A place of a text goes on only if the hash of its first piece, or of its first three, is that of some term: a test
    inside the row, which also tells how long such terms are. Only runs of these lengths meet the dictionary. So the plan
    is the same for any dictionary.

    The dictionary is measured first and broadcast only up to ``broadcast_bytes`` of text; a
    larger one is joined by a shuffle, where adaptive execution splits
    frequent words. Terms of one piece cannot overlap, so a dictionary of plain
    words needs no grouping per text.
    """
    terms = dictionary.select(F.trim(F.lower("term")).alias("term")).filter(is_present(F.col("term"))).distinct()
    shaped = terms.select("term", _pieces(F.col("term")).alias("p"))
    shape = shaped.agg(
        F.sum(F.octet_length("term") + ROW_OVERHEAD).alias("bytes"), F.max(F.size("p")).alias("longest"),
        F.bool_and(F.col("term").rlike(f"^{WORD}")).alias("words"),
    ).first()
    if shape["longest"] is None or shape["longest"] == 1 and shape["words"]:
        # Plain words: counted first, so that what meets the dictionary is one row per different word.
        words = explode_once(df.filter(is_present(F.col(comment))), tokenize(F.col(comment)), "term")
        return words.groupBy("term").agg(F.count("*").alias("n")).join(terms, "term")
    terms = F.broadcast(terms) if shape["bytes"] <= broadcast_bytes else terms.hint("merge")
    maps = [F.lit(m) for m in _slots(shaped)]
    lengths = lambda held, *parts: F.ascii(F.substring(held, _hash(*parts) + 1, F.lit(1)).cast("string"))
    pieces, longest = F.col("_p"), shape["longest"]
    step = 2 if shape["words"] else 1  # pieces are words and what lies between them, in turn

    def masks(i: Column) -> Column:
        first, three = F.get(pieces, i), [F.get(pieces, i + k) for k in range(3)]
        return F.struct(i.alias("start"), lengths(maps[0], first).alias("short"), (lengths(maps[1], *three) if longest > 2 else F.lit(0)).alias("long"))

    def runs(m: Column) -> Column:
        held = lambda n: F.when(n < 3, m["short"]).otherwise(m["long"])
        some = F.filter(
            F.sequence(F.lit(1), F.least(F.lit(longest), F.size(pieces) - m["start"])),
            lambda n: F.getbit(held(n), _lengths_at(n >= 3, n)) == 1,
        )
        return F.transform(some, lambda n: F.struct(m["start"].alias("start"), n.alias("pieces"), F.array_join(F.slice(pieces, m["start"] + 1, n), "").alias("term")))

    # Other characters at the very start and end have no word boundary on their outer side.
    inner = F.regexp_replace(F.lower(F.col(comment)), r"^[^\p{L}\p{N}_]+|[^\p{L}\p{N}_]+$", "")
    texts = df.filter(is_present(F.col(comment))).select(F.col(key).alias("_key"), _pieces(inner).alias("_p"))
    starts = F.transform(F.sequence(F.lit(0), F.size("_p") - 1, F.lit(step)), masks)
    found = F.flatten(F.transform(F.filter(starts, lambda m: (m["short"] > 0) | (m["long"] > 0)), runs))
    hits = explode_once(texts, F.when(F.size("_p") > 0, found), "m", "_key").select("_key", "m.*").join(terms, "term")
    if longest == 1:
        return hits.groupBy("term").agg(F.count("*").alias("n"))

    # Leftmost first, longest first, no overlap. Hits that touch no other hit count
    # as they are; only a cluster of overlapping ones has to be walked through.
    order = Window.partitionBy("_key").orderBy("start", F.desc("pieces"))
    reach = F.max(F.col("start") + F.col("pieces")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    clustered = hits.withColumn("_new", F.when(F.col("start") < reach, 0).otherwise(1)).withColumn(
        "_cluster", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    members = clustered.groupBy("_key", "_cluster").agg(
        F.array_sort(F.collect_list(F.struct("start", (-F.col("pieces")).alias("shorter"), "term"))).alias("m")
    )
    kept = F.when(F.size("m") == 1, F.array(F.get("m", 0)["term"])).otherwise(_walk(F.col("m")))
    return explode_once(members, kept, "term").groupBy("term").agg(F.count("*").alias("n"))


def _walk(hits: Column) -> Column:
    """Terms of the hits that are kept when each takes its place unless an earlier one has it."""

    def step(state: Column, hit: Column) -> Column:
        taken = F.struct(
            (hit["start"] - hit["shorter"]).alias("end"), F.concat(state["terms"], F.array(hit["term"])).alias("terms")
        )
        return F.when(hit["start"] >= state["end"], taken).otherwise(state)

    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("terms"))
    return F.aggregate(hits, start, step, lambda state: state["terms"])
