"""Text helpers: ids, defaults, lists, tokens, keyword tests."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv

# A word character in any script. Java's \w and \b are ASCII by default.
WORD = r"[\p{L}\p{N}_]"
WORD_START = rf"(?<!{WORD})"
WORD_END = rf"(?!{WORD})"
# Whitespace of any script, as stripped from both ends of free text.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column) -> Column:
    """Text without outer whitespace, line breaks included."""
    return F.btrim(value, F.lit(WHITESPACE))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def is_present(value: Column) -> Column:
    """not NULL and not empty."""
    return value.isNotNull() & (value != "")


def not_placeholder(value: Column, placeholders: Sequence[str]) -> Column:
    """not NULL and not one of the given texts (exact, case counts)."""
    return value.isNotNull() & ~value.isin(*placeholders)


def default_if_blank(value: Column, default: str) -> Column:
    """The value, or ``default`` when it is NULL or empty."""
    return F.when(is_present(value), value).otherwise(F.lit(default))


def first_present(*values: Column) -> Column:
    """The first value that is neither NULL nor empty, else ''."""
    return F.coalesce(*[F.when(v != "", v) for v in values], F.lit(""))


def make_short_id(value: Column) -> Column:
    """``rest_d123`` out of an address holding ``-d123-``; other text stays; NULL gives ''."""
    found = F.regexp_extract(value, fv.SHORT_ID_PATTERN, 1)
    return (
        F.when(value.isNull(), F.lit(""))
        .when(found != "", F.concat(F.lit(fv.RESTAURANT_ID_PREFIX), found))
        .otherwise(value)
    )


def split_address(address: Column) -> tuple[Column, Column]:
    """(district, city) = (second last, last) comma part; NULL where there is none."""
    parts = F.split(F.when(address != "", address), ",", -1)
    return strip(F.try_element_at(parts, F.lit(-2))), strip(F.try_element_at(parts, F.lit(-1)))


def trimmed_list(items: Column) -> Column:
    """Array of trimmed texts without NULL and empty ones; a NULL array gives an empty one."""
    trimmed = F.transform(items, strip)
    return F.coalesce(F.filter(trimmed, lambda x: F.length(x) > 0), F.array().cast("array<string>"))


def array_to_csv(items: Column) -> Column:
    """Non-empty elements joined by ', '; a NULL array gives ''."""
    return F.coalesce(F.array_join(F.filter(items, lambda x: F.length(x) > 0), ", "), F.lit(""))


def csv_to_array(value: Column) -> Column:
    """Inverse of ``array_to_csv`` for elements without ', '."""
    return F.when(value == "", F.array().cast("array<string>")).otherwise(F.split(value, ", ", -1))


def tokenize(value: Column) -> Column:
    """Lower-case words of any script."""
    return F.regexp_extract_all(F.lower(value), F.lit(f"({WORD}+)"), 1)


def whole_words_pattern(words: Iterable[str]) -> str:
    """One alternation that finds the words as whole words, longest first.

    An edge of a word is held by a look-around on the side where the word has a
    word character; a word that starts or ends with another character needs a
    word character next to it there, as a word boundary does.
    """
    is_word = re.compile(r"\w").match
    def bounded(word: str) -> str:
        start = WORD_START if is_word(word[0]) else rf"(?<={WORD})"
        end = WORD_END if is_word(word[-1]) else rf"(?={WORD})"
        return f"{start}{java_quote(word)}{end}"

    ordered = sorted({w for w in words if w}, key=lambda w: (-len(w), w))
    if not ordered:
        raise ValueError("the word list is empty")
    if all(is_word(w[0]) and is_word(w[-1]) for w in ordered):
        return f"{WORD_START}({'|'.join(java_quote(w) for w in ordered)}){WORD_END}"
    return f"({'|'.join(bounded(w) for w in ordered)})"


def java_quote(word: str) -> str:
    """Escape regex characters so that the word is taken literally."""
    return re.sub(r"([\\^$.|?*+()\[\]{}\-&~#])", r"\\\1", word)


def contains_any(value: Column, words: Sequence[str], whole_word: bool = False) -> Column:
    """F8: does the lower-cased text hold any of the words, as substrings unless ``whole_word``."""
    text = F.lower(value)
    if whole_word:
        return text.rlike(whole_words_pattern(words))
    return any_of(text.contains(w) for w in words)


def like_any(value: Column, patterns: Sequence[str]) -> Column:
    """does the lower-cased text match any LIKE pattern."""
    text = F.lower(value)
    return any_of(text.like(p) for p in patterns)


def explode_once(df: DataFrame, items: Column, name: str, *keep: str) -> DataFrame:
    """One row per element that is not NULL, with the ``keep`` columns.

    A plain explode makes the optimizer add a size test on ``items``, which works
    a computed array out twice; the outer form does not.
    """
    return df.select(*keep, F.explode_outer(items).alias(name)).filter(F.col(name).isNotNull())
