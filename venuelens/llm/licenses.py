"""License scans: exact phrases, and short notices with a bounded number of edits.

Texts are sequences of words (runs of ASCII letters and digits, A-Z lower-cased, and of bytes beyond ASCII). Base
phrases are counted where their words stand consecutively. Notices may differ by edits: a notice cut into one piece
more than the edits allowed keeps one piece unchanged (pigeonhole), so exact hits of the pieces, all searched in one
pass by an Aho-Corasick automaton, give the only places where it can be. There the regex library's bounded-error
matching verifies it and reports the span and its edits; the parts of a stretch before and behind a match are searched too.

Defined results: a null or empty text has no words and score 0; repeated rows are each scanned; an empty table gives
an empty result; other columns are not looked at.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import text_bytes

# Base phrases with their labels, and short notices of well-known licences.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("under the terms of the gnu general public license as published by", "gpl"),
    ("under the terms of the gnu lesser general public license", "lgpl"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl-2.0"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("spdx license identifier", "spdx"),
)
#: One edit is allowed for so many characters, while pieces keep ``SEED`` characters at least.
PER_EDIT = 10
SEED = 7
#: Lengths of a notice in one window of a long stretch.
WINDOW = 8

_WORD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


@dataclass(frozen=True)
class Hit:
    label: str
    first_word: int
    end_word: int
    edits: int
    score: float


def edits_for(notice: str) -> int:
    return max(0, min(len(notice) // PER_EDIT, len(notice) // SEED - 1))


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """The notice in ``edits + 1`` parts, each with its place."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(low, notice[low:high]) for low, high in zip(cuts, cuts[1:])]


def least_edits(notice: str, text: str) -> int:
    """The least edits from the notice to any stretch of the text: one column of the edit table per character, held in
    the bits of two numbers (up and down steps)."""
    whole = (1 << len(notice)) - 1
    top = 1 << len(notice) - 1
    where: dict[str, int] = {}
    for i, char in enumerate(notice):
        where[char] = where.get(char, 0) | 1 << i
    up, down, edits, best = whole, 0, len(notice), len(notice)
    for char in text:
        same = where.get(char, 0)
        across = (((same & up) + up) ^ up) | same
        more, less = down | ~(across | up) & whole, up & across
        edits += bool(more & top) - bool(less & top)
        best = min(best, edits)
        more, less = more << 1 & whole, less << 1 & whole
        up, down = less | ~(same | down | more) & whole, more & (same | down)
    return best


class Spaces:
    """Words before a place, from all places of spaces, which are taken once and only if asked for."""

    def __init__(self, joined: bytes):
        self.joined = joined

    @functools.cached_property
    def places(self) -> np.ndarray:
        return np.flatnonzero(np.frombuffer(self.joined, np.uint8) == 32)

    def before(self, at: int) -> int:
        return int(np.searchsorted(self.places, at))


class Notices:
    """Notices ready for searching."""

    def __init__(self, notices=NOTICES):
        self.notices = [(notice, label, edits_for(notice)) for notice, label in notices]
        self.seeds = ahocorasick.Automaton()
        for number, (notice, _, edits) in enumerate(self.notices):
            for at, piece in pieces(notice, edits):
                self.seeds.add_word(piece, [*self.seeds.get(piece, []), (number, at, len(piece))])
        self.seeds.make_automaton()
        # Among matches within the bound the library looks for the one with fewest edits.
        self.fuzzy = [regex.compile(f"(?b)(?:{regex.escape(notice, special_only=True)}){{e<={edits}}}") for notice, _, edits in self.notices]

    def find(self, words: str, spaces: Spaces) -> list[Hit]:
        """Hits in normalised words, by place. ``words`` starts and ends with a space."""
        places: dict[int, list[int]] = {}
        for end, found in self.seeds.iter(words):
            for number, at, length in found:
                places.setdefault(number, []).append(end + 1 - length - at)
        hits = []
        for number, starts in places.items():
            notice, label, edits = self.notices[number]
            for low, high in _stretches(sorted(starts), edits, len(notice) + edits, len(words)):
                # Most pieces stand alone; this rules their stretches out without losing one that the library would find.
                if least_edits(notice, words[low:high]) > edits:
                    continue
                for match in self._matches(number, words, low, high):
                    made = sum(match.fuzzy_counts)
                    held = words[match.start() : match.end()]
                    first = spaces.before(match.start() + len(held) - len(held.lstrip(" "))) - 1
                    last = spaces.before(match.end() - len(held) + len(held.rstrip(" ")))
                    hits.append(Hit(label, first, last, made, 1 - made / len(notice)))
        return sorted(hits, key=lambda h: (h.first_word, h.label, h.end_word))

    def _matches(self, number: int, words: str, low: int, high: int) -> Iterator[regex.Match]:
        """The best match of a stretch, then those of the parts before and behind it.

        A stretch of many notices in a row is taken in windows, since the best match of all of it would be looked for again
        and again. A window leaves what may reach beyond it to the next one.
        """
        notice, _, edits = self.notices[number]
        reach = len(notice) + edits
        while high - low > 2 * WINDOW * reach:
            end, done = low + WINDOW * reach, low + (WINDOW - 1) * reach
            for match in self._best(number, words, low, end):
                if match.end() <= end - reach:
                    yield match
                elif match.start() < done:
                    yield match
                    done = max(done, match.end())
            low = done
        yield from self._best(number, words, low, high)

    def _best(self, number: int, words: str, low: int, high: int) -> Iterator[regex.Match]:
        notice, _, edits = self.notices[number]
        parts = [(low, high)]
        while parts:
            low, high = parts.pop()
            if high - low < len(notice) - edits:
                continue
            match = self.fuzzy[number].search(words, low, high)
            if match and match.end() > match.start():
                yield match
                parts += [(low, match.start()), (match.end(), high)]


def _stretches(starts: list[int], before: int, after: int, size: int) -> Iterator[tuple[int, int]]:
    """Merged stretches around the places where a notice may start."""
    low = high = None
    for start in starts:
        if high is not None and start - before <= high:
            high = max(high, start + after)
            continue
        if high is not None:
            yield max(0, low), min(size, high)
        low, high = start - before, start + after
    if high is not None:
        yield max(0, low), min(size, high)


@functools.cache
def _notices() -> Notices:
    return Notices()


def base_places(joined: bytes, spaces: Spaces) -> list[tuple[int, str]]:
    """(first word, label) of every place of a base phrase in space-joined words."""
    found = []
    for phrase, label in BASE:
        look = f" {phrase} ".encode()
        at = joined.find(look)
        while at >= 0:
            found.append((spaces.before(at), label))
            at = joined.find(look, at + 1)
    return found


NAMES = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"
_KINDS = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.float64(), pa.string()]


def scan_text(raw: bytes) -> tuple:
    """The values of one text in the order of ``SCHEMA``, without the id."""
    words = raw.translate(_WORD).split()
    if not words:
        return 0, 0, None, None, "", "", 0.0, ""
    joined = b" " + b" ".join(words) + b" "
    spaces = Spaces(joined)
    base = base_places(joined, spaces)
    hits = _notices().find(joined.decode("latin-1"), spaces)
    places = [place for place, _ in base]
    own = {label for _, label in base}
    score = 1.0 if base else max((h.score for h in hits), default=0.0)
    spans = ",".join(f"{h.label}:{h.first_word}:{h.end_word}:{h.edits}" for h in hits)
    every = ",".join(sorted(own | {h.label for h in hits}))
    return len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted(own)), every, score, spans


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document. ``spans`` lists label:first word:end word:edits of the notices, end exclusive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = zip(*(scan_text(raw.as_py()) for raw in batch.column(1)))
                arrays = [batch.column(0), *(pa.array(values, kind) for values, kind in zip(columns, _KINDS[1:]))]
                yield pa.RecordBatch.from_arrays(arrays, NAMES)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("raw")).mapInArrow(run, SCHEMA)
