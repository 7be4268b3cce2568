"""Token counts that follow edits: a segment tree of pre-tokens per document.

The leaves of a document's tree are blocks of pre-tokens with their characters and tokens; each inner node has the
sums of its two children. An edit walks down the sums to the block where it begins, goes back over enough context that
the split before it cannot change, and splits anew from there until a new boundary falls on an old one behind the
edit: the split looks ahead but never back, so all that follows stays as it was. Only these pre-tokens are encoded
again, and only the sums above their blocks are updated.

A stretch with characters that the encoder's own pattern does not know is split by the library's pre-tokenizer, which
splits all other stretches alike, so every script has a tree. Only a tokenizer that does not work by pre-tokens has one
leaf, encoded whole. Defined results: a null text
is empty and has no tokens; places of an edit are code points of the text as it is after the edits before it, cut to
that text; null edits are none; repeated rows are each counted; an empty table gives an empty result; columns other
than those named are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .encoding import Encoder, encoder

BLOCK = 64


class CountTree:
    """Pre-tokens of one text and the sums over them."""

    def __init__(self, text: str, coder: Encoder, stored: bytes | None = None):
        """``stored`` is what ``store`` gave for the same text; with it nothing is encoded."""
        if coder.word_ends:
            raise ValueError("the tree needs a vocabulary whose pre-tokens make up the text")
        self.coder = coder
        self.encoded = 0  # characters given to the encoder so far
        if stored is None:
            self._build(text)
        else:
            lengths, counts = np.frombuffer(stored[1:], "<u4").reshape(2, -1)
            ends = np.cumsum(lengths, dtype=np.int64).tolist()
            self.whole = stored[:1] == b"w"
            self._shape([text[low:high] for low, high in zip([0, *ends], ends)], counts.tolist())

    def store(self) -> bytes:
        """Lengths and tokens of the pre-tokens, to be kept beside the text."""
        parts = [part for block in self.blocks for part in block]
        counts = [n for block in self.counts for n in block]
        return (b"w" if self.whole else b"p") + np.array([list(map(len, parts)), counts], "<u4").tobytes()

    def _build(self, text: str) -> None:
        self.whole = not self.coder.by_word
        parts = [text] if self.whole else list(self.coder.split(text))
        self._shape(parts, self._encode(parts))

    def _encode(self, parts: list[str]) -> list[int]:
        self.encoded += sum(map(len, parts))
        ids = self.coder.ids if self.whole else self.coder.piece
        return [len(found) // 4 for found in map(ids, parts)]

    def _shape(self, parts: list[str], counts: list[int]) -> None:
        """Leaves are nodes ``leaves`` and up; node i has the children 2i and 2i + 1."""
        self.blocks = [parts[i : i + BLOCK] for i in range(0, len(parts), BLOCK)] or [[]]
        self.counts = [counts[i : i + BLOCK] for i in range(0, len(parts), BLOCK)] or [[]]
        self.leaves = 1 << (len(self.blocks) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.leaves), [0] * (2 * self.leaves)
        for b, (block, own) in enumerate(zip(self.blocks, self.counts)):
            self.chars[self.leaves + b], self.tokens[self.leaves + b] = sum(map(len, block)), sum(own)
        for node in range(self.leaves - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def _changed(self, b: int) -> None:
        node = self.leaves + b
        self.chars[node], self.tokens[node] = sum(map(len, self.blocks[b])), sum(self.counts[b])
        while node > 1:
            node >>= 1
            self._sum(node)

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(part for block in self.blocks for part in block)

    def _find(self, place: int) -> tuple[int, int, int]:
        """(block, pre-token, start of it) of the pre-token that holds a place; behind the last one for the end."""
        if place >= self.length:
            return len(self.blocks) - 1, len(self.blocks[-1]), self.length
        node, before = 1, 0
        while node < self.leaves:
            node *= 2
            if place - before >= self.chars[node]:
                before += self.chars[node]
                node += 1
        b = node - self.leaves
        for i, part in enumerate(self.blocks[b]):
            if place < before + len(part):
                return b, i, before
            before += len(part)
        raise AssertionError("sums and pre-tokens differ")

    def _back(self, b: int, i: int, at: int) -> tuple[int, int, int]:
        """The pre-token from which on an edit in this one can change the split: two back, and then not of space alone."""
        steps = 0
        while steps < 2 or i < len(self.blocks[b]) and self.blocks[b][i].isspace():
            while i == 0 and b > 0:
                b -= 1
                i = len(self.blocks[b])
            if i == 0:
                break
            i -= 1
            at -= len(self.blocks[b][i])
            steps += 1
        return b, i, at

    def edit(self, start: int, end: int, new: str) -> None:
        """Puts a text in place of the characters from start to end."""
        start = max(0, min(start, self.length))
        end = max(start, min(end, self.length))
        if self.whole:
            text = self.text()
            self._build(text[:start] + new + text[end:])
            return
        first_b, first_i, first_at = self._back(*self._find(start))
        last_b, last_i, last_at = self._find(end)
        taken: list[str] = []
        b, i = first_b, first_i
        while (b, i) < (last_b, last_i):
            taken += self.blocks[b][i:] if b < last_b else self.blocks[b][i:last_i]
            b, i = (b + 1, 0) if b < last_b else (last_b, last_i)
        # Old boundaries behind the edit, in places of the new text from ``first_at`` on, with what they lead to.
        shift = len(new) - (end - start) - first_at
        head = "".join(taken + self.blocks[last_b][last_i : last_i + 1])[: start - first_at]
        cut = end - last_at
        rest: list[str] = []
        bounds: dict[int, tuple[int, int]] = {}
        at, reach = last_at, 1
        b, i = last_b, last_i
        while True:
            for _ in range(reach):
                while b < len(self.blocks) and i < len(self.blocks[b]):
                    if at >= end:
                        bounds[at + shift] = (b, i)
                    rest.append(self.blocks[b][i])
                    at += len(self.blocks[b][i])
                    i += 1
                if b + 1 < len(self.blocks):
                    b, i = b + 1, 0
                else:
                    break
            whole_rest = b + 1 == len(self.blocks) and i == len(self.blocks[b])
            if whole_rest:
                bounds[at + shift] = (b, i)
            text = head + new + "".join(rest)[cut:]
            # A split this close to what is not yet seen could still change.
            safe = len(text) if whole_rest else len(text.rstrip()) - 1
            parts, place, found = [], 0, None
            for part in self.coder.split(text):
                if place in bounds and place <= safe and place >= len(head) + len(new):
                    found = bounds[place]
                    break
                parts.append(part)
                place += len(part)
            else:
                if whole_rest:
                    found = bounds[len(text)]
            if found is not None:
                break
            reach *= 2
        counts = self._encode(parts)
        self._replace(first_b, first_i, *found, parts, counts)

    def _replace(self, first_b: int, first_i: int, b: int, i: int, parts: list[str], counts: list[int]) -> None:
        if first_b == b:
            self.blocks[b][first_i:i], self.counts[b][first_i:i] = parts, counts
        else:
            self.blocks[first_b][first_i:], self.counts[first_b][first_i:] = parts, counts
            del self.blocks[b][:i], self.counts[b][:i]
            for between in range(first_b + 1, b):
                self.blocks[between], self.counts[between] = [], []
                self._changed(between)
            self._changed(b)
        if len(self.blocks[first_b]) > 16 * BLOCK:
            self._shape([p for block in self.blocks for p in block], [n for block in self.counts for n in block])
        else:
            self._changed(first_b)


NAMES = ("doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_chars_edited", "encoded_again", "tree")
SCHEMA = "doc_id long, n_tokens long, n_edits long, n_tokens_edited long, n_chars_edited long, encoded_again long, tree binary"
NO_EDITS = "array<struct<start:int,end:int,new:string>>"


def counts(
    docs: DataFrame, vocabulary: str, edits: Column | None = None, stored: Column | None = None, keep_trees: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: tokens before and after its edits, the characters encoded again for them, and the tree.

    ``edits`` is an array of structs (start, end, new), applied one after the other; ``stored`` trees save encoding the
    text before them; ``tree`` is null unless kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in batches:
            rows = []
            for doc_id, text, changes, old in zip(*(batch.column(i) for i in range(4))):
                tree = CountTree(text.as_py() or "", coder, old.as_py())
                before, encoded = tree.total, tree.encoded
                made = [c for c in changes.as_py() or [] if c is not None and c["start"] is not None and c["end"] is not None]
                for change in made:
                    tree.edit(change["start"], change["end"], change["new"] or "")
                kept = tree.store() if keep_trees else None
                rows.append((doc_id.as_py(), before, len(made), tree.total, tree.length, tree.encoded - encoded, kept))
            if rows:
                arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), [pa.int64()] * 6 + [pa.binary()])]
                yield pa.RecordBatch.from_arrays(arrays, NAMES)

    none = F.array().cast(NO_EDITS)
    columns = [
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
        (none if edits is None else edits.cast(NO_EDITS)).alias("edits"), (F.lit(None).cast("binary") if stored is None else stored).alias("stored"),
    ]
    return docs.select(*columns).mapInArrow(run, SCHEMA)
