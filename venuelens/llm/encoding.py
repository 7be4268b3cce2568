"""Token ids of whole texts by the tokenizers library, with a memory of words already encoded.

The library encodes about one million characters a second. Its result for a text is the ids of its pre-tokens one
after the other, so each distinct pre-token is given to the library's model once per worker and looked up from then
on. Chunks between single spaces are looked up first, and split into pre-tokens only when new.

This holds for the two vocabularies known here and for characters whose classes are the same in every version of
Unicode (Latin letters, digits and common punctuation). Any other tokenizer, and any other text, is encoded whole by
the library. Both ways give the same ids; tests compare them.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
from collections.abc import Iterator

from tokenizers import Tokenizer

# Classes of the characters for which words are looked up, and the two patterns in these classes.
LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-įı-ȳ"
NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACE = "\t\n\r \xa0"
KNOWN = "\t\n\r -~\xa0-įı-ȳ‐-‧‰-⁞€"
BYTE_LEVEL = (
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+"
    f"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
WORD_ENDS = f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^{SPACE}{LETTER}{NUMBER}]+"

_UNKNOWN = re.compile(f"[^{KNOWN}]")
_PLAIN = bytes([9, 10, 13, *range(32, 127), *range(160, 256)])
#: Chunks and words in each of the two generations that a worker remembers, some 120 MB in all.
CHUNKS = 300_000
WORDS = 40_000
#: Marks of those that came once, a byte each; a power of two.
ONCE = 1 << 22


class Memory(dict):
    """What ``make`` gave for each key that came twice. When full it becomes the older generation; what is used again moves up.

    Keys that came once only leave a mark, so the many words that never come again take no room.
    """

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.older = make, size, {}
        self.once = bytearray(ONCE)

    def __missing__(self, key):
        found = self.older.pop(key, None)
        if found is None:
            found = self.make(key)
            at = hash(key) & ONCE - 1
            if not self.once[at]:
                self.once[at] = 1
                return found
        if len(self) >= self.size:
            self.older, self.once = dict(self), bytearray(ONCE)
            self.clear()
        self[key] = found
        return found


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path) as file:
            shape = json.load(file)
        before, model = shape.get("pre_tokenizer") or {}, shape["model"]
        byte_level = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        self.word_ends = model.get("end_of_word_suffix") == "</w>" and before.get("type") == "Sequence"
        plain = model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
        self.by_word = plain and (self.word_ends or byte_level and not shape.get("normalizer"))
        self.pattern = re.compile(WORD_ENDS if self.word_ends else BYTE_LEVEL)
        self.before = "" if self.word_ends else " "
        self.model = self.tokenizer.model
        self.written = [struct.pack("<I", i) for i in range(1 + max(self.tokenizer.get_vocab().values()))]
        self.letters = _byte_letters()
        self.mark = self.before.translate(self.letters)
        self.words = Memory(self._word, WORDS)
        self.chunks = Memory(self._chunk, CHUNKS)

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        return self._ids(word.encode().decode("latin-1").translate(self.letters))

    def _ids(self, shown: str) -> bytes:
        written = self.written
        return b"".join([written[token.id] for token in self.model.tokenize(shown)])

    def piece(self, word: str) -> bytes:
        """The ids of one pre-token. Words of letters are remembered as the chunks they mostly are."""
        letters = word if self.word_ends else word[1:] if word[0] == " " else ""
        return self.chunks[letters] if letters.isalpha() else self.words[word]

    def _pieces(self, text: str) -> bytes:
        return b"".join(map(self.piece, self.pattern.findall(text)))

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return self._ids(self.mark + chunk) if chunk.isascii() else self._word(self.before + chunk)
        return self._pieces(self.before + chunk)

    def known(self, text: str) -> bool:
        try:
            return not text.encode("latin-1").translate(None, _PLAIN)
        except UnicodeEncodeError:
            return not _UNKNOWN.search(text)

    def split(self, text: str) -> Iterator[str]:
        """The pre-tokens of a text or of a stretch of one, for vocabularies whose pre-tokens make up the text."""
        if self.known(text):
            yield from (found[0] for found in self.pattern.finditer(text))
            return
        # One letter of a byte-level pre-token is one byte of the text.
        raw, at = text.encode(), 0
        for shown, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text):
            yield raw[at : at + len(shown)].decode()
            at += len(shown)

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.by_word or not self.known(text):
            return self._whole(text)
        if self.word_ends:
            return b"".join(map(self.chunks.__getitem__, text.lower().split()))
        if any(pair in text for pair in ("  ", " \n", " \t", " \r", " \xa0")):
            # Runs of spaces are pre-tokens of their own; only a single space starts a chunk.
            return self._pieces(text)
        first, *rest = text.split(" ")
        return self._pieces(first) + b"".join(map(self.chunks.__getitem__, rest))


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary, kept over the tasks of the worker."""
    return Encoder(path)


def forget() -> None:
    """Drops what this worker remembers; other operators call it, since Spark gives them the same workers later on."""
    encoder.cache_clear()
