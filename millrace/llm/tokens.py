"""Token ids by the tokenizers library, with memory of the words met before.

Where a pre-token ends is known without the library in a few places: before white space that follows
anything else, and between letters, digits and ASCII marks other than the apostrophe. A text is cut there
and nowhere else, so the ids of the pieces, one after the other, are those of the whole text. Pieces seen
before are looked up; a word of plain letters goes to the library's model, anything else through all of
its steps.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

#: Letters that neither normal form nor a change of case takes apart.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = r"!-&(-/:-@\[-`{-~"
_PLAIN = re.compile(rf"([{LETTERS}]+)([.,]?)")
_FINE = re.compile(
    rf" ?[{LETTERS}]+(?=[\s0-9{_MARKS}]|$)| ?[{_MARKS}]+(?=[\s0-9{LETTERS}]|$)|"
    rf" ?[0-9]+(?=[\s{LETTERS}{_MARKS}]|$)|\n(?=[0-9{LETTERS}{_MARKS}])|\s*\S+|\s+"
)
_SEGMENT = re.compile(r"\s*\S+|\s+")
_WORD = re.compile(rf" ?[{LETTERS}]+")
#: Characters on whose class the libraries may differ.
_ODD = "\x1c\x1d\x1e\x1f"
#: White space and then a blank: such texts aren't cut at each blank.
_UNEVEN = {chr(c): chr(c) + " " for c in range(0x3001) if chr(c).isspace()}
#: Entries of a generation of what a worker remembers, some 100 bytes each; changes no result.
REMEMBERED = 250_000
#: Characters of the longest entry that is remembered; longer ones seldom come again.
SHORT = 24


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Remembered(dict):
    """Values worked out when first asked for.

    Two generations are kept: when the younger is full it becomes the older one, and what is asked for
    again moves back, so frequent entries stay and memory is bounded.
    """

    def __init__(self, remembered: int) -> None:
        super().__init__()
        self.remembered = remembered
        self.older: dict[str, bytes] = {}

    def value(self, key: str) -> bytes:
        raise NotImplementedError

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.value(key)
            if len(key) > SHORT:
                return found
        if len(self) >= self.remembered:
            self.older = self.copy()
            self.clear()
        self[key] = found
        return found


class _Pieces(_Remembered):
    """Ids of pieces; ``blank`` stands before each. A plain word is known by itself, without marks after it."""

    def __init__(self, encoder: Encoder, blank: str):
        super().__init__(encoder.remembered)
        self.encoder, self.blank = encoder, blank
        self.tokenize, self.letters = encoder.tokenizer.model.tokenize, _byte_letters()
        self.before = blank.translate(self.letters)

    def value(self, key: str) -> bytes:
        if key.isascii() and key.isalpha():  # each letter is its own byte
            return array("I", [t.id for t in self.tokenize(key.lower() if self.encoder.folds else self.before + key)]).tobytes()
        plain = _PLAIN.fullmatch(key)
        if plain:
            word, marks = plain.groups()
            if marks:
                return self[word] + self.encoder.others[marks]
            spelled = word.lower() if self.encoder.folds else self.blank + word
            return array("I", [t.id for t in self.tokenize(spelled.encode().decode("latin-1").translate(self.letters))]).tobytes()
        return b"".join([self.encoder.part(x) for x in _FINE.findall(self.blank + key)])


class _Others(_Remembered):
    """Ids of all else by every step of the library."""

    def __init__(self, tokenizer, remembered: int):
        super().__init__(remembered)
        self.tokenizer = tokenizer

    def value(self, key: str) -> bytes:
        return array("I", self.tokenizer.encode(key, add_special_tokens=False).ids).tobytes()


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers.

    The strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.remembered = remembered
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            self.folds = json.load(file).get("normalizer") is not None  # lower case, blanks dropped
        self.others = _Others(self.tokenizer, remembered)
        self.first = _Pieces(self, "")
        self.rest = self.first if self.folds else _Pieces(self, " ")

    def part(self, text: str) -> bytes:
        """The ids of a part of a piece: a plain word with or without its blank, or anything else."""
        if _WORD.fullmatch(text):
            return self.rest[text[1:]] if text[0] == " " else self.first[text]
        return self.others[text]

    def encode(self, text: str) -> bytes:
        """The ids of a whole text."""
        if not text:
            return b""
        if any(x in text for x in _ODD):
            return self.others[text]
        if any(pair in text for x, pair in _UNEVEN.items() if x in text):
            return b"".join([self.first[x] for x in _SEGMENT.findall(text)])
        first, *rest = text.split(" ")
        return (self.first[first] if first else b"") + b"".join(map(self.rest.__getitem__, rest))


@lru_cache(maxsize=4)
def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """One encoder for each worker, vocabulary and size of its memory."""
    return Encoder(path, remembered)


def forget() -> None:
    """Gives back what this worker remembers, before it does something else that takes memory."""
    encoder.cache_clear()


def segments(text: str) -> list[str]:
    """Cuts a text where the ids of both sides do not depend on each other."""
    return [text] if any(x in text for x in _ODD) else _SEGMENT.findall(text)
