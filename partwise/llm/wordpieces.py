"""Token ids of a text from a cache of its white-space separated chunks, as the library gives them.

Where a tokenizer drops white space before it splits and no rule looks across it, the ids of a text
are the ids of its chunks in order. The chunks are cut at ASCII white space only; any other white
space stays inside a chunk and is left to the library. Tokenizers of another build, and texts for
which the library would look across white space, are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
from array import array

import numpy as np

# Fixed value: a pre-tokenizer with this pattern, removing what it does not match, never joins over white space.
DROPS_SPACE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LONGEST_KEPT = 64
# Marks that after letters make a pre-token of their own; an apostrophe may belong to the letters after it.
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Letters before this one, but for the one below, are their own NFC form and have one small letter.
FIRST_OTHER, DOTTED_I = "\u0180", "\u0130"
# The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
BYTE_CHARACTERS = {b: b for b in _PRINTABLE} | {b: 256 + i for i, b in enumerate(_OTHERS)}


class Tokens:
    """The library's tokenizer with a way for single chunks."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            text = file.read()
        self.library, made = Tokenizer.from_str(text), json.loads(text)
        self.library.no_truncation()
        self.library.no_padding()
        self.by_chunk = self._splits_at_space(made)
        self.model = self.library.model

    @staticmethod
    def _splits_at_space(made: dict) -> bool:
        first = ((made.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        added = made.get("added_tokens") or []
        kinds = [n["type"] for n in (made.get("normalizer") or {}).get("normalizers", [])]
        return (
            first.get("type") == "Split"
            and first.get("pattern") == {"Regex": DROPS_SPACE}
            and first.get("behavior") == "Removed"
            and first.get("invert") is True
            and kinds == ["NFC", "Replace", "Lowercase"]
            and not any(a["lstrip"] or a["rstrip"] or re.search(r"\s", a["content"]) for a in added)
        )

    def ids(self, raw: bytes) -> list[int]:
        return self.library.encode(raw.decode("utf-8", "replace"), add_special_tokens=False).ids

    def folded(self, raw: bytes) -> bytes | None:
        """A chunk of letters that needs no normaliser but lower case, so changed; others give None."""
        if raw.isalpha():  # ASCII letters only
            return raw.lower()
        text = raw.decode("utf-8", "replace")
        if text.isalpha() and max(text) < FIRST_OTHER and DOTTED_I not in text:
            return text.lower().encode()
        return None

    def word(self, folded: bytes) -> list[int]:
        text = folded.decode() if folded.isascii() else folded.decode("latin-1").translate(BYTE_CHARACTERS)
        return [t.id for t in self.model.tokenize(text)]


def shared(key: tuple, make):
    """One object of a kind in each worker process; another key of the kind replaces it.

    The library is shipped to workers by value, so what outlives a task is kept in a module of its own.
    """
    kept = sys.modules.setdefault("_partwise_shared", types.ModuleType("_partwise_shared")).__dict__
    name, rest = key[0], key[1:]
    if kept.get(name, (None,))[0] != rest:
        kept[name] = (rest, make())
    return kept[name][1]


def tokens(path: str) -> Tokens:
    return shared(("tokenizer", path), lambda: Tokens(path))


class Cache(dict):
    """What is made of a key, made when it is first asked for.

    When `most` entries have come to the first ones, they become the old half: what is asked for again
    moves over, the rest goes with the next change.
    """

    def __init__(self, make, first: dict, most: int) -> None:
        super().__init__(first)
        self.make, self.first, self.most, self.old = make, first, len(first) + most, {}

    def __missing__(self, key: bytes):
        made = self.old.get(key)
        if made is None:
            made = self.make(key)
        if len(key) <= LONGEST_KEPT:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
                self.update(self.first)
            self[key] = made
        return made


def chunk_cache(own: Tokens, form, first: dict, most: int) -> Cache:
    """What `form` makes of the ids of a chunk; forms of parts have to add up to the form of the whole."""
    words = Cache(lambda word: form(own.word(word)), {}, most // 2)
    marks = Cache(lambda mark: form(own.ids(mark)), {}, 1000)

    def make(chunk: bytes):
        letters = chunk.rstrip(MARKS)
        word = own.folded(letters) if letters else None
        if word is None:
            return form(own.ids(chunk))
        return words[word] if len(letters) == len(chunk) else words[word] + marks[chunk[len(letters) :]]

    return Cache(make, first, most)


def packed(ids: list[int]) -> bytes:
    """Unsigned 32-bit integers, little-endian."""
    return np.array(ids, dtype="<u4").tobytes()


def short(ids: list[int]) -> bytes:
    """Unsigned 16-bit integers, for vocabularies that are small enough, in this machine's order."""
    return array("H", ids).tobytes()
