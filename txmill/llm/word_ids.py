"""Token ids of texts, word by word.

A byte-pair model is applied to one word at a time, and the pre-tokeniser's pattern says what a word
is. A text of ASCII and common Latin-1 letters, where every library agrees on letters and their lower
case, is cut by that pattern here, and a worker asks the model once for each different word. Other
texts are cut only where the pre-tokeniser never joins anything; a piece with other characters goes
to the tokenizer as it is. So do texts with a special token's string and all texts of tokenizers
that cut in another way. The ids are always those of the tokenizer.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterable

import numpy as np

#: Different words whose ids a worker remembers; when full it starts anew.
WORDS_KEPT = 500_000
#: The same for pieces of texts with uncommon characters.
PIECES_KEPT = 50_000


class Remembered(dict):
    """Results by argument; a missing one is computed when it is asked for."""

    def __init__(self, compute: Callable[[str], bytes], most: int) -> None:
        super().__init__()
        self._compute, self._most = compute, most

    def __missing__(self, key: str) -> bytes:
        found = self._compute(key)
        if len(self) >= self._most:
            self.clear()
        self[key] = found
        return found


def byte_signs() -> list[str]:
    """The signs of byte-level vocabularies: visible bytes stand for themselves, others follow 255."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b if b in visible else 256 + hidden.index(b)) for b in range(256)]


_SIGNS = byte_signs()
_ASCII_SIGNS = {k: sign for k, sign in enumerate(_SIGNS) if k < 128 and sign != chr(k)}
#: Letters of Latin-1 that are composed and have one lower-case form everywhere.
_LETTERS = "À-ÖØ-öø-ÿ"
#: Characters 28 to 31 are white space to Python only.
_COMMON = re.compile(f"[\\x00-\\x1B\\x20-\\x7F{_LETTERS}]*").fullmatch


def _is_common(text: str) -> bool:
    if text.isascii():
        return not ("\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text)
    return bool(_COMMON(text))


# What the pre-tokenisers call a word, among common characters. Letters stand first, as
# the commonest; no other branch begins with one.
SPACE_FREE = rf"[A-Za-z{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\sA-Za-z{_LETTERS}0-9]+"
BYTE_LEVEL = rf" ?[A-Za-z{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\sA-Za-z{_LETTERS}0-9]+|\s+(?!\S)|\s+"


class Words:
    """Ids of texts by the words that ``pattern`` finds in them; what it does not find has none."""

    def __init__(self, tokenizer, pattern: str, lower: bool) -> None:
        self.tokenizer, self.model, self.lower = tokenizer, tokenizer.model, lower
        self._find = re.compile(pattern).findall
        self._of_word = Remembered(self._word, WORDS_KEPT).__getitem__
        self.of_piece = Remembered(self._piece, PIECES_KEPT).__getitem__

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if word.isascii():
            signs = word if word.isalpha() else word.translate(_ASCII_SIGNS)
        else:
            signs = "".join(map(_SIGNS.__getitem__, word.encode()))
        return array("I", [t.id for t in self.model.tokenize(signs)]).tobytes()

    def common(self, text: str) -> bytes:
        """Ids of a text of common characters."""
        return b"".join(map(self._of_word, self._find(text.lower() if self.lower else text)))

    def _piece(self, piece: str) -> bytes:
        return self.common(piece) if _is_common(piece) else self.whole(piece)

    def encode(self, text: str, cut: Callable[[str], Iterable[str]]) -> bytes:
        """``cut`` parts a text where the pre-tokeniser never joins anything."""
        return self.common(text) if _is_common(text) else b"".join(map(self.of_piece, cut(text)))


def special_strings(tokenizer) -> list[str]:
    return [t.content for t in tokenizer.get_added_tokens_decoder().values()]


def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _drops_space(tokenizer) -> bool:
    """Whether the tokenizer composes and lower-cases letters and keeps only what its pattern finds."""
    settings = json.loads(tokenizer.to_str())
    normalizer, pre = settings.get("normalizer") or {}, settings.get("pre_tokenizer") or {}
    steps = normalizer.get("normalizers", [])
    first = (pre.get("pretokenizers") or [{}])[0]
    return (
        [n.get("type") for n in steps] == ["NFC", "Replace", "Lowercase"]
        and steps[1]["pattern"] == {"Regex": r"\s+"}
        and first.get("behavior") == "Removed"
        and first.get("invert") is True
        and first.get("pattern") == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
    )


class SpaceFreeEncoder:
    """Ids of whole texts by a tokenizer that drops white space, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        self.tokenizer = load(path)
        self.words = Words(self.tokenizer, SPACE_FREE, lower=True)
        self.by_words = _drops_space(self.tokenizer)
        self.special = special_strings(self.tokenizer)

    def encode(self, text: str) -> bytes:
        if not self.by_words or any(s in text for s in self.special):
            return self.words.whole(text)
        return self.words.encode(text, _UNICODE_SPACE.split)


#: White space as Unicode has it: without characters 28 to 31.
_UNICODE_SPACE = re.compile(r"[^\S\x1C-\x1F]+")


_encoders: dict[str, SpaceFreeEncoder] = {}


def space_free_encoder(path: str) -> SpaceFreeEncoder:
    """One per worker and path."""
    if path not in _encoders:
        _encoders[path] = SpaceFreeEncoder(path)
    return _encoders[path]
