"""Words of texts as numbers of a reference vocabulary, and rolling hashes over their runs."""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np

WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return WORD.findall(text.lower())


def vocabulary(texts: Iterable[list[str]]) -> dict[str, int]:
    known: dict[str, int] = {}
    for text in texts:
        for word in text:
            known.setdefault(word, len(known))
    return known


def numbers(found: list[str], known: dict[str, int]) -> np.ndarray:
    """Number of each word, -1 if the vocabulary lacks it."""
    get = known.get
    return np.array([get(w, -1) for w in found], np.int64)


def runs(ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin hash of every run of ``length`` known words, and where the run starts."""
    count = len(ids) - length + 1
    if count <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    value = np.zeros(count, np.uint64)
    known = np.ones(count, bool)
    unsigned = ids.astype(np.uint64) + np.uint64(1)
    for k in range(length):
        value = value * _BASE + unsigned[k : k + count]
        known &= ids[k : k + count] >= 0
    at = np.flatnonzero(known)
    return value[at], at
