"""Plans for packing lengths into sequences, from their histogram alone.

A pattern is a few lengths that fill a sequence exactly. Patterns over the lengths that occur are
enumerated, their repeat counts are fitted to the histogram by non-negative least squares, rounded,
and held to what is left of each length. That is repeated over the rest. What no pattern fits, the
residual, is packed by best fit over the histogram: all pieces of one length at a time, all equal
sequences at once.

Everything here is bounded by the context, whatever the number of documents.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from typing import NamedTuple

import numpy as np

#: Most lengths in a pattern.
PARTS = 6
#: Lengths that a pattern may repeat, spread over those that occur.
FILLERS = 24
ROUNDS = 4
STEPS = 300


class Pattern(NamedTuple):
    """``repeats`` sequences that hold each length so many times, in this order."""

    repeats: int
    parts: tuple[tuple[int, int], ...]


def enumerate_patterns(left: np.ndarray, context: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns that fill ``context`` exactly: a row of lengths each, and how often each occurs in it.

    The longest part is any length that occurs, a filler is repeated 0 to PARTS - 2 times, and one
    more length fills the rest. Unused columns have count 0.
    """
    present = np.flatnonzero(left)
    if not len(present):
        return np.empty((0, 3), np.int64), np.empty((0, 3), np.int64)
    # Fillers at even shares of all pieces, so that common lengths come first.
    share = np.cumsum(left[present]) / left[present].sum()
    fillers = np.unique(present[np.searchsorted(share, (np.arange(FILLERS) + 0.5) / FILLERS)])
    first, filler, times = (
        x.ravel() for x in np.meshgrid(present, np.append(fillers, 0), np.arange(PARTS - 1), indexing="ij")
    )
    last = context - first - filler * times
    good = (last >= 0) & (last <= first) & ((filler > 0) == (times > 0)) & (filler <= first)
    first, filler, times, last = (x[good] for x in (first, filler, times, last))
    good = (last == 0) | (left[last] > 0)
    lengths = np.stack([first, filler, last], axis=1)[good]
    counts = np.stack([np.ones_like(first), times, (last > 0).astype(np.int64)], axis=1)[good]
    return lengths, counts


def fitted(lengths: np.ndarray, counts: np.ndarray, left: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative x that brings the lengths of x patterns closest to the histogram, in squares.

    Accelerated projected gradient steps: both products with the matrix of patterns are sums over
    its few entries.
    """
    size, target = len(left), left.astype(float)

    def total(x: np.ndarray) -> np.ndarray:
        return np.bincount(lengths.ravel(), (counts * x[:, None]).ravel(), size)

    def gradient(residual: np.ndarray) -> np.ndarray:
        return (counts * residual[lengths]).sum(axis=1)

    probe = np.ones(len(lengths))
    norm = 1.0
    for _ in range(20):
        probe = gradient(total(probe))
        norm = float(np.linalg.norm(probe)) or 1.0
        probe /= norm
    x = np.zeros(len(lengths))
    ahead, speed = x, 1.0
    for _ in range(steps):
        new = np.maximum(ahead - gradient(total(ahead) - target) / (1.05 * norm), 0.0)
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        ahead = new + (speed - 1) / faster * (new - x)
        x, speed = new, faster
    return x


def rounded(lengths: np.ndarray, counts: np.ndarray, x: np.ndarray, left: np.ndarray) -> list[Pattern]:
    """Whole repeat counts, largest first, each held to what is left; ``left`` is reduced."""
    out = []
    for k in np.argsort(-x, kind="stable"):
        if x[k] < 0.05:
            break
        parts = defaultdict(int)
        for length, n in zip(lengths[k].tolist(), counts[k].tolist()):
            if n:
                parts[length] += n
        repeats = min(int(np.ceil(x[k])), *(int(left[length]) // n for length, n in parts.items()))
        if repeats:
            for length, n in parts.items():
                left[length] -= repeats * n
            out.append(Pattern(repeats, tuple(sorted(parts.items(), reverse=True))))
    return out


def best_fit(left: np.ndarray, context: int) -> list[Pattern]:
    """Longest first into the fullest sequences that have room; equal sequences are filled together."""
    room: dict[int, list[tuple[int, tuple[tuple[int, int], ...]]]] = defaultdict(list)
    rooms: list[int] = []
    done = []

    def put(space: int, number: int, parts: tuple[tuple[int, int], ...]) -> None:
        if not number:
            return
        if not space:
            done.append(Pattern(number, parts))
            return
        if not room[space]:
            insort(rooms, space)
        room[space].append((number, parts))

    for length in np.flatnonzero(left)[::-1].tolist():
        rest = int(left[length])
        while rest:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                space = rooms[at]
                number, parts = room[space].pop()
                if not room[space]:
                    rooms.pop(at)
            else:
                space, number, parts = context, -(-rest // (context // length)), ()
            fits = space // length
            full = min(number, rest // fits)
            put(space - fits * length, full, (*parts, (length, fits)))
            rest -= full * fits
            some = rest if full < number else 0
            if some:
                put(space - some * length, 1, (*parts, (length, some)))
                rest = 0
            put(space, number - full - (some > 0), parts)
    for space in rooms:
        done += [Pattern(number, parts) for number, parts in room[space]]
    return done


def plan(histogram: np.ndarray, context: int, rounds: int = ROUNDS, steps: int = STEPS) -> list[Pattern]:
    """Sequences for all pieces; ``histogram`` counts the pieces of each length from 0 to ``context``."""
    left = np.asarray(histogram, np.int64).copy()
    left[0] = 0
    found = []
    for _ in range(rounds):
        lengths, counts = enumerate_patterns(left, context)
        if not len(lengths):
            break
        chosen = rounded(lengths, counts, fitted(lengths, counts, left, steps), left)
        found += chosen
        if not chosen:
            break
    return found + best_fit(left, context)
