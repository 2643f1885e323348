"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item are compared if they share seeds, runs of ``MATCH`` words found by
Karp-Rabin hashes. Then the longest common runs are marked again and again, no word of either side
twice, until none of ``MATCH`` words is left. The item is leaked if the marked tiles cover enough
of it, in whatever order they stand in the document. The length of the longest run is searched by
halving; for each length tried, one hash per place is held, so memory is that of the two texts.

The benchmark goes to the documents, not the other way round: its different texts are cut into blocks
of bounded size, and each block is sent to all tasks, so documents are never shuffled. A benchmark
above one block is handled in further passes over the documents; what a pass finds is stored, and its
block let go. Copies of an item meet its leaks in the end.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txmill.llm import tokens
from txmill.llm.common import per_text, stored

MATCH = 5
COVERAGE = 0.6
#: Bound of one block of the benchmark, in characters; a longer item is a block of its own.
BLOCK_CHARACTERS = 8_000_000


@dataclass(frozen=True)
class Block:
    """Items as word numbers, and an index from seeds to the items that hold them."""

    known: dict[str, int]
    ids: list[int | None]
    items: list[np.ndarray]
    seeds: np.ndarray
    owner: np.ndarray
    needed: np.ndarray


def needed_seeds(item: np.ndarray, match: int, coverage: float) -> int:
    """Different seeds that a document must share with an item at least to cover it.

    Tiles are of ``match`` words or more, so covering n words takes n / match places of seeds; a
    seed that the item repeats fills as many places as it occurs.
    """
    places = math.ceil(math.ceil(coverage * len(item) - 1e-9) / match)
    _, times = np.unique(tokens.runs(item, match)[0], return_counts=True)
    return int(np.searchsorted(np.cumsum(np.sort(times)[::-1]), places)) + 1


def build(rows: Iterable[tuple[int | None, str | None]], match: int, coverage: float) -> Block:
    """Index a block. Of each item the commonest seeds are left out, as many as can be spared:
    whoever shares all the seeds that an item needs shares at least one of the others."""
    found = [(i, tokens.words(t or "")) for i, t in rows]
    found = [(i, w) for i, w in found if len(w) >= match]
    known = tokens.vocabulary(w for _, w in found)
    items = [tokens.numbers(w, known) for _, w in found]
    distinct = [np.unique(tokens.runs(item, match)[0]) for item in items]
    every, times = np.unique(np.concatenate([*distinct, np.empty(0, np.uint64)]), return_counts=True)
    needed = [needed_seeds(item, match, coverage) for item in items]
    kept = []
    for seeds, least in zip(distinct, needed):
        rarest = np.argsort(times[np.searchsorted(every, seeds)], kind="stable")
        kept.append(seeds[rarest[: len(seeds) - least + 1]])
    seeds = np.concatenate([*kept, np.empty(0, np.uint64)])
    owner = np.repeat(np.arange(len(kept)), [len(k) for k in kept])
    order = np.argsort(seeds, kind="stable")
    return Block(known, [i for i, _ in found], items, seeds[order], owner[order], np.array(needed))


class _Places:
    """Places of a text where a run of free words may start, by the run's hash, for any length."""

    def __init__(self, ids: np.ndarray) -> None:
        self.ids, self.free = ids, ids >= 0
        self._sums = np.concatenate(([np.uint64(0)], np.cumsum((ids.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(ids)))))
        self._back = _powers(_INVERSE, len(ids) + 1)

    def starts(self, length: int) -> np.ndarray:
        """Where ``length`` free words stand together."""
        taken = np.concatenate(([0], np.cumsum(~self.free)))
        return np.flatnonzero(taken[length:] == taken[:-length]) if length <= len(self.ids) else np.empty(0, np.int64)

    def hashes(self, starts: np.ndarray, length: int) -> np.ndarray:
        """Sums of words times powers of a base, shifted back to the same power."""
        return (self._sums[starts + length] - self._sums[starts]) * self._back[starts]

    def longest(self) -> int:
        edge = np.flatnonzero(np.diff(np.concatenate(([False], self.free, [False])).astype(np.int8)))
        return int((edge[1::2] - edge[::2]).max()) if len(edge) else 0


#: An odd number and its inverse among 64-bit integers.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _common(doc: _Places, item: _Places, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of both texts whose free runs of this length have a hash in common, and the hashes."""
    at_d, at_i = doc.starts(length), item.starts(length)
    hash_d, hash_i = doc.hashes(at_d, length), item.hashes(at_i, length)
    in_d, in_i = np.isin(hash_d, hash_i), np.isin(hash_i, hash_d)
    return at_d[in_d], hash_d[in_d], at_i[in_i], hash_i[in_i]


def tiles(
    doc: np.ndarray, item: np.ndarray, match: int = MATCH, least: float = 0.0
) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in doc, start in item, length), longest first.

    Each round takes the longest common runs of unmarked words, of equal ones the earliest in the
    document and then in the item. Stops early, with what it has, once the words that common runs
    could still cover are too few for ``least`` in all.
    """
    left, right = _Places(doc), _Places(item)
    marked: list[tuple[int, int, int]] = []
    most, covered = min(left.longest(), right.longest()), 0
    while most >= match:
        # All that may still be marked is inside common runs of the least length.
        _, _, at_i, _ = _common(left, right, match)
        reach = np.zeros(len(item) + 1, np.int64)
        np.add.at(reach, at_i, 1)
        np.add.at(reach, at_i + match, -1)
        possible = int(np.count_nonzero(np.cumsum(reach)[:-1]))
        if not possible or covered + possible < least:
            break
        low, high = match, most
        while low < high:
            middle = (low + high + 1) // 2
            if len(_common(left, right, middle)[0]):
                low = middle
            else:
                high = middle - 1
        found = _mark(left, right, low)
        marked += found
        covered += low * len(found)
        most = low - 1
    return marked


def _mark(doc: _Places, item: _Places, length: int) -> list[tuple[int, int, int]]:
    """Marks all common runs of this length in order, each word of either side once."""
    at_d, hash_d, at_i, hash_i = _common(doc, item, length)
    waiting: dict[int, deque[int]] = {}
    for h, q in zip(hash_i.tolist(), at_i.tolist()):
        waiting.setdefault(h, deque()).append(q)
    found, end = [], -1
    for h, p in zip(hash_d.tolist(), at_d.tolist()):
        if p < end:
            continue
        places = waiting[h]
        while places and not item.free[places[0] : places[0] + length].all():
            places.popleft()
        # Texts differ only if the hashes of different runs collide.
        q = next((q for q in places if (doc.ids[p : p + length] == item.ids[q : q + length]).all()
                  and item.free[q : q + length].all()), None)
        if q is not None:
            doc.free[p : p + length] = item.free[q : q + length] = False
            found.append((p, q, length))
            end = p + length
    return found


def leaks(text: str, block: Block, match: int, coverage: float) -> list[dict]:
    """Items of the block that the text covers."""
    doc = tokens.numbers(tokens.words(text), block.known)
    hashes, at = tokens.runs(doc, match)
    if not len(hashes) or not len(block.seeds):
        return []
    first = np.searchsorted(block.seeds, hashes, "left")
    last = np.searchsorted(block.seeds, hashes, "right")
    if not (last > first).any():
        return []
    candidates = {i for a, b in zip(first.tolist(), last.tolist()) if b > a for i in block.owner[a:b].tolist()}
    present = np.unique(hashes)
    found = []
    for i in sorted(candidates):
        item = block.items[i]
        shared = np.isin(np.unique(tokens.runs(item, match)[0]), present).sum()
        if shared < block.needed[i]:
            continue
        parts = tiles(_near(doc, hashes, at, item, match), item, match, coverage * len(item) - 1e-9)
        covered = sum(length for _, _, length in parts)
        if covered >= coverage * len(item) - 1e-9:
            found.append(
                {"item_id": block.ids[i], "coverage": covered / len(item), "tiles": len(parts), "words": covered}
            )
    return found


def _near(doc: np.ndarray, hashes: np.ndarray, at: np.ndarray, item: np.ndarray, match: int) -> np.ndarray:
    """The document with every word outside the item's seeds taken out, one gap for each stretch."""
    inside = np.zeros(len(doc), bool)
    for start in at[np.isin(hashes, tokens.runs(item, match)[0])].tolist():
        inside[start : start + match] = True
    kept = np.where(inside, doc, -1)
    gap = ~inside
    return kept[~(gap & np.concatenate(([False], gap[:-1])))]


LEAK = "array<struct<item_id:bigint,coverage:double,tiles:int,words:int>>"
_LEAK_TYPE = pa.list_(
    pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.int32()), ("words", pa.int32())])
)


def different_items(benchmark: DataFrame, item_id: str, text: str) -> tuple[DataFrame, DataFrame | None]:
    """(item_id, text) of the different texts with a word, and (key, item_id) of all items.

    If no text repeats, there is no second table and the first has the items' own ids; else its
    ``item_id`` is a key of the text. Copies of one text, even if they make up a third of all items,
    are one row of the first table.
    """
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).filter(
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[\p{L}\p{N}_]+")) >= 1
    )
    counted = items.groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    if counted.filter("n > 1").isEmpty():
        return items, None
    texts = stored(counted.select("text", F.monotonically_increasing_id().alias("key")), "items")
    members = stored(items.join(texts, "text").select("key", "item_id"), "item-copies")
    return texts.select(F.col("key").alias("item_id"), "text"), members


def blocks(items: DataFrame, match: int, coverage: float, characters: int) -> Iterator[tuple[Block, bool]]:
    """The items in blocks of bounded size, and whether more blocks follow."""
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, math.ceil(1.5 * total / characters)) if total > characters else 1
    for n in range(count):
        part = items if count == 1 else items.filter(F.pmod(F.xxhash64("text"), F.lit(count)) == n)
        rows = part.orderBy("item_id", "text").collect()
        yield build([(r.item_id, r.text) for r in rows], match, coverage), n + 1 < count


def _leaks_of(block: Block, match: int, coverage: float):
    def batch(texts: Iterable[str]) -> pa.Array:
        return pa.array([leaks(t, block, match, coverage) for t in texts], _LEAK_TYPE)

    return per_text(batch, LEAK)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    match: int = MATCH,
    coverage: float = COVERAGE,
    block_characters: int = BLOCK_CHARACTERS,
) -> DataFrame:
    """One row per document and item it covers: doc_id, item_id, coverage, tiles, words.

    NULL and empty texts hold no seed and give no row; the same is true of items shorter than
    ``match`` words, which are no evidence. Repeated rows of either table count each. Other columns
    are ignored. An empty benchmark gives no rows.
    """
    items, members = different_items(benchmark, item_id, item_text)
    every = None
    for block, more in blocks(items, match, coverage, block_characters):
        found = docs.select(F.col(doc_id), F.explode(_leaks_of(block, match, coverage)(F.col(text))).alias("leak"))
        # Stored, so that no plan holds more than one block.
        found = found if every is None and not more else stored(found, "leaks")
        every = found if every is None else every.unionByName(found)
    rows = every.select(doc_id, "leak.item_id", "leak.coverage", "leak.tiles", "leak.words")
    if members is None:
        return rows
    by_key = rows.withColumnRenamed("item_id", "key").select(F.struct(doc_id).alias("doc"), "key", "coverage", "tiles", "words")
    return by_key.join(members, "key").select("doc.*", "item_id", "coverage", "tiles", "words")


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    match: int = MATCH,
    coverage: float = COVERAGE,
    block_characters: int = BLOCK_CHARACTERS,
) -> DataFrame:
    """The documents that cover no item, with their columns; no shuffle. Passes but the last are stored."""
    items, _ = different_items(benchmark, item_id, item_text)
    for block, more in blocks(items, match, coverage, block_characters):
        docs = docs.filter(F.size(_leaks_of(block, match, coverage)(F.col(text))) == 0)
        docs = stored(docs, "not-leaked") if more else docs
    return docs
