"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint is eight bytes. If at most ``max_bits`` bits differ, at most as many bytes differ, so
two linked fingerprints share at least ``8 - max_bits`` bytes in place: the guaranteed minimum.

A posting list of a single positional byte would hold 1/256 of all fingerprints. So the index is
keyed by three positional bytes at once, for a set of triples that is chosen so that any four
positions contain one of them. Every pair that reaches the minimum meets under some key. There all
eight positional bytes are tallied, pairs below the minimum go, and the rest is verified by
counting the differing bits.

Only different fingerprints are indexed; copies share one. From a posting list a task returns links
that connect the same fingerprints as all its pairs would, at most one per fingerprint.

Comparing the pairs of a list takes the square of its length. A list above ``LONG`` is therefore
keyed once more: a pair that reaches the minimum shares one more positional byte, so the members of
a long list meet again under the list's key and each byte in the other positions, in lists 256 times
shorter. Only where more than ``LONG`` different fingerprints share the same four bytes or more,
which no text does by chance, pairs are found another way that is exact as well: two fingerprints
are within four bits if, and only if, some value is within two bits of both. Each fingerprint of
such a list lists the 2081 values within half of ``max_bits``, and those with a common value are
linked. No value has more than 2081 fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txmill.llm.common import per_text, stored

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BYTES = 8
#: Fingerprints of a posting list up to which it is compared as it is.
LONG = 8192
#: A fingerprint of more than one in this number of rows is hot; there are fewer such than this number.
HOT = 1000
_SHINGLES_AT_ONCE = 8192


def fingerprint(text: str) -> int:
    """SimHash of a text's word shingles as a signed 64-bit integer; 0 if there are no words."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(words) - SHINGLE + 1, 1)
    spans = list(zip(starts[:last].tolist(), ends[min(SHINGLE, len(words)) - 1 :].tolist()))
    ones = np.zeros(64, np.int64)
    for at in range(0, last, _SHINGLES_AT_ONCE):
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans[at : at + _SHINGLES_AT_ONCE]]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, BYTES)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > last, bitorder="little").view("<i8")[0])


def _fingerprints(texts: Iterable[str]) -> pa.Array:
    return pa.array([fingerprint(t) for t in texts], pa.int64())


def fingerprint_of(text: Column | str) -> Column:
    """Fingerprint column; a NULL text has that of an empty one."""
    return per_text(_fingerprints, "bigint")(text)


def hexadecimal(value: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def index_triples(minimum: int) -> list[tuple[int, ...]]:
    """Triples of byte positions such that any ``minimum`` positions contain one of them.

    For four or more: positions are dealt into three classes, and a triple is taken if it lies in
    one class, or has two positions in one class and one in the next. That makes 20 of the 56.
    """
    if minimum < 3:
        raise ValueError("max_bits above 5 would need keys of fewer than three bytes")
    every = list(combinations(range(BYTES), 3))
    if minimum == 3:
        return every

    def taken(triple: tuple[int, ...]) -> bool:
        count = [sum(p % 3 == c for p in triple) for c in range(3)]
        return 3 in count or any(count[c] == 2 and count[(c + 1) % 3] == 1 for c in range(3))

    return [t for t in every if taken(t)]


def _postings(prints: DataFrame, minimum: int) -> DataFrame:
    octet = [F.shiftrightunsigned(F.col("fp"), 8 * p).bitwiseAND(F.lit(255)) for p in range(BYTES)]
    keys = [
        F.lit(n << 24) + F.shiftleft(octet[a], 16) + F.shiftleft(octet[b], 8) + octet[c]
        for n, (a, b, c) in enumerate(index_triples(minimum))
    ]
    return prints.select("fp", F.explode(F.array(*keys)).alias("key"))


def _connect(group: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside sorted groups: for each row but the first of a connected set, one to the first."""
    n = len(group)
    change = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    left = np.repeat(np.append(change[1:], n), np.diff(np.append(change, n))) - np.arange(n) - 1
    label = np.arange(n)
    near = np.flatnonzero(left >= 1)
    step = 1
    while len(near):
        a, b = near, near + step
        differing = prints[a] ^ prints[b]
        shared = (differing.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
        linked = (shared >= BYTES - max_bits) & (np.bitwise_count(differing) <= max_bits)
        linked &= label[a] != label[b]
        a, b = a[linked], b[linked]
        while len(a):
            low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
            target = np.arange(n)
            np.minimum.at(target, high, low)
            while (target != target[target]).any():
                target = target[target]
            label = target[label]
            apart = label[a] != label[b]
            a, b = a[apart], b[apart]
        step += 1
        near = near[left[near] >= step]
    rest = np.flatnonzero(label != np.arange(n))
    return prints[rest], prints[label[rest]]


def _links_of_lists(max_bits: int):
    """Arrow function over rows sorted by ``key``: holds one batch and the list at its end."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = np.empty(0, np.int64), np.empty(0, np.uint64)

        def found(upto: int) -> pa.RecordBatch:
            ends = _connect(keys[:upto], prints[:upto], max_bits)
            return pa.RecordBatch.from_arrays([pa.array(e.view(np.int64)) for e in ends], ["u", "v"])

        for batch in batches:
            keys = np.concatenate((keys, batch.column("key").to_numpy()))
            prints = np.concatenate((prints, batch.column("fp").to_numpy().view(np.uint64)))
            done = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if done:
                yield found(done)
                keys, prints = keys[done:], prints[done:]
        if len(keys):
            yield found(len(keys))

    return links


def _short_links(index: DataFrame, max_bits: int) -> DataFrame:
    ordered = index.repartition("key").sortWithinPartitions("key", "fp")
    return ordered.mapInArrow(_links_of_lists(max_bits), "u bigint, v bigint")


def _flips(bits: int) -> Column:
    """All values with at most ``bits`` of 64 bits set."""
    values = [0]
    layer = [0]
    for _ in range(bits):
        layer = [v | 1 << b for v in layer for b in range(v.bit_length(), 64)]
        values += layer
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    return F.from_json(F.lit(str(signed)), "array<bigint>")


def _long_links(prints: DataFrame, max_bits: int) -> DataFrame:
    """If ``max_bits`` is odd, one side may be a bit further from the common value than the other."""
    near, far = _flips(max_bits // 2), _flips(max_bits - max_bits // 2)
    meeting = prints.select("fp", F.explode(near).alias("flip"), F.lit(True).alias("near"))
    if max_bits % 2:
        meeting = meeting.unionByName(
            prints.select("fp", F.explode(far).alias("flip"), F.lit(False).alias("near"))
        )
    # At most one fingerprint per flip shares a value, so no group is larger than their number.
    value = Window.partitionBy("value")
    met = meeting.select("fp", "near", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
    least = met.withColumn("v", F.min(F.when(F.col("near"), F.col("fp"))).over(value))
    return least.filter("fp <> v").select(F.col("fp").alias("u"), "v").distinct()


def _finer(index: DataFrame, minimum: int) -> DataFrame:
    """Members of long lists under the list's key, one further position, and the byte there."""
    triples = index_triples(minimum)
    number = F.shiftright("key", 24).cast("int")
    others = F.array(*[F.array(*[F.lit(p) for p in range(BYTES) if p not in t]) for t in triples])
    octet = F.array(*[F.shiftrightunsigned(F.col("fp"), 8 * p).bitwiseAND(F.lit(255)) for p in range(BYTES)])
    keys = F.transform(
        F.get(others, number), lambda p: F.col("key") * 2048 + p * 256 + F.get(octet, p)
    )
    return index.select("fp", F.explode(keys).alias("key"))


def _by_length(index: DataFrame, long: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the lists of at most ``long`` members, and those of the others if there are any."""
    long_keys = stored(
        index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > long).select("key"),
        "long-lists",
    )
    short = index.join(long_keys, "key", "left_anti")
    return short, None if long_keys.isEmpty() else index.join(long_keys, "key", "left_semi")


def links(prints: DataFrame, max_bits: int = MAX_BITS, long: int = LONG) -> DataFrame:
    """Links (u, v) between different fingerprints ``fp`` that connect all within ``max_bits`` bits."""
    minimum = BYTES - max_bits
    short, crowded = _by_length(_postings(prints, minimum).withColumn("key", F.col("key").cast("long")), long)
    found = _short_links(short, max_bits)
    if crowded is not None and minimum > 3:
        short, crowded = _by_length(_finer(crowded, minimum), long)
        found = found.unionByName(_short_links(short, max_bits))
    if crowded is not None:
        found = found.unionByName(_long_links(crowded.select("fp").distinct(), max_bits))
    return found


def components(edges: DataFrame) -> DataFrame:
    """Columns node and label: every node of an edge, and the smallest node it is connected with.

    Alternates two steps until nothing changes: each node's larger neighbours are linked to the
    smallest neighbour, then each node's smaller ones. Only minima per node are aggregated. The
    edges of every round are stored, so that a lost executor costs one round at most.
    """
    ordered = edges.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    current, state = stored(ordered.distinct(), "links"), None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("a"), F.col("u").alias("b"), "m")
        small = small.select("a", "m").union(small.select("b", "m")).toDF("u", "v").filter("u <> v")
        current = stored(small.distinct(), "links")
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1 << 31))).first()
        if now == state:
            break
        state = now
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def _component_of_print(prints: DataFrame, max_bits: int) -> DataFrame:
    """From (id, fp) rows: fp, n (its rows), first (its smallest id) and component_id, the smallest id
    that its links reach."""
    first = stored(
        prints.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")), "fingerprints"
    )
    label = components(links(first.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    linked = label.join(first, "fp")
    smallest = linked.groupBy("label").agg(F.min("first").alias("smallest"))
    joined = linked.select("fp", "label").join(smallest, "label").select("fp", "smallest")
    return first.join(joined, "fp", "left").select(
        "fp", "n", "first", F.coalesce("smallest", "first").alias("component_id")
    )


def _members(prints: DataFrame, max_bits: int, hot: int) -> DataFrame:
    """id, fp, component_id of every (id, fp) row.

    The rows of a hot fingerprint stay where they are: fewer than ``hot`` fingerprints hold more than
    one in ``hot`` rows, and these are sent to all tasks. All others meet their component by a shuffle.
    """
    found = stored(_component_of_print(prints, max_bits), "components")
    total = found.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * hot > total
    few, many = (found.filter(c).select("fp", "component_id") for c in (is_hot, ~is_hot))
    few = F.broadcast(few)
    rest = prints.join(few, "fp", "left_anti").join(many, "fp")
    return prints.join(few, "fp").unionByName(rest)


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    max_bits: int = MAX_BITS,
    hot: int = HOT,
) -> DataFrame:
    """One row per document: its id, fingerprint (16 hex digits), component_id.

    A NULL text is an empty one and has fingerprint zero, which links like any other. NULL ids are
    never the smallest unless a component has no other. Repeated rows are all returned. Other
    columns are ignored; an empty table gives no rows. The result does not depend on ``hot``.
    """
    prints = stored(docs.select(F.col(doc_id).alias("id"), fingerprint_of(text).alias("fp")), "prints")
    found = _members(prints, max_bits, hot)
    return found.select(F.col("id").alias(doc_id), hexadecimal("fp").alias("fingerprint"), "component_id")


def drop_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """The document with the smallest id of every component, with all its columns; of equal ids, one.

    Rows are stored with their fingerprint and a number of their own, so a fingerprint is computed
    once. Its smallest row stands for it, and the row that a component's id and number name is kept:
    a join by that number, which spreads a large component over all tasks. NULL ids come last.
    """
    rows = stored(
        docs.select(
            F.struct(*[docs[c] for c in docs.columns]).alias("row"),
            docs[doc_id].alias("id"),
            fingerprint_of(docs[text]).alias("fp"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "near-rows",
    )
    name = F.struct(F.col("id").isNull().alias("missing"), F.col("id"), F.col("number"))
    found = _component_of_print(rows.select(name.alias("id"), "fp"), max_bits)
    kept = found.filter(F.col("first") == F.col("component_id")).select(F.col("first.number").alias("number"))
    return rows.join(kept, "number").select("row.*")
