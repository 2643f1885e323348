"""Packing into optimal length buckets.

Documents longer than the context are cut into pieces, so lengths have a bound and the histogram of
all lengths is small whatever the corpus. Dynamic programming over that histogram places the bucket
boundaries that need the least padding; each bucket then forms batches under a token budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txmill.llm.common import stored, whole

CONTEXT = 2048
BUCKETS = 16
TOKEN_BUDGET = 32_768
#: Pieces whose places in a bucket are counted in one task.
CELL_ROWS = 100_000


def words(text: Column | str) -> Column:
    """Length of a text in words, runs of anything but white space."""
    return F.regexp_count(whole(text), F.lit(r"[^\x20\x09-\x0D]+"))


def optimal_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding; ascending lengths.

    Padding of the lengths i..j in one bucket is length[j] times their number less their sum. It
    satisfies the quadrangle inequality, so the best cut moves forward only and each layer of the
    table is filled by halving: O(buckets * n * log n).
    """
    n = len(lengths)
    if n <= buckets:
        return [int(x) for x in lengths]
    number = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
    total = np.concatenate(([0], np.cumsum(counts * lengths, dtype=np.int64)))
    # least[j]: padding of the first j lengths in the buckets so far
    least = np.concatenate(([0], lengths * number[1:] - total[1:])).astype(np.int64)
    cuts = []
    for _ in range(buckets - 1):
        following, cut = least.copy(), np.zeros(n + 1, np.int64)
        waiting = [(1, n, 0, n)]
        while waiting:
            low, high, first, last = waiting.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(first, min(last, j - 1) + 1)
            cost = least[i] + lengths[j - 1] * (number[j] - number[i]) - (total[j] - total[i])
            at = int(cost.argmin())
            following[j], cut[j] = cost[at], i[at]
            waiting += [(low, j - 1, first, int(i[at])), (j + 1, high, int(i[at]), last)]
        least = following
        cuts.append(cut)
    bounds, j = [], n
    for cut in reversed(cuts):
        if j == 0:
            break
        bounds.append(int(lengths[j - 1]))
        j = int(cut[j])
    if j:
        bounds.append(int(lengths[j - 1]))
    return sorted(bounds)


def pieces(docs: DataFrame, doc_id: str, length: Column, context: int) -> DataFrame:
    """id, piece, start, n_tokens: a document in parts of at most ``context`` tokens.

    A document without tokens has one piece of length 0.
    """
    tokens = docs.select(F.col(doc_id).alias("id"), length.cast("long").alias("total"))
    last = F.greatest(F.floor((F.col("total") - 1) / context), F.lit(0)).cast("int")
    return tokens.select("id", "total", F.explode(F.sequence(F.lit(0), last)).alias("piece")).select(
        "id",
        "piece",
        (F.col("piece").cast("long") * context).alias("start"),
        F.least(F.col("total") - F.col("piece").cast("long") * context, F.lit(context)).alias("n_tokens"),
    )


def _cut(placed: DataFrame, cell_rows: int) -> DataFrame:
    """Adds ``cut``: 0, or the part of a cell that holds more than twice ``cell_rows`` rows."""
    full = stored(
        placed.groupBy("bucket", "cell")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 2 * cell_rows)
        .select("bucket", "cell", F.ceil(F.col("n") / cell_rows).cast("long").alias("cuts")),
        "full-cells",
    )
    if full.isEmpty():
        return placed.withColumn("cut", F.lit(0).cast("long"))
    # At most one row per 2 * cell_rows pieces, and none but for equal ones.
    joined = placed.join(full, ["bucket", "cell"], "left")
    cut = F.coalesce(F.pmod(F.xxhash64("tie"), F.col("cuts")), F.lit(0).cast("long"))
    return joined.withColumn("cut", cut).drop("cuts")


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    length: Column | None = None,
    context: int = CONTEXT,
    buckets: int = BUCKETS,
    budget: int = TOKEN_BUDGET,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """One row per piece: id, piece, start, n_tokens, bucket, batch, slot, padding.

    ``length`` is the number of tokens, by default of words in ``text``; NULL counts as 0.
    ``bucket`` is the length that its rows are padded to; a batch of a bucket holds as many rows as
    fit into ``budget`` tokens, at least one, and only the last one of a bucket may hold fewer.
    Places in a bucket follow a hash of the piece. They are counted per cell, a share of the bucket
    of about ``cell_rows``, and each cell starts where the cells before it end; so a bucket with a
    third of all rows is spread. A cell that equal rows fill beyond that is cut by the number of the
    stored row. Equal rows take neighbouring places or such cuts. No row is left out; an empty table
    gives no rows.
    """
    length = words("text") if length is None else F.coalesce(length, F.lit(0))
    numbered = pieces(docs, doc_id, length, context).withColumn("tie", F.monotonically_increasing_id())
    parts = stored(numbered, "pieces")
    # At most context + 1 rows, whatever the size of the corpus.
    histogram = sorted((r.n_tokens, r.n) for r in parts.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect())
    lengths = np.array([x for x, _ in histogram], np.int64)
    counts = np.array([n for _, n in histogram], np.int64)
    bounds = optimal_boundaries(lengths, counts, buckets)
    inside = np.searchsorted(bounds, lengths)
    rows_of = {b: int(counts[inside == k].sum()) for k, b in enumerate(bounds)}
    bucket = F.lit(None).cast("long")
    capacity = cells = F.lit(1).cast("long")
    for b in reversed(bounds):
        bucket = F.when(F.col("n_tokens") <= b, F.lit(b).cast("long")).otherwise(bucket)
        is_b = F.col("bucket") == b
        capacity = F.when(is_b, F.lit(max(1, budget // b) if b else max(1, budget)).cast("long")).otherwise(capacity)
        cells = F.when(is_b, F.lit(-(-rows_of[b] // cell_rows)).cast("long")).otherwise(cells)
    order = F.xxhash64("id", "piece", "n_tokens")
    placed = parts.withColumn("bucket", bucket).withColumn("order", order)
    placed = _cut(placed.withColumn("cell", F.pmod(F.col("order"), cells)), cell_rows)
    earlier = Window.partitionBy("bucket").orderBy("cell", "cut").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("bucket", "cell", "cut").agg(F.count(F.lit(1)).alias("n")).select(
        "bucket", "cell", "cut", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    in_cell = Window.partitionBy("bucket", "cell", "cut").orderBy("order", "id", "piece", "n_tokens", "tie")
    numbered = placed.withColumn("place", F.row_number().over(in_cell) - 1).join(starts, ["bucket", "cell", "cut"])
    place = F.col("before") + F.col("place")
    return numbered.select(
        F.col("id").alias(doc_id),
        "piece",
        "start",
        "n_tokens",
        "bucket",
        F.floor(place / capacity).cast("long").alias("batch"),
        (place % capacity).cast("long").alias("slot"),
        (F.col("bucket") - F.col("n_tokens")).alias("padding"),
    )
