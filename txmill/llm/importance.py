"""Target-distribution importance resampling.

Texts are bags of hashed words and word pairs. A bucket's gain is the logarithm of how much likelier
the target makes it than the corpus, a document's weight the mean gain of its features, looked up
for all of them at once in an array. Gumbel noise that follows from the id makes the highest scores
a draw without replacement.

The cutoff is found without sorting the corpus: a mergeable quantile sketch proposes a bracket of
scores, exact counts outside it tell whether it holds the cutoff, wider brackets are tried until one
does, and only the rows inside are sorted. The features of both tables are counted in full.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txmill.llm.common import stored, whole

BUCKETS = 10_000
SEED = 7
MIN_WORDS = 20
SHARE_PERCENT = 25
#: Half widths of the brackets that are tried, as shares of all rows; the last holds everything.
BRACKETS = (0.002, 0.01, 0.05, 0.2, 1.0)
#: The sketch's quantiles are off by one in this number of rows at most.
ACCURACY = 10_000

# Bytes of UTF-8: digits, lower-case letters, and all of any character beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def features(text: str, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every word and every pair of neighbours."""
    words = _WORD.findall(text.encode("utf-8", "replace").lower())
    n = len(words)
    alone = list(map(zlib.crc32, words))
    # The checksum of a pair carries on from that of its first word and the space.
    pairs = map(zlib.crc32, words[1:], map(zlib.crc32, repeat(b" "), alone))
    found = np.empty(max(2 * n - 1, 0), np.int64)
    found[:n] = alone
    found[n:] = np.fromiter(pairs, np.int64, max(n - 1, 0))
    return n, found % buckets


def _counting(buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(features(text.as_py(), buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    return count


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all texts. A task returns at most one row per bucket, and so does the sum."""
    counted = texts.select(whole(text).alias("text")).mapInArrow(_counting(buckets), "bucket bigint, n bigint")
    total = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row.bucket] = row.n
    return total


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target and source shares, one added to every count, floored."""
    s_all, t_all, n = float(source.sum()), float(target.sum()), float(len(source))
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n))))
            for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist())
        ],
        np.int64,
    )


def _weighing(gains: np.ndarray):
    def weigh(texts):
        words, sizes, weights = [], [], []
        for text in texts:
            n, found = features(text.as_py(), len(gains))
            words.append(n)
            sizes.append(len(found))
            weights.append(int(gains[found].sum()) // len(found) if len(found) else 0)
        columns = [pa.array(c, pa.int64()) for c in (words, sizes, weights)]
        return pa.StructArray.from_arrays(columns, ["n_words", "n_features", "weight"])

    weigh.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(weigh, returnType="n_words bigint, n_features bigint, weight bigint")


def _noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the id; a NULL id counts as an empty one."""
    hexadecimal = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(hexadecimal, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.ln(-F.ln(uniform))).cast("long")


def scored(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    seed: int = SEED,
    whole_rows: bool = False,
) -> DataFrame:
    """One stored row per document: id, n_words, n_features, weight, score, tie (and row, if asked for).

    ``tie`` numbers the rows, so that rows alike in all else still have an order. Texts are read
    twice, for the counts and for the weights, and never moved. A NULL text has no features and
    weight 0; NULL ids draw the noise of an empty id.
    """
    gains = bucket_gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    columns = [docs[doc_id].alias("id"), _weighing(gains)(whole(docs[text])).alias("w")]
    if whole_rows:
        columns.append(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = docs.select(*columns).select("id", "w.*", *(["row"] if whole_rows else []))
    score = F.col("weight") + _noise(F.col("id"), seed)
    return stored(rows.withColumns({"score": score, "tie": F.monotonically_increasing_id()}), "scored")


def _place() -> Column:
    """Order of the draw: highest score, smallest id (NULL last), first row."""
    return F.struct((-F.col("score")).alias("s"), F.col("id").isNull().alias("n"), F.col("id"), F.col("tie"))


def _sorted(rows: DataFrame, name: str) -> DataFrame:
    """The rows in order of the draw, stored, with ``part`` and the ``number`` of each in its part.

    Ranges end at any row, so rows with one score or one id are spread as well.
    """
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("tie").asc()]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    kept = stored(ordered.withColumn("at", at), name)
    return kept.select(
        *rows.columns, F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("number")
    )


def _before(ordered: DataFrame) -> DataFrame:
    """part and the number of rows in the parts before it; one row per part of a shuffle."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    return parts.select("part", "rows", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))


def bracket(rows: DataFrame, wanted: int, total: int, widths: Iterable[float] = BRACKETS) -> tuple[int, int, int]:
    """Lowest and highest score of a bracket that holds the ``wanted``-th highest, and how many are above.

    All proposals come from one sketch; the counts are exact, so a poor sketch costs another count
    and never a wrong result.
    """
    at = 1 - wanted / total
    ends = [min(max(at + side * w, 0.0), 1.0) for w in widths for side in (-1, 1)]
    sketch = rows.agg(
        F.percentile_approx("score", ends, ACCURACY).alias("q"), F.min("score").alias("least"), F.max("score").alias("most")
    ).first()
    for low, high in [*zip(sketch.q[::2], sketch.q[1::2]), (sketch.least, sketch.most)]:
        counts = rows.agg(
            F.count_if(F.col("score") > high).alias("above"), F.count_if(F.col("score") >= low).alias("upto")
        ).first()
        if counts.above < wanted <= counts.upto:
            return low, high, counts.above
    raise AssertionError("the widest bracket holds all rows")


def cutoff(rows: DataFrame, wanted: int, total: int, widths: Iterable[float] = BRACKETS):
    """The row that is ``wanted``-th in order of the draw; only rows inside the bracket are sorted."""
    low, high, above = bracket(rows, wanted, total, widths)
    inside = rows.filter(F.col("score").between(low, high)).select("score", "id", "tie")
    ordered = _sorted(inside, "bracket")
    place = wanted - above - 1
    part = _before(ordered).filter((F.col("before") <= place) & (F.col("before") + F.col("rows") > place)).first()
    return ordered.filter((F.col("part") == part.part) & (F.col("number") == place - part.before)).first()


def drawn(
    rows: DataFrame, min_words: int = MIN_WORDS, share_percent: int = SHARE_PERCENT, widths: Iterable[float] = BRACKETS
) -> tuple[DataFrame, DataFrame]:
    """Rows of ``scored`` that are drawn, and all others."""
    able = F.col("n_words") >= min_words
    total = rows.filter(able).count()
    wanted = share_percent * total // 100
    if not wanted:
        return rows.limit(0), rows
    last = cutoff(rows.filter(able), wanted, total, widths)
    kind = rows.schema["id"].dataType
    limit = F.struct(
        F.lit(-last.score).cast("long").alias("s"), F.lit(last.id is None).alias("n"), F.lit(last.id).cast(kind).alias("id"), F.lit(last.tie).cast("long").alias("tie")
    )
    taken = able & (_place() <= limit)
    return rows.filter(taken), rows.filter(~taken)


def ranked(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    seed: int = SEED,
    min_words: int = MIN_WORDS,
    share_percent: int = SHARE_PERCENT,
    widths: Iterable[float] = BRACKETS,
) -> DataFrame:
    """One row per document: id, n_features, weight, score, rank (NULL if it is not drawn).

    Equal scores are ordered by id, NULL ids last; rows equal in both are all ranked, in any order.
    Other columns are ignored; an empty table gives no rows, and an empty target is a flat one.
    """
    rows = scored(docs, target, doc_id, text, target_text, buckets, seed)
    taken, rest = drawn(rows, min_words, share_percent, widths)
    ordered = _sorted(taken, "drawn")
    # One row per part of the shuffle.
    numbered = ordered.join(F.broadcast(_before(ordered)), "part")
    numbered = numbered.withColumn("rank", F.col("before") + F.col("number") + 1)
    both = numbered.unionByName(rest.withColumn("rank", F.lit(None).cast("long")), allowMissingColumns=True)
    return both.select(F.col("id").alias(doc_id), "n_features", "weight", "score", "rank")


def resampled(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that are drawn, with all their columns; options as in ``scored`` and ``drawn``."""
    scoring = {k: options.pop(k) for k in ("target_text", "buckets", "seed") if k in options}
    rows = scored(docs, target, doc_id, text, whole_rows=True, **scoring)
    return drawn(rows, **options)[0].select("row.*")
