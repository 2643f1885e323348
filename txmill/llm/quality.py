"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed from the whole text where the text is. Only the sample that the trees are
fitted on goes to the driver: at most ``SAMPLE`` labelled documents, those whose id hashes lowest.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txmill.llm import boosting
from txmill.llm.boosting import Forest
from txmill.llm.common import held_out, per_text

#: Bound of the labelled documents that the trees are fitted on.
SAMPLE = 20_000
ACCEPT = 0.3

_SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~"
_STOPS = b".,;:!?"


def _marks(characters: bytes) -> np.ndarray:
    marks = np.zeros(256, np.int64)
    marks[list(characters)] = 1
    return marks


_CLASSES = np.stack(
    [
        _marks(b" \t\n\v\f\r"),
        _marks(b"\n"),
        _marks(b"0123456789"),
        _marks(bytes(range(65, 91))),
        _marks(bytes(range(97, 123))),
        _marks(_STOPS),
        _marks(b"!"),
        _marks(_SYMBOLS),
        _marks(b"|"),
        _marks(b"\"'()-"),
        _marks(bytes(range(128, 256))),
    ]
)


def statistics(text: str) -> list[float]:
    """Numbers that describe a text. An empty one has one empty line and no words."""
    data = text.encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size = max(len(data), 1)
    shares = (_CLASSES @ counts) / size
    used = counts[counts > 0] / size
    words = text.split()
    n = max(len(words), 1)
    tally = Counter(words)
    lines = text.split("\n")
    pairs = max(len(words) - 1, 1)
    letters = (counts[65:91].sum() + counts[97:123].sum()) or 1
    top = tally.most_common(1)[0][1] if words else 0
    return [
        np.log1p(len(data)),
        np.log1p(len(words)),
        *shares,
        float(-(used * np.log2(used)).sum()) if len(used) else 0.0,
        counts[65:91].sum() / letters,
        (size - shares[0] * size) / n,
        max(map(len, tally), default=0),
        len(tally) / n,
        top / n,
        sum(c for c in tally.values() if c == 1) / n,
        sum(map(eq, words, words[1:])) / pairs,
        len(set(zip(words, words[1:]))) / pairs if len(words) > 1 else 0.0,
        sum(1 for w in tally if len(w) == 1) / n,
        len(set(lines)) / len(lines),
        len(lines) / n,
        len(data) / len(lines),
    ]


def _matrix(texts: Iterable[str]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], dtype=float)


def statistics_of(text: Column | str) -> Column:
    def batch(texts: Iterable[str]) -> pa.Array:
        return pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))

    return per_text(batch, "array<double>")(text)


def score_of(model: Forest, text: Column | str) -> Column:
    """Score in [0, 1], higher if label 1 is likelier. Empty and NULL texts get one as well."""

    def batch(texts: Iterable[str]) -> pa.Array:
        rows = _matrix(texts)
        return pa.array(model.score(rows) if len(rows) else [], pa.float64())

    return per_text(batch, "double")(text)


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
) -> Forest:
    """Fit on labelled documents that are not held out.

    A label other than 0 or 1, or of a NULL id, is left out; a repeated label counts once and
    contradicting ones both count. Without any usable label every score is 0.5. Language, source
    and id are not used. The result depends on the rows only, not on their layout.
    """
    chosen = (
        labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y"))
        .filter(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out("id"))
        .distinct()
        .orderBy(F.xxhash64("id"), "id", "y")
        .limit(sample)
    )
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    # The sample has at most ``sample`` rows of two numbers, whatever the size of the tables.
    sampled = rows.join(F.broadcast(chosen), "id").select("id", "y", statistics_of("text").alias("x"))
    found = sorted((r.id, r.y, tuple(r.x)) for r in sampled.orderBy(F.xxhash64("id"), "id", "y").limit(sample).collect())
    return boosting.fit(np.array([r[2] for r in found], dtype=float), np.array([r[1] for r in found], dtype=float))


def scored(docs: DataFrame, model: Forest, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row; no shuffle. A NULL id is not held out."""
    return docs.select(
        F.col(doc_id), held_out(doc_id).alias("held_out"), score_of(model, text).alias("score")
    ).withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def accepted(docs: DataFrame, model: Forest, text: str = "text") -> DataFrame:
    """The documents whose score is at least ``ACCEPT``, with their columns; no shuffle."""
    return docs.filter(score_of(model, text) >= ACCEPT)
