"""Best-fit packing by patterns: documents to as few sequences of bounded length as possible.

Texts are encoded where they are and cut into pieces of at most ``context`` tokens. The histogram of
piece lengths, which the context bounds, is all that the plan needs (see ``patterns``). Which piece
takes which place does not matter to the plan, so pieces of a length are numbered by task and by
order in the task, which needs no sort: a task counts its own, and the counts of earlier tasks are
added. A piece finds its sequence and offset by its number in the plan.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txmill.llm.common import stored, whole
from txmill.llm.patterns import Pattern, plan
from txmill.llm.word_ids import space_free_encoder

CONTEXT = 2048
END_ID = 0
#: Pieces of one length and task that meet their first number together.
CELL = 256
#: A task hands over rows when their ids fill so many bytes.
_BYTES_AT_ONCE = 1 << 23


def _cutting(path: str, context: int, end_id: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = space_free_encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        shard, seen = TaskContext.get().partitionId(), [0] * (context + 1)
        for batch in batches:
            ids, texts = batch.column("id"), batch.column("text")
            rows, held = [], 0

            def closed() -> pa.RecordBatch:
                at, piece, start, length, nth, data = zip(*rows)
                columns = [
                    ids.take(pa.array(at, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(data, pa.binary()),
                    pa.array([shard] * len(rows), pa.int32()),
                    pa.array(nth, pa.int64()),
                ]
                return pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids", "shard", "nth"])

            for at, text in enumerate(texts):
                code = codes.encode(text.as_py()) + end
                for piece, first in enumerate(range(0, len(code), 4 * context)):
                    part = code[first : first + 4 * context]
                    length = len(part) // 4
                    rows.append((at, piece, first // 4, length, seen[length], part))
                    seen[length] += 1
                    held += len(part)
                    if held >= _BYTES_AT_ONCE:
                        yield closed()
                        rows, held = [], 0
            if rows:
                yield closed()

    return cut


def pieces(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    context: int = CONTEXT,
    end_id: int = END_ID,
) -> DataFrame:
    """One stored row per piece: id, piece, start, length, ids (little-endian uint32), shard, nth.

    ``end_id`` follows the ids of each text; only documents that are longer with it are cut. A NULL
    text is empty and one piece of the end id alone. ``shard`` is the task and ``nth`` the number of
    the piece among those of its length there; no two rows have both and the length in common.
    ``tokenizer`` is the path of a file that every executor has. No row is moved.
    """
    rows = docs.select(F.col(doc_id).alias("id"), whole(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids binary, shard int, nth bigint"
    return stored(rows.mapInArrow(_cutting(tokenizer, context, end_id), schema), "pieces", compression="zstd")


class Places:
    """The plan as arrays: pieces are numbered by length, then by their number within it."""

    def __init__(self, patterns: Sequence[Pattern], histogram: np.ndarray) -> None:
        entries, base = [], 0
        for repeats, parts in patterns:
            offset = 0
            for length, times in parts:
                entries.append((length, repeats * times, base, times, offset))
                offset += length * times
            base += repeats
        table = np.array(sorted(entries), np.int64).reshape(-1, 5)
        self.length, number, self.base, self.times, self.offset = table.T.copy()
        self.first = np.cumsum(number) - number
        self.start = np.cumsum(histogram) - histogram

    def of(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these numbers among those of their length."""
        place = self.start[length] + number
        at = np.searchsorted(self.first, place, "right") - 1
        inside = place - self.first[at]
        return self.base[at] + inside // self.times[at], self.offset[at] + inside % self.times[at] * self.length[at]


def _placing(places: Places):
    def place(lengths, numbers):
        found = places.of(lengths.to_numpy(zero_copy_only=False), numbers.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], ["sequence_id", "offset"])

    place.__annotations__ = {"lengths": pa.Array, "numbers": pa.Array, "return": pa.Array}
    return F.arrow_udf(place, returnType="sequence_id bigint, offset bigint")


def packed(parts: DataFrame, context: int = CONTEXT, cell: int = CELL) -> DataFrame:
    """Rows of ``pieces``, with any columns beside length, shard and nth, and sequence_id and offset.

    Sequences are filled from offset 0 without gaps. Only counts per task and length are ordered. A
    task's pieces of one length meet their first number in cells of ``cell``, so copies of one
    document, which share a length, are spread. An empty table gives no rows.
    """
    counts = stored(parts.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = np.zeros(context + 1, np.int64)
    # At most one row per length.
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row.length] = row.n
    places = Places(plan(histogram, context), histogram)
    earlier = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    cells = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / cell).cast("long"))
    before = before.select("length", "shard", "before", F.explode(cells).alias("cell"))
    numbered = parts.withColumn("cell", F.floor(F.col("nth") / cell).cast("long")).join(
        before, ["length", "shard", "cell"]
    )
    place = _placing(places)("length", F.col("before") + F.col("nth"))
    kept = [c for c in parts.columns if c not in ("shard", "nth")]
    return numbered.select(*kept, place.alias("place")).select(*kept, "place.sequence_id", "place.offset")


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens and ids of every sequence, from ``packed`` rows with their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", context: int = CONTEXT) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    NULL ids and repeated rows are packed like any other; other columns are ignored.
    """
    parts = pieces(docs, tokenizer, doc_id, text, context)
    narrow = parts.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packed(narrow, context).select(
        F.col("id").alias(doc_id), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
