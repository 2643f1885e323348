"""Token ids in packed binary files, and their reading with numpy.

A file is a row of blocks. Each block holds whole documents in order and stands alone:

    magic (8 bytes) | shard, block, documents, width (4 x uint32) | ids (uint64)
    document ids (int64 each) | first id of each document in the block (uint64, one more than documents)
    ids of ``width`` bits each, packed without gaps, lowest bit first

and ends with a fixed mark. Since all ids have one width, id n starts at bit n * width, so a
document is unpacked without reading what stands before it. ``width`` is the smallest that holds
the vocabulary. Shards and blocks are numbered in the order of the document ids.

Spark writes the blocks: its text writer puts out the bytes it is given, with the mark as record
separator, on any file system and with its usual commit.
"""

from __future__ import annotations

import json
import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txmill.llm.common import stored, whole
from txmill.llm.word_ids import BYTE_LEVEL, Words, load, special_strings

MAGIC = b"TXTOKEN1"
MARK = "\n#end of block#\n"
_HEAD = struct.Struct("<8s4IQ")
END_ID = 0
#: A block closes when it has this many ids, a file when it has this many blocks.
BLOCK_IDS = 1 << 17
FILE_BLOCKS = 64

_encoders: dict[str, "Encoder"] = {}


def width_of(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids of ``width`` bits each, lowest bit first, filled up to a whole byte."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if width % 8 == 0:
        return octets[:, : width // 8].tobytes()
    bits = np.unpackbits(octets, axis=1, bitorder="little", count=width)
    return np.packbits(bits, bitorder="little").tobytes()


def unpack(data: bytes | memoryview, width: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from id number ``start`` on, without touching earlier bytes."""
    first, last = start * width // 8, -(-(start + count) * width // 8)
    octets = np.frombuffer(data, np.uint8)[first:last]
    out = np.zeros((count, 4), np.uint8)
    if width % 8 == 0:
        out[:, : width // 8] = octets.reshape(count, width // 8)
    else:
        skip = start * width - 8 * first
        bits = np.unpackbits(octets, bitorder="little")[skip : skip + count * width]
        packed = np.packbits(bits.reshape(count, width), axis=1, bitorder="little")
        out[:, : packed.shape[1]] = packed
    return out.reshape(-1).view("<u4")


class Encoder:
    """Byte-level BPE that remembers the ids of words.

    Its pre-tokeniser never joins anything across a single space between two other characters, so
    a text with uncommon characters is cut there. Texts with a special token's string, and
    tokenizers of another kind, are encoded whole.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = load(path)
        self.special = special_strings(self.tokenizer)
        pre = json.loads(self.tokenizer.to_str()).get("pre_tokenizer") or {}
        self.by_words = (
            self.tokenizer.normalizer is None
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex") is True
            and pre.get("add_prefix_space") is False
        )
        self.words = Words(self.tokenizer, BYTE_LEVEL, lower=False)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)

    def encode(self, text: str) -> bytes:
        """Ids of the text as little-endian unsigned 32-bit integers."""
        if not self.by_words or any(s in text for s in self.special):
            return self.words.whole(text)
        return self.words.encode(text, _cut)


def _cut(text: str) -> list[str]:
    pieces = text.split(" ")
    if _loose(text):
        pieces = _joined(pieces)
    return [pieces[0], *(f" {p}" for p in pieces[1:])]


_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c != " ")


def _loose(text: str) -> bool:
    """Whether a space stands beside white space or at an end of the text."""
    return (
        text[:1] == " "
        or text[-1:] == " "
        or "  " in text
        or any(c in text and (f"{c} " in text or f" {c}" in text) for c in _SPACES)
    )


def _joined(pieces: list[str]) -> list[str]:
    """Put the space back where one of its neighbours is white space or missing."""
    out = [pieces[0]]
    for piece in pieces[1:]:
        before = out[-1]
        if before and piece and not before[-1].isspace() and not piece[0].isspace():
            out.append(piece)
        else:
            out[-1] = f"{before} {piece}"
    return out


def encoder(path: str) -> Encoder:
    """One per worker and path."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def block_bytes(shard: int, number: int, doc_ids: list[int], sizes: list[int], ids: bytes, width: int) -> bytes:
    starts = np.concatenate(([0], np.cumsum(sizes))).astype("<u8")
    values = np.frombuffer(ids, "<u4")
    head = _HEAD.pack(MAGIC, shard, number, len(doc_ids), width, len(values))
    return head + np.array(doc_ids, "<i8").tobytes() + starts.tobytes() + pack(values, width)


def _write(path: str, block_ids: int, end_id: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoder(path)
        width = width_of(max(codes.size, end_id + 1))
        end = np.array([end_id], "<u4").tobytes()
        shard, number = TaskContext.get().partitionId(), 0
        doc_ids, sizes, ids, held = [], [], [], 0

        def closed() -> pa.RecordBatch:
            data = block_bytes(shard, number, doc_ids, sizes, b"".join(ids), width)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["value"])

        for batch in batches:
            for doc_id, text in zip(batch.column("id"), batch.column("text")):
                code = codes.encode(text.as_py() or "") + end
                doc_ids.append(_NULL_ID if doc_id.as_py() is None else doc_id.as_py())
                sizes.append(len(code) // 4)
                ids.append(code)
                held += sizes[-1]
                if held >= block_ids:
                    yield closed()
                    number, doc_ids, sizes, ids, held = number + 1, [], [], [], 0
        if doc_ids:
            yield closed()

    return blocks


#: Stands for a NULL id in a file.
_NULL_ID = -(1 << 63)


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode every text, append ``end_id``, and write files in ascending order of the id.

    Texts are range-partitioned by id before they are encoded, ties by a hash of the text, so equal
    ids do not pile up. ``tokenizer`` is the path of a tokenizer file that every executor has. A
    NULL text is empty and has the end id only; NULL ids come first. Other columns are ignored; an
    empty table gives no blocks.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), whole(text).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text")
    blocks = ordered.select("id", "text").mapInArrow(_write(tokenizer, block_ids, end_id), "value binary")
    blocks.select(F.col("value").cast("string")).write.option("lineSep", MARK).option(
        "maxRecordsPerFile", FILE_BLOCKS
    ).text(path)


def parse(data: bytes) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int, memoryview]]:
    """shard, block, document ids, starts, width and packed ids of each block of a file."""
    view, at, mark = memoryview(data), 0, MARK.encode()
    while at < len(data):
        magic, shard, number, documents, width, count = _HEAD.unpack_from(view, at)
        if magic != MAGIC:
            raise ValueError(f"no block at byte {at}")
        at += _HEAD.size
        doc_ids = np.frombuffer(view, "<i8", documents, at)
        at += 8 * documents
        starts = np.frombuffer(view, "<u8", documents + 1, at).astype(np.int64)
        at += 8 * (documents + 1)
        size = math.ceil(count * width / 8)
        yield shard, number, doc_ids, starts, width, view[at : at + size]
        at += size
        if view[at : at + len(mark)] != mark:
            raise ValueError(f"block without its mark at byte {at}")
        at += len(mark)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            for shard, number, doc_ids, starts, width, packed in parse(content.as_py()):
                crc = [
                    zlib.crc32(unpack(packed, width, a, b - a).tobytes())
                    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())
                ]
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, shard, np.int64)),
                        pa.array(np.full(n, number, np.int64)),
                        pa.array(np.arange(n)),
                        pa.array(doc_ids, pa.int64(), mask=doc_ids == _NULL_ID),
                        pa.array(np.diff(starts)),
                        pa.array(crc, pa.int64()),
                    ],
                    ["shard", "block", "place", "id", "n_tokens", "ids_crc32"],
                )


def read(spark: SparkSession, path: str, doc_id: str = "doc_id") -> DataFrame:
    """Per document: id, start, n_tokens, ids_crc32, all from the files in ``path``.

    ``start`` is the number of ids before the document: those of earlier shards, from one row per
    shard, and those before it in its shard, which holds what one task wrote.
    """
    schema = "shard bigint, block bigint, place bigint, id bigint, n_tokens bigint, ids_crc32 bigint"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    found = stored(files.select("content").mapInArrow(_read, schema), "token-index")
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = found.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("shard").orderBy("block", "place").rowsBetween(Window.unboundedPreceding, -1)
    placed = found.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return placed.join(shards, "shard").select(
        F.col("id").alias(doc_id), (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
