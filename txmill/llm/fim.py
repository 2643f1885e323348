"""Fill-in-the-middle transformation on a piece table.

A document is a row of descriptors (buffer, start, end) over two buffers that never change: its
text and the sentinels. Cutting splits a descriptor, an arrangement is a permutation of them, and
the inverse permutation puts them back. Text is copied only where an output is written, and digests
take the pieces one after the other.

Positions are bytes of UTF-8. A cut is always at the end of a token, so it never parts a character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txmill.llm.common import whole

SEED = 42
FIM_PERCENT = 50
SPM_PERCENT = 80
#: Sentinels of prefix, middle and suffix.
SENTINELS = ("<P>", "<M>", "<S>")

#: Order of (sentinel, part) descriptors of a cut document: prefix 0 1, middle 2 3, suffix 4 5.
ARRANGEMENTS = {"psm": (0, 1, 4, 5, 2, 3), "spm": (4, 5, 0, 1, 2, 3)}

TEXT, MARKS = 0, 1
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


class Piece(NamedTuple):
    """A stretch of one of the buffers."""

    buffer: int
    start: int
    end: int


Buffers = Sequence[memoryview]


def split(pieces: list[Piece], at: int) -> list[Piece]:
    """The same content with a boundary at offset ``at``; an empty piece may arise at an end."""
    before = 0
    for k, p in enumerate(pieces):
        size = p.end - p.start
        if at <= before + size:
            middle = p.start + at - before
            return [*pieces[:k], p._replace(end=middle), p._replace(start=middle), *pieces[k + 1 :]]
        before += size
    raise ValueError(f"no offset {at}")


def permuted(pieces: Sequence[Piece], order: Sequence[int]) -> list[Piece]:
    return [pieces[k] for k in order]


def inverse(order: Sequence[int]) -> list[int]:
    return [int(k) for k in np.argsort(order)]


def content(pieces: Iterable[Piece], buffers: Buffers) -> bytes:
    return b"".join(buffers[p.buffer][p.start : p.end] for p in pieces)


def digest(pieces: Iterable[Piece], buffers: Buffers) -> str:
    """SHA-256 of the content, piece by piece, without joining it."""
    state = hashlib.sha256()
    for p in pieces:
        state.update(buffers[p.buffer][p.start : p.end])
    return state.hexdigest()


def code_points(pieces: Iterable[Piece], buffers: Buffers) -> int:
    """Characters: bytes that do not continue one."""
    parts = [np.frombuffer(buffers[p.buffer][p.start : p.end], np.uint8) for p in pieces]
    return sum(int(np.count_nonzero((x & 0xC0) != 0x80)) for x in parts)


def token_ends(data: bytes) -> np.ndarray:
    """Ends of the tokens: white space with the word after it; white space at the end is one more."""
    space = _SPACE[np.frombuffer(data, np.uint8)]
    if not len(space):
        return np.empty(0, np.int64)
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.append(ends, len(space))


def _marks(sentinels: Sequence[str]) -> tuple[bytes, list[Piece]]:
    marks = [s.encode() for s in sentinels]
    ends = np.cumsum([0, *map(len, marks)]).tolist()
    return b"".join(marks), [Piece(MARKS, a, b) for a, b in zip(ends, ends[1:])]


def cut(size: int, first: int, second: int, marks: Sequence[Piece]) -> list[Piece]:
    """Six descriptors in document order: each of prefix, middle and suffix after its sentinel."""
    low, high = sorted((first, second))
    prefix, middle, suffix = split(split([Piece(TEXT, 0, size)], low), high)[-3:]
    return [marks[0], prefix, marks[1], middle, marks[2], suffix]


def restored(output: bytes, form: str, sentinels: Sequence[str] = SENTINELS) -> list[Piece]:
    """Descriptors over ``output`` alone that spell the document's text."""
    if form == "plain":
        return [Piece(TEXT, 0, len(output))]
    order = ARRANGEMENTS[form]
    marks = [s.encode() for s in sentinels]
    pieces, at = [], 0
    stands = [k // 2 for k in order[::2]]
    for this, following in zip(stands, [*stands[1:], None]):
        if not output.startswith(marks[this], at):
            raise ValueError(f"no sentinel {sentinels[this]} at byte {at}")
        start = at + len(marks[this])
        at = len(output) if following is None else output.find(marks[following], start)
        if at < 0:
            raise ValueError(f"no sentinel {sentinels[following]}")
        pieces += [Piece(TEXT, start - len(marks[this]), start), Piece(TEXT, start, at)]
    return permuted(pieces, inverse(order))[1::2]


def rearranged(
    data: bytes, draws: Sequence[int], fim_percent: int, spm_percent: int, sentinels: Sequence[str]
) -> tuple[int, str, list[Piece], bytes]:
    """Number of tokens, form, descriptors of the output, and the sentinel buffer."""
    buffer, marks = _marks(sentinels)
    ends = token_ends(data)
    n = len(ends)
    taken = any(s.encode() in data for s in sentinels)
    if not data or taken or draws[2] % 100 >= fim_percent:
        return n, "plain", [Piece(TEXT, 0, len(data))], buffer
    form = "spm" if draws[3] % 100 < spm_percent else "psm"
    first, second = (int(ends[k - 1]) if k else 0 for k in (d % (n + 1) for d in draws[:2]))
    return n, form, permuted(cut(len(data), first, second, marks), ARRANGEMENTS[form]), buffer


def _transforming(fim_percent: int, spm_percent: int, sentinels: Sequence[str]):
    def transform_batch(texts, draws):
        n, form, prefix, middle, output, sha, back_sha = [], [], [], [], [], [], []
        for text, drawn in zip(texts, draws):
            data = text.as_py().encode("utf-8", "replace")
            count, kind, pieces, marks = rearranged(data, drawn.as_py(), fim_percent, spm_percent, sentinels)
            buffers = (memoryview(data), memoryview(marks))
            back = permuted(pieces, inverse(ARRANGEMENTS[kind])) if kind != "plain" else None
            n.append(count)
            form.append(kind)
            prefix.append(code_points(back[1:2], buffers) if back else None)
            middle.append(code_points(back[3:4], buffers) if back else None)
            sha.append(digest(pieces, buffers))
            written = content(pieces, buffers)
            output.append(written.decode())
            back_sha.append(digest(restored(written, kind, sentinels), (memoryview(written),)))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
        columns = [pa.array(c, k) for c, k in zip((n, form, prefix, middle, output, sha, back_sha), kinds)]
        return pa.StructArray.from_arrays(columns, _FIELDS)

    transform_batch.__annotations__ = {"texts": pa.Array, "draws": pa.Array, "return": pa.Array}
    returns = (
        "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string, "
        "output_sha256 string, restored_sha256 string"
    )
    return F.arrow_udf(transform_batch, returnType=returns)


_FIELDS = ["n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored_sha256"]


def _draws(doc_id: Column, seed: int) -> Column:
    """Four unsigned 32-bit numbers that follow from the id; a NULL id counts as an empty one."""
    hexadecimal = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(hexadecimal, at, 8), 16, 10).cast("long") for at in (1, 9, 17, 25)])


def transform(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
    sentinels: Sequence[str] = SENTINELS,
) -> DataFrame:
    """One row per document: its id, n (tokens), form, prefix_chars, middle_chars, output and two digests.

    ``output_sha256`` is taken from the descriptors, ``restored_sha256`` from the text that the written
    output and its form give back, in the same worker, so that texts pass to Python once.
    Cuts, form and arrangement follow from ``seed`` and the id, so a repeated task and a repeated
    row give the same. An empty text (NULL is empty) and a text that contains a sentinel stay plain,
    and the lengths of their parts are NULL. NULL ids draw like an empty id. Nothing is shuffled;
    other columns are ignored; an empty table gives no rows.
    """
    draws = _draws(F.col(doc_id), seed)
    done = _transforming(fim_percent, spm_percent, tuple(sentinels))(whole(text), draws)
    return docs.select(F.col(doc_id), done.alias("fim")).select(doc_id, *[f"fim.{f}" for f in _FIELDS])


def _restoring(sentinels: Sequence[str]):
    def restore_batch(outputs, forms):
        found = []
        for output, form in zip(outputs, forms):
            data = output.as_py().encode("utf-8", "replace")
            found.append(content(restored(data, form.as_py(), sentinels), (memoryview(data),)).decode())
        return pa.array(found, pa.string())

    restore_batch.__annotations__ = {"outputs": pa.Array, "forms": pa.Array, "return": pa.Array}
    return F.arrow_udf(restore_batch, returnType="string")


def restored_text(
    output: Column | str = "output", form: Column | str = "form", sentinels: Sequence[str] = SENTINELS
) -> Column:
    """The document's text from its output and form alone."""
    return _restoring(tuple(sentinels))(output, form)
