"""WARC archives with revisit records in place of repeated payloads.

Headers are grouped by payload digest: the page with the smallest id of a digest becomes the
response, and all others become revisit records that refer to it and carry no payload. Archives are
written by Spark's text writer, whose record separator is the two line ends that close a WARC
record. So they go to any file system that Spark writes to, and a retried task leaves no torn file.
Reading takes the archives as bytes and walks from record to record by Content-Length.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmill.llm.common import stored, whole

#: Payloads of fewer bytes are always written in full.
LEAST_BYTES = 0
#: Bounds of an archive, which is read as one value: records, and bytes of payload unless a single
#: one has more.
ARCHIVE_RECORDS = 1024
ARCHIVE_BYTES = 1 << 27
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX_TO_BASE32 = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
END = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1. 160 bits are eight times 20 bits: five hex digits, four of base 32."""
    hexadecimal = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(hexadecimal, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)
    ]
    return F.translate(F.concat(*parts), *HEX_TO_BASE32)


def _record_id(number: Column) -> Column:
    """A name-based UUID of the record's number, stable over reruns."""
    h = F.md5(F.concat(F.lit("record "), number.cast("string")))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    return F.concat(
        F.lit("<urn:uuid:"), cut[0], F.lit("-"), cut[1], F.lit("-3"), cut[2], F.lit("-8"), cut[3], F.lit("-"), cut[4], F.lit(">")
    )


def resolve(pages: DataFrame, page_id: str, url: str, payload: str, least_bytes: int) -> DataFrame:
    """id, target, body, digest, bytes, first (smallest id of the payload, NULL if it is alone).

    Equal payloads are those with equal SHA-1, SHA-256 and length. Only these headers are grouped;
    a digest that a third of all pages share is reduced to its smallest id before it is shuffled.
    """
    body = whole(F.col(payload))
    rows = pages.select(
        F.col(page_id).alias("id"), F.col(url).alias("target"), body.alias("body")
    ).withColumns(
        {
            "digest": base32_sha1(F.col("body").cast("binary")),
            "bytes": F.octet_length("body").cast("long"),
            "check": F.sha2("body", 256),
        }
    )
    keys = ["digest", "check", "bytes"]
    originals = stored(
        rows.filter(F.col("bytes") >= least_bytes)
        .groupBy(*keys)
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("pages"))
        .filter("pages > 1")
        .drop("pages"),
        "originals",
    )
    return rows.join(originals, keys, "left").drop("check")


def records(pages: DataFrame, page_id: str, url: str, payload: str, least_bytes: int, date: str) -> DataFrame:
    """One text per page, ``value``: the WARC record without the two line ends that close it; and its
    payload's ``bytes``."""
    headers = resolve(pages, page_id, url, payload, least_bytes)
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    target = F.regexp_replace("target", r"[\x00-\x20\x7F]", "")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(END + END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("body")))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))

    head = F.concat(
        F.lit(VERSION + END),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _record_id(F.coalesce(F.col("id").cast("string"), F.lit("null")))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.when(target != "", target)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        line("WARC-Refers-To", F.when(revisit, _record_id(F.col("first")))),
        line("X-Page-Id", F.col("id").cast("string")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
    )
    return headers.select(F.concat(head, F.lit(END), block).alias("value"), "bytes")


def size_classes(most: int, archive_records: int, archive_bytes: int) -> list[tuple[int, int, int]]:
    """Classes of payloads up to ``most`` bytes: over, up to, and how many records make an archive.

    Each class holds four times larger payloads than the one before and a quarter of the records, so
    an archive of any class keeps within ``archive_bytes``; the last class has one record each.
    """
    out, over, records = [], -1, archive_records
    while over < most:
        upto = archive_bytes // records if records > 1 else max(most, archive_bytes)
        out.append((over, upto, records))
        over, records = upto, max(records // 4, 1)
    return out


def write(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = LEAST_BYTES,
    date: str = DATE,
    archive_records: int = ARCHIVE_RECORDS,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write one record per page to uncompressed archives in the folder ``path``.

    A NULL payload is empty, a NULL url leaves the target out, control characters and spaces are
    taken out of urls. Of equal payloads of at least ``least_bytes`` bytes, the page with the
    smallest id is the response. Rows that repeat both its id and its payload are responses too.
    Other columns are ignored. An archive has at most ``archive_records`` records, and payloads of at
    most ``archive_bytes`` bytes or a single one: larger pages go to archives of fewer records, class
    by class, as the largest page of the table asks.
    """
    size = F.octet_length(whole(F.col(payload))).cast("long")
    most = pages.agg(F.max(size).alias("most")).first().most or 0
    rows = records(pages, page_id, url, payload, least_bytes, date)
    for over, upto, number in size_classes(most, archive_records, archive_bytes):
        rows.filter((F.col("bytes") > over) & (F.col("bytes") <= upto)).select("value").write.option(
            "lineSep", END + END
        ).option("maxRecordsPerFile", number).text(f"{path}/{number}" if over < 0 else f"{path}/{number}-over-{over}")


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an archive."""
    at = 0
    view = memoryview(archive)
    while at < len(archive):
        stop = archive.index(b"\r\n\r\n", at)
        lines = archive[at:stop].decode("utf-8").split(END)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        size = int(fields["Content-Length"])
        yield fields, bytes(view[stop + 4 : stop + 4 + size])
        at = stop + 4 + size + 4


FIELDS = "record_id string, record_type string, page_id bigint, payload_bytes bigint, payload_digest string, refers_to_record string"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in FIELDS.split(", ")]
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    for batch in batches:
        for archive in batch.column("content"):
            rows = []
            for fields, block in parse(archive.as_py()):
                payload = block[block.index(b"\r\n\r\n") + 4 :]
                revisit = fields["WARC-Type"] == "revisit"
                number = fields.get("X-Page-Id")
                rows.append(
                    (
                        fields["WARC-Record-ID"],
                        fields["WARC-Type"],
                        None if number is None else int(number),
                        None if revisit else len(payload),
                        None if revisit else base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                        fields.get("WARC-Refers-To"),
                    )
                )
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives in ``path``; size and digest are taken from the payload read.

    Archives are parsed once: what is returned is stored."""
    archives = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return stored(archives.select("content").mapInArrow(_read, FIELDS), "records")


def resolved(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: revisits joined to responses.

    A response that a third of all records refer to is one row; Spark splits the other side.
    """
    responses = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_record"),
        F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("found_bytes"),
        F.col("payload_digest").alias("found_digest"),
    ).dropDuplicates(["refers_to_record"])
    revisits = records.filter("record_type = 'revisit'").join(responses, "refers_to_record", "left")
    return records.filter("record_type = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("bigint").alias("refers_to")
    ).unionByName(
        revisits.select(
            "page_id",
            F.col("found_bytes").alias("payload_bytes"),
            F.col("found_digest").alias("payload_digest"),
            "record_type",
            "refers_to",
        )
    )
