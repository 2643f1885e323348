"""Exact duplicates by skew-safe combining.

Equal texts are found in three steps, and each groups by digest *and* content, so texts are told
apart even if their digests collide:

1. locally: Spark's partial aggregation leaves one row per text and map task;
2. salted: local winners of a digest meet in as many groups as there are salts, so copies that
   make up a third of all rows are still spread;
3. globally: at most one winner per salt is left of each text.

A group is reduced to its smallest id and its size; its members are never gathered.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txmill.llm.common import WHITE_SPACE, stored, whole

SALTS = 32


def normalised(text: Column | str) -> Column:
    """Runs of ASCII white space become one space; nothing is trimmed; NULL is empty."""
    return F.regexp_replace(whole(text), WHITE_SPACE, " ")


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def text_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """One row per different text: digest, content, keep_id (smallest id) and group_size.

    NULL ids count as members but are kept only if the group has no other id.
    """
    rows = docs.select(
        F.col(doc_id).alias("id"),
        normalised(text).alias("content"),
        (F.spark_partition_id() % salts).alias("salt"),
    ).withColumn("digest", digest(F.col("content")))
    salted = rows.groupBy("digest", "salt", "content").agg(
        F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return salted.groupBy("digest", "content").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )


def _by_digest(groups: DataFrame) -> DataFrame:
    """One row per digest, stored: the group if ``texts`` is 1, and the number of its texts."""
    return stored(
        groups.groupBy("digest").agg(
            F.count(F.lit(1)).alias("texts"),
            F.min("keep_id").alias("keep_id"),
            F.sum("group_size").alias("group_size"),
        ),
        "exact-digests",
    )


def _collisions(digests: DataFrame) -> DataFrame | None:
    """Digests that stand for several texts, or None if there are none."""
    shared = digests.filter("texts > 1").select("digest")
    return None if shared.isEmpty() else shared


def exact_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """One row per document: its id, keep_id, group_size, kept, text_sha256.

    Where every text has a digest of its own, which the stored groups tell, members find their
    group by the digest, without moving the text again. Texts with a shared digest find it by
    content. A NULL text equals an empty one. If rows repeat both id and text, one of them is kept.
    Other columns are ignored. An empty table gives no rows.
    """
    groups = text_groups(docs, doc_id, text, digest, salts)
    digests = _by_digest(groups)
    rows = docs.select(F.col(doc_id).alias("id"), normalised(text).alias("content")).withColumns(
        {"digest": digest(F.col("content")), "text_sha256": sha256(F.col("content"))}
    )
    members = rows.groupBy("id", "digest", "text_sha256").agg(F.count(F.lit(1)).alias("times"))
    found = members.join(digests.filter("texts = 1").drop("texts"), "digest")
    collisions = _collisions(digests)
    if collisions is not None:
        several = rows.join(collisions, "digest", "left_semi")
        apart = several.groupBy("id", "digest", "text_sha256", "content").agg(
            F.count(F.lit(1)).alias("times")
        )
        found = found.unionByName(apart.join(groups, ["digest", "content"]).drop("content"))
    return found.select(
        F.col("id").alias(doc_id),
        "keep_id",
        "group_size",
        F.posexplode(F.array_repeat(F.col("id").eqNullSafe(F.col("keep_id")), F.col("times").cast("int"))),
        "text_sha256",
    ).select(
        doc_id,
        "keep_id",
        "group_size",
        (F.col("col") & (F.col("pos") == 0)).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns.

    The join is by digest and id, so the rows of a large group are spread over all tasks. Should
    digests collide, the content takes part in the join as well. Rows that repeat an id and a text
    lie together after the join, so whole rows are moved once.
    """
    groups = text_groups(docs, doc_id, text)
    digests = _by_digest(groups)
    by_content = _collisions(digests) is not None
    keys = ["digest", "content"] if by_content else ["digest"]

    def name(of: Column) -> Column:
        # Never NULL, so that plain equality serves the join and the grouping after it.
        return F.coalesce(F.concat(F.lit("="), of.cast("string")), F.lit("")).alias("name")

    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        name(docs[doc_id]),
        normalised(docs[text]).alias("content"),
    ).withColumn("digest", sha256(F.col("content")))
    keepers = (groups if by_content else digests).select(*keys, name(F.col("keep_id")))
    kept = rows.select("row", "name", *keys).join(keepers, ["name", *keys])
    return kept.dropDuplicates(["name", *keys]).select("row.*")
