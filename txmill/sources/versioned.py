"""Tables that are replaced in one step: whole versions, and a manifest that names the current one.

    table/_versions/<id>/part-*.parquet     one folder per version, never changed
    table/_manifest/part-*.json             one small file per committed version

Overwriting in place deletes a table before the new rows exist. Here a version is written beside the
current one, and becomes current by one more file in the manifest, whose appearance is the commit. A
writer that fails or still runs has no file there, so readers never see its rows, nor an empty
table. Spark itself passes over both folders if the table's own path is read as Parquet.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ENTRY = "number bigint, folder string, rows bigint"


def _manifest(path: str) -> str:
    return f"{path.rstrip('/')}/_manifest"


def _versions(path: str) -> str:
    return f"{path.rstrip('/')}/_versions"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Committed versions: number, folder, rows. Empty if there are none."""
    if not is_versioned(spark, path):
        return spark.createDataFrame([], _ENTRY)
    return spark.read.schema(_ENTRY).json(_manifest(path))


def is_versioned(spark: SparkSession, path: str) -> bool:
    """Whether a version was ever written to ``path``; the file system is asked."""
    where = spark._jvm.org.apache.hadoop.fs.Path(_manifest(path))
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def current(spark: SparkSession, path: str) -> dict | None:
    """number, folder and rows of the version that readers see, or None.

    If two writers commit at the same time, both versions are whole, and all readers see the same.
    """
    last = manifest(spark, path).orderBy(F.col("number").desc(), F.col("folder").desc()).first()
    return last.asDict() if last else None


def replace(df: DataFrame, path: str, *, files: int | None = None) -> dict:
    """Write ``df`` as the next version and make it the current one; returns its manifest entry.

    ``df`` may read the current version: that is left alone.
    """
    spark = df.sparkSession
    folder = uuid.uuid4().hex
    target = f"{_versions(path)}/{folder}"
    (df.repartition(files) if files else df).write.parquet(target)
    # Counted from the footers of the files, so it is the number of rows that were written.
    rows = spark.read.schema(df.schema).parquet(target).count()
    before = current(spark, path)
    entry = {"number": before["number"] + 1 if before else 1, "folder": folder, "rows": rows}
    one = spark.createDataFrame([tuple(entry.values())], _ENTRY).coalesce(1)
    one.write.mode("append").json(_manifest(path))
    return entry


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """Rows of the current version, or of an older one that has not expired."""
    if number is None:
        chosen = current(spark, path)
    else:
        wanted = manifest(spark, path).filter(F.col("number") == F.lit(number))
        row = wanted.orderBy(F.col("folder").desc()).first()
        chosen = row.asDict() if row else None
    if chosen is None:
        raise ValueError(f"no version{'' if number is None else f' {number}'} of {path} was committed")
    return spark.read.parquet(f"{_versions(path)}/{chosen['folder']}")


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete the folders of all but the last ``keep`` committed versions, and those never committed.

    Not to be run while a writer or a reader of such a version is at work. The manifest keeps the
    names, so numbers go on. Returns the deleted folders.
    """
    if keep < 1:
        raise ValueError("the current version must be kept")
    committed = manifest(spark, path).orderBy(F.col("number").desc(), F.col("folder").desc())
    kept = {r["folder"] for r in committed.limit(keep).collect()}
    root = spark._jvm.org.apache.hadoop.fs.Path(_versions(path))
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = [s.getPath() for s in system.listStatus(root) if s.getPath().getName() not in kept]
    for folder in gone:
        system.delete(folder, True)
    return sorted(folder.getName() for folder in gone)
