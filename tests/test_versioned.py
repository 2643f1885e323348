"""Replacing a table in one step."""

import pytest
from pyspark.sql import functions as F

from txmill.plans import clean_job
from txmill.sources import read_parquet, versioned, write_parquet

HEADER = (
    "# tranaction_id | tx_datetime | customer_id | terminal_id | tx_amount"
    " | tx_time_seconds | tx_time_days | tx_fraud | tx_fraud_scenario"
)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def failing(df, at):
    """The rows of ``df``, but the task that meets id ``at`` fails after it has written others."""
    boom = F.raise_error(F.lit("killed")).cast("bigint")
    return df.select(F.when(F.col("id") == at, boom).otherwise(F.col("id")).alias("id"))


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "a table")


def test_versions_follow_each_other(spark, path):
    assert versioned.current(spark, path) is None and not versioned.is_versioned(spark, path)
    with pytest.raises(ValueError, match="no version"):
        versioned.read_version(spark, path)
    first = versioned.replace(spark.range(5), path, files=2)
    second = versioned.replace(spark.range(10, 13), path)
    assert (first["number"], first["rows"], second["number"], second["rows"]) == (1, 5, 2, 3)
    assert versioned.current(spark, path) == second
    assert ids(versioned.read_version(spark, path)) == ids(read_parquet(spark, path)) == [10, 11, 12]
    assert ids(versioned.read_version(spark, path, 1)) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError, match="no version 7"):
        versioned.read_version(spark, path, 7)


def test_a_failed_write_leaves_the_old_rows(spark, path):
    versioned.replace(spark.range(5), path)
    with pytest.raises(Exception, match="killed"):
        versioned.replace(failing(spark.range(0, 1000, 1, 8), 900), path)
    assert ids(read_parquet(spark, path)) == [0, 1, 2, 3, 4]
    assert versioned.current(spark, path)["number"] == 1
    assert versioned.replace(spark.range(2), path)["number"] == 2


def test_readers_see_the_old_rows_while_a_write_runs(spark, path, monkeypatch):
    versioned.replace(spark.range(5), path)
    seen = []
    before_commit = versioned.current

    def looking(session, where):  # called between the write of the rows and the commit
        seen.append(ids(versioned.read_version(session, where, 1)))
        monkeypatch.setattr(versioned, "current", before_commit)
        seen.append(ids(read_parquet(session, where)))
        return before_commit(session, where)

    monkeypatch.setattr(versioned, "current", looking)
    versioned.replace(spark.range(9), path)
    assert seen == [[0, 1, 2, 3, 4]] * 2
    assert ids(read_parquet(spark, path)) == list(range(9))


def test_a_table_may_be_replaced_by_rows_read_from_it(spark, path):
    versioned.replace(spark.range(5), path)
    versioned.replace(read_parquet(spark, path).filter("id > 2"), path)
    assert ids(read_parquet(spark, path)) == [3, 4]


def test_empty_versions_and_equal_numbers(spark, path):
    versioned.replace(spark.range(0), path)
    assert read_parquet(spark, path).count() == 0
    one = spark.createDataFrame([(1, "zzz", 0)], "number bigint, folder string, rows bigint")
    spark.range(3).write.parquet(f"{path}/_versions/zzz")
    one.write.mode("append").json(f"{path}/_manifest")
    assert ids(read_parquet(spark, path)) == [0, 1, 2]  # a concurrent commit: all readers see the same


def test_expiry_keeps_the_last_versions(spark, path):
    for n in range(1, 4):
        versioned.replace(spark.range(n), path)
    with pytest.raises(Exception, match="killed"):
        versioned.replace(failing(spark.range(0, 1000, 1, 8), 900), path)
    assert len(versioned.expire(spark, path, keep=2)) == 2  # the first version and the failed one
    assert ids(read_parquet(spark, path)) == [0, 1, 2]
    assert ids(versioned.read_version(spark, path, 2)) == [0, 1]
    with pytest.raises(ValueError):
        versioned.expire(spark, path, keep=0)
    assert versioned.replace(spark.range(1), path)["number"] == 4


def test_the_clean_job_replaces_and_plain_tables_still_work(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    row = "1,2019-08-22 06:51:03,10,20,12.5,100,0,0,0"
    (source / "a.txt").write_text("\n".join([HEADER, row, ""]))
    clean_job.run(spark, f"{source}/*.txt", target, mode="replace")
    (source / "b.txt").write_text("\n".join([HEADER, row.replace("1,", "2,", 1), ""]))
    clean_job.run(spark, f"{source}/*.txt", target, mode="replace", files=1)
    assert sorted(r["transaction_id"] for r in read_parquet(spark, target).collect()) == [1, 2]
    (source / "c.txt").write_text("# tranaction_id | nothing else\n")
    for name in "abc":
        (source / f"{name}.txt").write_text("no header\n")
    with pytest.raises(ValueError, match="no header"):
        clean_job.run(spark, f"{source}/*.txt", target, mode="replace")
    assert read_parquet(spark, target).count() == 2
    write_parquet(spark.range(3), str(tmp_path / "plain"))
    assert ids(read_parquet(spark, str(tmp_path / "plain"))) == [0, 1, 2]
