from itertools import groupby

"""One key or value holds a third of the rows or more; no task may get it whole."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from txmill.operators import clean, metrics, registry
from txmill.operators.chunks import ordered_bits, running

ROWS = 40_000


def largest_share(df):
    """Share of the rows in the fullest partition."""
    # All columns are used, or the optimizer would drop the step that is looked at.
    used = [F.count(F.struct(*df.columns)).alias("rows"), F.max(F.struct(*df.columns))]
    sizes = df.groupBy(F.spark_partition_id()).agg(*used).collect()
    return max(r["rows"] for r in sizes) / sum(r["rows"] for r in sizes)


@pytest.fixture
def no_merging(spark):
    """Adaptive execution would merge the small partitions of a test."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture
def one_model(spark):
    return spark.range(ROWS).select(
        F.lit("m").alias("model_name"),
        F.col("id").alias("version"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / F.lit(1000.0)).alias("auc"),
    )


def test_one_model_is_spread_over_tasks(one_model, no_merging):
    chunked = one_model.withColumn("c", F.floor(F.col("version") / F.lit(100)))
    ours = running(
        chunked, ["model_name"], "c", ["version"], F.col("auc"), F.max, "r", inclusive=False
    )
    plain = one_model.withColumn(
        "r", F.max("auc").over(Window.partitionBy("model_name").orderBy("version"))
    )
    assert largest_share(plain) == 1.0
    assert largest_share(ours) < 0.4


def test_versions_of_one_model_are_spread_over_tasks(one_model, no_merging):
    registrations = one_model.select(
        "model_name",
        F.col("version").cast("string").alias("run_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("version")).alias("recorded_at"),
    )
    numbered = registry.model_versions(registrations)
    assert largest_share(numbered) < 0.4
    wrong = numbered.filter(F.col("version") != F.col("run_id").cast("int") + 1)
    assert wrong.count() == 0


def test_versions_of_one_moment_are_spread_over_tasks(one_model, no_merging):
    registrations = one_model.select(
        "model_name",
        F.md5(F.col("version").cast("string")).alias("run_id"),
        F.timestamp_seconds(F.lit(1_700_000_000)).alias("recorded_at"),
    )
    numbered = registry.model_versions(registrations)
    assert largest_share(numbered) < 0.4
    ids = [r["run_id"] for r in numbered.orderBy("version").select("run_id").collect()]
    assert ids == sorted(ids)


def test_versions_of_one_moment_with_alike_ids_are_spread_over_tasks(one_model, no_merging):
    """Ids that differ only in their last characters, and a third of them registered again."""
    registrations = one_model.select(
        "model_name",
        F.format_string("run-%09d", "version").alias("run_id"),
        F.timestamp_seconds(F.lit(1_700_000_000)).alias("recorded_at"),
    )
    again = registrations.filter(F.col("run_id") < "run-000013333").withColumn(
        "recorded_at", F.timestamp_seconds(F.lit(1_800_000_000))
    )
    numbered = registry.model_versions(registrations.unionByName(again))
    assert numbered.columns == [*registrations.columns, "version"]
    assert largest_share(numbered) < 0.4
    assert numbered.count() == ROWS
    assert numbered.filter(F.format_string("run-%09d", F.col("version") - 1) != F.col("run_id")).count() == 0


def test_scores_are_spread_over_tasks(spark, no_merging):
    scores = spark.range(ROWS).select(
        F.when(F.col("id") % 3 == 0, F.lit(0.5))
        .otherwise(F.exp(F.pmod(F.xxhash64("id"), F.lit(600)).cast("double")))
        .alias("score"),
        (F.col("id") % 7 == 0).cast("int").alias("label"),
    )
    assert_cells_spread(scores)


def test_scores_with_a_common_start_are_spread_over_tasks(spark, no_merging):
    scores = spark.range(ROWS).select(
        (F.lit(0.7) + F.col("id") / F.lit(1e8)).alias("score"),
        (F.col("id") % 7 == 0).cast("int").alias("label"),
    )
    assert_cells_spread(scores)


def test_saturated_scores_are_spread_over_tasks(spark, no_merging):
    """All within 4e-8 of 1, where cells of 24 fraction bits would be one."""
    scores = spark.range(ROWS).select(
        (F.lit(1.0) - F.pmod(F.xxhash64("id"), F.lit(10**6)) * F.lit(3e-14)).alias("score"),
        (F.col("id") % 7 == 0).cast("int").alias("label"),
    )
    assert_cells_spread(scores)


def assert_cells_spread(scores):
    cell = F.shiftright(ordered_bits(F.col("score")), metrics._CELL_SHIFTS[0])
    distinct = scores.select("score", cell.alias("c")).distinct()
    assert largest_share(distinct.repartition("c")) < 0.4
    rows = [(r["score"], r["label"]) for r in scores.collect()]
    rows.sort()
    below = pairs = 0
    for _, tied in groupby(rows, key=lambda r: r[0]):
        labels = [y for _, y in tied]
        pos, neg = sum(labels), len(labels) - sum(labels)
        pairs += pos * (2 * below + neg)
        below += neg
    positives = sum(y for _, y in rows)
    expected = pairs / (2 * positives * (len(rows) - positives))
    assert metrics.area_under_roc(scores).first()["auc"] == pytest.approx(expected, abs=1e-12)


def test_a_hot_key_leaves_each_map_task_as_one_row(spark, no_merging):
    rows = spark.range(ROWS).repartition(8)
    df = rows.select(F.pmod("id", F.lit(1)).alias("k"), F.col("id").alias("v"))
    kept = clean.keep_one_per_key(df, "k")
    assert [tuple(r) for r in kept.collect()] == [(0, 0)]
    node = kept._jdf.queryExecution().executedPlan()
    while node.nodeName() != "Exchange":
        node = node.children().head()
    assert node.metrics().get("shuffleRecordsWritten").get().value() == 8
