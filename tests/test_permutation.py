"""The keyed permutation, and what the generator makes of it."""

import pytest
from pyspark.sql import functions as F

from txmill.functions.permutation import grid, permuted
from txmill.operators import synth
from txmill.plans import synth_job
from txmill.sources import read_csv

ANCHOR = "2024-06-01 00:00:00"


def places(spark, count, seed=1):
    rows = spark.range(count).select("id", permuted(F.col("id"), count, seed).alias("place"))
    return [r["place"] for r in rows.orderBy("id").collect()]


@pytest.mark.parametrize("count", [1, 2, 3, 5, 7, 10, 11, 17, 100, 101, 997, 1000, 4097])
def test_every_place_is_taken_once(spark, count):
    high, low = grid(count)
    assert 0 <= high * low - count < low
    assert sorted(places(spark, count)) == list(range(count))


def test_no_rows(spark):
    assert places(spark, 0) == []


def test_seeds_and_keys_differ_and_layout_does_not_matter(spark):
    first, second = places(spark, 500, 1), places(spark, 500, 2)
    assert first != second and first == places(spark, 500, 1)
    assert sum(a == b for a, b in zip(first, second)) < 15
    assert sum(a == i for i, a in enumerate(first)) < 15


def test_places_look_even_and_independent(spark):
    found = places(spark, 20_000)
    for part in range(10):
        share = sum(found[k] < 10_000 for k in range(part * 2000, part * 2000 + 2000)) / 2000
        assert 0.45 < share < 0.55
    steps = [abs(a - b) for a, b in zip(found, found[1:])]
    assert 6300 < sum(steps) / len(steps) < 7000  # a third of the range


def test_places_of_a_large_table_stay_inside(spark):
    count = 10**12 + 39
    rows = spark.range(0, count, count // 2000).select(permuted(F.col("id"), count, 3).alias("p"))
    found = rows.agg(F.min("p"), F.max("p"), F.countDistinct("p"), F.count("*")).first()
    assert 0 <= found[0] and found[1] < count and found[2] == found[3]


@pytest.mark.parametrize("shuffle", [True, False])
def test_generated_parts_are_exact_and_need_no_shuffle(spark, shuffle):
    options = dict(anchor=ANCHOR, count=1000, fraud_rate=0.3, shuffle=shuffle)
    whole = synth.synthetic_transactions(spark, **options)
    parts = [synth.synthetic_transactions(spark, **options, places=p) for p in (range(800), range(800, 1000))]
    assert [p.count() for p in parts] == [800, 200]
    assert sorted(whole.collect()) == sorted(parts[0].collect() + parts[1].collect())
    for df in (whole, *parts):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan
    assert 180 < sum(r["fraud"] for r in parts[0].collect()) < 300


def test_the_generator_job_makes_each_row_once_and_counts_the_files(spark, tmp_path):
    found = synth_job.run(spark, str(tmp_path / "demo"), count=1001, anchor=ANCHOR, fraud_rate=0.1)
    assert found == {"rows": 1001, "positives": 101, "positive_pct": pytest.approx(100 * 101 / 1001)}
    schema = spark.createDataFrame([], synth_job.SCHEMA).schema
    parts = [read_csv(spark, str(tmp_path / "demo" / p), schema) for p in ("train", "test")]
    assert [p.count() for p in parts] == [801, 200]
    ids = {r["transaction_id"] for p in parts for r in p.collect()}
    assert len(ids) == 1001
    assert synth_job.run(spark, str(tmp_path / "none"), count=0, anchor=ANCHOR)["rows"] == 0
