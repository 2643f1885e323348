import datetime
import math

import pytest
from pyspark.sql import functions as F

from txmill.operators import synth
from txmill.sources import read_csv, write_csv

ANCHOR = "2024-06-01 00:00:00"
COUNT = 40_000


@pytest.fixture(scope="module")
def made(spark):
    df = synth.synthetic_transactions(spark, anchor=ANCHOR, count=COUNT, fraud_rate=0.25).cache()
    yield df
    df.unpersist()


def test_schema(made):
    assert tuple(made.columns) == synth.COLUMN_ORDER
    kinds = dict(made.dtypes)
    assert kinds["timestamp"] == "timestamp_ntz" and kinds["transaction_id"] == "string"
    assert kinds["amount"] == "double" and kinds["used_chip"] == kinds["fraud"] == "int"


def test_exact_class_counts_and_ids(made, spark):
    found = {r["fraud"]: r["count"] for r in made.groupBy("fraud").count().collect()}
    assert found == {0: 30_000, 1: 10_000}
    assert made.select("transaction_id").distinct().count() == COUNT
    assert made.agg(F.min("transaction_id"), F.max("transaction_id")).first()[:] == (
        "tx_00000000",
        f"tx_{COUNT - 1:08d}",
    )
    wide = spark.range(1).select(synth.format_ids(F.lit(123_456_789_012))).first()[0]
    assert wide == "tx_123456789012"
    odd = synth.synthetic_transactions(spark, anchor=ANCHOR, count=999)
    assert odd.filter("fraud = 1").count() == 999 - int(999 * 0.95)


def test_timestamps_lie_in_the_last_30_days(made):
    low, high = made.agg(F.min("timestamp"), F.max("timestamp")).first()
    anchor = datetime.datetime.fromisoformat(ANCHOR)
    assert anchor - datetime.timedelta(minutes=43_199) <= low < high
    assert high <= anchor - datetime.timedelta(minutes=1)
    assert low < anchor - datetime.timedelta(days=29)


def moments(kind, *p):
    """Mean and standard deviation of a distribution."""
    return {
        "lognormal": lambda: (p[0], p[1]),
        "normal": lambda: (p[0], p[1]),
        "exponential": lambda: (p[0], p[0]),
        "integer": lambda: ((p[0] - 1) / 2, math.sqrt((p[0] ** 2 - 1) / 12)),
        "bernoulli": lambda: (p[0], math.sqrt(p[0] * (1 - p[0]))),
    }[kind]()


# Written out, so that a wrong parameter in the library is noticed.
EXPECTED = {
    "amount": ("lognormal", (5.0, 1.0), (6.0, 2.0)),
    "hour_of_day": ("integer", (24,), (24,)),
    "day_of_week": ("integer", (7,), (7,)),
    "distance_from_home": ("exponential", (30.0,), (100.0,)),
    "distance_from_last_transaction": ("exponential", (20.0,), (100.0,)),
    "ratio_to_median_purchase_price": ("normal", (1.0, 0.5), (3.0, 1.0)),
    "repeat_retailer": ("bernoulli", (0.5,), (0.2,)),
    "used_chip": ("bernoulli", (0.9,), (0.2,)),
    "used_pin_number": ("bernoulli", (0.8,), (0.2,)),
    "online_order": ("bernoulli", (0.4,), (0.8,)),
}


@pytest.mark.parametrize("column", list(EXPECTED))
@pytest.mark.parametrize("fraud", [0, 1])
def test_moments(made, column, fraud):
    kind, *parameters = EXPECTED[column]
    mean, std = moments(kind, *parameters[fraud])
    value = F.ln(column) if kind == "lognormal" else F.col(column)
    found = made.filter(F.col("fraud") == fraud).agg(F.avg(value), F.stddev_samp(value)).first()
    rows = 10_000 if fraud else 30_000
    assert found[0] == pytest.approx(mean, abs=5 * std / math.sqrt(rows))
    assert found[1] == pytest.approx(std, rel=0.06)


def test_columns_are_independent(made):
    names = [c for c in synth.COLUMN_ORDER[2:] if c not in ("amount", "fraud")]
    usual = made.filter("fraud = 0")
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    found = usual.agg(*[F.corr(a, b) for a, b in pairs]).first()
    assert all(abs(v) < 0.03 for v in found)


def test_layout_does_not_matter(spark, made):
    ids = spark.range(COUNT).repartition(3)
    again = synth.transactions_for(ids, "id", count=COUNT, fraud_rate=0.25, anchor=ANCHOR)
    assert made.exceptAll(again).count() == 0


def test_shuffle_mixes_the_classes(spark):
    df = synth.synthetic_transactions(
        spark, anchor=ANCHOR, count=2_000, fraud_rate=0.5, shuffle=True
    )
    rows = df.orderBy("transaction_id").select("transaction_id", "fraud").collect()
    assert [r[0] for r in rows] == [f"tx_{i:08d}" for i in range(2_000)]
    assert sum(r[1] for r in rows) == 1_000
    assert 400 < sum(r[1] for r in rows[:1_000]) < 600


def test_csv_has_a_header_and_no_index(spark, made, tmp_path):
    part = made.limit(50)
    write_csv(part.coalesce(1), str(tmp_path / "csv"))
    text = next((tmp_path / "csv").glob("part-*.csv")).read_text().splitlines()
    assert text[0] == ",".join(synth.COLUMN_ORDER) and len(text) == 51
    schema = ", ".join(f"{c} {t}" for c, t in made.dtypes)
    assert read_csv(spark, str(tmp_path / "csv"), schema).exceptAll(part).count() == 0
