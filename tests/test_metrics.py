import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from txmill.operators import metrics


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "label int, score double")


def brute_auc(pairs):
    good = [s for y, s in pairs if y == 1]
    bad = [s for y, s in pairs if y == 0]
    won = sum((g > b) + 0.5 * (g == b) for g in good for b in bad)
    return won / (len(good) * len(bad))


@pytest.mark.parametrize("kind", ["distinct", "ties", "hot", "infinite"])
def test_auc_equals_counting_pairs(spark, kind):
    draw = random.Random(5)
    score = {
        "distinct": draw.random,
        "ties": lambda: float(draw.randrange(6)),
        "hot": lambda: 0.5 if draw.random() < 0.4 else draw.random(),
        "infinite": lambda: draw.choice([float("-inf"), 0.0, -0.0, 1.0, float("inf")]),
    }[kind]
    pairs = [(int(draw.random() < 0.3), score()) for _ in range(400)]
    found = metrics.area_under_roc(frame(spark, pairs)).first()["auc"]
    assert found == pytest.approx(brute_auc(pairs), abs=1e-12)


def test_auc_equals_spark_ml_without_bins(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("score"),
    )
    exact = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(rows)
    assert metrics.area_under_roc(rows).first()["auc"] == pytest.approx(exact, abs=1e-10)


@pytest.mark.parametrize("label", [0, 1])
def test_auc_of_one_class_is_null(spark, label):
    assert metrics.area_under_roc(frame(spark, [(label, 0.1), (label, 0.9)])).first()["auc"] is None


def test_auc_of_nothing_is_null(spark):
    assert metrics.area_under_roc(frame(spark, [])).first()["auc"] is None


def test_perfect_and_reversed(spark):
    assert metrics.area_under_roc(frame(spark, [(0, 0.1), (1, 0.9)])).first()["auc"] == 1.0
    assert metrics.area_under_roc(frame(spark, [(1, 0.1), (0, 0.9)])).first()["auc"] == 0.0


def test_pairs_beyond_a_bigint(spark):
    """Two scores, each with 4e9 rows' worth of weight, would overflow 64 bits when multiplied."""
    big = spark.createDataFrame([(4_000_000_000_000,)], "n bigint").select(
        F.col("n").cast("decimal(18,0)").alias("a"),
        (F.lit(2) * F.col("n")).cast("decimal(19,0)").alias("b"),
    )
    assert int(big.select(F.col("a") * F.col("b")).first()[0]) == 2 * 4_000_000_000_000**2


@pytest.mark.parametrize("classes", [2, 5])
def test_accuracy_and_f1_equal_spark_ml(spark, classes):
    draw = random.Random(7)
    pairs = [(draw.randrange(classes), draw.randrange(classes + 1)) for _ in range(500)]
    rows = spark.createDataFrame(pairs, "label int, prediction int").selectExpr(
        "double(label) AS label", "double(prediction) AS prediction"
    )
    found = metrics.classification_metrics(rows).first()
    for name in ("accuracy", "f1"):
        expected = MulticlassClassificationEvaluator(metricName=name).evaluate(rows)
        assert found[name] == pytest.approx(expected, abs=1e-12)
    assert metrics.accuracy(rows).first()["accuracy"] == pytest.approx(found["accuracy"])


def test_weighted_f1_is_not_the_fraud_class_f1(spark):
    rows = spark.createDataFrame(
        [(0, 0)] * 90 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 0)] * 5, "label int, prediction int"
    )
    found = metrics.classification_metrics(rows).first()
    assert found["f1_positive"] == pytest.approx(2 * 3 / (8 + 5))
    assert found["f1"] > 0.9


def test_positive_class_that_never_occurs(spark):
    rows = spark.createDataFrame([(0, 0)], "label int, prediction int")
    assert tuple(metrics.classification_metrics(rows).first()) == (1.0, 1.0, 0.0)
