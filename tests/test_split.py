import pytest
from pyspark.sql import functions as F

from txmill.catalog import bindings
from txmill.functions import fold_of, hash32
from txmill.operators import split
from txmill.operators.profile import group_counts


@pytest.fixture(scope="module")
def ids(spark):
    return spark.range(20_000)


def keys_of(df):
    return {r[0] for r in df.select("id").collect()}


def test_split_is_disjoint_complete_and_near_the_fraction(ids):
    train, test = split.hash_split(ids, "id")
    train_ids, test_ids = keys_of(train), keys_of(test)
    assert not train_ids & test_ids
    assert len(train_ids | test_ids) == 20_000
    assert abs(len(train_ids) / 20_000 - 0.8) < 0.01


def test_split_ignores_the_layout(ids):
    train, _ = split.hash_split(ids, "id")
    again, _ = split.hash_split(ids.repartition(7).orderBy(F.desc("id")), "id")
    assert keys_of(train) == keys_of(again)


def test_seed_changes_the_split(ids):
    other, _ = split.hash_split(ids, "id", seed=1)
    assert keys_of(split.hash_split(ids, "id")[0]) != keys_of(other)


def test_with_split_agrees_with_hash_split(ids):
    parts = split.with_split(ids, "id")
    assert keys_of(parts.filter("split = 'test'")) == keys_of(split.hash_split(ids, "id")[1])


def test_split_needs_no_shuffle(ids):
    plan = split.hash_split(ids, "id")[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_random_split_is_disjoint_and_complete(ids):
    train, test = split.random_split(ids)
    assert keys_of(train) | keys_of(test) == keys_of(ids)
    assert train.count() + test.count() == 20_000


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.5, 0.8, 1.0])
@pytest.mark.parametrize("rows", [0, 1, 7, 1000])
def test_exact_sample_has_the_exact_size(spark, rows, fraction):
    kept, rest = split.sample_and_rest(spark.range(rows), "id", fraction, exact=True)
    assert kept.count() == round(rows * fraction)
    assert keys_of(kept) | keys_of(rest) == set(range(rows))
    assert kept.count() + rest.count() == rows


def test_exact_sample_is_the_hash_order_prefix(spark):
    df = spark.range(5_000)
    kept, _ = split.sample_and_rest(df, "id", 0.3, seed=9, exact=True)
    order = df.select("id", hash32("id", "sample-9").alias("h")).orderBy("h", "id").collect()
    assert keys_of(kept) == {r["id"] for r in order[:1500]}


def test_exact_sample_keeps_a_hot_key_whole(spark):
    df = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("id")
    )
    for seed in range(4):
        kept, rest = split.sample_and_rest(df, "id", 0.5, seed, exact=True)
        hot = kept.filter("id = -1").count()
        assert hot in (0, 3_000)
        assert kept.count() + rest.count() == 9_000
        assert kept.count() >= 4_500


def test_exact_sample_shuffles_counts_only(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    kept, _ = split.sample_and_rest(spark.read.parquet(str(tmp_path / "t")), "id", exact=True)
    kept.collect()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    outer = plan[: plan.index("Subquery")]
    assert "Exchange" not in outer and "Join" not in plan


def test_shuffled_position_is_a_permutation_in_hash_order(spark):
    df = spark.range(3_000).repartition(5)
    placed = split.shuffled_position(df, "id").collect()
    order = spark.range(3_000).orderBy(hash32("id", "shuffle-42"), "id").collect()
    expected = {r["id"]: i for i, r in enumerate(order)}
    assert {r["id"]: r["position"] for r in placed} == expected


def test_folds_are_balanced(ids):
    counts = group_counts(ids.withColumn("fold", fold_of("id", 3)), "fold").collect()
    assert {r["fold"] for r in counts} == {0, 1, 2}
    assert all(abs(r["rows"] / 20_000 - 1 / 3) < 0.02 for r in counts)


def test_split_reads_only_the_columns_asked_for(spark, sf_dir):
    train, _ = split.hash_split(bindings.transactions(spark, sf_dir), "transaction_id")
    plan = train.select("tx_amount")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan
