from txmill.operators import profile
from txmill.sources import rows_to_table


def test_null_profile_reports_only_columns_with_nulls(spark):
    df = spark.createDataFrame(
        [(1, None, 1.0), (2, None, float("nan")), (3, "x", 2.0)], "a int, b string, c double"
    )
    assert [tuple(r) for r in profile.null_profile(df).collect()] == [("b", 2)]
    everything = profile.null_profile(df, only_present=False).collect()
    assert {r["column"]: r["nulls"] for r in everything} == {"a": 0, "b": 2, "c": 0}


def test_null_profile_is_one_scan(spark, sf_dir):
    found = profile.null_profile(spark.read.parquet(f"{sf_dir}/events.parquet"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_split_profile(spark):
    df = spark.createDataFrame(
        [("train", 1, None), ("train", None, None), ("test", 2, 3)], "part string, a int, b int"
    )
    found = {r["part"]: tuple(r)[1:] for r in profile.split_profile(df, "part").collect()}
    assert found == {"train": (2, 1, 2), "test": (1, 0, 0)}


def test_label_summary(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "y int")
    assert tuple(profile.label_summary(df, "y").first()) == (4, 1, 25.0)


def test_first_rows_and_schema(spark):
    df = spark.range(100)
    assert [r["id"] for r in profile.first_rows(df, ["id"], 3).collect()] == [0, 1, 2]
    assert profile.schema_report(df) == [(0, "id", "bigint")]


def test_inline_rows(spark):
    df = rows_to_table(spark, [(7, 0.5, None), (8, 1.5, "late")], ["n", "share", "note"])
    assert df.dtypes == [("n", "bigint"), ("share", "double"), ("note", "string")]
    assert [r["note"] for r in df.orderBy("n").collect()] == [None, "late"]



def test_missing_columns(spark):
    df = spark.createDataFrame([(1, None, 2.0), (None, None, None), (3, "x", float("nan"))], "a int, b string, c double")
    assert [r[0] for r in df.select(profile.missing_columns(df.columns)).collect()] == [["b"], ["a", "b", "c"], []]
