"""Run records and model versions kept as Parquet tables, and which version is the champion.

Writers only append rows. Version numbers, promotions and aliases are derived when the tables are
read, so two writers at the same time cannot take the same version.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txmill.operators.chunks import running
from txmill.operators.clean import keep_one_per_key
from txmill.sources.scratch import scratch_path

# The names under which options and results of a run are kept.
RUNS_SCHEMA = (
    "run_id string, run_name string, model_name string, model_type string, recorded_at timestamp, "
    "numTrees_options array<int>, maxDepth_options array<int>, "
    "auc double, accuracy double, f1 double, best_numTrees int, best_maxDepth int"
)
REGISTRATIONS_SCHEMA = "model_name string, run_id string, recorded_at timestamp"

# Alias names, and how a model is named after its experiment.
CHAMPION = "champion"
CHALLENGER = "challenger"
MODEL_NAME_FORMAT = "{experiment}_model"

# Versions of one model that share a window task.
_VERSIONS_PER_CHUNK = 1_000_000


def _append(spark: SparkSession, path: str, row: dict, schema: str) -> None:
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(path)


def record_run(spark: SparkSession, path: str, run: dict) -> None:
    """Append one run; runs at once."""
    _append(spark, path, {"recorded_at": datetime.now(timezone.utc), **run}, RUNS_SCHEMA)


def register_run(spark: SparkSession, path: str, model_name: str, run_id: str) -> None:
    """Append a run to the versions of a model; runs at once."""
    row = {"model_name": model_name, "run_id": run_id, "recorded_at": datetime.now(timezone.utc)}
    _append(spark, path, row, REGISTRATIONS_SCHEMA)


def model_versions(registrations: DataFrame) -> DataFrame:
    """Number the runs registered for each model 1, 2, ... by time, then run id; runs at once.

    A run that was registered again, by a retry, counts once, with its first time. Registrations are
    sorted into ranges of equal size, whose ends Spark takes from a sample: wherever ids or moments
    crowd, further ends fall between them. Sorted once, they are stored with their place; the version
    follows from the place and one row per range and model, so nothing is counted inside a model.
    """
    columns = registrations.columns
    others = [c for c in columns if c not in ("model_name", "run_id", "recorded_at")]
    ordered = registrations.select("model_name", "run_id", "recorded_at", *others)
    order = ["model_name", "recorded_at", "run_id"]
    sorted_rows = keep_one_per_key(ordered, ["model_name", "run_id"]).repartitionByRange(*order).sortWithinPartitions(*order)
    # Rows of a partition are numbered one by one, from a start of its own.
    path = scratch_path(registrations.sparkSession, "versions")
    sorted_rows.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    rows = registrations.sparkSession.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
    earlier = Window.partitionBy("model_name").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("model_name", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    ranges = ranges.select(
        F.struct("model_name", "_part").alias("_range"), (before - F.col("_first") + F.lit(1)).alias("_shift")
    )
    # Structs compare NULL names as equal.
    joined = rows.join(ranges, F.struct("model_name", "_part") == F.col("_range"))
    return joined.select(*columns, (F.col("_at") + F.col("_shift")).alias("version"))


def version_history(registrations: DataFrame, runs: DataFrame) -> DataFrame:
    """Versions with the metrics of their runs; NULL metrics if a run was not recorded.

    A run that was recorded again, by a retry, counts once: its smallest row does.
    """
    metrics = keep_one_per_key(runs.select("run_id", "auc", "accuracy", "f1"), "run_id")
    return model_versions(registrations).join(metrics, "run_id", "left")


def _usable(auc: Column) -> Column:
    return F.when(~F.isnan(auc), auc)


def promotions(history: DataFrame, chunk: int = _VERSIONS_PER_CHUNK) -> DataFrame:
    """Add ``champion_auc`` (best before this version) and ``promoted`` to each version.

    The first version with a usable AUC is promoted, later ones only if strictly better. A version
    without one never is. ``version`` is a whole number, unique per model, so a chunk of the
    history holds at most ``chunk`` rows of a model.
    """
    version = F.col("version")
    chunked = history.withColumn("_chunk", version - F.pmod(version, F.lit(chunk)))
    auc = _usable(F.col("auc"))
    compared = running(
        chunked,
        ["model_name"],
        "_chunk",
        ["version"],
        auc,
        F.max,
        "champion_auc",
        inclusive=False,
    )
    better = F.col("champion_auc").isNull() | (auc > F.col("champion_auc"))
    return compared.withColumn("promoted", auc.isNotNull() & better).drop("_chunk")


def improvement_pct(new: Column, old: Column) -> Column:
    """(new - old) / old * 100; NULL if there is no old value or it is 0."""
    return F.try_divide(new - old, old) * F.lit(100.0)


def improvements(history: DataFrame) -> DataFrame:
    """Promoted versions with how much better they are than the champion they replace."""
    return (
        promotions(history)
        .filter("promoted")
        .withColumn("improvement_pct", improvement_pct(F.col("auc"), F.col("champion_auc")))
        .drop("promoted")
    )


def champions(history: DataFrame) -> DataFrame:
    """The champion of each model: its best AUC, and of equals the earliest version.

    Promotion needs a strictly better AUC, so this is the last promoted version, found by an
    aggregate that keeps one row per model and map task.
    """
    others = [c for c in history.columns if c != "model_name"]
    rank = F.struct(F.col("auc").alias("auc"), (-F.col("version")).alias("age"))
    return (
        history.filter(_usable(F.col("auc")).isNotNull())
        .groupBy("model_name")
        .agg(F.max_by(F.struct(*others), rank).alias("_row"))
        .select("model_name", "_row.*")
    )


def aliases(history: DataFrame) -> DataFrame:
    """Which version holds each alias of a model: the latest promoted, the latest other one."""
    alias = F.when(F.col("promoted"), F.lit(CHAMPION)).otherwise(F.lit(CHALLENGER))
    return (
        promotions(history)
        .groupBy("model_name", alias.alias("alias"))
        .agg(F.max("version").alias("version"))
    )
