"""Retrain job: Parquet transactions in, a tuned model out, and a decision on the champion.

    spark-submit txmill/plans/retrain_job.py --input s3a://bucket/clean \
        --output s3a://bucket/model --registry s3a://bucket/registry --auto-register
"""

from __future__ import annotations

import argparse
import os
import sys
import traceback
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmill.operators import model as models
from txmill.operators import registry
from txmill.operators.clean import KEY
from txmill.operators.features import LABEL, feature_columns
from txmill.operators.profile import first_rows, group_counts, missing_columns, schema_report
from txmill.operators.split import SEED, random_split, with_split
from txmill.sources.objectstore import s3a_settings
from txmill.sources.scratch import scratch_path
from txmill.sources.tables import read_parquet

# Defaults of the job's options.
EXPERIMENT = "fraud_detection"
RUN_NAME_FORMAT = "fraud_detection_{model_type}_{source}"


@dataclass(frozen=True)
class Report:
    """What a training run found."""

    schema: list[tuple[int, str, str]]
    first_rows: list[tuple]
    features: list[str]
    rows: dict[str, int]
    train_nulls: dict[str, int]
    model_type: str
    auc: float | None
    accuracy: float
    f1: float
    best_numTrees: int | None
    best_maxDepth: int | None


def default_run_name(model_type: str, source: str) -> str:
    return RUN_NAME_FORMAT.format(model_type=model_type, source=os.path.basename(source))


def store_parts(
    parts: DataFrame, part: str, needed: Sequence[str], key: str, seed: int
) -> tuple[DataFrame, dict[str, int], dict[str, int]]:
    """Needed columns, fold and part, stored; rows per part; columns of the training part with NULLs.

    The one reading of the source: which columns are NULL is stored with each row, and counted there.
    """
    missing = missing_columns([c for c in parts.columns if c != part])
    rows = models.with_fold(parts.withColumn("_missing", missing), key, seed=seed)
    rows = rows.select(*needed, "fold", part, "_missing")
    path = scratch_path(parts.sparkSession, "training")
    rows.write.parquet(path)
    stored = parts.sparkSession.read.schema(rows.schema).parquet(path)
    sizes = {"train": 0, "test": 0} | {r[part]: r["rows"] for r in group_counts(stored, part).collect()}
    nulls = stored.filter(F.col(part) == F.lit("train")).select(F.explode("_missing").alias("column"))
    found = {r["column"]: r["rows"] for r in group_counts(nulls, "column").collect()}
    in_order = {c: found[c] for c in parts.columns if c in found}
    return stored.drop("_missing"), sizes, in_order


def train_and_evaluate(
    df: DataFrame,
    *,
    key: str = KEY,
    label: str = LABEL,
    model_type: str = "rf",
    exclude: Sequence[str] = (),
    grid: models.Grid | None = None,
    seed: int = SEED,
    parallelism: int = 4,
    layout_split: bool = False,
    partitions: int | None = None,
    exact_auc: bool = False,
) -> tuple[PipelineModel, Report]:
    """Split, tune, fit and test; runs at once, and reads ``df`` once (twice with ``layout_split``).

    The split hashes the key. ``layout_split`` takes Spark's ``randomSplit`` instead, which only
    repeats itself on unchanged files. ``partitions`` deals the training rows out by key, so that
    the model does not hang on files and cores. ``exact_auc`` as in ``models.evaluate``.
    """
    features = feature_columns(df.schema, exclude)
    needed = list(dict.fromkeys([key, *features, label]))
    if layout_split:
        train, test = random_split(df, seed=seed)
        parts = train.withColumn("_part", F.lit("train")).unionByName(
            test.withColumn("_part", F.lit("test"))
        )
    else:
        parts = with_split(df, key, seed=seed, out="_part")
    stored, rows, nulls = store_parts(parts, "_part", needed, key, seed)
    train, test = (stored.filter(F.col("_part") == F.lit(p)).drop("_part") for p in ("train", "test"))
    tuned = models.cross_validate(
        train,
        features,
        key,
        model_type=model_type,
        label=label,
        grid=grid,
        seed=seed,
        parallelism=parallelism,
        partitions=partitions,
    )
    best = tuned.bestModel
    found = models.evaluate(models.score(best, test), label, exact_auc=exact_auc)
    sample = first_rows(train.select(*needed), [key]).collect()
    return best, Report(
        schema_report(df),
        [tuple(r) for r in sample],
        features,
        rows,
        nulls,
        model_type,
        **found,
        **models.best_parameters(best),
    )


def retrain(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    registry_path: str | None = None,
    experiment: str = EXPERIMENT,
    auto_register: bool = False,
    run_name: str | None = None,
    model_type: str = "rf",
    grid: models.Grid | None = None,
    **options,
) -> dict:
    """Train on ``source``, save the model to ``target``, record the run and maybe register it.

    Runs and registrations are the tables ``runs`` and ``registrations`` under ``registry_path``,
    and ``models`` keeps the model of every run, because the next training replaces ``target``.
    Returns the report, the run's id and name, whether the run became the champion, the metrics of
    the champion before it, and by how many percent its AUC differs from that champion's.
    """
    options_tried = (grid or models.Grid()) if model_type == "rf" else models.Grid((), ())
    name = run_name or default_run_name(model_type, source)
    run_id = uuid.uuid4().hex
    model_name = registry.MODEL_NAME_FORMAT.format(experiment=experiment)

    best, report = train_and_evaluate(
        read_parquet(spark, source), model_type=model_type, grid=grid, **options
    )
    before = None
    if registry_path:
        models.save_model(best, run_model_path(registry_path, run_id))
        registry.record_run(
            spark,
            f"{registry_path}/runs",
            {
                "run_id": run_id,
                "run_name": name,
                "model_name": model_name,
                "model_type": model_type,
                "numTrees_options": list(options_tried.num_trees) or None,
                "maxDepth_options": list(options_tried.max_depth) or None,
                "auc": report.auc,
                "accuracy": report.accuracy,
                "f1": report.f1,
                "best_numTrees": report.best_numTrees,
                "best_maxDepth": report.best_maxDepth,
            },
        )
    models.save_model(best, target)
    promoted = None
    if auto_register and registry_path:
        before = champion_metrics(spark, registry_path, model_name)
        registry.register_run(spark, f"{registry_path}/registrations", model_name, run_id)
        promoted = champion_run(spark, registry_path, model_name) == run_id
    gain = None
    if before and before["auc"] and report.auc is not None:
        gain = (report.auc - before["auc"]) / before["auc"] * 100.0
    return {
        **asdict(report),
        "run_id": run_id,
        "run_name": name,
        "promoted": promoted,
        "champion_before": before,
        "improvement_pct": gain,
    }


def run_model_path(registry_path: str, run_id: str) -> str:
    return f"{registry_path}/models/{run_id}"


def history_of(spark: SparkSession, registry_path: str) -> DataFrame:
    """All registered versions with their metrics."""
    return registry.version_history(
        read_parquet(spark, f"{registry_path}/registrations"),
        read_parquet(spark, f"{registry_path}/runs"),
    )


def champion_run(spark: SparkSession, registry_path: str, model_name: str) -> str | None:
    """Run whose version holds the champion alias of the model, if any does."""
    history = history_of(spark, registry_path).filter(F.col("model_name") == F.lit(model_name))
    current = registry.champions(history).select("run_id").first()
    return current["run_id"] if current else None


def champion_metrics(
    spark: SparkSession, registry_path: str, model_name: str
) -> dict[str, float | int | None] | None:
    """Version and metrics of the champion; None if there is no registration or no champion."""
    try:
        history = history_of(spark, registry_path)
    except AnalysisException:  # nothing was registered yet
        return None
    own = history.filter(F.col("model_name") == F.lit(model_name))
    found = registry.champions(own).select("version", "auc", "accuracy", "f1").first()
    return found.asDict() if found else None


def load_champion(
    spark: SparkSession, registry_path: str, experiment: str = EXPERIMENT
) -> PipelineModel | None:
    """The champion of an experiment, ready to score."""
    model_name = registry.MODEL_NAME_FORMAT.format(experiment=experiment)
    run_id = champion_run(spark, registry_path, model_name)
    return models.load_model(run_model_path(registry_path, run_id)) if run_id else None


def report_lines(done: dict) -> list[str]:
    """The result of ``retrain`` as text."""
    lines = [f"column {i}: {name} {kind}" for i, name, kind in done["schema"]]
    lines += [f"row: {row}" for row in done["first_rows"]]
    lines += [
        f"rows: {done['rows']['train']} train, {done['rows']['test']} test",
        f"features: {', '.join(done['features'])}",
    ]
    lines += [f"warning: {n} missing values in {c}" for c, n in done["train_nulls"].items()]
    lines += [f"{name}: {done[name]}" for name in ("model_type", "auc", "accuracy", "f1")]
    if done["best_numTrees"] is not None:
        lines.append(f"best: {done['best_numTrees']} trees of depth {done['best_maxDepth']}")
    if done["champion_before"]:
        old = done["champion_before"]
        lines.append(f"champion before: version {old['version']}, auc {old['auc']}")
    if done["improvement_pct"] is not None:
        lines.append(f"improvement: {done['improvement_pct']:.2f} %")
    if done["promoted"] is not None:
        lines.append("promoted to champion" if done["promoted"] else "kept as challenger")
    return lines


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    # The names of the first ten options, the interface of the job.
    parser = argparse.ArgumentParser(description="Train a fraud model and keep the best version")
    parser.add_argument("--input", required=True, help="Parquet table of transactions")
    parser.add_argument("--output", required=True, help="path to save the model to")
    parser.add_argument("--model-type", default="rf", help="rf or lr")
    parser.add_argument("--registry", help="folder of the run and version tables")
    parser.add_argument("--experiment-name", default=EXPERIMENT)
    parser.add_argument("--auto-register", action="store_true", help="register the new model")
    parser.add_argument("--run-name")
    parser.add_argument("--exclude", nargs="*", default=[], help="columns that are no features")
    parser.add_argument("--seed", type=int, default=SEED)
    parser.add_argument("--parallelism", type=int, default=4, help="models fitted at a time")
    parser.add_argument("--partitions", type=int, help="deal training rows out by id")
    parser.add_argument("--layout-split", action="store_true", help="split as Spark's randomSplit")
    parser.add_argument("--exact-auc", action="store_true", help="AUC without bins")
    parser.add_argument("--num-trees", type=int, nargs="+", default=models.NUM_TREES_OPTIONS)
    parser.add_argument("--max-depth", type=int, nargs="+", default=models.MAX_DEPTH_OPTIONS)
    parser.add_argument("--s3-endpoint-url")
    parser.add_argument("--s3-access-key")
    parser.add_argument("--s3-secret-key")
    args = parser.parse_args(argv)
    if args.auto_register and not args.registry:
        parser.error("--auto-register needs --registry")
    return args


def main(argv: Sequence[str] | None = None) -> int:
    """Exit code 0, or 1 if the training failed."""
    args = parse_args(argv)
    builder = SparkSession.builder.appName("retrain")
    settings = s3a_settings(args.s3_endpoint_url, args.s3_access_key, args.s3_secret_key)
    for setting, value in settings.items():
        builder = builder.config(setting, value)
    spark = builder.getOrCreate()
    try:
        done = retrain(
            spark,
            args.input,
            args.output,
            registry_path=args.registry,
            experiment=args.experiment_name,
            auto_register=args.auto_register,
            run_name=args.run_name,
            model_type=args.model_type,
            grid=models.Grid(args.num_trees, args.max_depth),
            exclude=args.exclude,
            seed=args.seed,
            parallelism=args.parallelism,
            partitions=args.partitions,
            layout_split=args.layout_split,
            exact_auc=args.exact_auc,
        )
        print("\n".join(report_lines(done)))
        return 0
    except Exception:
        traceback.print_exc()
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
