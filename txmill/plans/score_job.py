"""Scoring job: Parquet transactions in, scores by the champion model out.

    spark-submit txmill/plans/score_job.py --input s3a://bucket/clean \\
        --registry s3a://bucket/registry --output s3a://bucket/scores
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmill.operators import model as models
from txmill.operators.clean import KEY
from txmill.plans.retrain_job import EXPERIMENT, load_champion
from txmill.sources.tables import read_parquet, write_parquet

PROBABILITY = "fraud_probability"


def input_columns(model: PipelineModel) -> list[str]:
    """Columns that the model's first stage reads."""
    return next(s.getInputCols() for s in model.stages if isinstance(s, VectorAssembler))


def scored_rows(model: PipelineModel, df: DataFrame, key: str = KEY) -> DataFrame:
    """Key, probability of fraud and prediction; a row with a missing feature
    (NULL or NaN) gets NULL for both.

    Only the key and the model's columns are read, and nothing is shuffled.
    """
    columns = input_columns(model)
    missing = [c for c in [key, *columns] if c not in df.columns]
    if missing:
        raise ValueError(f"the input lacks {', '.join(missing)}, which the model was fitted on")
    known = F.lit(True)
    for c in columns:
        value = F.col(c)
        known = known & value.isNotNull()
        if dict(df.dtypes)[c] in ("float", "double"):
            known = known & ~F.isnan(value)
    rows = df.select(F.col(key).alias("_key"), known.alias("_known"), *columns)
    # The assembler refuses NULL and NaN; such rows are scored as zeros and their result is taken back.
    scored = models.score(model, rows.na.fill(0, columns))
    probability = F.get(vector_to_array("probability"), F.lit(1))
    return scored.select(
        F.col("_key").alias(key),
        F.when(F.col("_known"), probability).alias(PROBABILITY),
        F.when(F.col("_known"), F.col("prediction")).alias("prediction"),
    )


def run(
    spark: SparkSession,
    source: str,
    registry_path: str,
    target: str,
    *,
    experiment: str = EXPERIMENT,
    key: str = KEY,
    mode: str = "errorifexists",
) -> dict[str, int]:
    """Score ``source`` with the experiment's champion into ``target``; returns rows and frauds in it."""
    champion = load_champion(spark, registry_path, experiment)
    if champion is None:
        raise ValueError(f"{registry_path} has no champion of {experiment}")
    write_parquet(scored_rows(champion, read_parquet(spark, source), key), target, mode=mode)
    found = read_parquet(spark, target, ["prediction"]).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("prediction") == F.lit(1.0)).alias("frauds"),
        F.count_if(F.col("prediction").isNull()).alias("unscored"),
    )
    return found.first().asDict()


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Score transactions with the champion model")
    parser.add_argument("--input", required=True, help="Parquet table of transactions")
    parser.add_argument("--registry", required=True, help="folder of the run and version tables")
    parser.add_argument("--output", required=True, help="path of the scores")
    parser.add_argument("--experiment-name", default=EXPERIMENT)
    parser.add_argument(
        "--mode", default="errorifexists", choices=["errorifexists", "overwrite", "append", "replace"]
    )
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> int:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("score").getOrCreate()
    try:
        found = run(
            spark, args.input, args.registry, args.output, experiment=args.experiment_name, mode=args.mode
        )
        print("\n".join(f"{name}: {rows}" for name, rows in found.items()))
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
