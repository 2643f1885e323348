"""Named queries over the given tables; each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmill.catalog import bindings
from txmill.functions import hash32, uniform
from txmill.functions.permutation import permuted
from txmill.operators import clean, features, metrics, profile, registry, split, synth
from txmill.operators import model as models
from txmill.plans import clean_job, retrain_job, score_job, synth_job
from txmill.sources import tables, text
from txmill.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

KEY = clean.KEY
# Training rows are dealt out by key to so many partitions.
PARTITIONS = 8
ANCHOR = "2024-06-01 00:00:00"
SCALED = ["terminal_id", "tx_amount", "tx_time_seconds"]
REPORT_COLUMNS = ["transaction_id", "customer_id", "terminal_id", "tx_amount"]


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Columns to that many digits. Plain arithmetic, because round() goes through decimal text."""
    scale = F.lit(10.0**digits)
    return df.withColumns(
        {c: F.floor(F.col(c).cast("double") * scale + F.lit(0.5)) / scale for c in columns}
    )


def _shown(df: DataFrame) -> DataFrame:
    """Transactions in the form that is compared: amounts to 2 digits, dates as text."""
    return _rounded(df, 2, "tx_amount").withColumn(
        "tx_datetime", F.col("tx_datetime").cast("string")
    )


def _names(lines: DataFrame) -> list[str]:
    return text.header_columns(text.find_header(lines), len(clean.FIELD_TYPES))


# Cleaning


def scan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    bindings.raw_lines(spark, sf_dir).write.text(path)
    return text.read_lines(spark, f"{path}/*.txt")


def header_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _names(bindings.raw_lines(spark, sf_dir))
    return tables.rows_to_table(spark, list(enumerate(names)), ["position", "name"])


def drop_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_comments(bindings.raw_lines(spark, sf_dir))


def split_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = bindings.raw_lines(spark, sf_dir)
    return clean.split_fields(clean.drop_comments(lines), _names(lines))


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = bindings.raw_lines(spark, sf_dir)
    return clean.typed_fields(clean.drop_comments(lines), _names(lines))


def typed_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values after the cast; all but the amount are shown as text, because many are NULL."""
    typed = clean.cast_fields(split_fields(spark, sf_dir))
    amount = F.col("tx_amount")
    known = typed.withColumn("amount_is_nan", F.isnan(amount)).withColumn(
        "tx_amount", F.when(~F.isnan(amount), amount)
    )
    texts = [c for c in typed.columns if c != "tx_amount"]
    return _rounded(known, 2, "tx_amount").withColumns(
        {c: F.col(c).cast("string") for c in texts}
    )


def field_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The types after the cast, and how many values each column holds."""
    typed = _typed(spark, sf_dir)
    kinds = F.array(
        *[
            F.struct(F.lit(n).alias("column"), F.lit(t).alias("type"), F.count(n).alias("values"))
            for n, t in typed.dtypes
        ]
    )
    return typed.agg(kinds.alias("kinds")).select(F.inline("kinds"))


def drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(clean.drop_incomplete(_typed(spark, sf_dir)))


def rename_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.rename_key(drop_incomplete(spark, sf_dir))


def dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = bindings.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    return clean.keep_one_per_key(lineitem, "l_orderkey")


def dedup_by_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = bindings.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_returnflag"
    )
    return clean.keep_one_per_key(lineitem, ["l_orderkey", "l_linenumber"])


def dedup_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three keys only, so each holds about a third of the rows."""
    lineitem = bindings.table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey"
    )
    return clean.keep_one_per_key(lineitem, "l_returnflag")


def clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = bindings.raw_lines(spark, sf_dir)
    return _shown(clean.clean_transactions(lines, _names(lines)))


def clean_reordered_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id stands third, after the customer."""
    lines = bindings.reordered_lines(spark, sf_dir)
    return _shown(clean.clean_transactions(lines, _names(lines)))


def clean_job_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files in, Parquet out, run twice over the same output as a scheduler would."""
    source, target = scratch_path(spark, "lines"), scratch_path(spark, "cleaned")
    bindings.raw_lines(spark, sf_dir).write.text(source)
    clean_job.run(spark, f"{source}/*.txt", target)
    clean_job.run(spark, f"{source}/*.txt", target, mode="overwrite", files=5)
    return _shown(tables.read_parquet(spark, target))


def clean_own_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that name their columns in two different orders, each read by its own header."""
    source = scratch_path(spark, "lines")
    for name, lines in zip(("a", "b"), bindings.lines_in_two_orders(spark, sf_dir), strict=True):
        lines.write.text(f"{source}/{name}")
    return _shown(clean_job.cleaned_files(text.read_file_lines(spark, f"{source}/*/*.txt")))


def clean_job_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean job twice, the second time over all files; readers get the second version."""
    source, target = scratch_path(spark, "lines"), scratch_path(spark, "cleaned")
    for name, lines in zip(("a", "b"), bindings.lines_in_two_orders(spark, sf_dir), strict=True):
        lines.write.text(f"{source}/{name}")
    clean_job.run(spark, f"{source}/a/*.txt", target, mode="replace")
    clean_job.run(spark, f"{source}/*/*.txt", target, mode="replace")
    return _shown(tables.read_parquet(spark, target))


def clean_job_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records the clean job met, dropped and kept."""
    source, target = scratch_path(spark, "lines"), scratch_path(spark, "cleaned")
    bindings.raw_lines(spark, sf_dir).write.text(source)
    found = clean_job.run(spark, f"{source}/*.txt", target, report=True)
    return tables.rows_to_table(spark, [tuple(found.values())], list(found))


# Sources and sinks


def read_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_parquet(
        spark, f"{sf_dir}/events.parquet", ["event_id", "user_id", "event_type", "value"]
    )


def read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "transactions")
    tables.write_parquet(bindings.transactions(spark, sf_dir), path)
    return tables.read_parquet(spark, path, REPORT_COLUMNS)


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    rows = bindings.transactions(spark, sf_dir).select(*REPORT_COLUMNS)
    tables.write_csv(rows, path)
    return tables.read_csv(
        spark,
        path,
        "transaction_id bigint, customer_id bigint, terminal_id int, tx_amount double",
    )


# Profiling


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = split.with_split(bindings.transactions(spark, sf_dir), KEY)
    return profile.group_counts(parts, "split")


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_profile(_typed(spark, sf_dir))


def split_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = clean.rename_key(_typed(spark, sf_dir)).select(*REPORT_COLUMNS)
    return profile.split_profile(split.with_split(typed, "customer_id"), "split")


def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bindings.transactions(spark, sf_dir).select(*REPORT_COLUMNS)
    return profile.first_rows(rows, ["tx_amount", KEY])


def label_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = profile.label_summary(bindings.transactions(spark, sf_dir), features.LABEL)
    return _rounded(summary, 6, "positive_pct")


# Splitting and sampling


def _tagged(kept: DataFrame, rest: DataFrame, names: tuple[str, str]) -> DataFrame:
    first, second = (
        df.select(KEY, F.lit(name).alias("part"))
        for df, name in zip((kept, rest), names, strict=True)
    )
    return first.unionByName(second)


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = split.hash_split(bindings.transactions(spark, sf_dir), KEY)
    return _tagged(train, test, ("train", "test"))


def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = split.random_split(bindings.transactions(spark, sf_dir))
    return _tagged(train, test, ("train", "test"))


def random_split_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whatever rows the random split draws, both parts together hold each row once."""
    return random_split(spark, sf_dir).agg(
        F.count("*").alias("rows"), F.countDistinct(KEY).alias("transactions")
    )


def sample_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, rest = split.sample_and_rest(bindings.transactions(spark, sf_dir), KEY, seed=7)
    return _tagged(kept, rest, ("sample", "rest"))


def sample_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, rest = split.sample_and_rest(bindings.transactions(spark, sf_dir), KEY, exact=True)
    return _tagged(kept, rest, ("sample", "rest"))


def fold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = models.with_fold(bindings.transactions(spark, sf_dir), KEY)
    return profile.group_counts(folded, "fold")


# Generated transactions


def format_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bindings.table(spark, sf_dir, "events").select(
        "event_id", synth.format_ids(F.col("event_id")).alias("transaction_id")
    )


def reorder_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["tx_fraud", "tx_amount", "terminal_id", "transaction_id"]
    return synth.reorder_columns(bindings.transactions(spark, sf_dir), order)


def random_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    anchor = F.lit(ANCHOR).cast("timestamp_ntz")
    return bindings.table(spark, sf_dir, "events").select(
        "event_id",
        synth.minutes_back(anchor, uniform(hash32("event_id", "minutes"))).alias("timestamp"),
    )


DOUBLES = (
    "amount",
    "distance_from_home",
    "distance_from_last_transaction",
    "ratio_to_median_purchase_price",
)


def synth_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generated transaction per event, whose ids are row numbers from 0."""
    ids = bindings.table(spark, sf_dir, "events").select("event_id")
    made = synth.transactions_for(ids, "event_id", count=ids.count(), anchor=ANCHOR)
    return _rounded(made, 4, *DOUBLES)


def synth_job_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many generated transactions as there are events, in CSV files: rows and frauds per file
    set, and whether the two sets share an id."""
    path = scratch_path(spark, "synth")
    count = bindings.table(spark, sf_dir, "events").count()
    synth_job.run(spark, path, count=count, anchor=ANCHOR)
    schema = spark.createDataFrame([], synth_job.SCHEMA).schema
    parts = [
        tables.read_csv(spark, f"{path}/{part}", schema).withColumn("part", F.lit(part))
        for part in ("train", "test")
    ]
    return parts[0].unionByName(parts[1]).agg(
        F.count("*").alias("rows"),
        F.countDistinct("transaction_id").alias("ids"),
        F.sum(F.col("fraud").cast("bigint")).alias("frauds"),
        F.count_if(F.col("part") == F.lit("train")).alias("train_rows"),
    )


def synth_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a keyed permutation puts each event, whose ids are row numbers from 0, and whether it
    is in an exact sample of four fifths."""
    ids = bindings.table(spark, sf_dir, "events").select("event_id")
    count = ids.count()
    place = permuted(F.col("event_id"), count, "sample-42")
    sampled = place < F.lit(round(0.8 * count))
    return ids.select("event_id", place.alias("place"), sampled.alias("sampled"))


def synth_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids in shuffled order, with the class each belongs to."""
    ids = bindings.table(spark, sf_dir, "events").select("event_id")
    made = synth.transactions_for(
        split.shuffled_position(ids, "event_id"),
        "event_id",
        count=ids.count(),
        anchor=ANCHOR,
        number="position",
    )
    return made.select("transaction_id", "fraud", "hour_of_day")


# Features


def _feature_columns(df: DataFrame) -> list[str]:
    return features.feature_columns(df.schema)


def _vector_columns(df: DataFrame, vector: str, names: list[str]) -> list[Column]:
    values = vector_to_array(vector)
    return [F.get(values, F.lit(i)).alias(n) for i, n in enumerate(names)]


def assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bindings.transactions(spark, sf_dir)
    names = _feature_columns(rows)
    vectors = features.assemble(rows, names)
    return vectors.select(*_vector_columns(vectors, features.RAW_VECTOR, names))


def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bindings.transactions(spark, sf_dir).select(KEY, *SCALED)
    return _rounded(features.standardize(rows, SCALED), 6, *SCALED)


def standardize_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scaling stage of the training pipeline."""
    rows = bindings.transactions(spark, sf_dir).select(KEY, *SCALED)
    vectors = features.assemble(rows, SCALED)
    scaled = models.build_scaler().fit(vectors).transform(vectors)
    return _rounded(
        scaled.select(KEY, *_vector_columns(scaled, features.VECTOR, SCALED)), 6, *SCALED
    )


# Metrics


def auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.area_under_roc(bindings.scored(spark, sf_dir)), 9, "auc")


def auc_few_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores with many ties: a third of the line items share each of a few values."""
    lineitem = bindings.table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == F.lit("R")).cast("int").alias("label"),
        F.greatest(F.col("l_quantity"), F.lit(20.0)).alias("score"),
    )
    return _rounded(metrics.area_under_roc(lineitem), 9, "auc")


def auc_evaluator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark ML's evaluator without bins, which is exact."""
    rows = bindings.scored(spark, sf_dir).withColumn("label", F.col("label").cast("double"))
    exact = models.auc_evaluator("label", "score", bins=0)
    return _rounded(tables.rows_to_table(spark, [(exact.evaluate(rows),)], ["auc"]), 9, "auc")


def auc_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluator as training uses it, with bins: a share, and close to the exact value."""
    rows = bindings.scored(spark, sf_dir).withColumn("label", F.col("label").cast("double"))
    binned = models.auc_evaluator("label", "score").evaluate(rows)
    exact = metrics.area_under_roc(rows).withColumns(
        {
            "binned_is_auc": F.lit(binned).between(0.0, 1.0),
            "binned_is_near": F.abs(F.lit(binned) - F.col("auc")) < F.lit(0.001),
        }
    )
    return _rounded(exact, 9, "auc")


def auc_saturated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores that all lie within 1e-9 of 1, as those of a very sure model."""
    line = F.col("l_extendedprice") * F.lit(1e-15)
    lineitem = bindings.table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == F.lit("R")).cast("int").alias("label"),
        (F.lit(1.0) - line).alias("score"),
    )
    return _rounded(metrics.area_under_roc(lineitem), 9, "auc")


def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.accuracy(bindings.scored(spark, sf_dir)), 9, "accuracy")


def f1_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.classification_metrics(bindings.scored(spark, sf_dir))
    return _rounded(found, 9, "accuracy", "f1", "f1_positive")


def evaluate_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics of a training run, with the exact AUC."""
    score = F.col("score")
    rows = bindings.scored(spark, sf_dir).select(
        F.col("label").cast("double"),
        F.col("prediction").cast("double"),
        array_to_vector(F.array(-score, score)).alias("rawPrediction"),
    )
    names = ["auc", "accuracy", "f1"]
    found = models.evaluate(rows, "label", exact_auc=True)
    one = tables.rows_to_table(spark, [tuple(found[n] for n in names)], names)
    return _rounded(one, 9, *names)


def f1_evaluator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy and F1 of a training run alone."""
    return evaluate_scored(spark, sf_dir).select("accuracy", "f1")


def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(bindings.scored(spark, sf_dir))


def class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = bindings.table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("label"),
        (F.lit(1) + F.col("l_suppkey") % F.lit(8)).alias("prediction"),
    )
    found = metrics.class_scores(metrics.confusion(lineitem))
    return _rounded(found, 9, "precision", "recall", "f1")


# Registry


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = registry.model_versions(bindings.registrations(spark, sf_dir))
    return versions.select("model_name", "run_id", "version")


def version_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Champions over derived versions, with the metrics joined from the runs."""
    runs = bindings.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("value").alias("auc"),
        (F.col("value") / F.lit(2.0)).alias("accuracy"),
        (F.col("value") / F.lit(4.0)).alias("f1"),
    )
    history = registry.version_history(bindings.registrations(spark, sf_dir), runs)
    best = registry.champions(history)
    return best.select("model_name", "version", "run_id", "auc", "accuracy", "f1")


def promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.promotions(bindings.run_history(spark, sf_dir))


def champion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.champions(bindings.run_history(spark, sf_dir))


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.aliases(bindings.run_history(spark, sf_dir))


def improvement_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = registry.improvements(bindings.run_history(spark, sf_dir))
    return _rounded(found, 6, "improvement_pct")


# Models


def _train_and_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    train, test = split.hash_split(bindings.transactions(spark, sf_dir), KEY)
    return models.laid_out(train, KEY, PARTITIONS), test


def _fit(train: DataFrame, model_type: str):
    columns = _feature_columns(train)
    needed = train.select(*columns, features.LABEL).persist()
    try:
        return models.build_stages(columns, models.build_classifier(model_type)).fit(needed)
    finally:
        needed.unpersist()


def _scores(df: DataFrame) -> DataFrame:
    return df.select(
        KEY,
        features.LABEL,
        F.get(vector_to_array("probability"), F.lit(1)).alias("fraud_probability"),
        "prediction",
    )


def score_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows scored by a forest, and how many break what holds for any classifier."""
    train, test = _train_and_test(spark, sf_dir)
    p, chosen = F.col("fraud_probability"), F.col("prediction")
    return _scores(models.score(_fit(train, "rf"), test)).agg(
        F.count("*").alias("rows"),
        F.count_if(p.isNull() | ~p.between(0.0, 1.0)).alias("outside"),
        F.count_if((chosen == F.lit(1.0)) != (p > F.lit(0.5))).alias("other_side"),
    )


def score_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows scored by a logistic regression with an intercept and no penalty, for which
    the probabilities add up to the positives."""
    train, _ = _train_and_test(spark, sf_dir)
    return _scores(models.score(_fit(train, "lr"), train)).agg(
        F.count("*").alias("rows"),
        F.round(F.sum("fraud_probability")).cast("bigint").alias("expected_positives"),
    )


def model_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows, and how many a saved and loaded model scores differently."""
    train, test = _train_and_test(spark, sf_dir)
    fitted = _fit(train, "rf")
    path = scratch_path(spark, "model")
    models.save_model(fitted, path)
    before = models.score(fitted, test).withColumnRenamed("prediction", "before")
    kept = before.drop(features.RAW_VECTOR, features.VECTOR, "rawPrediction", "probability")
    both = models.score(models.load_model(path), kept)
    return both.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("before") != F.col("prediction")).alias("different"),
    )


def score_job_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All transactions scored in a batch by the registered champion, and what holds of its scores."""
    train, _ = _train_and_test(spark, sf_dir)
    source, target, kept = (scratch_path(spark, n) for n in ("rows", "scores", "registry"))
    model_name = registry.MODEL_NAME_FORMAT.format(experiment=retrain_job.EXPERIMENT)
    models.save_model(_fit(train, "lr"), retrain_job.run_model_path(kept, "only"))
    registry.record_run(spark, f"{kept}/runs", {"run_id": "only", "model_name": model_name, "auc": 0.5})
    registry.register_run(spark, f"{kept}/registrations", model_name, "only")
    tables.write_parquet(bindings.transactions(spark, sf_dir), source)
    done = score_job.run(spark, source, kept, target, mode="replace")
    p, chosen = F.col(score_job.PROBABILITY), F.col("prediction")
    return tables.read_parquet(spark, target).agg(
        F.count("*").alias("rows"),
        F.countDistinct(KEY).alias("transactions"),
        F.count_if(p.isNull() | ~p.between(0.0, 1.0)).alias("outside"),
        F.count_if((chosen == F.lit(1.0)) != (p > F.lit(0.5))).alias("other_side"),
        (F.lit(done["rows"]) == F.count("*")).alias("counted_rows"),
        (F.lit(done["frauds"]) == F.count_if(chosen == F.lit(1.0))).alias("counted_frauds"),
    )


def grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combinations of the grid, whether each mean AUC is one, and if one best was refitted."""
    rows = bindings.transactions(spark, sf_dir)
    tuned = models.cross_validate(rows, _feature_columns(rows), KEY, partitions=PARTITIONS)
    best = models.best_parameters(tuned.bestModel)
    means = [float(m) for m in tuned.avgMetrics]
    found = []
    for params, mean in zip(tuned.getEstimatorParamMaps(), means, strict=True):
        trees, depth = (int(v) for v in params.values())
        chosen = (trees, depth) == (best["best_numTrees"], best["best_maxDepth"])
        found.append((trees, depth, 0.0 <= mean <= 1.0, chosen == (mean == max(means))))
    names = ["num_trees", "max_depth", "mean_is_auc", "best_is_largest"]
    return tables.rows_to_table(spark, found, names)


def retrain_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole retrain job on stored transactions, and the history it leaves."""
    source, target, kept = (scratch_path(spark, n) for n in ("train", "model", "registry"))
    tables.write_parquet(bindings.transactions(spark, sf_dir), source)
    retrain_job.retrain(
        spark,
        source,
        target,
        registry_path=kept,
        auto_register=True,
        run_name="cycle",
        partitions=PARTITIONS,
    )
    runs = tables.read_parquet(spark, f"{kept}/runs").drop("model_name", "auc", "accuracy", "f1")
    history = registry.promotions(retrain_job.history_of(spark, kept)).join(runs, "run_id")
    inside = [F.col(c).between(0.0, 1.0) for c in ("auc", "accuracy", "f1")]
    tried = F.array_contains("numTrees_options", F.col("best_numTrees")) & F.array_contains(
        "maxDepth_options", F.col("best_maxDepth")
    )
    return history.select(
        "model_name",
        "version",
        "run_name",
        "model_type",
        F.array_join(F.col("numTrees_options").cast("array<string>"), ",").alias("trees"),
        F.array_join(F.col("maxDepth_options").cast("array<string>"), ",").alias("depths"),
        "promoted",
        (inside[0] & inside[1] & inside[2]).alias("metrics_in_range"),
        tried.alias("best_in_grid"),
    )


def retrain_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the retrain job says about its data and its decision."""
    source, target, kept = (scratch_path(spark, n) for n in ("train", "model", "registry"))
    tables.write_parquet(bindings.transactions(spark, sf_dir), source)
    done = retrain_job.retrain(
        spark,
        source,
        target,
        registry_path=kept,
        auto_register=True,
        partitions=PARTITIONS,
    )
    version = retrain_job.history_of(spark, kept).first()["version"]
    row = (done["rows"]["train"], done["rows"]["test"], ",".join(done["features"]), version)
    names = ["train_rows", "test_rows", "features", "version", "promoted"]
    return tables.rows_to_table(spark, [(*row, done["promoted"])], names)


_QUERIES: tuple[Query, ...] = (
    scan_lines,
    header_columns,
    drop_comments,
    split_fields,
    typed_cast,
    field_types,
    drop_incomplete,
    rename_key,
    dedup_by_key,
    dedup_by_two_keys,
    dedup_by_flag,
    clean_transactions,
    clean_reordered_header,
    clean_job_files,
    clean_own_headers,
    clean_job_replace,
    clean_job_report,
    read_parquet,
    read_back,
    csv_round_trip,
    split_counts,
    null_profile,
    split_profile,
    first_rows,
    label_summary,
    hash_split,
    random_split,
    random_split_totals,
    sample_complement,
    sample_exact,
    fold_counts,
    format_ids,
    reorder_columns,
    random_minutes,
    synth_transactions,
    synth_places,
    synth_shuffled,
    synth_job_files,
    assemble,
    standardize,
    standardize_ml,
    auc,
    auc_few_scores,
    auc_evaluator,
    auc_binned,
    auc_saturated,
    accuracy,
    f1_weighted,
    evaluate_scored,
    f1_evaluator,
    confusion,
    class_scores,
    model_versions,
    version_history,
    promotions,
    champion,
    aliases,
    improvement_pct,
    score_test,
    score_logistic,
    model_reload,
    score_job_files,
    grid_search,
    retrain_cycle,
    retrain_report,
)

QUERIES: dict[str, Query] = {q.__name__: q for q in _QUERIES}
