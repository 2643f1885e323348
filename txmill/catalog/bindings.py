"""The given tables seen as transactions, raw lines, scored rows and run histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmill.functions import wall_clock_seconds

HEADER = (
    "# tranaction_id | tx_datetime | customer_id | terminal_id | tx_amount"
    " | tx_time_seconds | tx_time_days | tx_fraud | tx_fraud_scenario"
)
EPOCH = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a typed transaction."""
    ts, error = F.col("ts"), F.col("event_type") == F.lit("error")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("transaction_id"),
        F.to_date(ts).alias("tx_datetime"),
        F.col("user_id").alias("customer_id"),
        F.get_json_object("props", "$.k").cast("int").alias("terminal_id"),
        F.col("value").alias("tx_amount"),
        wall_clock_seconds(ts, EPOCH).cast("int").alias("tx_time_seconds"),
        F.datediff(F.to_date(ts), F.lit(EPOCH).cast("date")).alias("tx_time_days"),
        error.cast("int").alias("tx_fraud"),
        F.when(error, F.lit(1) + F.col("user_id") % F.lit(3))
        .otherwise(F.lit(0))
        .cast("int")
        .alias("tx_fraud_scenario"),
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a line of text, with duplicate ids and many kinds of dirt."""
    events = table(spark, sf_dir, "events")
    number = F.col("event_id")

    def each(step: int, at: int = 0) -> Column:
        return number % F.lit(step) == F.lit(at)

    ts, error = F.col("ts"), F.col("event_type") == F.lit("error")
    terminal = F.get_json_object("props", "$.k")
    day = F.datediff(F.to_date(ts), F.lit(EPOCH).cast("date"))
    fields = [
        F.when(each(41, 5), F.lit("99999999999")).otherwise(
            F.floor(number / F.lit(2)).cast("string")
        ),
        F.when(each(43, 7), F.lit("2019-13-45")).otherwise(
            F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 19)
        ),
        F.when(each(53, 11), F.concat(F.lit(" +"), F.col("user_id"))).otherwise(
            F.col("user_id").cast("string")
        ),
        F.when(each(17), F.lit("Err"))
        .when(each(19), F.concat(terminal, F.lit(".9")))
        .otherwise(terminal),
        F.when(each(23), F.lit(""))
        .when(each(29), F.lit("NaN"))
        .otherwise(F.col("value").cast("decimal(12,2)").cast("string")),
        wall_clock_seconds(ts, EPOCH).cast("string"),
        day.cast("string"),
        error.cast("int").cast("string"),
        F.when(error, F.lit(1) + F.col("user_id") % F.lit(3)).otherwise(F.lit(0)).cast("string"),
    ]
    line = F.concat_ws(",", *fields)
    dirty = (
        F.when(each(97), F.lit(HEADER))
        .when(each(31), F.concat(number.cast("string"), F.lit(",bad")))
        .when(each(37), F.lit(""))
        .when(each(47), F.concat(line, F.lit(",extra")))
        .otherwise(line)
    )
    # As a generated column, so that filters on the text do not build it a second time.
    return events.select(F.explode(F.array(dirty)).alias("value"))


def _reordered(lines: DataFrame) -> DataFrame:
    names = HEADER.removeprefix("# ").split(" | ")
    names[0], names[2] = names[2], names[0]
    parts = F.split("value", ",")
    swapped = F.concat_ws(
        ",", parts[2], parts[1], parts[0], F.slice(parts, F.lit(4), F.size(parts))
    )
    value = (
        F.when(F.col("value").startswith("#"), F.lit("# " + " | ".join(names)))
        .when(F.size(parts) > F.lit(3), swapped)
        .otherwise(F.col("value"))
    )
    return lines.select(value.alias("value"))


def reordered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines with the customer's column first and the id third, in data and header."""
    return _reordered(raw_lines(spark, sf_dir))


def lines_in_two_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Half of the lines as they are, the others reordered; both with header lines."""
    lines = raw_lines(spark, sf_dir)
    first = F.crc32(F.col("value").cast("binary")) % F.lit(2) == F.lit(0)
    header = F.col("value").startswith("#")
    return lines.filter(first | header), _reordered(lines.filter(~first | header))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with a label, a score and a prediction that SQL can compute too."""
    return table(spark, sf_dir, "events").select(
        (F.col("event_type") == F.lit("error")).cast("int").alias("label"),
        F.col("value").alias("score"),
        (F.col("value") > F.lit(25.0)).cast("int").alias("prediction"),
    )


def _model_name() -> Column:
    hot = F.col("event_id") % F.lit(3) == F.lit(0)
    return F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("user_"), F.col("user_id")))


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a model version with an AUC; one model holds a third of them."""
    auc = F.when(F.col("event_id") % F.lit(13) != F.lit(0), F.col("value"))
    return table(spark, sf_dir, "events").select(
        _model_name().alias("model_name"),
        F.col("event_id").alias("version"),
        auc.alias("auc"),
    )


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as the registration of a run; one model holds a third of them."""
    return table(spark, sf_dir, "events").select(
        _model_name().alias("model_name"),
        F.col("event_id").cast("string").alias("run_id"),
        F.col("ts").alias("recorded_at"),
    )
