"""Generator job: labelled synthetic transactions, split into train and test, as CSV files.

    spark-submit txmill/plans/synth_job.py --output s3a://bucket/demo --rows 100000
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from txmill.operators.profile import label_summary
from txmill.operators.split import SEED, TRAIN_FRACTION
from txmill.operators.synth import FRAUD_RATE, ROWS, synthetic_transactions
from txmill.sources.tables import write_csv

# The columns of the generated files.
LABEL = "fraud"
SCHEMA = (
    "transaction_id string, timestamp timestamp_ntz, amount double, hour_of_day int, "
    "day_of_week int, distance_from_home double, distance_from_last_transaction double, "
    "ratio_to_median_purchase_price double, repeat_retailer int, used_chip int, "
    "used_pin_number int, online_order int, fraud int"
)


def run(
    spark: SparkSession,
    target: str,
    *,
    count: int = ROWS,
    anchor: str | None = None,
    fraud_rate: float = FRAUD_RATE,
    fraction: float = TRAIN_FRACTION,
    seed: int = SEED,
    mode: str = "errorifexists",
) -> dict:
    """Write the folders ``train`` and ``test`` under ``target``; returns the label summary.

    Exactly ``round(fraction * count)`` rows are in ``train``. Times lie before ``anchor``, by
    default now; all else depends on the seed only. Each row is made once, where it is written; the
    summary counts the labels in the files.
    """
    end = anchor or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    size = round(fraction * count)
    for part, places in (("train", range(size)), ("test", range(size, count))):
        rows = synthetic_transactions(
            spark, anchor=end, count=count, fraud_rate=fraud_rate, seed=seed, shuffle=True, places=places
        )
        write_csv(rows, f"{target}/{part}", mode=mode)
    written = spark.read.schema(SCHEMA).option("header", True)
    every = written.csv([f"{target}/train", f"{target}/test"]).select(F.col(LABEL))
    return label_summary(every, LABEL).first().asDict()


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Generate labelled transactions")
    parser.add_argument("--output", required=True, help="folder for train and test files")
    parser.add_argument("--rows", type=int, default=ROWS)
    parser.add_argument("--fraud-rate", type=float, default=FRAUD_RATE)
    parser.add_argument("--seed", type=int, default=SEED)
    parser.add_argument("--anchor", help="latest time, YYYY-MM-DD HH:MM:SS; default now")
    parser.add_argument("--mode", default="errorifexists")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> int:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("synth").getOrCreate()
    try:
        found = run(
            spark,
            args.output,
            count=args.rows,
            anchor=args.anchor,
            fraud_rate=args.fraud_rate,
            seed=args.seed,
            mode=args.mode,
        )
        print(f"rows: {found['rows']}")
        share = found["positive_pct"]
        print(f"fraud: {found['positives']}" + ("" if share is None else f" ({share:.2f} %)"))
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
