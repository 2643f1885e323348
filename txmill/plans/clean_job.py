"""Clean job: raw text files in, typed transactions in Parquet out.

    spark-submit txmill/plans/clean_job.py --input 's3a://bucket/in/*.txt' --output s3a://bucket/out

Running it again on the same input gives the same table, so a scheduler may repeat it. ``--mode
replace`` shows readers the old table until the new one is whole; ``--mode overwrite`` deletes first.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmill.operators.clean import (
    BROADCAST_FILES,
    FIELD_TYPES,
    KEY,
    clean_transactions,
    complete_transactions,
    drop_comments,
    located_fields,
    proper_names,
)
from txmill.sources.tables import write_parquet
from txmill.sources.text import file_headers, find_header, header_columns, read_file_lines

# Where the files lie in a bucket.
INPUT_FORMAT = "s3a://{bucket}/input_data/*.txt"
OUTPUT_FORMAT = "s3a://{bucket}/output_data/prepare_data.parquet"


def cleaned(lines: DataFrame, header: str) -> DataFrame:
    """Transactions from raw lines whose columns are named by ``header``."""
    return clean_transactions(lines, header_columns(header, len(FIELD_TYPES)))


def headed_lines(
    lines: DataFrame, *, check_headers: bool = False, broadcast_files: int = BROADCAST_FILES
) -> tuple[DataFrame, list[str]]:
    """Lines of many files, to be read by the header of their own, and the columns they name.

    The first file with a header, by path, decides the columns and their order. Files without one are
    read like it; a file that lacks one of the columns is refused. ``check_headers`` refuses all
    files that name other columns or in another order. Runs one scan for the headers at once.
    """
    headers = file_headers(lines, len(FIELD_TYPES))
    # One row per different header.
    kinds = headers.groupBy("names").agg(F.min("file").alias("file"), F.count("*").alias("files"))
    kinds = sorted(kinds.collect(), key=lambda k: k["file"])
    if not kinds:  # says why
        return lines, header_columns(find_header(lines), len(FIELD_TYPES))
    names = list(kinds[0]["names"])
    proper = proper_names(names)
    others = [k for k in kinds if proper_names(k["names"]) != proper]
    for other in others:
        if check_headers:
            raise ValueError(
                f"columns differ between files: {', '.join(names)} and {', '.join(other['names'])}"
            )
        missing = set(proper) - set(proper_names(other["names"]))
        if missing:
            raise ValueError(f"{other['file']} names no column {', '.join(sorted(missing))}")
    if others:
        few = sum(k["files"] for k in others) <= broadcast_files
        lines = located_fields(lines, headers, names, broadcast=few)
    return lines, names


def cleaned_files(lines: DataFrame, **options) -> DataFrame:
    """Transactions from the lines of many files; options as in ``headed_lines``."""
    return clean_transactions(*headed_lines(lines, **options))


def run(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    files: int | None = None,
    mode: str = "errorifexists",
    check_headers: bool = False,
    report: bool = False,
) -> dict[str, int] | None:
    """Clean ``source`` into ``target``; files may name their columns in different orders.

    ``report`` parses the text once more, to count records and how many of them were incomplete,
    repeated an id, or were kept.
    """
    lines, names = headed_lines(read_file_lines(spark, source), check_headers=check_headers)
    write_parquet(clean_transactions(lines, names), target, files=files, mode=mode)
    if not report:
        return None
    records = drop_comments(lines).count()
    complete = complete_transactions(lines, names).agg(F.count(F.lit(1)), F.countDistinct(KEY)).first()
    return {
        "records": records, "incomplete": records - complete[0],
        "repeated": complete[0] - complete[1], "kept": complete[1],
    }


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Clean raw transaction text into Parquet")
    parser.add_argument("--input", help="path or glob of the text files")
    parser.add_argument("--output", help="path of the Parquet table")
    parser.add_argument("--bucket", help="bucket with the standard layout, instead of both paths")
    parser.add_argument("--files", type=int, help="number of output files")
    parser.add_argument(
        "--mode", default="errorifexists", choices=["errorifexists", "overwrite", "append", "replace"]
    )
    parser.add_argument(
        "--check-headers",
        action="store_true",
        help="fail if files name different columns; by default each is read by its own header",
    )
    parser.add_argument("--report", action="store_true", help="count what was dropped; parses twice")
    args = parser.parse_args(argv)
    if args.bucket:
        args.input = args.input or INPUT_FORMAT.format(bucket=args.bucket)
        args.output = args.output or OUTPUT_FORMAT.format(bucket=args.bucket)
    if not (args.input and args.output):
        parser.error("give --input and --output, or --bucket")
    return args


def main(argv: Sequence[str] | None = None) -> None:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("clean_transactions").getOrCreate()
    try:
        found = run(
            spark,
            args.input,
            args.output,
            files=args.files,
            mode=args.mode,
            check_headers=args.check_headers,
            report=args.report,
        )
        print("\n".join(f"{name}: {rows}" for name, rows in (found or {}).items()))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
