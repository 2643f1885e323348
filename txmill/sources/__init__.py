"""Reading and writing: delimited text, Parquet, CSV, inline rows, object-store settings."""

from txmill.sources.objectstore import s3a_settings
from txmill.sources.scratch import scratch_path
from txmill.sources.tables import (
    read_csv,
    read_parquet,
    rows_to_table,
    write_csv,
    write_parquet,
)
from txmill.sources.text import COMMENT, find_header, header_columns, read_lines

__all__ = [
    "COMMENT",
    "find_header",
    "header_columns",
    "read_csv",
    "read_lines",
    "read_parquet",
    "rows_to_table",
    "s3a_settings",
    "scratch_path",
    "write_csv",
    "write_parquet",
]
