"""DuckDB SQL for the queries, written from the rules and not from the Spark code's plans."""

from __future__ import annotations

# Everything is written out here: a wrong constant in the library must not be repeated in the SQL.
EPOCH = "2024-01-01"
ANCHOR = "2024-06-01 00:00:00"
HEADER = (
    "# tranaction_id | tx_datetime | customer_id | terminal_id | tx_amount"
    " | tx_time_seconds | tx_time_days | tx_fraud | tx_fraud_scenario"
)
FIELD_TYPES = ["int", "date", "int", "int", "float", "int", "int", "int", "int"]
FRAUD_RATE = 0.05

# Column: kind, number of its first uniform draw, parameters of normal and fraudulent rows.
DRAWS = {
    "amount": ("lognormal", 1, (5.0, 1.0), (6.0, 2.0)),
    "hour_of_day": ("integer", 3, (24,), (24,)),
    "day_of_week": ("integer", 4, (7,), (7,)),
    "distance_from_home": ("exponential", 5, (30.0,), (100.0,)),
    "distance_from_last_transaction": ("exponential", 6, (20.0,), (100.0,)),
    "ratio_to_median_purchase_price": ("normal", 7, (1.0, 0.5), (3.0, 1.0)),
    "repeat_retailer": ("bernoulli", 9, (0.5,), (0.2,)),
    "used_chip": ("bernoulli", 10, (0.9,), (0.2,)),
    "used_pin_number": ("bernoulli", 11, (0.8,), (0.2,)),
    "online_order": ("bernoulli", 12, (0.4,), (0.8,)),
}


def _round(value: str, digits: int) -> str:
    return f"floor(({value}) * 1e{digits}::DOUBLE + 0.5::DOUBLE) / 1e{digits}::DOUBLE"


COLUMNS = [
    "transaction_id",
    "tx_datetime",
    "customer_id",
    "terminal_id",
    "tx_amount",
    "tx_time_seconds",
    "tx_time_days",
    "tx_fraud",
    "tx_fraud_scenario",
]
RAW_COLUMNS = ["tranaction_id", *COLUMNS[1:]]

_TERMINAL = r"regexp_extract(props, '\"k\": *(\d+)', 1)"
_DAYS = f"date_diff('day', DATE '{EPOCH}', CAST(ts AS DATE))"
_SECONDS = f"({_DAYS} * 86400 + hour(ts) * 3600 + minute(ts) * 60 + second(ts))"
_SCENARIO = "CASE WHEN event_type = 'error' THEN 1 + user_id % 3 ELSE 0 END"

TX = f"""tx AS (
    SELECT event_id AS transaction_id, CAST(ts AS DATE) AS tx_datetime, user_id AS customer_id,
           CAST({_TERMINAL} AS INTEGER) AS terminal_id, value AS tx_amount,
           CAST({_SECONDS} AS INTEGER) AS tx_time_seconds, CAST({_DAYS} AS INTEGER) AS tx_time_days,
           CAST(event_type = 'error' AS INTEGER) AS tx_fraud,
           CAST({_SCENARIO} AS INTEGER) AS tx_fraud_scenario
    FROM events)"""

RAW = f"""fields AS (
    SELECT event_id,
        concat_ws(',',
            CASE WHEN event_id % 41 = 5 THEN '99999999999'
                 ELSE CAST(event_id // 2 AS VARCHAR) END,
            CASE WHEN event_id % 43 = 7 THEN '2019-13-45'
                 ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END,
            CASE WHEN event_id % 53 = 11 THEN ' +' || user_id ELSE CAST(user_id AS VARCHAR) END,
            CASE WHEN event_id % 17 = 0 THEN 'Err'
                 WHEN event_id % 19 = 0 THEN {_TERMINAL} || '.9' ELSE {_TERMINAL} END,
            CASE WHEN event_id % 23 = 0 THEN '' WHEN event_id % 29 = 0 THEN 'NaN'
                 ELSE CAST(CAST(value AS DECIMAL(12, 2)) AS VARCHAR) END,
            CAST({_SECONDS} AS VARCHAR), CAST({_DAYS} AS VARCHAR),
            CASE WHEN event_type = 'error' THEN '1' ELSE '0' END,
            CAST({_SCENARIO} AS VARCHAR)) AS line
    FROM events),
raw AS (
    SELECT CASE WHEN event_id % 97 = 0 THEN '{HEADER}'
                WHEN event_id % 31 = 0 THEN event_id || ',bad'
                WHEN event_id % 37 = 0 THEN ''
                WHEN event_id % 47 = 0 THEN line || ',extra'
                ELSE line END AS value
    FROM fields),
data AS (SELECT value FROM raw WHERE NOT starts_with(value, '#'))"""


def _field(i: int) -> str:
    return f"string_split(value, ',')[{i + 1}]"


def _as_int(text: str) -> str:
    """Integer part of a decimal number, else NULL."""
    number = r"\s*([+-]?)(\d*)(\.\d*)?\s*"
    return (
        f"CASE WHEN regexp_full_match({text}, '{number}') AND regexp_matches({text}, '[0-9.]') "
        f"THEN TRY_CAST(replace(regexp_extract({text}, '{number}', 1), '+', '') || '0' || "
        f"regexp_extract({text}, '{number}', 2) AS INTEGER) END"
    )


def _typed(i: int, kind: str) -> str:
    text = _field(i)
    if kind == "int":
        return _as_int(text)
    if kind == "date":
        return f"TRY_CAST(substr({text}, 1, 10) AS DATE)"
    return f"TRY_CAST(nullif(trim({text}), '') AS REAL)"


_TYPED_LIST = ", ".join(
    f"{_typed(i, kind)} AS {name}"
    for i, (name, kind) in enumerate(zip(RAW_COLUMNS, FIELD_TYPES, strict=True))
)
_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in RAW_COLUMNS) + " AND NOT isnan(tx_amount)"
_SHOWN = (
    f"{_round('CAST(tx_amount AS DOUBLE)', 2)} AS tx_amount, "
    "CAST(tx_datetime AS VARCHAR) AS tx_datetime"
)
TYPED = f"{RAW}, typed AS (SELECT {_TYPED_LIST} FROM data)"
COMPLETE = f"{TYPED}, complete AS (SELECT * FROM typed WHERE {_COMPLETE})"
_CLEAN = f"""WITH {COMPLETE},
numbered AS (
    SELECT *, row_number() OVER (
        PARTITION BY tranaction_id ORDER BY {", ".join(RAW_COLUMNS[1:])}) AS n
    FROM complete)
SELECT * EXCLUDE (n, tranaction_id) REPLACE ({_SHOWN}), tranaction_id AS transaction_id
FROM numbered WHERE n = 1"""


def _hash(key: str, salt: object, start: int = 1, length: int = 8) -> str:
    digest = f"md5(concat_ws('|', '{salt}', CAST({key} AS VARCHAR)))"
    return f"CAST('0x' || substr({digest}, {start}, {length}) AS BIGINT)"


def _part(key: str, salt: object, names: tuple[str, str]) -> str:
    limit = int(0.8 * 2**32)
    return f"CASE WHEN {_hash(key, salt)} < {limit} THEN '{names[0]}' ELSE '{names[1]}' END"


def _uniform(salt: object, slot: int = 0) -> str:
    number = _hash("event_id", salt, 1 + 8 * slot, 8)
    return f"(({number} + 0.5::DOUBLE) / 4294967296.0::DOUBLE)"


def _column(column: str) -> str:
    kind, first, usual, fraud = DRAWS[column]
    takes = 2 if kind in ("normal", "lognormal") else 1
    u = [_uniform(f"row-42-{i // 4}", i % 4) for i in range(first, first + takes)]
    p = [
        f"CASE WHEN fraud = 1 THEN {b}::DOUBLE ELSE {a}::DOUBLE END"
        for a, b in zip(usual, fraud, strict=True)
    ]
    if kind == "integer":
        return f"CAST(floor({u[0]} * {p[0]}) AS INTEGER) AS {column}"
    if kind == "bernoulli":
        return f"CAST({u[0]} < {p[0]} AS INTEGER) AS {column}"
    if kind == "exponential":
        return f"{_round(f'-({p[0]}) * ln({u[0]})', 4)} AS {column}"
    z = f"{p[0]} + {p[1]} * sqrt(-2.0 * ln({u[0]})) * cos(2.0 * pi() * {u[1]})"
    return f"{_round(f'exp({z})' if kind == 'lognormal' else z, 4)} AS {column}"


def _timestamp(uniform: str) -> str:
    minutes = f"(1 + CAST(floor({uniform} * 43199) AS INTEGER))"
    return f"TIMESTAMP '{ANCHOR}' - to_minutes({minutes}) AS timestamp"


_LABELLED = f"""labelled AS (
    SELECT event_id,
           CAST(event_id >= (SELECT CAST(floor(count(*) * {1 - FRAUD_RATE}) AS BIGINT) FROM events)
                AS INTEGER) AS fraud
    FROM events)"""


def _id(number: str) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return f"'tx_' || lpad({text}, CAST(greatest(8, length({text})) AS INTEGER), '0')"


SCORED = """scored AS (
    SELECT CAST(event_type = 'error' AS INTEGER) AS label, value AS score,
           CAST(value > 25.0 AS INTEGER) AS prediction
    FROM events)"""


_AUC = (
    "CAST(sum(CAST(pos AS HUGEINT) * CAST(2 * below + neg AS HUGEINT)) AS DOUBLE)"
    " / (2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE))"
)


def _auc(source: str) -> str:
    return f"""WITH {source},
ties AS (SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM scored GROUP BY score),
ranked AS (
    SELECT pos, neg, coalesce(sum(neg) OVER (
        ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
    FROM ties)
SELECT {_round(_AUC, 9)} AS auc
FROM ranked"""


def _classes(source: str) -> str:
    return f"""{source},
classes AS (SELECT label AS class FROM scored UNION SELECT prediction FROM scored),
per_class AS (
    SELECT CAST(class AS DOUBLE) AS class,
           (SELECT count(*) FROM scored WHERE label = class) AS actual,
           (SELECT count(*) FROM scored WHERE prediction = class) AS predicted,
           (SELECT count(*) FROM scored WHERE label = class AND prediction = class) AS hits
    FROM classes),
class_scores AS (
    SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE hits::DOUBLE / predicted END AS precision,
           CASE WHEN actual = 0 THEN 0.0 ELSE hits::DOUBLE / actual END AS recall,
           2.0 * hits::DOUBLE / (actual + predicted) AS f1
    FROM per_class)"""


_HITS = _round("avg(CAST(label = prediction AS INTEGER))", 9)
_ACCURACY = f"(SELECT {_HITS} FROM scored) AS accuracy"
_F1 = f"{_round('sum(f1 * actual) / sum(actual)', 9)} AS f1"

_MODEL = "CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE 'user_' || user_id END AS model_name"
HISTORY = f"""history AS (
    SELECT {_MODEL}, event_id AS version, CASE WHEN event_id % 13 <> 0 THEN value END AS auc
    FROM events),
compared AS (
    SELECT *, max(auc) OVER (PARTITION BY model_name ORDER BY version
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS champion_auc
    FROM history),
decided AS (
    SELECT *, auc IS NOT NULL AND (champion_auc IS NULL OR auc > champion_auc) AS promoted
    FROM compared)"""
VERSIONS = f"""versions AS (
    SELECT {_MODEL}, CAST(event_id AS VARCHAR) AS run_id, value AS auc,
           row_number() OVER (
               PARTITION BY CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE 'user_' || user_id END
               ORDER BY ts, CAST(event_id AS VARCHAR)) AS version
    FROM events)"""


def _z(column: str) -> str:
    z = f"({column} - avg({column}) OVER ()) / nullif(stddev_samp({column}) OVER (), 0)"
    return f"{_round(f'coalesce({z}, 0.0)', 6)} AS {column}"


_STANDARDIZED = f"""WITH {TX}
SELECT transaction_id, {_z("terminal_id")}, {_z("tx_amount")}, {_z("tx_time_seconds")} FROM tx"""

_FEATURES = [c for c in COLUMNS if c not in ("tx_datetime", "tx_fraud", "tx_fraud_scenario")]
_REPORT = "transaction_id, customer_id, terminal_id, tx_amount"


def _smallest(keys: str, others: str) -> str:
    return f"""SELECT {keys}, {others} FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {others}) AS n FROM lineitem)
WHERE n = 1"""


def _round_of_permutation(i: int) -> str:
    """One digit of the place is moved by a hash of the other."""
    moved, other, size = ("l", "r", "high") if i % 2 == 0 else ("r", "l", "low")
    return (
        f"round_{i} AS (SELECT x, {other}, "
        f"({moved} + {_hash(other, f'permute-sample-42-{i}')}) % {size} AS {moved}, high, low FROM round_{i - 1})"
    )


# The whole grid is permuted, and places outside are followed until they lead inside.
_PLACES = f"""WITH RECURSIVE sizes AS (
    SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS low FROM events),
grid AS (SELECT n, low, (n + low - 1) // low AS high FROM sizes),
round_start AS (
    SELECT x, x // low AS l, x % low AS r, high, low
    FROM (SELECT unnest(range(0, (SELECT high * low FROM grid))) AS x), grid),
{", ".join(_round_of_permutation(i) for i in range(6)).replace("FROM round_-1", "FROM round_start")},
permutation AS (SELECT x, l * low + r AS y FROM round_5),
walk AS (
    SELECT x, y FROM permutation WHERE x < (SELECT n FROM sizes)
    UNION ALL
    SELECT walk.x, permutation.y FROM walk JOIN permutation ON walk.y = permutation.x
    WHERE walk.y >= (SELECT n FROM sizes))
SELECT x AS event_id, y AS place, y < (SELECT round(0.8 * n) FROM sizes) AS sampled
FROM walk WHERE y < (SELECT n FROM sizes)"""


ORACLE: dict[str, str] = {
    "scan_lines": f"WITH {RAW} SELECT value FROM raw",
    "header_columns": f"""WITH {RAW},
header AS (SELECT DISTINCT value FROM raw WHERE starts_with(value, '#')),
names AS (SELECT string_split(substr(value, 3), ' | ') AS names FROM header)
SELECT CAST(i - 1 AS BIGINT) AS position, names[i] AS name
FROM names, (SELECT unnest(range(1, 10)) AS i)""",
    "drop_comments": f"WITH {RAW} SELECT value FROM data",
    "split_fields": f"WITH {RAW} SELECT "
    + ", ".join(f"{_field(i)} AS {c}" for i, c in enumerate(RAW_COLUMNS))
    + " FROM data",
    "typed_cast": f"""WITH {TYPED}
SELECT {", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in RAW_COLUMNS if c != "tx_amount")},
       CASE WHEN NOT isnan(tx_amount) THEN {_round("CAST(tx_amount AS DOUBLE)", 2)} END AS tx_amount,
       coalesce(isnan(tx_amount), FALSE) AS amount_is_nan
FROM typed""",
    "field_types": f"""WITH {TYPED}
SELECT * FROM ("""
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS \"values\" FROM typed"
        for c, t in zip(RAW_COLUMNS, FIELD_TYPES, strict=True)
    )
    + ")",
    "drop_incomplete": f"WITH {COMPLETE} SELECT * REPLACE ({_SHOWN}) FROM complete",
    "rename_key": f"""WITH {COMPLETE}
SELECT * EXCLUDE (tranaction_id) REPLACE ({_SHOWN}), tranaction_id AS transaction_id
FROM complete""",
    "dedup_by_key": _smallest(
        "l_orderkey", "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
    ),
    "dedup_by_two_keys": _smallest(
        "l_orderkey, l_linenumber", "l_shipdate, l_partkey, l_suppkey, l_returnflag"
    ),
    "dedup_by_flag": _smallest(
        "l_returnflag", "l_extendedprice, l_orderkey, l_linenumber, l_partkey"
    ),
    "clean_transactions": _CLEAN,
    "clean_reordered_header": f"""WITH {COMPLETE},
numbered AS (
    SELECT *, row_number() OVER (
        PARTITION BY tranaction_id
        ORDER BY customer_id, tx_datetime, {", ".join(RAW_COLUMNS[3:])}) AS n
    FROM complete)
SELECT * EXCLUDE (n, tranaction_id) REPLACE ({_SHOWN}), tranaction_id AS transaction_id
FROM numbered WHERE n = 1""",
    "clean_job_files": _CLEAN,
    "clean_own_headers": _CLEAN,
    "clean_job_replace": _CLEAN,
    "clean_job_report": f"""WITH {COMPLETE}
SELECT (SELECT count(*) FROM data) AS records,
       (SELECT count(*) FROM data) - count(*) AS incomplete,
       count(*) - count(DISTINCT tranaction_id) AS repeated,
       count(DISTINCT tranaction_id) AS kept
FROM complete""",
    "read_parquet": "SELECT event_id, user_id, event_type, value FROM events",
    "read_back": f"WITH {TX} SELECT {_REPORT} FROM tx",
    "csv_round_trip": f"WITH {TX} SELECT {_REPORT} FROM tx",
    "split_counts": f"""WITH {TX}
SELECT {_part("transaction_id", 42, ("train", "test"))} AS split, count(*) AS rows
FROM tx GROUP BY 1""",
    "null_profile": f"""WITH {TYPED}
SELECT * FROM ("""
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM typed"
        for c in RAW_COLUMNS
    )
    + ") WHERE nulls > 0",
    "split_profile": f"""WITH {TYPED},
report AS (SELECT tranaction_id AS transaction_id, * EXCLUDE (tranaction_id) FROM typed)
SELECT {_part("customer_id", 42, ("train", "test"))} AS split, count(*) AS rows, """
    + ", ".join(f"count(*) - count({c}) AS {c}" for c in _REPORT.split(", "))
    + " FROM report GROUP BY 1",
    "first_rows": f"WITH {TX} SELECT {_REPORT} FROM tx ORDER BY tx_amount, transaction_id LIMIT 5",
    "label_summary": f"""WITH {TX}
SELECT count(*) AS rows, CAST(sum(tx_fraud) AS BIGINT) AS positives,
       {_round("avg(tx_fraud) * 100", 6)} AS positive_pct
FROM tx""",
    "hash_split": f"""WITH {TX}
SELECT transaction_id, {_part("transaction_id", 42, ("train", "test"))} AS part FROM tx""",
    "random_split_totals": f"""WITH {TX}
SELECT count(*) AS rows, count(DISTINCT transaction_id) AS transactions FROM tx""",
    "sample_complement": f"""WITH {TX}
SELECT transaction_id, {_part("transaction_id", 7, ("sample", "rest"))} AS part FROM tx""",
    "sample_exact": f"""WITH {TX},
placed AS (
    SELECT transaction_id, count(*) OVER () AS n,
           row_number() OVER (
               ORDER BY {_hash("transaction_id", "sample-42")}, transaction_id) AS place
    FROM tx)
SELECT transaction_id, CASE WHEN place <= round(n * 0.8) THEN 'sample' ELSE 'rest' END AS part
FROM placed""",
    "fold_counts": f"""WITH {TX}
SELECT CAST({_hash("transaction_id", "fold-42")} % 3 AS INTEGER) AS fold, count(*) AS rows
FROM tx GROUP BY 1""",
    "format_ids": f"SELECT event_id, {_id('event_id')} AS transaction_id FROM events",
    "reorder_columns": f"WITH {TX} SELECT tx_fraud, tx_amount, terminal_id, transaction_id FROM tx",
    "random_minutes": f"SELECT event_id, {_timestamp(_uniform('minutes'))} FROM events",
    "synth_transactions": f"""WITH {_LABELLED}
SELECT {_id("event_id")} AS transaction_id, {_timestamp(_uniform("row-42-0"))},
       {", ".join(_column(c) for c in DRAWS)}, fraud
FROM labelled""",
    "synth_places": _PLACES,
    "synth_shuffled": f"""WITH {_LABELLED},
placed AS (
    SELECT *, row_number() OVER (ORDER BY {_hash("event_id", "shuffle-42")}, event_id) - 1 AS place
    FROM labelled)
SELECT {_id("place")} AS transaction_id, fraud, {_column("hour_of_day")} FROM placed""",
    "assemble": f"WITH {TX} SELECT "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _FEATURES)
    + " FROM tx",
    "standardize": _STANDARDIZED,
    "standardize_ml": _STANDARDIZED,
    "auc": _auc(SCORED),
    "auc_few_scores": _auc(
        """scored AS (
    SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, greatest(l_quantity, 20.0) AS score
    FROM lineitem)"""
    ),
    "auc_evaluator": _auc(SCORED),
    "auc_binned": f"""SELECT auc, TRUE AS binned_is_auc, TRUE AS binned_is_near
FROM ({_auc(SCORED)})""",
    "auc_saturated": _auc(
        """scored AS (
    SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label,
           1.0::DOUBLE - l_extendedprice * 1e-15::DOUBLE AS score
    FROM lineitem)"""
    ),
    "accuracy": f"WITH {SCORED} SELECT {_ACCURACY}",
    "f1_weighted": f"""WITH {_classes(SCORED)}
SELECT {_ACCURACY}, {_F1},
       {_round("max(CASE WHEN class = 1 THEN f1 END)", 9)} AS f1_positive
FROM class_scores""",
    "evaluate_scored": f"""WITH {_classes(SCORED)},
ties AS (SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM scored GROUP BY score),
ranked AS (
    SELECT pos, neg, coalesce(sum(neg) OVER (
        ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
    FROM ties)
SELECT (SELECT {_round(_AUC, 9)} FROM ranked) AS auc, {_ACCURACY}, {_F1} FROM class_scores""",
    "f1_evaluator": f"WITH {_classes(SCORED)} SELECT {_ACCURACY}, {_F1} FROM class_scores",
    "confusion": f"""WITH {SCORED}
SELECT CAST(label AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction, count(*) AS rows
FROM scored GROUP BY 1, 2""",
    "class_scores": "WITH "
    + _classes(
        "scored AS (SELECT l_linenumber AS label, 1 + l_suppkey % 8 AS prediction FROM lineitem)"
    )
    + f"""
SELECT class, actual, predicted, hits, {_round("precision", 9)} AS precision,
       {_round("recall", 9)} AS recall, {_round("f1", 9)} AS f1
FROM class_scores""",
    "model_versions": f"WITH {VERSIONS} SELECT model_name, run_id, version FROM versions",
    "version_history": f"""WITH {VERSIONS},
best AS (
    SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY auc DESC, version) AS n
    FROM versions)
SELECT model_name, version, run_id, auc, auc / 2.0 AS accuracy, auc / 4.0 AS f1
FROM best WHERE n = 1""",
    "promotions": f"WITH {HISTORY} SELECT * FROM decided",
    "champion": f"""WITH {HISTORY}
SELECT model_name, version, auc FROM (
    SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY version DESC) AS n
    FROM decided WHERE promoted)
WHERE n = 1""",
    "aliases": f"""WITH {HISTORY}
SELECT model_name, CASE WHEN promoted THEN 'champion' ELSE 'challenger' END AS alias,
       max(version) AS version
FROM decided GROUP BY 1, 2""",
    "improvement_pct": f"""WITH {HISTORY}
SELECT model_name, version, auc, champion_auc,
       {_round("(auc - champion_auc) / nullif(champion_auc, 0) * 100", 6)} AS improvement_pct
FROM decided WHERE promoted""",
    "synth_job_files": """SELECT count(*) AS rows, count(*) AS ids,
       CAST(count(*) - floor(count(*) * (1 - 0.05)) AS BIGINT) AS frauds,
       CAST(round(count(*) * 0.8) AS BIGINT) AS train_rows
FROM events""",
    "score_test": f"""WITH {TX}
SELECT count(*) AS rows, CAST(0 AS BIGINT) AS outside, CAST(0 AS BIGINT) AS other_side
FROM tx WHERE {_part("transaction_id", 42, ("train", "test"))} = 'test'""",
    "score_job_files": """SELECT count(*) AS rows, count(*) AS transactions,
       CAST(0 AS BIGINT) AS outside, CAST(0 AS BIGINT) AS other_side,
       TRUE AS counted_rows, TRUE AS counted_frauds
FROM events""",
    "score_logistic": f"""WITH {TX}
SELECT count(*) AS rows, CAST(sum(tx_fraud) AS BIGINT) AS expected_positives
FROM tx WHERE {_part("transaction_id", 42, ("train", "test"))} = 'train'""",
    "grid_search": """SELECT CAST(t AS BIGINT) AS num_trees, CAST(d AS BIGINT) AS max_depth,
       TRUE AS mean_is_auc, TRUE AS best_is_largest
FROM (VALUES (10), (20)) AS trees(t), (VALUES (5), (10)) AS depths(d)""",
    "retrain_cycle": """SELECT 'fraud_detection_model' AS model_name, CAST(1 AS BIGINT) AS version,
       'cycle' AS run_name, 'rf' AS model_type, '10,20' AS trees, '5,10' AS depths,
       TRUE AS promoted, TRUE AS metrics_in_range, TRUE AS best_in_grid""",
    "model_reload": f"""WITH {TX}
SELECT count(*) AS rows, CAST(0 AS BIGINT) AS different
FROM tx WHERE {_part("transaction_id", 42, ("train", "test"))} = 'test'""",
    "retrain_report": f"""WITH {TX},
parts AS (SELECT {_part("transaction_id", 42, ("train", "test"))} AS part FROM tx)
SELECT count(*) FILTER (part = 'train') AS train_rows,
       count(*) FILTER (part = 'test') AS test_rows,
       '{",".join(_FEATURES)}' AS features, CAST(1 AS BIGINT) AS version, TRUE AS promoted
FROM parts""",
}
