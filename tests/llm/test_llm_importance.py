"""Importance resampling: features, brackets, awkward rows and brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from txmill.llm import importance, queries

SCHEMA = "doc_id bigint, text string, id bigint, score bigint, tie bigint, weight string, row string, n_words int"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def features_brute(text, buckets):
    words = WORD.findall(lower(text or ""))
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]


def brute(rows, target, buckets=10_000, seed=7, min_words=20, share=25):
    """(id, n_features, weight, score, rank) of every row."""
    found = [features_brute(t, buckets) for _, t in rows]
    s = Counter(b for _, f in found for b in f)
    t = Counter(b for text in target for b in features_brute(text, buckets)[1])
    s_all, t_all = float(sum(s.values())), float(sum(t.values()))
    gain = [
        math.floor(1000 * math.log((float(t[b]) + 1) * (s_all + buckets) / ((float(s[b]) + 1) * (t_all + buckets))))
        for b in range(buckets)
    ]
    out, able = [], []
    for k, ((i, _), (n, f)) in enumerate(zip(rows, found)):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None])
        if n >= min_words:
            able.append((-score, i is None, i or 0, k))
    for rank, (*_, k) in enumerate(sorted(able)[: share * len(able) // 100], 1):
        out[k][4] = rank
    return sorted(map(tuple, out), key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


PROSE = "The QUICK brown fox, jumped; over 12 lazy dogs and ran a long way home to its den 4 you and me now é"
ROWS = [
    *[(i, f"{PROSE} {i} {'again ' * (i % 7)}") for i in range(60)],
    *[(1000, PROSE)] * 40,
    *[(None, PROSE)] * 30,
    *[(None, f"{PROSE} other")] * 3,
    (200, None),
    (201, ""),
    (202, " \t\n"),
    (203, "one"),
    (204, "Ünïcode 😀😀 ­ \x7f \x00 mixed-Case_words " * 6),
    (205, "tail " * 40_000),
    (206, "nineteen " * 19),
    (207, "twenty " * 20),
    (None, None),
]
TARGET = ["a long way home", "Lazy dogs and foxes", None, "", "a long way home"]


@pytest.mark.parametrize("share", [0, 1, 25, 60, 100])
@pytest.mark.parametrize("widths", [importance.BRACKETS, (0.0,)])
def test_awkward_rows_equal_brute_force(spark, share, widths):
    """A bracket of one quantile is widened until it holds the cutoff."""
    docs = spark.createDataFrame([(*r, 1, 2, 3, "w", "r", 4) for r in ROWS], SCHEMA).repartition(5)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    found = importance.ranked(docs, target, share_percent=share, widths=widths)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert rows_of(found) == brute(ROWS, TARGET, share=share)


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    assert importance.ranked(nothing, target).count() == 0
    docs = spark.createDataFrame([(*r, 1, 2, 3, "w", "r", 4) for r in ROWS[:30]], SCHEMA)
    assert rows_of(importance.ranked(docs, target.limit(0))) == brute(ROWS[:30], [])
    short = spark.createDataFrame([(1, "too short"), (2, None)], "doc_id int, text string")
    assert [r.rank for r in importance.ranked(short, target).collect()] == [None, None]


def test_the_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    found = queries.QUERIES["op11_importance_resampling"](spark, sf_dir)
    assert rows_of(found) == brute([(r.doc_id, r.text) for r in docs], [r.text for r in target])


def test_drawn_documents_keep_their_columns(spark):
    docs = spark.createDataFrame([(*r, 1, 2, 3, "w", "r", 4) for r in ROWS], SCHEMA)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    kept = importance.resampled(docs, target, share_percent=40)
    assert kept.schema == docs.schema
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in brute(ROWS, TARGET, share=40) if r[4])


def test_other_buckets_and_seed(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    found = importance.ranked(docs, target, buckets=16, seed=3, min_words=5)
    assert rows_of(found) == brute(ROWS, TARGET, buckets=16, seed=3, min_words=5)


@pytest.mark.parametrize("scores", [[5] * 500, list(range(500)), [0] * 300 + [9] * 200, [1] * 499 + [-7]])
@pytest.mark.parametrize("wanted", [1, 125, 300, 499, 500])
def test_brackets_and_cutoffs(spark, scores, wanted):
    """However scores are tied, the bracket holds the cutoff, and the cutoff is the wanted row."""
    order = list(range(500))
    random.Random(wanted).shuffle(order)
    rows = spark.createDataFrame([(scores[k], k // 2, k) for k in order], "score bigint, id bigint, tie bigint")
    low, high, above = importance.bracket(rows, wanted, 500)
    expected = sorted(((-scores[k], k // 2, k) for k in range(500)))[wanted - 1]
    assert low <= -expected[0] <= high and above == sum(s > high for s in scores) < wanted
    last = importance.cutoff(rows, wanted, 500)
    assert (-last.score, last.id, last.tie) == expected


@given(st.text(alphabet="aB9 _é😀\x00-\n" + "zZ"), st.integers(1, 50))
def test_features(text, buckets):
    n, found = importance.features(text, buckets)
    assert (n, sorted(found.tolist())) == (lambda a: (a[0], sorted(a[1])))(features_brute(text, buckets))


def test_gains_prefer_what_the_target_prefers():
    gains = importance.bucket_gains(np.array([10, 10, 0]), np.array([0, 20, 0]))
    assert gains[1] > gains[2] == 0 > gains[0]


def test_rows_with_one_score_are_sorted_by_many_tasks(spark):
    """A third of all rows may be alike in score and id; the sort still ends ranges among them."""
    rows = spark.range(40_000).selectExpr("7L as score", "cast(null as bigint) as id", "id as tie")
    sizes = [r["count"] for r in importance._sorted(rows, "alike").groupBy("part").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 30_000
