"""Fitted operators against twins in plain Python: statistics, URL features, randomness tests, null."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from txmill.llm import language, quality, secrets, url_filter
from txmill.llm.queries import RULES

# Quality


def statistics_twin(text):
    data, words, lines = text.encode(), text.split(), text.split("\n")
    size, n, tally = max(len(data), 1), max(len(words), 1), Counter(words)
    classes = [
        " \t\n\v\f\r", "\n", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", ".,;:!?", "!",
        "#$%&*+/<=>@[\\]^_`{|}~", "|", "\"'()-",
    ]
    shares = [sum(text.count(c) for c in k) / size for k in classes] + [sum(b >= 128 for b in data) / size]
    used = [c / size for c in Counter(data).values()]
    upper, lower = (sum(a <= c <= b for c in text) for a, b in ("AZ", "az"))
    pairs = list(zip(words, words[1:]))
    return [
        math.log1p(len(data)),
        math.log1p(len(words)),
        *shares,
        -sum(p * math.log2(p) for p in used),
        upper / ((upper + lower) or 1),
        (size - shares[0] * size) / n,
        max(map(len, words), default=0),
        len(tally) / n,
        max(tally.values(), default=0) / n,
        sum(c == 1 for c in tally.values()) / n,
        sum(a == b for a, b in pairs) / max(len(words) - 1, 1),
        len(set(pairs)) / max(len(words) - 1, 1),
        sum(len(w) == 1 for w in tally) / n,
        len(set(lines)) / len(lines),
        len(lines) / n,
        len(data) / len(lines),
    ]


TEXTS = ["", " ", "\n\n", "One.", "a a b\na a b\n| x | y |", "É tête 😀 «x» (it's) [1] {2}", "w " * 3000, "X" * 500, "a\tb\x0bc\x1cd"]


@pytest.mark.parametrize("text", TEXTS)
def test_statistics_of_chosen_texts(text):
    assert quality.statistics(text) == pytest.approx(statistics_twin(text), abs=1e-12)


def test_statistics_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = docs.select("text", quality.statistics_of("text").alias("x")).collect()
    for r in found:
        assert r.x == pytest.approx(statistics_twin(r.text or ""), abs=1e-9)


# URLs


def entropy(text):
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def features_twin(url, host, path):
    return {
        "url_length": len(url), "host_length": len(host), "path_length": len(path),
        "host_depth": host.count("."), "path_depth": path.count("/"),
        "digit_ratio": sum(c in "0123456789" for c in url) / max(len(url), 1),
        "host_digits": sum(c in "0123456789" for c in host), "host_hyphens": host.count("-"),
        "longest_label": max(map(len, host.split("."))), "entropy": entropy(url), "host_entropy": entropy(host),
        "parameters": url.count("=") + url.count("&"), "has_query": float("?" in url),
        "has_fragment": float("#" in url), "escapes": url.count("%"), "secure": float(url.startswith("https:")),
    }


def test_url_features_and_suffix_shares(spark, sf_dir):
    urls = [r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("url").collect()]
    urls += [None, "", "x", "a://", "https://a-b.c1.example.ORG/x/y?q=1&r=%20#f", "http://é.com/" + "z" * 5000, "a://..//%%=="]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rows = url_filter.parsed(frame, "page_id", "url", RULES)
    known = url_filter.labelled(rows)
    suffixes = url_filter.train(known, 50).suffixes
    tally, blocked = Counter(), Counter()
    for r in known.collect():
        tally[r.suffix] += 1
        blocked[r.suffix] += r.label
    found = url_filter._features(rows, suffixes).collect()
    assert len(found) == len(urls)
    for r in found:
        for name, value in features_twin(r.url, r.host, r.path).items():
            assert r[f"f_{name}"] == pytest.approx(value, abs=1e-9), (name, r.url)
        seen = tally[r.suffix]
        assert r.f_suffix_share == pytest.approx((blocked[r.suffix] + 1) / (seen + 2) if seen else 0.5)
        assert r.f_suffix_known == pytest.approx(math.log1p(seen))


# Randomness tests


def two_sided(z):
    x = abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    a = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    return min(1.0, sum(c * t ** (k + 1) for k, c in enumerate(a)) * math.exp(-x * x))


def battery_twin(word, alphabet):
    n, k = len(word), len(alphabet)
    chi = sum((word.count(c) - n / k) ** 2 / (n / k) for c in alphabet)
    part = 2 / (9 * (k - 1))
    z = ((chi / (k - 1)) ** (1 / 3) - (1 - part)) / math.sqrt(part)
    uniform = two_sided(z) / 2 if z > 0 else 1 - two_sided(z) / 2
    marks = np.array([alphabet.index(c) >= k // 2 for c in word])
    ones = int(marks.sum())
    mean = 2 * ones * (n - ones) / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    runs = int((marks[1:] != marks[:-1]).sum()) + 1
    by_runs = two_sided((runs - mean) / math.sqrt(variance)) if variance > 0 else 2.0 ** (1 - n)
    v = np.array([alphabet.index(c) + 1 for c in word], float)
    d = v - v.mean()
    square = (d * d).sum()
    serial = two_sided(((d[1:] * d[:-1]).sum() / square + 1 / n) * math.sqrt(n)) if square > 0 else 0.0
    return uniform, by_runs, serial


def test_the_battery_equals_its_twin(spark):
    draw, rows = random.Random(1), []
    for number, alphabet in enumerate(secrets.ALPHABETS):
        for size in (20, 33, 64):
            rows.append(("".join(draw.choice(alphabet) for _ in range(size)), number))
            rows.append((alphabet[0] * size, number))
            rows.append(("".join(alphabet[i % len(alphabet)] for i in range(size)), number))
            rows.append((alphabet[-1] * (size // 2) + alphabet[0] * (size - size // 2), number))
    frame = spark.createDataFrame(rows, "word string, code int")
    alphabet = F.get(F.array(*[F.lit(a) for a in secrets.ALPHABETS]), F.col("code"))
    parts = [f(F.col("word"), alphabet) for f in (secrets._uniformity, secrets._runs, secrets._correlation)]
    whole = secrets.p_value(F.col("word"), F.col("code"))
    found = frame.select("word", "code", *[p.alias(n) for p, n in zip((*parts, whole), "urcp")]).collect()
    for r in found:
        twin = battery_twin(r.word, secrets.ALPHABETS[r.code])
        assert (r.u, r.r, r.c) == pytest.approx(twin, rel=1e-6, abs=1e-12), r
        assert r.p == pytest.approx(min(1.0, 3 * min(twin)), rel=1e-6, abs=1e-12)


# The null


def test_letter_pairs_equal_brute_force(spark, sf_dir):
    texts = ["Abc abc abc-9/x, été x2", "token " + "Q9" * 15 + " end", None, "", "a", "+a +a"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    expected = Counter()
    for words in (["Abc", "abc", "abc-0-x", "t", "x0"], ["token", "end"], ["a"], ["-a"]):
        for w in words:
            expected.update(a + b for a, b in zip(f" {w}", w))
    assert secrets.letter_pairs(frame) == dict(expected)
    assert secrets.letter_pairs(frame.limit(0)) == {}
    every = secrets.letter_pairs(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert len(every) <= 55 * 54 and every[" t"] > 0


@pytest.mark.parametrize("pairs", [None, {"ab": 10**6, " a": 5, "0-": 7}, {a + b: 1 for a in " xyz" for b in "xyz"}])
def test_the_null_is_a_distribution(pairs):
    bits, width = language.surprise(pairs), len(language.SYMBOLS)
    members = [len(language.DIGITS) if s == "0" else len(language.SEPARATORS) if s == "-" else 1 for s in language.SYMBOLS]
    for row in range(width + 1):
        shares = [2.0**-b for b in bits[row * width : (row + 1) * width]]
        assert sum(s * m for s, m in zip(shares, members)) == pytest.approx(1.0)


def test_evidence_is_at_most_one_on_average_over_ordinary_strings(spark):
    """Strings drawn from the fitted null itself."""
    draw = random.Random(2)
    pairs = {a + b: draw.randrange(2000) for a in " abcdefgh" for b in "abcdefgh"}
    bits, width = language.surprise(pairs), len(language.SYMBOLS)
    shares = [[2.0**-b for b in bits[r * width : (r + 1) * width]] for r in range(width + 1)]
    for row in shares:
        row[-2] *= len(language.DIGITS)
        row[-1] *= len(language.SEPARATORS)
    words = []
    for _ in range(1500):
        word, before = "", 0
        for _ in range(24):
            before = draw.choices(range(width), shares[before])[0] + 1
            symbol = language.SYMBOLS[before - 1]
            word += draw.choice(language.DIGITS if symbol == "0" else language.SEPARATORS if symbol == "-" else symbol)
        words.append((word,))
    frame = spark.createDataFrame(words, "word string")
    code = secrets._encoding(F.col("word"))
    e = secrets.evidence(F.col("word"), code, bits)
    found = frame.select(e.alias("e"), secrets.p_value(F.col("word"), code).alias("p")).collect()
    assert np.mean([2.0**r.e for r in found]) < 1
    assert sum(2.0**r.e * r.p >= 20 for r in found) <= 0.05 * len(found)


def test_words_of_an_unknown_language_become_ordinary(spark):
    """Long words of the letter pairs that the corpus is full of are not random; real keys still are."""
    draw = random.Random(3)
    syllables = ["qxo", "zju", "wvy", "kqa", "xzi", "jwu"]
    short = ["".join(draw.choice(syllables) for _ in range(draw.randrange(2, 6))) for _ in range(4000)]
    long = ["".join(draw.choice(syllables) for _ in range(9)) for _ in range(60)]
    key = "q9X2mVb7LrT4wZk8NcY3pHs6JdF5gGa1"
    rows = [(k, " ".join(short[40 * k : 40 * k + 40] + long[k : k + 1])) for k in range(60)]
    rows += [(k, " ".join(short[40 * (k % 100) : 40 * (k % 100) + 40])) for k in range(60, 100)] + [(100, f"see {key} here")]
    found = secrets.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).filter("spans <> ''").collect()
    assert [(r.doc_id, r.spans) for r in found] == [(100, "random:4:36")]
