"""Secret scan: three fixed patterns, and a battery of randomness tests for strings they miss.

Everything is built from DataFrame functions. A string of at least ``LEAST`` characters is tested
against the smallest alphabet that holds it: chi-squared for uniform use of the alphabet, a runs
test around the middle of the alphabet, and the serial correlation of neighbours. Three times the
smallest p-value is the battery's. A string below ``LEAST_P`` is not random, whatever else it is.

The null is that a string is ordinary: that it follows the letter pairs of the corpus's own shorter
words (see ``language``), which one aggregate of fixed size counts. How many times likelier a uniform
draw from the alphabet gives the string than the null does, times the battery's p-value, is its
evidence. Without the p-value it is at most 1 on average over ordinary strings, and so it is with
it; its reciprocal is therefore a p-value of the null, large for strings that the battery finds
uneven. Benjamini and Hochberg's rule sets the threshold of each length class so that at most ``FDR``
of what is reported is ordinary. One strongly random string passes whatever else its class holds.
Each different string of all documents is counted once in a histogram of fixed size, so copies
decide nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txmill.llm import language
from txmill.llm.common import stored, whole

# The base patterns with the least length of what counts, in the order of their kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24))
RANDOM = "random"

LEAST = 20
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
FDR = 0.05
#: Random strings fall below it in about one of 1000 cases.
LEAST_P = 0.001
#: Evidence is counted in whole bits, more than these as these.
MOST_BITS = 64
LENGTH_CLASSES = (20, 24, 32, 48, 64, 128)

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets in ascending size; the first that holds a string is its encoding.
ALPHABETS = (
    _DIGITS,
    _DIGITS + _LOWER[:6],
    _DIGITS + _UPPER[:6],
    _LOWER,
    _UPPER,
    _UPPER + _DIGITS[2:8],
    _DIGITS + _LOWER,
    _DIGITS + _UPPER,
    _UPPER + _LOWER,
    _UPPER + _LOWER + _DIGITS,
    _UPPER + _LOWER + _DIGITS + "+/",
    _UPPER + _LOWER + _DIGITS + "-_",
    _UPPER + _LOWER + _DIGITS + "+/-_",
)
_BLOCK = 256


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _running(lengths: Column) -> Column:
    """Sum of the lengths before each place. Sums of blocks keep the work far from n squared."""
    last = F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")
    block_sums = F.transform(
        F.sequence(F.lit(0), last), lambda k: _total(F.slice(lengths, k * _BLOCK + 1, F.lit(_BLOCK)))
    )

    def with_sums(sums: Column) -> Column:
        heads = F.transform(F.sequence(F.lit(0), last), lambda k: _total(F.slice(sums, F.lit(1), k)))
        return _let(
            heads,
            lambda head: F.transform(
                lengths,
                lambda _, i: F.element_at(head, F.floor(i / _BLOCK).cast("int") + 1)
                + _total(F.slice(lengths, i - i % _BLOCK + 1, i % _BLOCK)),
            ),
        )

    return _let(block_sums, with_sums)


def _matches(text: Column, pattern: str, group: int) -> Column:
    """start, end, word of all matches, leftmost first and not overlapping; in code points.

    What stands between matches comes from ``split`` by the same pattern, so each match starts
    where the gaps and the matches before it end.
    """
    whole_match = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    words = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def placed(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        steps = F.zip_with(gaps, found, lambda g, m: (F.length(g) + F.length(m)).cast("long"))

        def spans(step: Column) -> Column:
            ends = F.zip_with(_running(step), step, lambda before, own: before + own)
            return F.arrays_zip(
                F.zip_with(ends, found, lambda e, m: e - F.length(m)).alias("start"),
                ends.alias("end"),
                words.alias("word"),
            )

        return _let(steps, spans)

    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint,word:string>>)")
    return F.when(text.rlike(pattern), _let(whole_match, placed)).otherwise(none).cast(
        "array<struct<start:bigint,end:bigint,word:string>>"
    )


def _base(text: Column) -> Column:
    """start, kind (its number), end of the base spans, in the order of the contract."""
    each = []
    for number, (_, pattern, group, least) in enumerate(KINDS):
        # A run below the least length never matches later on, so such runs need not be listed.
        quick = {ACCESS: r"AKIA[A-Z0-9]{16,}", HEX: r"[0-9a-f]{24,}"}.get(pattern, pattern)
        found = F.filter(_matches(text, quick, group), lambda m: F.length(m["word"]) >= least)
        each.append(
            F.transform(
                found,
                lambda m: F.struct(
                    m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end")
                ),
            )
        )
    return F.array_sort(F.concat(*each))


def _two_sided(z: Column) -> Column:
    """Normal tail probability, rational approximation of Abramowitz and Stegun 7.1.26."""

    def tail(x: Column) -> Column:
        def series(t: Column) -> Column:
            inner = -0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))
            return F.least(F.lit(1.0), t * (0.254829592 + t * inner) * F.exp(-x * x))

        return _let(1.0 / (1.0 + 0.3275911 * x), series)

    return _let(F.abs(z) / F.lit(2.0**0.5), tail)


def _times(text: Column, part: Column | str) -> Column:
    part = F.lit(part) if isinstance(part, str) else part
    return (F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)


def _uniformity(word: Column, alphabet: Column) -> Column:
    n, k = F.length(word).cast("double"), F.length(alphabet).cast("double")
    squares = F.aggregate(
        F.split(alphabet, ""), F.lit(0.0), lambda a, c: a + F.pow(_times(word, c), F.lit(2.0))
    )

    def cube_root(free: Column) -> Column:
        spread = F.greatest(squares * k / n - n, F.lit(0.0))
        part = 2.0 / (9.0 * free)
        z = (F.pow(spread / free, F.lit(1.0 / 3.0)) - (1.0 - part)) / F.sqrt(part)
        return _let(
            z, lambda v: _let(_two_sided(v) / 2, lambda p: F.when(v > 0, p).otherwise(1.0 - p))
        )

    return _let(k - 1.0, cube_root)


def _runs(word: Column, alphabet: Column) -> Column:
    half = F.floor(F.length(alphabet) / 2).cast("int")
    marks = F.concat(F.repeat(F.lit("0"), half), F.repeat(F.lit("1"), F.length(alphabet) - half))

    def tested(s: Column) -> Column:
        n = F.length(s).cast("double")

        def against(mean: Column) -> Column:
            runs = _times(s, "01") + _times(s, "10") + 1.0
            variance = (mean - 1.0) * (mean - 2.0) / (n - 1.0)
            one_sided = F.exp((1.0 - n) * F.lit(0.6931471805599453))
            return F.when(
                variance > 0, _two_sided((runs - mean) / F.sqrt(variance))
            ).otherwise(one_sided)

        return _let(_let(_times(s, "1"), lambda ones: 2.0 * ones * (n - ones) / n + 1.0), against)

    return _let(F.call_function("translate", word, alphabet, marks), tested)


def _correlation(word: Column, alphabet: Column) -> Column:
    values = F.transform(F.split(word, ""), lambda c: F.instr(alphabet, c).cast("double"))

    def tested(v: Column) -> Column:
        n = F.size(v)
        mean = F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / n

        def around(d: Column) -> Column:
            square = F.aggregate(d, F.lit(0.0), lambda a, x: a + x * x)
            product = F.aggregate(
                F.zip_with(F.slice(d, F.lit(1), n - 1), F.slice(d, F.lit(2), n - 1), lambda a, b: a * b),
                F.lit(0.0),
                lambda a, x: a + x,
            )
            return _let(
                square,
                lambda q: F.when(
                    q > 0, _two_sided((product / q + 1.0 / n) * F.sqrt(n.cast("double")))
                ).otherwise(F.lit(0.0)),
            )

        return _let(_let(mean, lambda m: F.transform(v, lambda x: x - m)), around)

    return _let(values, tested)


def _encoding(word: Column) -> Column:
    """Number of the first alphabet that holds the word."""
    last = F.lit(len(ALPHABETS) - 1)
    for number in range(len(ALPHABETS) - 2, -1, -1):
        last = F.when(F.translate(word, ALPHABETS[number], "") == "", F.lit(number)).otherwise(last)
    return last


def p_value(word: Column, encoding: Column) -> Column:
    """Probability that a uniform string of that alphabet and length looks less random."""

    def tested(alphabet: Column) -> Column:
        least = F.least(_uniformity(word, alphabet), _runs(word, alphabet), _correlation(word, alphabet))
        return F.least(F.lit(1.0), 3.0 * least)

    return _let(F.get(F.array(*[F.lit(a) for a in ALPHABETS]), encoding), tested)


def letter_pairs(texts: DataFrame, text: str = "text") -> dict[str, int]:
    """How often each symbol follows another in the words of fewer than ``LEAST`` characters.

    A word counts once per document, and its first symbol follows a space. There is at most one row
    per pair of symbols, whatever the size of the corpus.
    """
    symbols = "0" * len(language.DIGITS) + "-" * len(language.SEPARATORS)
    shorter = F.regexp_replace(whole(text), CANDIDATE, " ")
    plain = F.translate(shorter, language.DIGITS + language.SEPARATORS, symbols)
    words = F.array_distinct(F.split(plain, r"[^A-Za-z0\-]+"))
    spaced = texts.select(F.explode(words).alias("word")).select(F.concat(F.lit(" "), "word").alias("word"))
    places = F.explode(F.sequence(F.lit(1), F.length("word") - 1)).alias("at")
    pairs = spaced.filter(F.length("word") > 1).select("word", places)
    counts = pairs.groupBy(F.expr("substring(word, at, 2)").alias("pair")).agg(F.count(F.lit(1)).alias("n"))
    return {r["pair"]: r["n"] for r in counts.collect()}


def evidence(word: Column, encoding: Column, bits: Sequence[float]) -> Column:
    """Bits by which a uniform draw from the alphabet is likelier to give the word than the null.

    The alphabet is the word's own choice, for which the logarithm of their number is taken off.
    """
    # One literal of text, as a call for each number would be slow.
    table = F.split(F.lit(",".join(f"{b:.4f}" for b in bits)), ",").cast("array<double>")
    each = F.array(*[F.lit(math.log2(len(a))) for a in ALPHABETS])
    width = len(language.SYMBOLS)
    plain = F.translate(
        word,
        language.DIGITS + language.SEPARATORS,
        "0" * len(language.DIGITS) + "-" * len(language.SEPARATORS),
    )
    codes = F.transform(F.split(plain, ""), lambda c: F.instr(F.lit(language.SYMBOLS), c))

    def against(code: Column) -> Column:
        before = F.concat(F.array(F.lit(0)), F.slice(code, F.lit(1), F.size(code) - 1))
        steps = F.zip_with(before, code, lambda a, b: F.get(table, a * width + b - 1))
        bits = F.aggregate(steps, F.lit(0.0), lambda a, x: a + x)
        return bits - F.size(code) * F.get(each, encoding) - math.log2(len(ALPHABETS))

    return _let(codes, against)


def _length_class(word: Column) -> Column:
    return reduce(lambda a, b: a + b, [(F.length(word) >= x).cast("int") for x in LENGTH_CLASSES])


def _candidates(text: Column, base: Column, bits: Sequence[float]) -> Column:
    """start, end, class, digest, bin of the strings to be tested, outside all base spans."""
    outside = F.filter(
        _matches(text, CANDIDATE, 0),
        lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])),
    )

    def tested(c: Column) -> Column:
        return _let(
            _encoding(c["word"]),
            lambda code: F.struct(
                c["start"].alias("start"),
                c["end"].alias("end"),
                _length_class(c["word"]).alias("class"),
                F.xxhash64(c["word"]).alias("digest"),
                _let(
                    p_value(c["word"], code),
                    lambda p: F.when(p < LEAST_P, F.lit(0)).otherwise(
                        F.greatest(
                            F.least(
                                F.floor(evidence(c["word"], code, bits) + F.log2(p)).cast("int"),
                                F.lit(MOST_BITS),
                            ),
                            F.lit(0),
                        )
                    ),
                )
                .alias("bin"),
            ),
        )

    return F.transform(outside, tested)


def thresholds(tested: DataFrame, fdr: float = FDR) -> dict[int, int]:
    """Smallest bin per class from which on strings count as random; classes without one are absent.

    ``tested`` has a row (class, digest, bin) per string, of which equal ones count once. The
    histogram has a fixed size.
    """
    different = tested.select("class", "digest", "bin").distinct()
    counts = different.groupBy("class", "bin").agg(F.count(F.lit(1)).alias("n"))
    above = Window.partitionBy("class").orderBy(F.desc("bin"))
    everyone = Window.partitionBy("class")
    rows = counts.withColumn("reported", F.sum("n").over(above)).withColumn("all", F.sum("n").over(everyone))
    ordinary = F.col("all") * F.pow(F.lit(2.0), -F.col("bin"))
    fine = rows.filter((F.col("bin") >= 1) & (ordinary <= fdr * F.col("reported")))
    return {r["class"]: r["bin"] for r in fine.groupBy("class").agg(F.min("bin").alias("bin")).collect()}


def _shown(spans: Column) -> Column:
    names = F.array(*[F.lit(name) for name, *_ in KINDS], F.lit(RANDOM))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fdr: float = FDR) -> DataFrame:
    """One row per document: its id, n_assign, n_access, n_hex, base_sha256, spans.

    ``spans`` lists kind:start:end of base matches and of strings that pass the tests, by start and
    kind; positions are code points. A NULL text is empty and has no spans. Repeated rows are all
    returned, other columns ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(doc_id).alias("id"), whole(text).alias("text"))
    bits = language.surprise(letter_pairs(rows))
    both = _let(
        _base(F.col("text")),
        lambda base: F.struct(base.alias("base"), _candidates(F.col("text"), base, bits).alias("tested")),
    )
    found = stored(rows.select("id", both.alias("both")).select("id", "both.*"), "secrets")
    limits = thresholds(found.select(F.explode("tested").alias("t")).select("t.*"), fdr)

    def passes(c: Column) -> Column:
        chosen = F.lit(MOST_BITS + 1)
        for number, least in sorted(limits.items()):
            chosen = F.when(c["class"] == number, F.lit(least)).otherwise(chosen)
        return c["bin"] >= chosen

    random = F.transform(
        F.filter("tested", passes),
        lambda c: F.struct(c["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), c["end"].alias("end")),
    )

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    numbers = [number(k).alias(f"n_{name}") for k, (name, *_) in enumerate(KINDS)]
    return found.select(
        F.col("id").alias(doc_id),
        *numbers,
        F.sha2(_shown(F.col("base")), 256).alias("base_sha256"),
        _shown(F.array_sort(F.concat("base", random))).alias("spans"),
    )
