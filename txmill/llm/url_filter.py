"""URL filter: rules first, gradient-boosted trees over lexical features for all other URLs.

Everything is built from DataFrame functions and Spark ML's trees. No page is fetched; only labelled
URLs are shuffled, for the sample of different ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txmill.llm.common import stored

ALLOW, BLOCK = "allow", "block"
#: Bound of the different URLs of each label that the trees are fitted on, lowest hashes first.
SAMPLE = 10_000
#: Up to so many rules become one expression; more are a table that hosts and paths are joined with.
EXPRESSION_RULES = 200
TREES, DEPTH, SEED = 20, 4, 7

#: Words of a host that make its URLs examples of blocked ones. A list of our own.
SEED_WORDS = ("adult", "ads", "bets", "casino", "pills", "spam")


@dataclass(frozen=True)
class Rule:
    """Fits its host and all subdomains, for paths that start with its own."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


@dataclass(frozen=True)
class Model:
    """Fitted trees, None without labelled URLs, and the share of blocked URLs per host suffix.

    The shares are those of all labelled pages, also of those that the trees are not fitted on.
    """

    trees: PipelineModel | None
    suffixes: DataFrame | None


def host_of(url: Column) -> Column:
    """Between the first :// and the next of / ? #; A-Z in lower case; empty without ://."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host to the next of ? #; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _by_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, NULL if none does; of equal ones, block."""
    text = verdict = F  # one flat list of cases, the first that fits counts
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == BLOCK, r.text), reverse=True):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        text, verdict = text.when(fits, F.lit(rule.text)), verdict.when(fits, F.lit(rule.verdict))
    if not rules:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return text, verdict


def _with_rules(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds rule and ruled by joins: hosts by their suffixes, paths by their beginnings.

    Different hosts and paths are joined, once each, so a host with many pages costs no more than
    others. A rule is met by equality of its host with a suffix and of its path with a beginning of
    the length that it has, so a host with many rules is no longer list than any.
    """
    spark = rows.sparkSession
    listed = [(r.host, r.path, r.text, r.verdict) for r in sorted(set(rules), key=lambda r: (r.text, r.verdict))]
    table = spark.createDataFrame(listed, "rule_host string, rule_path string, rule string, ruled string")
    lengths = F.array(*[F.lit(n) for n in sorted({len(r.path) for r in rules})])
    places = rows.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.concat_ws(".", F.slice(labels, k, F.size(labels))),
    )
    fitting = F.filter(lengths, lambda n: n <= F.length("path"))
    offered = (
        places.select("host", "path", F.explode(suffixes).alias("rule_host"))
        .withColumn("length", F.explode(fitting))
        .withColumn("rule_path", F.expr("substring(path, 1, length)"))
    )
    met = offered.join(table, ["rule_host", "rule_path"])
    order = F.struct(F.length("rule"), (F.col("ruled") == BLOCK).alias("b"), F.col("rule"))
    best = met.groupBy("host", "path").agg(F.max_by(F.struct("rule", "ruled"), order).alias("best"))
    return rows.join(best, ["host", "path"], "left").select(*rows.columns, "best.rule", "best.ruled")


def _count(text: Column, part: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))).cast("double") / len(part)


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text).cast("double")

    def add(total: Column, c: Column) -> Column:
        share = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return total - share * F.log2(share)

    letters = F.array_distinct(F.split(text, ""))
    return F.when(n > 0, F.aggregate(letters, F.lit(0.0), add)).otherwise(F.lit(0.0))


def parsed(
    pages: DataFrame, page_id: str, url: str, rules: list[Rule], expression_rules: int = EXPRESSION_RULES
) -> DataFrame:
    """id, url, host, path, suffix, rule, ruled (the verdict of the rule)."""
    rows = pages.select(F.col(page_id).alias("id"), F.coalesce(F.col(url), F.lit("")).alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rows = rows.withColumn("suffix", F.substring_index("host", ".", -1))
    if len(rules) > expression_rules:
        return _with_rules(rows, rules)
    rule, ruled = _by_rule(rules, F.col("host"), F.col("path"))
    return rows.withColumns({"rule": rule, "ruled": ruled})


FEATURES = {
    "url_length": lambda: F.length("url"),
    "host_length": lambda: F.length("host"),
    "path_length": lambda: F.length("path"),
    "host_depth": lambda: _count(F.col("host"), "."),
    "path_depth": lambda: _count(F.col("path"), "/"),
    "digit_ratio": lambda: F.length(F.regexp_replace("url", r"[^0-9]", "")) / F.greatest(F.length("url"), F.lit(1)),
    "host_digits": lambda: F.length(F.regexp_replace("host", r"[^0-9]", "")),
    "host_hyphens": lambda: _count(F.col("host"), "-"),
    "longest_label": lambda: F.array_max(F.transform(F.split("host", r"\."), F.length)),
    "entropy": lambda: _entropy(F.col("url")),
    "host_entropy": lambda: _entropy(F.col("host")),
    "parameters": lambda: _count(F.col("url"), "=") + _count(F.col("url"), "&"),
    "has_query": lambda: F.contains(F.col("url"), F.lit("?")).cast("double"),
    "has_fragment": lambda: F.contains(F.col("url"), F.lit("#")).cast("double"),
    "escapes": lambda: _count(F.col("url"), "%"),
    "secure": lambda: F.col("url").startswith("https:").cast("double"),
}
SUFFIX_FEATURES = ["suffix_share", "suffix_known"]


def _features(rows: DataFrame, suffixes: DataFrame) -> DataFrame:
    rows = rows.withColumns({f"f_{n}": make().cast("double") for n, make in FEATURES.items()})
    # As many rows as there are suffixes, so no broadcast is forced; adaptive execution splits hot ones.
    joined = rows.join(suffixes, "suffix", "left")
    return joined.fillna({"f_suffix_share": 0.5, "f_suffix_known": 0.0})


def labelled(rows: DataFrame) -> DataFrame:
    """All parsed URLs with a host, and label: 1 if a rule or a seed word blocks, else 0."""
    seeded = F.arrays_overlap(F.split("host", r"[.-]"), F.array(*[F.lit(w) for w in SEED_WORDS]))
    label = F.when(F.col("ruled").isNotNull(), F.col("ruled") == BLOCK).otherwise(seeded)
    return rows.filter(F.col("host") != "").withColumn("label", label.cast("double"))


def sampled(rows: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` different labelled URLs of each label, with their weight.

    The weights give each label its share of all different URLs, so the share that the trees learn
    does not depend on the size of the table.
    """
    different = stored(rows.select("url", "host", "path", "suffix", "label").dropDuplicates(["url"]), "urls")
    counts = {r["label"]: r["n"] for r in different.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken = sum(min(n, sample) for n in counts.values())
    kinds = []
    for label in (0.0, 1.0):
        n = counts.get(label, 0)
        weight = n / sum(counts.values()) * taken / min(n, sample) if n else 0.0
        chosen = different.filter(F.col("label") == label).orderBy(F.xxhash64("url"), "url").limit(sample)
        kinds.append(chosen.withColumn("weight", F.lit(weight)))
    return kinds[0].unionByName(kinds[1])


def train(rows: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on labelled URLs: columns of ``parsed`` and label. Without any, nothing is blocked."""
    if rows.isEmpty():
        return Model(None, None)
    shares = rows.groupBy("suffix").agg(
        ((F.sum("label") + 1.0) / (F.count(F.lit(1)) + 2.0)).alias("f_suffix_share"),
        F.log1p(F.count(F.lit(1))).alias("f_suffix_known"),
    )
    suffixes = stored(shares, "suffixes")
    names = [f"f_{n}" for n in [*FEATURES, *SUFFIX_FEATURES]]
    stages = [
        VectorAssembler(inputCols=names, outputCol="features"),
        GBTClassifier(labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=SEED),
    ]
    data = _features(sampled(rows, sample), suffixes).select("label", "weight", *names)
    return Model(Pipeline(stages=stages).fit(data), suffixes)


def judge(
    pages: DataFrame, rules: list[Rule], model: Model, page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """One row per page: its id, host, path, rule, verdict, score.

    The verdict is the rule's, else block if the trees give at least one half. A NULL or empty url,
    and one without ``://``, has an empty host and path; like any url without a rule it is judged
    by the trees. Without trees such urls are allowed. Repeated rows are all returned and other
    columns ignored; an empty table gives no rows.
    """
    rows = parsed(pages, page_id, url, rules)
    if model.trees is None:
        scored = rows.withColumn("score", F.lit(0.0))
    else:
        scored = model.trees.transform(_features(rows, model.suffixes)).withColumn(
            "score", vector_to_array("probability")[1]
        )
    own = F.when(F.col("score") >= 0.5, BLOCK).otherwise(ALLOW)
    return scored.select(
        F.col("id").alias(page_id), "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "score"
    )
