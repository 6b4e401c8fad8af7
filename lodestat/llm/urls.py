"""URL filter: rules first, gradient-boosted trees on lexical features for the rest."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from lodestat.session import settle_table

#: Labelled URLs to learn from, by a hash of the URL; the only sample here.
MAX_LABELLED = 100_000
#: Distinct host suffixes with statistics of their own; the most frequent of the sample.
MAX_SUFFIXES = 10_000
TREES, DEPTH = 12, 3
LEXICAL = ["n_chars", "depth", "digit_ratio", "entropy", "n_params", "host_labels", "host_chars", "suffix_rate", "suffix_rows"]


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``; A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_fits(rule: str) -> Column:
    """True where a rule like ``net/`` or ``example.org/fr/`` fits ``host`` and ``path``."""
    name, slash, path = rule.partition("/")
    host = (F.col("host") == F.lit(name)) | F.endswith(F.col("host"), F.lit("." + name))
    return host & F.startswith(F.col("path"), F.lit(slash + path))


def match_rules(urls: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Add ``rule`` and ``ruled``: the longest fitting rule (of equal length, the smallest) and its verdict; else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(sorted(rules, reverse=True), key=len):
        rule = F.when(rule_fits(r), F.lit(r)).otherwise(rule)
    for r, v in rules.items():
        verdict = F.when(F.col("rule") == F.lit(r), F.lit(v)).otherwise(verdict)
    return urls.withColumn("rule", rule).withColumn("ruled", verdict)


def _suffix() -> Column:
    return F.substring_index("host", ".", -1)


def lexical(urls: DataFrame) -> DataFrame:
    """Add the features that need the URL alone; ``urls`` has ``url, host, path``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    n = F.length(url)
    signs = F.array_distinct(F.split(url, ""))
    share = lambda c: (n - F.length(F.replace(url, c, F.lit("")))) / n
    entropy = F.aggregate(F.filter(signs, lambda c: c != ""), F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))
    return (urls.withColumn("n_chars", n.cast("double"))
            .withColumn("depth", (F.length("path") - F.length(F.replace("path", F.lit("/"), F.lit("")))).cast("double"))
            .withColumn("digit_ratio", F.when(n > 0, (n - F.length(F.regexp_replace(url, "[0-9]", ""))) / n).otherwise(0.0))
            .withColumn("entropy", F.when(n > 0, entropy).otherwise(0.0))
            .withColumn("n_params", F.size(F.filter(F.split(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), "&"), lambda p: p != "")).cast("double"))
            .withColumn("host_labels", F.size(F.split("host", r"\.")).cast("double"))
            .withColumn("host_chars", F.length("host").cast("double")))


class UrlModel:
    """Suffix statistics and boosted trees, or one verdict where the labels have fewer than two classes."""

    def __init__(self, suffixes: DataFrame | None, trees: PipelineModel | None, constant: str):
        self.suffixes, self.trees, self.constant = suffixes, trees, constant

    def features(self, urls: DataFrame) -> DataFrame:
        # At most MAX_SUFFIXES rows.
        known = F.broadcast(self.suffixes)
        return (lexical(urls).withColumn("suffix", _suffix()).join(known, "suffix", "left")
                .fillna({"suffix_rate": 0.5, "suffix_rows": 0.0}))

    def add_verdict(self, urls: DataFrame, name: str = "learned") -> DataFrame:
        """Add ``name``: ``block`` or ``allow``."""
        if self.trees is None:
            return urls.withColumn(name, F.lit(self.constant))
        out = self.trees.transform(self.features(urls))
        verdict = F.when(F.col("prediction") == 1.0, F.lit("block")).otherwise(F.lit("allow"))
        return out.select(*urls.columns, verdict.alias(name))


def train(labelled: DataFrame, most: int = MAX_LABELLED) -> UrlModel:
    """Fit a model on ``(url, host, path, blocked)`` rows; at most about ``most`` by a hash of the URL.

    Rows without a label stay out. Suffix statistics are the smoothed share of blocked
    rows for each last host label of the sample.
    """
    rows = labelled.filter(F.col("blocked").isNotNull()).select("url", "host", "path", F.col("blocked").cast("double").alias("blocked"))
    n = rows.count()
    if n > most:
        rows = rows.filter(F.pmod(F.xxhash64("url"), F.lit(1_000_000)) < int(1_000_000 * most / n))
    rows = settle_table(rows.sort("url", "host", "path"))
    seen = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("blocked"), F.lit(0.0)).alias("b")).first()
    if seen["b"] in (0, seen["n"]):
        return UrlModel(None, None, "block" if seen["n"] and seen["b"] else "allow")
    suffixes = settle_table(rows.groupBy(_suffix().alias("suffix")).agg(
        ((F.sum("blocked") + 1) / (F.count("*") + 2)).alias("suffix_rate"), F.count("*").cast("double").alias("suffix_rows"))
        .orderBy(F.desc("suffix_rows"), "suffix").limit(MAX_SUFFIXES))
    model = UrlModel(suffixes, None, "allow")
    ready = VectorAssembler(inputCols=LEXICAL, outputCol="x")
    trees = GBTClassifier(featuresCol="x", labelCol="blocked", maxIter=TREES, maxDepth=DEPTH, seed=7).fit(ready.transform(model.features(rows)))
    model.trees = PipelineModel([ready, trees])
    return model


def judge(pages: DataFrame, rules: dict[str, str], key: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    A fitting rule decides; the trees, trained on the URLs that rules label, decide the
    rest. A null URL, or one without ``://``, has an empty host and path, and so no
    rule. Repeated rows stay; other columns are not read; an empty table gives no
    rows; without labelled URLs every other URL is allowed.
    """
    slim = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"))
    ruled = match_rules(slim.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))), rules)
    labelled = ruled.withColumn("blocked", (F.col("ruled") == "block").cast("int"))
    model = train(labelled.select("url", "host", "path", "blocked"))
    return model.add_verdict(ruled).select("page_id", "host", "path", "rule", F.coalesce("ruled", "learned").alias("verdict"))
