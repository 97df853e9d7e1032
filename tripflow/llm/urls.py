"""URL filter: rules first, then gradient-boosted trees on lexical features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import text_of, without, written
from tripflow.llm.extraction import host_of, path_of

ALLOW, BLOCK = "allow", "block"
RULES = ((ALLOW, "com/"), (BLOCK, "example.com/en/"), (ALLOW, "www.example.com/en/"),
         (BLOCK, "net/es/"), (BLOCK, "net/fr/"))
SAMPLE_ROWS = 20_000
OUTPUTS = ("host", "path", "rule", "verdict")
LEXICAL = ("url_length", "host_length", "path_length", "depth", "labels", "digit_ratio",
           "letter_ratio", "hyphens", "entropy", "parameters", "longest_segment", "fragment",
           "secure")
SUFFIX = ("suffix_length", "suffix_urls", "suffix_hosts", "suffix_mean_length",
          "suffix_mean_depth", "suffix_mean_digits")


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits as a struct of ``rule`` and ``verdict``, or null.

    A rule fits its host, the host's subdomains, and paths that start with its path.
    """
    found = F.lit(None)
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
                       ).otherwise(found)
    return found


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Features of the characters of a url alone."""
    length = F.length(url)
    some = F.greatest(length, F.lit(1))

    def share(pattern: str) -> Column:
        return F.regexp_count(url, F.lit(pattern)) / some

    chars = F.array_distinct(F.split(url, ""))
    parts = F.transform(chars, lambda c: F.when(c == "", 0.0).otherwise(
        (length - F.length(F.replace(url, c, F.lit("")))) / some))
    bits = F.aggregate(parts, F.lit(0.0), lambda total, p: total - F.when(
        p > 0, p * F.log2(p)).otherwise(0.0))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    segments = F.transform(F.split(path, "/"), lambda s: F.length(s))
    return {
        "url_length": length, "host_length": F.length(host), "path_length": F.length(path),
        "depth": F.regexp_count(path, F.lit("/[^/]")), "labels": F.regexp_count(host, F.lit("[^.]+")),
        "digit_ratio": share("[0-9]"), "letter_ratio": share("[A-Za-z]"),
        "hyphens": F.regexp_count(host, F.lit("-")), "entropy": bits,
        "parameters": F.regexp_count(query, F.lit("[^&]+")),
        "longest_segment": F.array_max(segments), "fragment": url.contains("#").cast("int"),
        "secure": url.startswith("https://").cast("int"),
    }


def with_features(urls: DataFrame) -> DataFrame:
    """Add features to distinct ``url`` rows; suffix statistics are over all of them."""
    named = urls.withColumn("_suffix", F.substring_index("host", ".", -1))
    rows = named.select("*", *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(n) for n, c in
                               lexical(F.col("url"), F.col("host"), F.col("path")).items()])
    by_suffix = rows.groupBy("_suffix").agg(
        F.count(F.lit(1)).alias("_urls"), F.approx_count_distinct("host").alias("_hosts"),
        F.avg("url_length").alias("suffix_mean_length"), F.avg("depth").alias("suffix_mean_depth"),
        F.avg("digit_ratio").alias("suffix_mean_digits"))
    stats = by_suffix.select(
        "_suffix", F.length("_suffix").cast("double").alias("suffix_length"),
        F.log1p("_urls").alias("suffix_urls"), F.log1p("_hosts").alias("suffix_hosts"),
        "suffix_mean_length", "suffix_mean_depth", "suffix_mean_digits")
    return rows.join(written(stats, "suffixes"), "_suffix").drop("_suffix")


def vectors(features: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[*LEXICAL, *SUFFIX], outputCol="features").transform(features)


def fit(features: DataFrame, *, sample_rows: int = SAMPLE_ROWS, trees: int = 20, depth: int = 4,
        rate: float = 0.3) -> GBTClassificationModel | None:
    """Learn ``verdict`` from at most ``sample_rows`` labelled urls, the first by hash.

    The sample is bounded because its use is to learn a model of fixed size. None if
    not both verdicts are labelled.
    """
    labelled = features.where(F.col("verdict").isNotNull())
    sample = labelled.orderBy(F.xxhash64("url"), "url").limit(sample_rows)
    table = written(vectors(sample).select(
        "features", (F.col("verdict") == BLOCK).cast("double").alias("label")).repartition(4),
        "url-sample")
    if table.agg(F.count_distinct("label")).first()[0] < 2:
        return None
    return GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=rate, seed=4,
                         checkpointInterval=-1).fit(table)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row, from ``url``.

    The longest fitting rule decides. Urls that no rule fits are judged by trees learnt
    from those that rules label; if these are not of both kinds, they are allowed. A
    null url is judged like an empty one. Urls are judged once however often they
    occur, and equal urls are judged alike. Input columns named like the new ones are
    replaced; no rows give no rows.
    """
    kept = without(pages, OUTPUTS).select(F.struct("*").alias("_row"), text_of("url").alias("url"))
    split = kept.select("url").distinct().withColumn("host", host_of("url")).withColumn(
        "path", path_of("url"))
    ruled = split.withColumn("_rule", matching_rule(F.col("host"), F.col("path"), rules)).select(
        "url", "host", "path", "_rule.rule", "_rule.verdict")
    features = written(with_features(ruled), "url-features")
    model = fit(features)
    if model is None:
        judged = features.withColumn("prediction", F.lit(0.0))
    else:
        judged = model.transform(vectors(features))
    verdicts = judged.select("url", "host", "path", "rule", F.coalesce(
        "verdict", F.when(F.col("prediction") > 0.5, BLOCK).otherwise(ALLOW)).alias("verdict"))
    return kept.join(written(verdicts, "verdicts"), "url").select("_row.*", *OUTPUTS)
