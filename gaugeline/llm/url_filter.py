"""URL verdicts: rules first, then logistic regression on hashed character n-grams.

Main path and training use DataFrame functions and ``pyspark.ml`` stages, which run in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import hash_sample, lower_ascii


@dataclass(frozen=True)
class Rule:
    """Fits its host and all subdomains where the URL's path starts with the rule's."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return (((host == self.host) | host.endswith("." + self.host))
                & path.startswith(self.path))


def with_host_and_path(urls: DataFrame) -> DataFrame:
    """Add host and path; both are empty where the url is null or has no ``://``."""
    mark = F.locate("://", F.col("url"))
    rest = F.when(mark > 0, F.substring(F.col("url"), mark + 3, F.length("url"))).otherwise("")
    return (urls.withColumn("_rest", rest)
            .withColumn("_host", F.regexp_extract("_rest", r"^[^/?#]*", 0))
            .withColumn("path", F.regexp_extract(
                F.substring(F.col("_rest"), F.length("_host") + 1, F.length("_rest")),
                r"^[^?#]*", 0))
            .withColumn("host", lower_ascii(F.col("_host")))
            .drop("_rest", "_host"))


def fitting_rule(rules: Sequence[Rule]) -> Column:
    """Struct of name and verdict of the longest rule that fits, null if none does."""
    found: Column = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        found = F.when(rule.fits(F.col("host"), F.col("path")),
                       F.struct(F.lit(rule.name).alias("rule"),
                                F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def grams(sizes: Sequence[int]) -> Column:
    """Character n-grams of host and path, each marked with its part; never empty."""
    def of(mark: str, text: Column, n: int) -> Column:
        chars = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")
        found = F.transform(chars, lambda c: F.concat(F.lit(mark), c))
        for k in range(1, n):  # the characters k places on; past the end there are none
            found = F.zip_with(found, F.slice(chars, k + 1, F.length(text) + 2),
                               lambda a, b: F.concat(a, b))
        return F.filter(found, lambda g: g.isNotNull())
    return F.concat(F.array(F.lit("any")), *[
        of(mark, F.col(part), n) for mark, part in (("h:", "host"), ("p:", "path")) for n in sizes])


@dataclass(frozen=True)
class UrlModel:
    """Features and weights; ``model`` is None where the labels hold fewer than two verdicts."""

    sizes: tuple[int, ...]
    model: PipelineModel | None
    only: str = "allow"

    def verdict(self, urls: DataFrame) -> DataFrame:
        """Add the column ``learned`` to a frame with host and path."""
        if self.model is None:
            return urls.withColumn("learned", F.lit(self.only))
        scored = self.model.transform(urls.withColumn("_grams", grams(self.sizes)))
        return (scored.withColumn("learned", F.when(F.col("_block") > 0.5, "block")
                                  .otherwise("allow"))
                .drop("_grams", "_features", "_raw", "_probability", "_block"))


def train(labelled: DataFrame, sizes: Sequence[int] = (3, 4, 5), buckets: int = 1 << 14,
          penalty: float = 1e-3, rows: int = 20_000) -> UrlModel:
    """Fit on a small table of url and verdict (allow or block).

    At most ``rows`` distinct (host, path) are used, those with the smallest hashes; a pair labelled
    both ways counts as blocked. Rows with another or no verdict are left out.
    """
    table = (with_host_and_path(labelled.select("url", "verdict"))
             .where(F.col("verdict").isin("allow", "block"))
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))
    sample = (hash_sample(table, F.struct("host", "path"), rows)
              .select("host", "path", (F.col("verdict") == "block").cast("double").alias("_label"),
                      grams(sizes).alias("_grams")).coalesce(1).cache())
    try:
        classes = [r[0] for r in sample.select("_label").distinct().collect()]
        if len(classes) < 2:
            return UrlModel(tuple(sizes), None, "block" if classes == [1.0] else "allow")
        hashing = HashingTF(inputCol="_grams", outputCol="_features", numFeatures=buckets,
                            binary=True)
        regression = LogisticRegression(
            featuresCol="_features", labelCol="_label", predictionCol="_block",
            rawPredictionCol="_raw", probabilityCol="_probability", regParam=penalty, maxIter=30)
        fitted = regression.fit(hashing.transform(sample))
        return UrlModel(tuple(sizes), PipelineModel([hashing, fitted]))
    finally:
        sample.unpersist()


def judge(urls: DataFrame, rules: Sequence[Rule], model: UrlModel) -> DataFrame:
    """Add host, path, rule and verdict to each row: the longest fitting rule's verdict, else the
    model's.

    One pass without a shuffle. A null url, or one without ``://``, has an empty host and path, fits
    no rule and gets the model's verdict on no characters. Repeated rows are judged alike, a URL of any
    length is read whole, and an empty table stays empty. Columns of these names that the input already
    has are replaced.
    """
    parts = with_host_and_path(urls.drop("host", "path", "rule", "verdict"))
    ruled = model.verdict(parts.withColumn("_fit", fitting_rule(rules)))
    return (ruled.withColumn("rule", F.col("_fit.rule"))
            .withColumn("verdict", F.coalesce(F.col("_fit.verdict"), F.col("learned")))
            .drop("_fit", "learned"))


def rule_labelled(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """URLs that fit a rule, with its verdict: a labelled table where no other is at hand."""
    fit = with_host_and_path(urls.select("url")).withColumn("_fit", fitting_rule(rules))
    return fit.where(F.col("_fit").isNotNull()).select("url", F.col("_fit.verdict").alias("verdict"))
