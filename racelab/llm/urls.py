"""URL filters: rules by host and path, and a logistic regression for the rest, with DataFrame functions only.

A rule fits its host and all subdomains if the path starts with the rule's; of several the longest wins, of equally
long ones the one with the longer host, then block. Urls that no rule fits are judged by logistic regression on hashed
character n-grams of host and path, with no other inputs than the url. It is trained from a small labelled table of
urls, by default that of ``url_labels``, in which the rules have no part.

Null urls and those without ``://`` have an empty host and path; without features they get the verdict of the bias.
Without labels of both kinds the method allows, or blocks, all as the one kind says; without any it allows. Rows are
judged one by one, so a hot host is no matter; html isn't read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from racelab.llm.common import ascii_lower, let, stored, table
from racelab.llm.url_labels import ALLOWED, BLOCKED

#: (verdict, rule): a host and the start of a path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Rules stand in the plan as a constant, so their number is bounded.
MOST_RULES = 1000
BITS, GRAMS = 14, (3, 4)
MOST_STEPS, PENALTY = 30, 0.01
THRESHOLD = 0.5


def host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host_: Column, path_: Column, rules=RULES) -> Column:
    """struct<verdict, rule> of the longest rule that fits, or null."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    if not rules:
        return F.lit(None).cast("struct<verdict:string,rule:string>")
    fitting = []
    for verdict, rule in rules:
        name, slash, rest = rule.partition("/")
        fits = ((host_ == name) | host_.endswith(f".{name}")) & path_.startswith(slash + rest)
        rank = F.struct(F.lit(len(rule)).alias("n"), F.lit(len(name)).alias("host"), F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        fitting.append(F.when(fits, rank))
    best = F.greatest(*fitting) if len(fitting) > 1 else fitting[0]
    return let(best, lambda b: F.when(b.isNotNull(), F.struct(b["verdict"].alias("verdict"), b["rule"].alias("rule"))))


def _gram(marked: Column, n: int) -> Callable[[Column], Column]:
    return lambda i: F.substr(marked, i, F.lit(n))


def grams(host_: Column, path_: Column) -> Column:
    """The character n-grams of a url's host and of its path, marked which."""

    def of(marked: Column) -> Column:
        each = [
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.length(marked) - (n - 1), F.lit(1))),
                _gram(marked, n),
            )
            for n in GRAMS
        ]
        return reduce(F.concat, each)

    return F.array_distinct(F.concat(let(F.concat(F.lit("^"), host_, F.lit("$")), of), let(F.concat(F.lit("<"), path_, F.lit(">")), of)))


def parsed(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, url, host, path, by_rule) of every row."""
    rows = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    return rows.withColumn("by_rule", rule_for(F.col("host"), F.col("path"), rules))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(host, path, blocked) of the labelled table that comes with the library."""

    def rows(text: str, blocked: float) -> DataFrame:
        url = F.explode(F.split(F.lit(text.strip()), "\n")).alias("url")
        return spark.range(1).select(url).select(F.substring_index("url", "/", 1).alias("host"), F.regexp_extract("url", "/.*", 0).alias("path"), F.lit(blocked).alias("blocked"))

    return rows(BLOCKED, 1.0).unionByName(rows(ALLOWED, 0.0))


def hashing() -> HashingTF:
    return HashingTF(numFeatures=1 << BITS, binary=True, inputCol="grams", outputCol="features")


def fitted(labelled: DataFrame) -> LogisticRegressionModel | float:
    """The regression, or the one label where there are no labels of both kinds (0 without any).

    ``labelled`` is a small table (host, path, blocked 0 or 1).
    """
    sample = hashing().transform(labelled.withColumn("grams", grams(F.col("host"), F.col("path")))).select("features", F.col("blocked").cast("double").alias("label"))
    kinds = [r["label"] for r in sample.select("label").distinct().collect()]  # two at most
    if len(kinds) < 2:
        return kinds[0] if kinds else 0.0
    return LogisticRegression(maxIter=MOST_STEPS, regParam=PENALTY, probabilityCol="probability", rawPredictionCol="raw").fit(sample)


def judged(pages: DataFrame, labelled: DataFrame | None = None, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row; score is the regression's, also where a rule decides."""
    model = fitted(stored(labelled_urls(pages.sparkSession) if labelled is None else labelled))
    rows = parsed(pages, rules)
    if isinstance(model, float):
        scored = rows.withColumn("score", F.lit(model))
    else:
        scored = model.transform(hashing().transform(rows.withColumn("grams", grams(F.col("host"), F.col("path")))))
        scored = scored.withColumn("score", F.get(vector_to_array("probability"), 1))
    verdict = F.coalesce(F.col("by_rule.verdict"), F.when(F.col("score") >= THRESHOLD, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", F.col("by_rule.rule").alias("rule"), verdict.alias("verdict"), "score")


def op8_url_filters(spark, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages")).drop("score")
