"""Operator 2: URL filter — host/path rules, then logistic regression on hashed
character n-grams of host and path, trained from a small labelled URL table.

Defined results: a null url, or one without ``://``, has empty host and path;
no rule fits it and the model judges the empty string.  Equal rows are judged
alike, each on its own; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pixelframe.llm.base import lower_ascii, read_table

#: (host, path, verdict); a rule fits its host and all subdomains of it.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
N_FEATURES = 1 << 18
GRAMS = (3, 4, 5)
THRESHOLD = 0.65

# Words of the host names in the labelled URL table (fixed values).
BLOCK_WORDS = """
casino poker slots jackpot lottery win winner bonus bets betting odds spins cheap free pills viagra meds pharmacy
loans payday ads adserver banner popup track tracker click pixel spam farm links seo adult xxx porn sex cams dating
x warez crack keygen replica
""".split()
ALLOW_WORDS = """
weather station theory thinking mother father another library nation history science gardens museum travel recipes
kitchen reader letters earth northern southern western eastern interest tender tension intention rather together
other either neither gather further anthem rhythm thistle theatre thousand threshold thread hearing training
teaching reading printing shelter shore shield stone street string strand nature culture question school journal
council health music review stadium teacher
""".split()
_DOMAINS = ("example.com", "example.net", "example.org", "com", "net", "org")
_SUBDOMAINS = ("", "www.", "m.", "blog.")
_PATHS = ("/en/1001", "/fr/22.html", "/de/310/", "/es/4#top", "/en/55?page=2", "/", "")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label), 1 = block.  Host names are single words and word pairs of
    one list, each under every subdomain; domains and paths are dealt in turn
    to both labels, so that only the name tells them apart."""
    rows = []
    for words, label in ((BLOCK_WORDS, 1.0), (ALLOW_WORDS, 0.0)):
        n = len(words)
        names = words + [f"{w}-{words[(i + k) % n]}" for k in (1, 4, 9, 16) for i, w in enumerate(words)]
        rows += [(f"http://{sub}{name}.{_DOMAINS[(i + j) % 6]}{_PATHS[(i + j) % 7]}", label)
                 for i, name in enumerate(names) for j, sub in enumerate(_SUBDOMAINS)]
    return spark.createDataFrame(rows, "url string, label double").coalesce(1)


def with_host_path(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``; both empty without ``://``."""
    u = F.coalesce(F.col(url), F.lit(""))
    host = F.regexp_extract(u, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(u, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return df.withColumn("host", lower_ascii(host)).withColumn("path", path)


def char_grams(text: Column, sizes: Sequence[int] = GRAMS) -> Column:
    """Array of the character n-grams of ``text`` for every n in ``sizes``."""

    def of_size(n: int) -> Column:  # a second parameter of the lambda would be the place in the array
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.substring(text, i, F.lit(n)))

    return F.concat(*[of_size(n) for n in sizes])


def features(df: DataFrame) -> DataFrame:
    """Add ``grams``: of the host between ^ and its end, and of the path with digits as 0."""
    return df.withColumn("grams", F.concat(
        char_grams(F.concat(F.lit("^"), F.col("host"), F.lit("$"))),
        F.transform(char_grams(F.regexp_replace("path", "[0-9]+", "0")), lambda g: F.concat(F.lit("p:"), g))))


def fit(urls: DataFrame, n_features: int = N_FEATURES, reg: float = 0.001) -> PipelineModel:
    """Logistic regression over hashed n-grams of (url, label)."""
    return Pipeline(stages=[
        HashingTF(inputCol="grams", outputCol="tf", numFeatures=n_features, binary=True),
        LogisticRegression(featuresCol="tf", labelCol="label", regParam=reg, maxIter=100,
                           thresholds=[1 - THRESHOLD, THRESHOLD], predictionCol="is_blocked",
                           probabilityCol="probability", rawPredictionCol="margin"),
    ]).fit(features(with_host_path(urls)))


def rule_column(rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, what in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # the longest is tested first
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def judge(pages: DataFrame, model: PipelineModel, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url)."""
    rows = features(with_host_path(pages.select(pages["page_id"], pages["url"])))
    scored = model.transform(rows)
    rule, by_rule = rule_column(rules)
    by_model = F.when(F.col("is_blocked") == 1.0, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(by_rule, by_model).alias("verdict"))


def op2_urls(spark, sf_dir) -> DataFrame:
    return judge(read_table(spark, sf_dir, "pages"), fit(labelled_urls(spark)))
