"""URL filter: rules on host and path, and a classifier for what no rule decides.

DataFrame and SQL functions only; the classifier is logistic regression on hashed
character n-grams of host and path. It is fitted on a small labelled table, of which
at most ``MAX_LABELLED`` rows are used, and scored as one expression per URL.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower

BLOCK, ALLOW = "block", "allow"
# Rows of the labelled table that are used, smallest hash of the URL first.
MAX_LABELLED = 50_000
GRAM_SIZES = (3, 4)
BUCKETS = 1 << 12


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


class UrlModel(NamedTuple):
    """A weight per n-gram bucket, and the intercept. ``score > 0`` blocks."""

    weights: list[float]
    intercept: float


# The rules of the contract.
RULES = (Rule("net", "/", BLOCK), Rule("example.net", "/en/", ALLOW),
         Rule("example.com", "/de/", BLOCK), Rule("org", "/fr/", ALLOW))

# A small labelled table. Hosts of shops that advertise by spam, and of ordinary sites.
_BLOCKED = ("cheap-pills", "spam-farm", "casino-bonus", "free-money", "best-pills-online", "win-casino",
            "adult-cams", "replica-watches", "cheap-meds", "payday-loans-now", "xxx-videos", "crypto-doubler",
            "bet-and-win", "hot-singles", "buy-followers", "clickbait-farm", "link-farm", "seo-spam",
            "free-casino-spins", "cheap-viagra", "lottery-winner", "miracle-diet", "warez-download", "get-rich-fast",
            "ads-server", "ad-track", "click-track", "popup-ads", "banner-ads", "track-pixel")
_ALLOWED = ("library", "university", "news", "weather", "cooking", "science", "museum", "gardening", "history",
            "city-council", "travel", "football", "music-school", "photography", "theatre", "astronomy", "mathematics",
            "hospital", "railway", "bookshop", "philosophy", "carpentry", "geology", "painting", "orchard", "harbour",
            "thereafter", "another", "northern", "lantern", "station", "thistle", "heather", "answers", "oriental",
            "reading", "winter", "mentor", "lumiere", "maison", "montagne", "quartier", "heimat", "zeitung", "garten",
            "schule", "ciudad", "camino", "montaña", "escuela", "jardin", "cocina", "estacion", "handwerk")
_FORMS = ("https://www.{0}.example.com/en/1", "http://{0}.example.org/de/22.html", "https://{0}.example.com/article/333",
          "https://m.{0}.example.org/es/4?page=2", "http://blog.{0}.example.com/5/")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table (url, blocked): fixed hosts in a few forms of URL."""
    rows = [(form.format(host), label) for label, hosts in ((1, _BLOCKED), (0, _ALLOWED))
            for host in hosts for form in _FORMS]
    return spark.createDataFrame(rows, "url string, blocked int")


def with_host_and_path(urls: DataFrame) -> DataFrame:
    """``urls`` with ``host`` and ``path``, replaced if there already.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case.
    Path: what follows, up to ``?``, ``#`` or the end. Both are empty for NULL or no ``://``.
    """
    url = F.coalesce(F.col("url"), F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    before_query = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    host = F.substring_index(before_query, "/", 1)
    path = F.substring(before_query, F.length(host) + 1, F.length(before_query))
    return urls.withColumns({"host": ascii_lower(host), "path": path})


def fit_url_model(labelled: DataFrame, reg: float = 0.01, max_iter: int = 50) -> UrlModel:
    """Fit on (url, blocked 0 or 1); rows without a label are left out, repeated ones count.

    At most ``MAX_LABELLED`` rows are used. Without rows of both classes every URL is
    scored by the share of blocked ones (none: 0, which allows).
    """
    few = (labelled.filter(F.col("blocked").isNotNull()).orderBy(F.xxhash64("url"), "url").limit(MAX_LABELLED))
    grams = HashingTF(binary=True, numFeatures=BUCKETS, inputCol="grams", outputCol="features")
    table = grams.transform(with_host_and_path(few).select(
        F.col("blocked").cast("double").alias("label"), _bucket_names().alias("grams")))
    classes = [row[0] for row in table.select("label").distinct().orderBy("label").collect()]
    if classes != [0.0, 1.0]:
        return UrlModel([0.0] * BUCKETS, 1.0 if classes == [1.0] else 0.0)
    fitted = LogisticRegression(regParam=reg, maxIter=max_iter).fit(table)
    weights = fitted.coefficients.toArray().tolist()
    # Which place HashingTF gives a bucket's name, so that weights can be read by bucket.
    names = labelled.sparkSession.range(0, BUCKETS, 1, 1).select(F.array(F.col("id").cast("string")).alias("grams"))
    places = [int(row.features.indices[0]) for row in grams.transform(names).orderBy(F.col("grams")[0].cast("int")).collect()]
    return UrlModel([weights[place] for place in places], float(fitted.intercept))


def judge_urls(urls: DataFrame, rules: Sequence[Rule], model: UrlModel) -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule``, ``score`` and ``verdict``, replaced if there already.

    A rule fits its host and all subdomains if the path starts with the rule's. The
    longest rule that fits gives the verdict; of equally long ones, the first in
    alphabetical order. Where none fits ``rule`` is NULL and the model decides; a URL
    without any n-gram has the intercept as its score. Rows are judged one by one, so
    repeated rows and NULLs need nothing special, and no rows give none.
    """
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    rule = F.coalesce(F.lit(None).cast("string"), *[F.when(_fits(r), r.text) for r in ordered])
    said = F.coalesce(F.lit(None).cast("string"), *[F.when(_fits(r), r.verdict) for r in ordered])
    score = _score(model)
    return (with_host_and_path(urls).withColumns({"rule": rule, "score": score})
            .withColumn("verdict", F.coalesce(said, F.when(F.col("score") > 0, BLOCK).otherwise(ALLOW))))


def _fits(rule: Rule) -> Column:
    host = (F.col("host") == rule.host) | F.endswith(F.col("host"), F.lit("." + rule.host))
    return host & F.startswith(F.col("path"), F.lit(rule.path))


def _buckets() -> Column:
    """The distinct n-gram buckets of host and path; a space marks where either ends."""
    line = F.concat(F.lit(" "), "host", F.lit(" "), "path", F.lit(" "))
    sizes = [F.when(F.length(line) >= n, F.transform(
        F.sequence(F.lit(1), F.length(line) - (n - 1)), lambda i, n=n: F.substring(line, i, F.lit(n))))
        .otherwise(F.array().cast("array<string>")) for n in GRAM_SIZES]
    return F.array_distinct(F.transform(F.concat(*sizes), lambda g: F.pmod(F.xxhash64(g), F.lit(BUCKETS)).cast("int")))


def _bucket_names() -> Column:
    return F.transform(_buckets(), lambda b: b.cast("string"))


def _score(model: UrlModel) -> Column:
    # One literal once folded; an array of as many literals would burden the planner.
    weights = F.split(F.lit(",".join(map(repr, model.weights))), ",").cast("array<double>")
    return F.aggregate(F.sort_array(_buckets()), F.lit(model.intercept), lambda s, b: s + F.get(weights, b))
