"""URL filter: host and path rules first, then logistic regression on hashed
character n-grams of host and path.

All DataFrame and SQL functions and ``pyspark.ml`` (JVM). The regression is
trained from a small labelled URL table; scoring is one pass over the URLs
without a shuffle. Rules are a short configured list, tested inside the
expression.

Defined cases: a null URL or one without ``://`` has an empty host and path,
meets no rule and is judged by the model on the empty n-grams (its intercept).
Repeated rows are judged alike; extra columns are ignored or carried.
"""
from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_RULES = 2000

#: Fixed values: (host, path, verdict).
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

#: The small labelled table that the query trains on: 1 is unwanted.
LABELLED = [
    (1, "http://spam-links.example.biz/buy"), (1, "http://cheap-pills.example.info/order"),
    (1, "http://casino-bonus.example.com/win"), (1, "http://free-slots.example.org/play"),
    (1, "https://adult-cams.example.com/live"), (1, "http://xxx-videos.example.net/watch"),
    (1, "http://link-farm.example.org/seo"), (1, "http://content-farm.example.com/page"),
    (1, "http://spam.example.org/offer"), (1, "http://poker-jackpot.example.com/cash"),
    (1, "https://replica-watches.example.info/sale"), (1, "http://payday-loans.example.biz/apply"),
    (1, "http://click-ads.example.com/track/banner"), (1, "http://adserver.example.net/popup"),
    (1, "http://win-prize.example.org/claim"), (1, "http://betting-tips.example.com/odds"),
    (1, "http://malware-download.example.info/crack.exe"), (1, "http://warez-keygen.example.org/serial"),
    (1, "http://phishing-login.example.com/verify-account"), (1, "http://doorway-farm.example.net/spam"),
    (0, "https://www.news.example.com/en/article/2020"), (0, "https://en.wiki.example.org/wiki/History"),
    (0, "https://blog.garden.example.net/post/12"), (0, "https://www.university.example.org/research"),
    (0, "https://docs.library.example.com/guide/start.html"), (0, "https://museum.example.org/collection/5"),
    (0, "http://www.weather.example.net/today"), (0, "https://recipes.example.com/soup/7.html"),
    (0, "https://m.travel.example.net/city/paris"), (0, "https://www.science.example.org/paper/88"),
    (0, "https://forum.music.example.com/topic?page=2"), (0, "https://school.example.org/fr/cours/3"),
    (0, "https://www.city-council.example.org/services"), (0, "http://books.example.com/de/autor/9"),
    (0, "https://www.health.example.org/advice/sleep"), (0, "https://sports.example.net/results/41"),
    (0, "https://code.example.org/project/readme.html"), (0, "http://www.history.example.com/es/siglo"),
    (0, "https://maps.example.org/route/3"), (0, "https://www.letters.example.net/en/471"),
]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL column."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return (F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as a struct of ``rule`` and ``verdict``
    (null if none does)."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"rules are a configured list of {MAX_RULES} at most")
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def url_grams(host: Column, path: Column, sizes: tuple[int, ...]) -> Column:
    """Character n-grams of host and path, marked by where they come from."""
    def grams(mark: str, text: Column, n: int) -> Column:
        text = F.concat(F.lit("^"), F.translate(text, UPPER, LOWER), F.lit("$"))
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1))),
                           lambda i: F.concat(F.lit(mark), F.substring(text, i, n)))
    return F.concat(*[grams(m, t, n) for m, t in (("h", host), ("p", path)) for n in sizes])


def train(labelled: DataFrame, buckets: int = 1 << 14, sizes: tuple[int, ...] = (3, 4), l2: float = 0.01,
          max_iter: int = 50) -> PipelineModel:
    """Fit the regression on columns ``url`` and ``label`` (0 or 1; rows with
    a null label are left out)."""
    host, path = url_parts(F.col("url"))
    rows = labelled.where("label IS NOT NULL").select(
        url_grams(host, path, sizes).alias("grams"), F.col("label").cast("double").alias("label"))
    tf = HashingTF(inputCol="grams", outputCol="features", numFeatures=buckets, binary=True)
    fit = LogisticRegression(regParam=l2, maxIter=max_iter).fit(tf.transform(rows.coalesce(1)))
    return PipelineModel([tf, fit])


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LABELLED, "label int, url string")


def judge_urls(urls: DataFrame, model: PipelineModel, rules: list[tuple[str, str, str]] = RULES,
               url_col: str = "url", sizes: tuple[int, ...] = (3, 4), keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns with host, path, rule, verdict and the model's
    probability that the URL is unwanted."""
    host, path = url_parts(F.col(url_col))
    rows = urls.select(*keep, host.alias("host"), path.alias("path"))
    rows = rows.withColumns({"fit": rule_of(F.col("host"), F.col("path"), rules),
                             "grams": url_grams(F.col("host"), F.col("path"), sizes)})
    scored = model.transform(rows)
    own = F.when(F.col("prediction") > 0.5, "block").otherwise("allow")
    return scored.select(*keep, "host", "path", F.col("fit.rule").alias("rule"),
                         F.coalesce(F.col("fit.verdict"), own).alias("verdict"), own.alias("model_verdict"))
