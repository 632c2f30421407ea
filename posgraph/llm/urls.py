"""Operator 6: URL filter, rules first, then logistic regression on hashed character n-grams.

A rule (host, path prefix, verdict) fits its host and every subdomain when the
url's path starts with the rule's; of the rules that fit, the longest decides
(of equally long ones the one that blocks, then the alphabetically first).
Other urls are judged by a logistic regression on hashed character 3- to
5-grams of host and path, trained from a small labelled url table.

Everything is DataFrame expressions and Spark ML stages: each distinct (host,
path) is judged once, rules meet the suffixes of the host in an equi-join.

Rows: one per input row.  A null url or one without ``://`` has an empty host
and path and is judged by the model alone.  Null ``page_id`` and repeated rows
are carried through.  Labelled rows without url or label are ignored; without
both labels the model allows everything.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posgraph.llm.common import rows_of

DIMS = 1 << 14
GRAMS = (3, 4, 5)
MAX_LABELLED = 10_000  # bound on the labelled urls learned from
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]

# The small labelled url table (1: block).
LABELLED = [
    ("https://www.casino-royal.example/play/slots", 1), ("http://online-casino.example/bonus", 1),
    ("http://casino-jackpot.test/en/12", 1), ("https://win-casino.example/fr/7", 1),
    ("http://poker-bets.example/table/4", 1), ("https://free-bets-now.test/de/3", 1), ("http://sports-bets.example/es/9", 1),
    ("http://adult-videos.example/watch/1", 1), ("https://adult-x-club.test/en/55", 1), ("http://xxx-adult.example/12", 1),
    ("https://m.adult-cams.example/live", 1), ("https://www.adult-shop.example/catalog", 1), ("http://adult.test/gallery", 1),
    ("http://cheap-pills-shop.example/buy", 1),
    ("https://pills-cheap.test/en/8", 1), ("http://online-pills.example/order/2", 1), ("http://cheap-meds.example/fr/4", 1),
    ("http://spam-link-farm.example/en/31", 1), ("https://link-farm.test/de/6", 1), ("http://seo-spam.example/page/7", 1),
    ("http://ads-tracker.example/pixel", 1), ("https://track-ads.test/click/9", 1), ("http://ads-server.example/en/2", 1),
    ("http://free-warez.example/crack", 1), ("https://payday-loans-fast.example/apply", 1),
    ("http://malware-download.test/setup.exe", 1),
    ("https://www.city-library.example/en/4", 0), ("https://blog.gardening.example/en/77", 0),
    ("http://news.daily-herald.test/de/12", 0), ("https://docs.python-guide.example/tutorial/3", 0),
    ("https://university.example/research/papers", 0), ("http://m.weather.example/fr/8", 0),
    ("https://wiki.history.test/es/90", 0), ("https://recipes.kitchen.example/en/15", 0),
    ("http://blog.travel-notes.example/de/6", 0), ("https://museum.example/collection/44", 0),
    ("https://www.hospital.test/en/contact", 0), ("http://science.journal.example/en/2", 0),
    ("https://www.theatre.example/fr/3", 0), ("https://m.another.example/es/1", 0), ("http://thornton.test/en/5", 0),
    ("https://blog.stationery.example/de/17", 0), ("http://www.therapist.example/en/20", 0),
    ("https://the-nation.test/en/9", 0), ("http://blog.inter.example/fr/13", 0), ("https://m.earth.example/de/21", 0),
    ("https://northern-lights.example/en/6", 0), ("http://www.threads.test/es/18", 0),
    ("https://thinking.example/en/2", 0), ("https://chat.support-forum.example/de/4", 0), ("http://what-is-that.test/en/30", 0),
    ("https://hat-shop.example/fr/2", 0), ("http://natural-habitat.example/en/61", 0), ("http://m.leather.example/fr/10", 0),
]


def _rest() -> Column:
    return F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")


def host() -> Column:
    return F.translate(F.regexp_extract(_rest(), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path() -> Column:
    return F.regexp_extract(_rest(), r"^[^/?#]*([^?#]*)", 1)


def _ngrams(name: str, chars: str, n: int) -> Column:
    at = F.sequence(F.lit(1), F.greatest(F.size(chars) - (n - 1), F.lit(1)))
    return F.transform(at, lambda i: F.concat(F.lit(name), F.array_join(F.slice(chars, i, n), "")))


def _features(df: DataFrame) -> DataFrame:
    """Hashed character n-grams of host and path; a run of digits counts as one character."""
    chars = (df.withColumn("_host", F.split(F.concat(F.lit("."), "host", F.lit(".")), ""))
             .withColumn("_path", F.split(F.regexp_replace("path", "[0-9]+", "0"), "")))
    grams = F.concat(*[_ngrams(name, c, n) for name, c in (("h", "_host"), ("p", "_path")) for n in GRAMS])
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=DIMS, binary=True).transform(
        chars.withColumn("grams", grams)).drop("_host", "_path", "grams")


def labelled_table(spark: SparkSession) -> DataFrame:
    return rows_of(spark, LABELLED, ["url", "label"])


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return rows_of(spark, rules, ["rule_host", "rule_path", "rule_verdict"])


def train(labelled: DataFrame):
    """A fitted classifier, or None where the table does not hold both labels."""
    rows = (labelled.where("url is not null and label in (0, 1)")
            .select(host().alias("host"), path().alias("path"), F.col("label").cast("double").alias("label"))
            .orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(MAX_LABELLED))
    if rows.select("label").distinct().count() < 2:
        return None
    return LogisticRegression(regParam=0.01, maxIter=100).fit(_features(rows))


def judge(pages: DataFrame, rules: DataFrame, model) -> DataFrame:
    """page_id, host, path, rule, verdict, score (probability of block by the model)."""
    pages = pages.select("page_id", host().alias("host"), path().alias("path"))
    places = pages.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)),
                         lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = (places.withColumn("rule_host", F.explode(suffix)).join(rules, "rule_host")
            .where(F.col("path").startswith(F.col("rule_path"))))
    # the longest rule; of equally long ones a block, then the alphabetically first name
    order = F.struct((-F.length(F.concat("rule_host", "rule_path"))).alias("shortness"),
                     (F.col("rule_verdict") != "block").alias("allows"),
                     F.concat("rule_host", "rule_path").alias("rule"), "rule_verdict")
    ruled = fits.groupBy("host", "path").agg(F.min(order).alias("r")).select("host", "path", "r.rule", "r.rule_verdict")
    if model is None:
        scored = places.withColumn("score", F.lit(0.0))
    else:
        scored = model.transform(_features(places)).select(
            "host", "path", vector_to_array("probability")[1].alias("score"))
    judged = scored.join(ruled, ["host", "path"], "left").select(
        "host", "path", "rule", "score",
        F.coalesce("rule_verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"))
    return pages.join(judged, ["host", "path"]).select("page_id", "host", "path", "rule", "verdict", "score")
