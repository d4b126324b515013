"""URL filtering: host and path rules first, then a logistic regression on hashed character n-grams.

The model is fitted by Spark's own logistic regression on a small table of labelled URLs. Its
coefficients, one per hash bucket, become a literal of the scoring expression, so judging a URL is a
plain column expression: no join, no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridagro.llm.common import a_z, read

#: (host, path, verdict); a rule fits its host and all subdomains if the path starts with the rule's.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

#: Hash buckets of n-grams, their lengths, and the strength of the L2 penalty.
BUCKETS, LENGTHS, PENALTY = 1024, (3, 4), 0.001

# Labelled URLs: invented examples of sites to keep out and of ordinary sites.
BLOCKED = """
http://cheap-pills.test/en/1 https://www.cheap-meds.test/buy/now http://pills-online.test/discount https://m.casino-win.test/en/7
http://casino-royal.test/spin/slots https://jackpot-casino.test/de/bonus http://free-bets.test/en/44 https://best-bets.test/odds/today
http://spam-farm.test/fr/12 https://link-farm.test/links/1 http://www.spam-mail.test/es/9 https://ads-track.test/click/55
http://ads-server.test/banner http://track-pixel.test/p/1 https://adult-cams.test/live http://xxx-videos.test/hot
http://free-casino.test/win https://win-prizes.test/free/claim http://payday-loans.test/apply https://replica-watches.test/buy
http://free-pills.test/order https://bets-win.test/fr/3 http://farm-links.test/seo https://track-ads.test/en/9
""".split()
ALLOWED = """
https://www.library.test/en/1 http://blog.garden.test/de/22 https://news.harbour.test/2020/05/storm http://museum.test/en/exhibits
https://m.weather.test/fr/3 http://university.test/courses/history https://docs.kernel.test/guide.html http://recipes.test/bread
https://blog.travel.test/es/rome http://www.river.test/en/571 https://theatre.test/programme http://science.test/papers/9
https://forum.cycling.test/t/12 http://www.city.test/fr/council https://shop.books.test/novels http://maps.test/de/berlin
https://blog.mother.test/en/5 http://thermal.test/en/88 https://www.station.test/trains http://nation.test/en/history
https://another.test/en/7 http://m.others.test/de/3 https://ring.test/en/2 http://gathering.test/fr/6
""".split()


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label): 1 for URLs to block. Bounded by the two lists above."""
    rows = ", ".join(f"('{url}', {label}.0D)" for label, urls in ((1, BLOCKED), (0, ALLOWED)) for url in urls)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(url, label)")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case and path; both empty for a null url and one without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return a_z(host), path


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null. Of equal length, the first listed."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, rule_verdict in sorted(rules, key=lambda r: -len(r[0] + r[1]))[::-1]:
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        found = F.when(fits, F.lit(rule_host + rule_path)).otherwise(found)
        verdict = F.when(fits, F.lit(rule_verdict)).otherwise(verdict)
    return found, verdict


def gram_buckets(host: Column, path: Column) -> Column:
    """Hash bucket of each n-gram of ``^host$`` and ``^path$``; those of host and path never mix. All digits count as 0."""

    def grams(text: Column, part: int, n: int) -> Column:
        count = F.length(text) - (n - 1)
        places = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.pmod(F.xxhash64(F.lit(part), F.substring(text, i, n)), F.lit(BUCKETS)).cast("int"))

    parts = [(F.concat(F.lit("^"), F.translate(x, "123456789", "0" * 9), F.lit("$")), k) for k, x in enumerate((host, path))]
    return F.concat(*[grams(text, k, n) for text, k in parts for n in LENGTHS])


def fit(labelled: DataFrame) -> tuple[float, list[float]]:
    """Bias and one weight per bucket, from (url, label)."""
    rows = labelled.filter("url is not null and label is not null")
    buckets = gram_buckets(*host_and_path(rows["url"]))
    # divided by the root of their number, so that long URLs do not weigh more
    counts = F.aggregate(F.col("b"), F.array_repeat(F.lit(0.0), BUCKETS), lambda sums, b: F.transform(sums, lambda x, i: F.when(i == b, x + 1.0).otherwise(x)))
    vectors = rows.select("label", buckets.alias("b")).select("label", array_to_vector(F.transform(counts, lambda x: x / F.sqrt(F.size("b").cast("double")))).alias("features"))
    model = LogisticRegression(regParam=PENALTY, maxIter=100, standardization=False).fit(vectors)
    return float(model.intercept), [float(w) for w in model.coefficients]


def blocking_probability(host: Column, path: Column, bias: float, weights: Sequence[float]) -> Column:
    table = F.array(*[F.lit(w) for w in weights])
    buckets = gram_buckets(host, path)
    total = F.aggregate(buckets, F.lit(0.0), lambda sums, b: sums + F.get(table, b))
    return 1 / (1 + F.exp(-(bias + F.coalesce(F.try_divide(total, F.sqrt(F.size(buckets).cast("double"))), F.lit(0.0)))))


def judge(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, least: float = 0.5) -> DataFrame:
    """One row per page: page_id, url, host, path, rule, verdict and the model's probability to block.

    A rule decides where one fits; else a URL is blocked from a probability of ``least`` on. Null urls
    and urls without host are judged by the model like any other, on what little they have. Rows that
    repeat are judged each; an empty table gives no rows.
    """
    bias, weights = fit(labelled)
    host, path = host_and_path(pages["url"])
    parsed = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    judged = parsed.select("*", rule.alias("rule"), verdict.alias("ruled"), blocking_probability(F.col("host"), F.col("path"), bias, weights).alias("probability"))
    by_model = F.when(F.col("probability") >= least, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "url", "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "probability")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(read(spark, sf_dir, "pages"), labelled_urls(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("probability", 6).alias("probability"))
