"""URL filters: rules first, then logistic regression on hashed character n-grams of host and path.

Everything is built-in expressions and Spark ML: parsing, rules and n-grams run in the JVM, the
model is a vector of ``DIMS`` weights. It is fitted on a labelled table of at most ``LABELLED``
URLs (those with the smallest hashes).
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.names import quoted

DIMS = 1 << 14
SIZES = (3, 4, 5)
#: Labelled URLs that are used for fitting, at most.
LABELLED = 4000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Host, path and verdict; the longest rule that fits a URL decides.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: What ordinary and unwanted sites call themselves, and pages that they have: plain English words.
ORDINARY = (
    "library", "museum", "university", "school", "council", "hospital", "garden", "kitchen", "recipes", "history",
    "science", "physics", "biology", "music", "theatre", "gallery", "journal", "gazette", "weather", "railway",
    "football", "cycling", "hiking", "travel", "bakery", "furniture", "software", "handbook", "dictionary", "parliament",
)
ORDINARY_PAGES = ("about", "contact", "articles/2019/spring-flowers", "help/getting-started", "research/papers", "")
UNWANTED = (
    "casino", "jackpot", "roulette", "slots", "betting", "poker", "porn", "xxx", "nude", "escort",
    "viagra", "cialis", "pharmacy-discount", "pills", "weightloss", "replica-watches", "payday", "quickloan", "lottery", "prizes",
    "clickbait", "popunder", "adserver", "tracker", "doorway", "backlinks", "warez", "keygen", "torrents", "cracked",
)
UNWANTED_PAGES = ("buy-now", "free-bonus", "win/claim-your-prize", "click?offer=1", "cheap/order-online", "")
#: The default labelled table: each site on a domain of its own, with each of its pages.
LABELLED_URLS = tuple(
    (f"https://{site}.{zone}/{page}", label)
    for label, sites, pages in (("allow", ORDINARY, ORDINARY_PAGES), ("block", UNWANTED, UNWANTED_PAGES))
    for i, site in enumerate(sites)
    for zone in (("org", "net", "info", "eu", "co.uk")[i % 5],)
    for page in pages
)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one or for null."""
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; nulls where none fits.

    A rule fits its host and all subdomains if the path starts with the rule's.
    """
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name = F.when(fits, h + p).otherwise(name)
        verdict = F.when(fits, v).otherwise(verdict)
    return name, verdict


def grams(host: Column, path: Column) -> Column:
    """Marked character n-grams of host and path."""

    def of(text: Column, mark: str) -> Column:
        padded = F.concat(F.lit("^"), text, F.lit("$"))
        # A look-ahead finds all grams in one pass; substrings would start from the front each time.
        parts = [
            F.transform(
                F.when(F.length(padded) < n, F.array(padded)).otherwise(F.regexp_extract_all(padded, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))),
                lambda gram: F.concat(F.lit(mark), gram),
            )
            for n in SIZES
        ]
        return F.concat(*parts)

    return F.concat(of(host, "h"), of(path, "p"))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``LABELLED_URLS`` as a table with columns ``url`` and ``verdict``."""
    rows = ", ".join(f"('{url}', '{verdict}')" for url, verdict in LABELLED_URLS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(url, verdict)")


def fit(labelled: DataFrame, url: str = "url", verdict: str = "verdict"):
    """A logistic regression from ``LABELLED`` distinct labelled URLs at most; rows without a label are left out."""
    known = labelled.select(F.col(quoted(url)).alias("url"), F.col(quoted(verdict)).alias("verdict"))
    known = known.where("url is not null and verdict in ('allow', 'block')").dropDuplicates(["url"])
    known = known.orderBy(F.xxhash64("url"), "url").limit(LABELLED)
    seen = known.select(
        grams(host(F.col("url")), path(F.col("url"))).alias("grams"),
        (F.col("verdict") == "block").cast("double").alias("label"),
    )
    return LogisticRegression(maxIter=30, regParam=1e-2).fit(_hashed(seen).select("features", "label"))


def _hashed(df: DataFrame) -> DataFrame:
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=DIMS, binary=True).transform(df)


def judge(pages: DataFrame, labelled: DataFrame | None = None, key: str = "page_id", url: str = "url", rules=RULES) -> DataFrame:
    """Per page: key, ``host``, ``path``, ``rule`` and ``verdict`` (allow or block).

    Where a rule fits, it decides; the model fitted on ``labelled`` (columns ``url``, ``verdict``;
    ``LABELLED_URLS`` by default) decides the rest. Null URLs and those without ``://`` have empty
    parts and get the model's verdict on those. Repeated rows get the same verdict.
    """
    parts = pages.select(F.col(quoted(key)).alias("key"), F.col(quoted(url)).alias("url"))
    parts = parts.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    name, verdict = rule(F.col("host"), F.col("path"), rules)
    parts = parts.withColumns({"rule": name, "ruled": verdict})
    model = fit(labelled_urls(pages.sparkSession) if labelled is None else labelled)
    scored = model.transform(_hashed(parts.withColumn("grams", grams(F.col("host"), F.col("path")))))
    own = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    return scored.select(F.col("key").alias(key), "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"))
