"""URL filters: gradient-boosted trees on lexical features of URLs.

Features are lengths, depths, the share of digits, the entropy of characters, counts of
parameters and marks, and statistics of suffixes: how often the labelled URLs with the same
last host label, last two host labels or first path segment are blocked (shrunk towards the
overall share) and how many there are.  All are DataFrame expressions.  The trees are Spark
ML's, trained on at most ``TRAIN_ROWS`` labelled URLs.

List rules come first: a rule has a host, a path and a verdict, fits the host and all its
subdomains if the URL's path starts with the rule's, and the longest fitting rule decides.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written

#: Bound on the labelled URLs that trees are trained on, taken in order of the URL's hash.
TRAIN_ROWS = 50_000
TREES = 10
DEPTH = 4
SEED = 10
#: Weight, in URLs, of the overall share in a suffix's share.
SHRINK = 20.0

#: Verdict, host and path of the rules.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/")]

SUFFIXES = ("last_label", "last_labels", "first_segment")


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty if null or without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, pattern, 1), upper, lower), F.regexp_extract(url, pattern, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (like ``net/``) and its verdict; null if none fits.  Of equally
    long ones the first given."""
    name = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _count(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("double")


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """The features that need the URL alone."""
    url = F.coalesce(url, F.lit(""))
    length = F.length(url)
    chars = F.array_distinct(F.split(url, ""))
    share = lambda c: (length - F.length(F.replace(url, c, F.lit("")))) / length
    entropy = F.aggregate(chars, F.lit(0.0), lambda acc, c: acc - F.when(c == "", 0.0).otherwise(share(c) * F.log2(share(c))))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return {
        "url_length": length.cast("double"), "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"), "query_length": F.length(query).cast("double"),
        "host_depth": F.size(F.split(host, r"\.")).cast("double"), "path_depth": _count(path, "/"),
        "digit_share": F.when(length > 0, _count(url, "[0-9]") / length).otherwise(0.0),
        "entropy": F.when(length > 0, entropy).otherwise(0.0), "parameters": _count(query, "="),
        "hyphens": _count(url, "-"), "path_dots": _count(path, r"\."), "path_digits": _count(path, "[0-9]"),
        "has_fragment": url.contains("#").cast("double"), "secure": url.startswith("https").cast("double"),
        "trailing_slash": path.endswith("/").cast("double")}


def _suffixes(host: Column, path: Column) -> dict[str, Column]:
    return {"last_label": F.substring_index(host, ".", -1), "last_labels": F.substring_index(host, ".", -2),
            "first_segment": F.substring_index(F.substring(path, 2, 2_000_000_000), "/", 1)}


def judge(pages: DataFrame, labelled: Column, url: str = "url", id: str = "page_id", rules=RULES,
          rows: int = TRAIN_ROWS) -> DataFrame:
    """Per row: the id, ``host``, ``path``, ``rule`` and ``verdict`` (allow or block), and
    ``block_probability`` by the trees.

    ``labelled`` is a column over ``id``, ``url``, ``host``, ``path`` and ``rule_verdict``: block,
    allow or null.  Labelled URLs train the trees; a rule's verdict holds, and the trees judge the rest.
    With labels of one kind only, that kind is the verdict; without any, allow.  Null URLs and
    URLs without ``://`` have empty host and path and are judged like others.  Repeated rows and
    ids stay; other columns are ignored; an empty table gives no rows."""
    host, path = parts(F.col("url"))
    base = pages.select(F.col(id).alias("id"), F.col(url).alias("url"))
    base = base.withColumn("host", host).withColumn("path", path)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    base = base.withColumn("rule", rule).withColumn("rule_verdict", verdict).withColumn("label", labelled) \
        .withColumns(_suffixes(F.col("host"), F.col("path")))
    known = base.filter("label IS NOT NULL")
    total = known.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("label") == "block").cast("double")).alias("share")).first()
    lexical = lexical_features(F.col("url"), F.col("host"), F.col("path"))
    names = list(lexical)
    rich = base.withColumns(lexical)
    overall = 0.0 if total.share is None else total.share
    for s in SUFFIXES:
        stats = written(known.groupBy(F.col(s).alias(f"{s}_key")).agg(
            F.count(F.lit(1)).alias("n"), F.sum((F.col("label") == "block").cast("double")).alias("b")).select(
            f"{s}_key", ((F.col("b") + SHRINK * overall) / (F.col("n") + SHRINK)).alias(f"{s}_share"),
            F.log1p("n").alias(f"{s}_count")), "url-suffixes")
        rich = rich.join(stats, F.col(s) == F.col(f"{s}_key"), "left").drop(f"{s}_key") \
            .fillna({f"{s}_share": overall, f"{s}_count": 0.0})
        names += [f"{s}_share", f"{s}_count"]
    result = ["id", "host", "path", "rule", "rule_verdict"]
    rich = written(rich.select(*result, "label", F.xxhash64("url").alias("order"), *names), "url-features")
    if total.n == 0 or overall in (0.0, 1.0):
        probability = F.lit(overall)
        judged = rich.select(*result, probability.alias("block_probability"))
    else:
        ready = VectorAssembler(inputCols=names, outputCol="features")
        sample = rich.filter("label IS NOT NULL").orderBy("order").limit(rows)
        train = written(ready.transform(sample).select("features", (F.col("label") == "block").cast("double").alias("y")), "url-sample")
        trees = GBTClassifier(labelCol="y", maxIter=TREES, maxDepth=DEPTH, seed=SEED, checkpointInterval=-1).fit(train)
        judged = trees.transform(ready.transform(rich)).select(
            *result, vector_to_array("probability").getItem(1).alias("block_probability"))
    verdict = F.coalesce("rule_verdict", F.when(F.col("block_probability") > 0.5, "block").otherwise("allow"))
    return judged.select(F.col("id").alias(id), "host", "path", "rule", verdict.alias("verdict"), "block_probability")
