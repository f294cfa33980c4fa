"""URL verdicts: host rules first, gradient-boosted trees on lexical features for the rest.

The URLs that a rule fits are the labelled ones.  Suffix statistics count all
of them; the trees are fitted on a sample of at most `SAMPLE_ROWS`, the first
by a hash of the URL.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import sized_broadcast, written

#: (rule, verdict): the fixed rules of the query.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: Labelled URLs that the trees are fitted on.
SAMPLE_ROWS = 20_000
TREES, TREE_DEPTH = 20, 4
#: Labelled URLs' worth of the overall rate in each suffix statistic.
PRIOR = 20.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ("f_length", "f_host_length", "f_labels", "f_depth", "f_digits", "f_path_digits", "f_entropy", "f_params",
            "f_hyphens", "f_suffix_rate", "f_ending_rate")


def parts(url):
    """(host, path, rest) of a URL column; empty where there is no `://`."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    after = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host_raw = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    tail = F.substr(after, F.length(host_raw) + 1)
    path = F.regexp_extract(tail, r"(?s)^([^?#]*)", 1)
    return F.translate(host_raw, UPPER, LOWER), path, F.substr(tail, F.length(path) + 1)


def rule_of(host, path, rules=RULES):
    """The longest fitting rule's (text, verdict), both null if none fits: its host or a subdomain, and its path's start."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        rule_host, slash, rule_path = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rule_path)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def _entropy(text):
    """Shannon entropy of the characters in nats: sorted characters fall into runs, whose lengths are the counts."""
    ordered = F.array_join(F.sort_array(F.split(text, "")), "")
    runs = F.transform(F.regexp_extract_all(ordered, F.lit(r"(?s)(.)\1*"), F.lit(0)), lambda r: F.length(r).cast("double"))
    total = F.length(text).cast("double")
    return F.when(total > 0, F.log(total) - F.aggregate(runs, F.lit(0.0), lambda s, c: s + c * F.log(c)) / total).otherwise(0.0)


def _count(text, pattern):
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def lexical(pages: DataFrame, url_col: str, rules) -> DataFrame:
    url = F.coalesce(F.col(url_col), F.lit(""))
    host, path, rest = parts(F.col(url_col))
    d = pages.withColumn("__host", host).withColumn("__path", path).withColumn("__rest", rest)
    name, verdict = rule_of(F.col("__host"), F.col("__path"), rules)
    size = F.greatest(F.length(url), F.lit(1)).cast("double")
    return d.withColumns({
        "__rule": name, "__said": verdict,
        "__suffix": F.substring_index("__host", ".", -1),
        "__ending": F.regexp_extract("__path", r"(\.[A-Za-z0-9]{1,8}|/)$", 1),
        "f_length": F.length(url).cast("double"),
        "f_host_length": F.length("__host").cast("double"),
        "f_labels": _count(F.col("__host"), r"\."),
        "f_depth": _count(F.col("__path"), "/[^/]"),
        "f_digits": _count(url, "[0-9]") / size,
        "f_path_digits": _count(F.col("__path"), "[0-9]"),
        "f_entropy": _entropy(url),
        "f_params": _count(F.col("__rest"), "[?&][^&#]"),
        "f_hyphens": _count(F.col("__host"), "-"),
    })


def _rates(known: DataFrame, key: str, feature: str, rate: float) -> DataFrame:
    blocked = F.sum((F.col("__said") == "block").cast("long"))
    return sized_broadcast(written(known.groupBy(key).agg(
        ((blocked + PRIOR * rate) / (F.count("*") + PRIOR)).alias(feature)), "suffixes"))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """(id, host, path, rule, verdict, block_score) of each row of `pages`.

    verdict is the rule's, else block where the trees give block_score >= 0.5.
    A null URL, or one without `://`, has an empty host and path and is left
    to the trees.  If the labelled URLs have one verdict only, the rest get
    that; without any, allow.  Rows that repeat an id or a URL are judged
    alike; an empty table gives an empty result.
    """
    narrow = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("u"))
    found = written(lexical(narrow, "u", rules), "urls")
    known = found.where("__rule IS NOT NULL")
    classes = {r["__said"]: r["count"] for r in known.groupBy("__said").count().collect()}
    columns = [F.col("id").alias(id_col), F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule").alias("rule")]
    if len(classes) < 2:
        other = next(iter(classes), "allow")
        return found.select(*columns, F.coalesce("__said", F.lit(other)).alias("verdict"),
                            F.lit(float(other == "block")).alias("block_score"))
    rate = classes["block"] / sum(classes.values())
    for key, feature in (("__suffix", "f_suffix_rate"), ("__ending", "f_ending_rate")):
        found = found.join(_rates(known, key, feature, rate), key, "left").fillna(rate, [feature])
    wide = VectorAssembler(inputCols=list(FEATURES), outputCol="__v").transform(found)
    sample = written(wide.where("__rule IS NOT NULL").orderBy(F.xxhash64("u"), "id").limit(SAMPLE_ROWS)
                     .select("__v", (F.col("__said") == "block").cast("double").alias("__label")), "sample")
    trees = GBTClassifier(featuresCol="__v", labelCol="__label", maxIter=TREES, maxDepth=TREE_DEPTH, stepSize=0.2,
                          seed=7).fit(sample)
    scored = trees.transform(wide).withColumn("block_score", vector_to_array("probability")[1])
    guess = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return scored.select(*columns, F.coalesce("__said", guess).alias("verdict"), "block_score")
