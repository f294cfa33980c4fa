"""Quality rules of documents and of their hosts, in DataFrame functions only.

Each document is judged by its own counts; the failures are aggregated by
host, the hosts' failure rates shrink towards a beta prior fitted to all
hosts by moments (a host with few documents stays near the mean rate), and
hosts above `HOST_RATE` lose all their documents.

Repeated windows are found inside each row: three neighbouring word hashes
make a window's number, sorting the numbers brings equal ones together, and
only rows with such pairs go on to their positions.  No word is exploded, so
nothing but one narrow row per document is ever shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import BLANK, sized_broadcast, written

HOST_RATE = 0.5
MIN_WORDS = 50
REPEAT_PERCENT = 50
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"


def _pairs(items, merge):
    """merge(x, next x) of neighbouring items."""
    return F.zip_with(F.slice(items, 1, F.greatest(F.size(items) - 1, F.lit(0))),
                      F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))), merge)


def rule_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (null text counts as empty)."""
    keep = docs.columns
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(BLANKS))
    d = docs.withColumn("__words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK)))
    d = d.withColumn("__hash", F.transform("__words", lambda w: F.xxhash64(w)))
    two = _pairs(F.col("__hash"), lambda a, b: F.xxhash64(a, b))
    # A window of three words is a pair of neighbouring pairs, which share the middle word.
    d = d.withColumn("__two", two).withColumn("__three", _pairs(F.col("__two"), lambda a, b: F.xxhash64(a, b)))
    d = d.withColumn("__sorted", F.sort_array("__three"))
    d = d.withColumn("__repeats", F.exists(_pairs(F.col("__sorted"), lambda a, b: a == b), lambda x: x))
    placed = F.sort_array(F.transform("__three", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    equal = _pairs(F.col("__placed"), lambda a, b: F.when(a.h == b.h, F.array(a.i, b.i)))
    covered = F.array_distinct(F.flatten(F.transform(F.flatten(F.array_compact(equal)),
                                                     lambda i: F.array(i, i + 1, i + 2))))
    d = d.withColumn("__placed", F.when(F.col("__repeats"), placed))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.withColumn("__lines", lines)
    return d.select(*keep, F.size("__words").cast("long").alias("n_words"),
                    F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
                    F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                    (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
                    F.when(F.col("__repeats"), F.size(covered)).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"))


def host_verdicts(hosts: DataFrame, rate: float = HOST_RATE) -> DataFrame:
    """Adds shrunk_rate and host_ok to (host, docs, failed).

    The prior is the beta distribution whose mean is the failed share of all
    documents and whose variance is the hosts' (weighted by documents); where
    the hosts don't differ its weight is 10**6 documents.
    """
    total = hosts.agg(F.sum("docs").alias("n"), F.sum("failed").alias("f"),
                      F.sum(F.col("failed") * F.col("failed") / F.col("docs")).alias("ff"))
    total = total.first()
    n, mean = total["n"] or 1, (total["f"] or 0) / (total["n"] or 1)
    spread = max((total["ff"] or 0.0) / n - mean * mean, 0.0)
    weight = max(1.0, min(1e6, mean * (1 - mean) / spread - 1)) if spread > 1e-12 else 1e6
    shrunk = (F.col("failed") + F.lit(mean * weight)) / (F.col("docs") + F.lit(weight))
    return hosts.withColumn("shrunk_rate", shrunk).withColumn("host_ok", F.col("shrunk_rate") <= rate)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          rate: float = HOST_RATE) -> DataFrame:
    """(id, host, counts, base_failed, host_rate, kept) for each row of `docs`.

    Null is a host of its own; rows that repeat an id count each; a null text
    counts as empty and fails; an empty table gives an empty result.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), F.col(text_col).alias("t"))
    counts = rule_counts(narrow, "t").drop("t")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    counts = written(counts.withColumn("base_failed", failed), "rules")
    hosts = counts.groupBy("host").agg(F.count("*").alias("docs"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    verdicts = host_verdicts(hosts, rate).select(F.col("host").alias("__host"), F.col("shrunk_rate").alias("host_rate"), "host_ok")
    verdicts = sized_broadcast(written(verdicts, "hosts"))
    out = counts.join(verdicts, F.col("host").eqNullSafe(F.col("__host")))
    return out.select(F.col("id").alias(id_col), F.col("host").alias(host_col), "n_words", "word_chars", "n_symbols",
                      "n_dup_lines", "n_repeat_words", "base_failed", "host_rate",
                      (~F.col("base_failed") & F.col("host_ok")).alias("kept"))
