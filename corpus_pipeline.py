"""The corpus pipeline: toxicity, near duplicates, repeated passages, benchmark leaks, source mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes
each result as Parquet into the shared scratch folder and hands the re-read
table to the next stage.  All stages but the last return the columns of
`documents`; the last adds copies, the number of times the mix takes a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.llm import decontamination, mixing, near_dedup, substring_dedup, toxicity
from lendlens.llm.common import read, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity is predicted 0; learned from the labels of the rows at hand."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    keep = [c for c in docs.columns if c not in toxicity.ADDED]
    return toxicity.score(docs, model, keep=keep).where("predicted = 0").select(keep)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each component linked at similarity 0.80 of 5-word shingles."""
    return near_dedup.one_of_each(docs, width=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has.

    A row that loses words gets the kept ones, joined by one space, and a new
    n_chars; other rows stay as they are.  A row that loses all goes.
    """
    names = docs.columns
    cut = substring_dedup.remove_repeats(docs)
    lost = F.col("n_removed") > 0
    out = cut.where(~lost | (F.col("n_removed") < F.col("n_words"))).withColumn("text", F.when(lost, F.col("kept_text")).otherwise(F.col("text")))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(lost, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(names)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return decontamination.without_leaks(docs, read(spark, sf_dir, "benchmark")).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the mix takes, with copies."""
    return mixing.mixed(docs).select(*[c for c in docs.columns if c != "copies"], "copies")


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("repeated_passages", cut_repeats),
          ("benchmark_leaks", drop_leaks), ("mix", mix)]

#: SQL can't express the trained scores and the random rounding; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
