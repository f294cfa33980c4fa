"""Splitting and class balance (K1, K4), for any number of classes.

The stratified split is exact in size and reproducible without sorting a
class into one partition: each row gets a 52-bit hash of (id, seed), and the
rows of a class with the smallest hashes go to the test side. The threshold
of every class is found at once: a histogram of hash prefixes by class gives
the cell that holds it, a second one inside these cells a finer cell, and
only the few rows left there (one in 2**26) are ranked by (hash, id).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlens.session import scratch_path

HASH_BITS = 52  # exactly representable as a double
CELL_BITS = 13


def split_hash(id_col: str, seed: int) -> Column:
    return F.xxhash64(F.col(id_col), F.lit(seed)).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """A table of classes in the shared scratch folder: computed once, and of a known size, by which the planner
    broadcasts it or not."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """(y, n): rows of each class, NULL being one."""
    return df.groupBy(F.col(label).alias("y")).agg(F.count(F.lit(1)).alias("n"))


def test_allocation(counts: DataFrame, test_size: float) -> DataFrame:
    """(y, n_test): total test size ``ceil(test_size·n)``; the train side
    takes floor(n_train·share) per class and the leftover rows go to the
    classes with the largest remainders (smaller label first on ties)."""
    n = counts.agg(F.sum("n")).first()[0] or 0
    n_train = n - int(math.ceil(test_size * n))
    whole = f"(CAST({n_train} AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(19, 0)))"
    shares = counts.select("y", "n", F.expr(f"{whole} div {max(n, 1)}").alias("train"), F.expr(f"{whole} % {max(n, 1)}").alias("rest"))
    left = n_train - (shares.agg(F.sum("train")).first()[0] or 0)
    lucky = shares.orderBy(F.desc("rest"), F.asc_nulls_last("y")).limit(int(left)).select(F.col("y").alias("z"), F.lit(1).alias("extra"))
    return shares.join(lucky, F.col("y").eqNullSafe(F.col("z")), "left").select(
        "y", (F.col("n") - F.col("train") - F.coalesce("extra", F.lit(0))).alias("n_test"))


def _holding_cell(cells: DataFrame) -> DataFrame:
    """Of (y, need, cell, n) rows the cell of each class in which the running count reaches ``need``; need counts on from there."""
    order = Window.partitionBy("y").orderBy("cell")  # at most 2**CELL_BITS rows a class
    run = cells.withColumn("upto", F.sum("n").over(order))
    return run.where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need"))).select(
        F.col("y").alias("z"), F.col("cell").alias("at"), (F.col("need") - F.col("upto") + F.col("n")).alias("need"))


def stratified_split(df: DataFrame, label: str = "TARGET", id_col: str = "ID", test_size: float = 0.2,
                     seed: int = 42, split_col: str = "split") -> DataFrame:
    """K1: add ``split`` = 'train' / 'test' with exact per-class test sizes.

    Rows that repeat an id share its side; a NULL label is a class of its own."""
    rows = df.select(F.col(label).alias("y"), F.col(id_col).alias("id"), split_hash(id_col, seed).alias("h"))
    need = _stored(test_allocation(_stored(class_counts(df, label), "class-counts"), test_size).where("n_test > 0"), "test-sizes")
    need = need.select(F.col("y").alias("z"), F.col("n_test").alias("need"))
    same, cells = F.col("y").eqNullSafe(F.col("z")), rows
    for level in (1, 2):
        cell = F.shiftright("h", HASH_BITS - level * CELL_BITS)
        counts = cells.groupBy("y", cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
        need = _stored(_holding_cell(counts.join(need, same).select("y", "need", "cell", "n")), "split-cells")
        cells = rows.join(need, same & (cell == F.col("at"))).select("y", "id", "h", "need")
        need = need.drop("at")
        if level == 1:
            cells = cells.drop("need")
    place = Window.partitionBy("y").orderBy("h", "id")  # the rows of one cell of 2**26
    last = cells.withColumn("place", F.row_number().over(place)).where("place = need")
    last = _stored(last.select(F.col("y").alias("__y"), F.struct("h", "id").alias("__last")), "split-thresholds")
    out = df.join(last, F.col(label).eqNullSafe(F.col("__y")), "left")
    mine = F.struct(split_hash(id_col, seed).alias("h"), F.col(id_col).alias("id"))
    test = F.coalesce(mine <= F.col("__last"), F.lit(False))
    return out.withColumn(split_col, F.when(test, F.lit("test")).otherwise(F.lit("train"))).drop("__y", "__last")


def train_test(df: DataFrame, split_col: str = "split") -> tuple[DataFrame, DataFrame]:
    return (df.where(F.col(split_col) == "train").drop(split_col),
            df.where(F.col(split_col) == "test").drop(split_col))


def class_weights(df: DataFrame, label: str = "TARGET") -> DataFrame:
    """K4: (y, weight) with the balanced weight n / (classes · n_c) of each class."""
    counts = class_counts(df, label)
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("classes")).first()
    return counts.select("y", (F.lit(float(total["n"] or 0)) / (F.lit(float(total["classes"])) * F.col("n"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str = "TARGET", weight_col: str = "weight") -> DataFrame:
    """K4 as a column: the balanced weight of each row's class, joined from the stored table of classes."""
    weights = _stored(class_weights(df, label).select(F.col("y").alias("__y"), F.col("weight").alias("__weight")), "class-weights")
    return df.join(weights, F.col(label).eqNullSafe(F.col("__y")), "left").withColumn(weight_col, F.col("__weight")).drop("__y", "__weight")
