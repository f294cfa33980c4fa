"""Running sums over ordered, already-aggregated rows (M1, M3).

Ranks, ROC/PR curves and the tie-aware AUC all need prefix sums over the
distinct values of a column. An unpartitioned window would pull every
distinct value into one task, so the rows are range-partitioned on the order
itself (any sortable type: numbers, text, structs) and written once with the
number of their partition: per-partition totals (one small row each) give
each partition's offset, and the prefix sum inside a partition is a window
partitioned by its number. There is one path for every size.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendlens.session import scratch_path


def running_sums(df: DataFrame, order_col: str, sum_cols: list[str], descending: bool = False,
                 max_rows: int | None = None, prefix: str = "cum_") -> DataFrame:
    """Add ``<prefix><c>`` = sum of ``c`` over rows ordered at or before the
    current one. ``order_col`` must be unique per row (aggregate first).
    ``max_rows`` aims at so many rows per range partition; the default is the
    session's number of shuffle partitions."""
    spark = df.sparkSession
    order = F.desc(order_col) if descending else F.asc(order_col)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if max_rows is not None:
        parts = max(1, math.ceil(df.count() / max_rows))
    # Written, so that every later pass sees the same partition numbers.
    placed = df.repartitionByRange(parts, order).withColumn("_bucket", F.spark_partition_id())
    path = scratch_path(spark, "ranges")
    placed.write.parquet(path)
    keyed = spark.read.schema(placed.schema).parquet(path)

    totals = keyed.groupBy("_bucket").agg(*[F.sum(c).alias(c) for c in sum_cols])
    schema = T.StructType([T.StructField("_bucket", T.IntegerType())]
                          + [T.StructField(f"_off_{c}", totals.schema[c].dataType) for c in sum_cols])
    offsets, acc = [], {c: 0 for c in sum_cols}
    for r in sorted(totals.collect(), key=lambda r: r["_bucket"]):  # one row per partition
        offsets.append((r["_bucket"], *[type(r[c])(acc[c]) if r[c] is not None else None for c in sum_cols]))
        for c in sum_cols:
            acc[c] += r[c] or 0
    off_df = spark.createDataFrame(offsets, schema)
    w = Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = keyed.join(F.broadcast(off_df), "_bucket", "left")
    out = out.withColumns({f"{prefix}{c}": F.sum(c).over(w) + F.coalesce(F.col(f"_off_{c}"), F.lit(0))
                           for c in sum_cols})
    return out.drop("_bucket", *[f"_off_{c}" for c in sum_cols])


def average_ranks(counts: DataFrame, value_col: str, count_col: str = "n", **kw) -> DataFrame:
    """Average (tie-aware) rank of each distinct value, 1-based:
    rows below + (ties + 1) / 2. ``counts`` has one row per distinct value."""
    out = running_sums(counts, value_col, [count_col], **kw)
    return out.withColumn("avg_rank", F.col(f"cum_{count_col}") - F.col(count_col)
                          + (F.col(count_col) + 1) / 2.0).drop(f"cum_{count_col}")
