"""Sources and sinks (A1, A2) and access to the supplied test tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendlens.sources.fixtures import APPLICATIONS_SQL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

#: Rows of a table that one task of ``spread`` gets, about.
ROWS_PER_TASK = 500_000

# Tables the applications view reads.
_APP_INPUTS = ("orders", "customer", "nation")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied Parquet table; Spark prunes columns and pushes filters."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names=_APP_INPUTS) -> None:
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def spread(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The rows dealt over all task slots, in tasks of at most about ``rows_per_task``."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(slots, math.ceil(df.count() / rows_per_task)))


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``applications`` view over ``orders ⋈ customer ⋈ nation``.

    Registers the three inputs as temp views, builds the view with Spark SQL
    and registers it as ``applications`` too. ``nation`` is tiny and
    broadcast by the planner; ``orders ⋈ customer`` is a keyed shuffle join
    that AQE can re-plan. A file of one row group is read by one task, so the
    narrow orders rows are dealt out before the join and the wide derivation.
    """
    register_tables(spark, sf_dir)
    spread(table(spark, sf_dir, "orders")).createOrReplaceTempView("orders")
    df = spark.sql(APPLICATIONS_SQL)
    df.createOrReplaceTempView("applications")
    return df


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column (done once, at the source).

    Spark aggregates skip NULL but not NaN, and NaN sorts above every value.
    """
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def read_applications(spark: SparkSession, path: str, schema: T.StructType | None = None,
                      fmt: str | None = None) -> DataFrame:
    """A1: read an application table (CSV with header, or Parquet).

    CSV blanks become NULL; an explicit ``schema`` avoids an inference pass
    (inference reads the whole file once more). NaN is normalised to NULL.
    """
    fmt = fmt or ("csv" if path.lower().endswith(".csv") else "parquet")
    if fmt == "csv":
        reader = spark.read.option("header", "true").option("nullValue", "")
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
        df = reader.csv(path)
    else:
        df = spark.read.schema(schema).parquet(path) if schema is not None else spark.read.parquet(path)
    return nan_to_null(df)


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> str:
    """A2: write a (result) table as CSV with header or as Parquet."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.parquet(path)
    return path
