"""Streaming batch scoring (A5 as a Structured Streaming query).

Every fitted stage's ``transform`` is a narrow projection or a left join with
its own fitted table (no aggregate of its input), so a saved preparation pipeline and classifier apply unchanged
to a stream: new application files landing in a folder are prepared, scored
and appended to a Parquet sink, with progress kept in a checkpoint folder on
shared storage (exactly-once file sink, restartable after failures).
``count_stream`` keeps the prediction counts of all files so far in the state store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendlens.plans.experiments import load_model, score_frame


def _scored(spark: SparkSession, model_path: str, input_dir: str, schema: T.StructType, id_col: str, fmt: str, files: int | None) -> DataFrame:
    source = spark.readStream.schema(schema).format(fmt)
    if files:
        source = source.option("maxFilesPerTrigger", files)
    return score_frame(load_model(model_path), source.load(input_dir), id_col)


def _started(writer, checkpoint_dir: str, available_now: bool):
    writer = writer.option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def score_stream(spark: SparkSession, model_path: str, input_dir: str, schema: T.StructType, output_dir: str,
                 checkpoint_dir: str, id_col: str = "ID", available_now: bool = True, fmt: str = "parquet",
                 files_per_trigger: int | None = None):
    """Start the scoring stream; returns the ``StreamingQuery``. With
    ``available_now`` it processes what is there and stops."""
    scored = _scored(spark, model_path, input_dir, schema, id_col, fmt, files_per_trigger)
    return _started(scored.writeStream.format("parquet").option("path", output_dir).outputMode("append"), checkpoint_dir, available_now)


def count_stream(spark: SparkSession, model_path: str, input_dir: str, schema: T.StructType, output_dir: str,
                 checkpoint_dir: str, id_col: str = "ID", available_now: bool = True, fmt: str = "parquet",
                 files_per_trigger: int | None = None):
    """Start the stream of prediction counts: how many rows so far got each class.

    The counts live in Spark's state store under the checkpoint, so a restart
    goes on where the stream stopped. Each batch writes all counts to a folder
    of its own; a batch that is replayed after a failure overwrites its folder."""
    scored = _scored(spark, model_path, input_dir, schema, id_col, fmt, files_per_trigger)
    counts = scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("count"))

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number).cast("long")).coalesce(1).write.mode("overwrite").parquet(f"{output_dir.rstrip('/')}/counts-{number}")

    return _started(counts.writeStream.outputMode("complete").foreachBatch(write), checkpoint_dir, available_now)


def latest_counts(spark: SparkSession, output_dir: str) -> DataFrame:
    """(prediction, count) of the last batch that ``count_stream`` wrote."""
    every = spark.read.schema("prediction int, count long, batch long").parquet(f"{output_dir.rstrip('/')}/counts-*")
    last = every.agg(F.max("batch")).first()[0]
    return every.where(F.col("batch") == F.lit(last)).select("prediction", "count")
