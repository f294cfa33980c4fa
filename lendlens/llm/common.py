"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.session import scratch_path

#: The words of all contracts, as Java/Python patterns.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"
#: Rows of an Arrow batch; with long texts this keeps a batch at a few MB.
BATCH_ROWS = "1000"
#: Rows up to which an aggregated side (sources, hosts) is broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 20_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by rows, so that Python workers hold a few MB of text at a time."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > int(BATCH_ROWS):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes `df` as Parquet into the shared scratch folder and reads it again.

    Cuts the lineage like a reliable checkpoint (a lost executor only costs a
    re-read), gives later joins true sizes, and lets each pass prune columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized_broadcast(df: DataFrame) -> DataFrame:
    """Marks an aggregated table for broadcast when its counted rows allow it."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def train_row(id_col: str = "doc_id"):
    """True for the rows labels may be learned from: crc32 of the id as text, modulo 5, is not 0.

    A null id counts as the empty text.
    """
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 != 0

