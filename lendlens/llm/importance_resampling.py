"""Importance resampling towards a target distribution, on hashed word n-grams.

A `tokenizers` pre-tokeniser (an untrained Regex Split) finds the words of the
ASCII-lowered text with their offsets; windows of 1 to `WIDTH` offset pairs are
the features.  A feature's bucket is the CRC-32 of its words joined by one
space, which chains from a window to the next longer one, so no joined text is
built.  Each row's buckets are written once as a packed array; corpus and
target histograms are sums over those arrays, a bucket's gain compares the two,
and a row's weight sums the gains of its features.  Adding hashed Gumbel noise
and taking the highest scores draws rows without replacement in proportion to
their weights; reruns agree.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from lendlens.llm.common import small_batches, written

#: Fixed value: the words, runs of ASCII letters and digits and of all other characters from U+0080 on.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WIDTH = 3
BUCKETS = 10_000
SEED = 42
SHARE = (5, 100)
MIN_WORDS = 20
#: Bytes of a text that are split at a time.
CHUNK_BYTES = 1 << 20
ADDED = ("n_words", "n_features", "weight", "score", "rank")
#: The bytes that are no part of a word.
_BETWEEN = bytes(b for b in range(128) if not chr(b).isalnum())
_SPACED = bytes.maketrans(_BETWEEN, b" " * len(_BETWEEN))


def splitter() -> pre_tokenizers.PreTokenizer:
    return pre_tokenizers.Split(Regex(WORD_PATTERN), behavior="removed", invert=True)


def _chunks(text: bytes) -> Iterator[bytes]:
    """The text in parts of about CHUNK_BYTES, cut at bytes that are no part of a word."""
    at = 0
    while len(text) - at > CHUNK_BYTES:
        # A place between words, looked for in steps so that a long word is copied once.
        cut, step = -1, at + CHUNK_BYTES
        while cut < 0 and step < len(text):
            cut = text[step:step + CHUNK_BYTES].translate(_SPACED).find(b" ")
            cut, step = (step + cut, step) if cut >= 0 else (-1, step + CHUNK_BYTES)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


def features(text: str, split: pre_tokenizers.PreTokenizer, width: int = WIDTH) -> tuple[int, np.ndarray]:
    """(number of words, CRC-32 of every run of 1 to `width` consecutive words)."""
    n_words, held, out = 0, [], []
    for chunk in _chunks(text.encode().lower()):  # bytes.lower changes A-Z only
        lowered = chunk.decode()
        words = [lowered[a:b].encode() for _, (a, b) in split.pre_tokenize_str(lowered)]
        n_words += len(words)
        # The last words of the part before open windows that end in this one.
        before, words = len(held), held + words
        spaced = [b" " + w for w in words]
        hashes = list(map(zlib.crc32, words))
        out.append(np.array(hashes[before:], dtype=np.uint32))
        for k in range(1, width):
            hashes = list(map(zlib.crc32, spaced[k:], hashes))
            out.append(np.array(hashes[max(before - k, 0):], dtype=np.uint32))
        held = words[-(width - 1):] if width > 1 else []
    return n_words, np.concatenate(out)


def bucket_rows(docs: DataFrame, text_col: str = "text", width: int = WIDTH, buckets: int = BUCKETS) -> DataFrame:
    """All columns but the text, plus n_words, n_features and buckets (packed little-endian uint32 or uint16)."""
    small_batches(docs.sparkSession)
    names = [c for c in docs.columns if c not in (text_col, "n_words", "n_features", "buckets")]
    narrow = docs.select(*names, F.col(text_col).alias("__text"))
    kind = "<u2" if buckets <= 1 << 16 else "<u4"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])

    def run(batches):
        split = splitter()
        for batch in batches:
            found = [features(t, split, width) if t else (0, np.zeros(0, np.uint32))
                     for t in (x.as_py() for x in batch.column(len(names)))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([n for n, _ in found], pa.int64()),
                 pa.array([len(h) for _, h in found], pa.int64()),
                 pa.array([(h % np.uint32(buckets)).astype(kind).tobytes() for _, h in found], pa.binary())],
                [*names, "n_words", "n_features", "buckets"])

    return narrow.mapInArrow(run, ", ".join(filter(None, [fields, "n_words long, n_features long, buckets binary"])))


def histogram(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of each bucket; every task sums its rows before the shuffle."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for packed in batch.column(0):
                total += np.bincount(np.frombuffer(packed.as_py(), dtype=kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    return rows.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain): floor of 1000 times the log of the target's smoothed share over the corpus's, for every bucket."""
    spark = corpus.sparkSession
    both = (spark.range(buckets).withColumnRenamed("id", "bucket")
            .join(corpus.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
            .select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t")))
    totals = both.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    ratio = (F.col("t") + 1.0) * F.lit(float(totals["s"] + buckets)) / ((F.col("s") + 1.0) * F.lit(float(totals["t"] + buckets)))
    return both.select("bucket", F.floor(1000 * F.ln(ratio)).cast("long").alias("gain"))


def noise(id_col: str, seed: int = SEED):
    """Gumbel noise of an id, in thousandths: the same in every run; a null id counts as the empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def score(rows: DataFrame, gains: DataFrame, id_col: str = "doc_id", buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """`rows` of bucket_rows with weight (the sum of their features' gains) and score in place of the buckets."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"
    table = np.zeros(buckets, dtype=np.int64)
    for r in gains.collect():  # as many rows as buckets, a parameter
        table[r["bucket"]] = r["gain"]
    shared = rows.sparkSession.sparkContext.broadcast(table)
    names = [c for c in rows.columns if c != "buckets"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "buckets")

    def run(batches):
        for batch in batches:
            weight = [int(shared.value[np.frombuffer(p.as_py(), dtype=kind)].sum()) for p in batch.column(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(weight, pa.int64())], [*names, "weight"])

    out = rows.select(*names, "buckets").mapInArrow(run, f"{fields}, weight long")
    return out.withColumn("score", F.col("weight") + noise(id_col, seed))


def ranked(rows: DataFrame, id_col: str = "doc_id", share: tuple[int, int] = SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """Adds rank (1, 2, ... of the drawn rows, else null): the highest scores among rows of at least `min_words` words.

    Draws floor(share[0] * N / share[1]) of the N rows long enough; ties go to the smaller id, null ids last.
    Rows are range-partitioned in that order and written with their partition's number; the counts of the
    partitions before give each partition's first rank, so no task sees more than its range.
    """
    long_enough = F.col("n_words") >= min_words
    names = rows.columns
    # A number of its own for every row, fixed once written, splits rows that are equal in all else.
    numbered = written(rows.withColumn("__row", F.monotonically_increasing_id()), "scored")
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_last(), F.col("__row")]
    dealt = written(numbered.where(long_enough).select(id_col, "score", "__row").repartitionByRange(*order)
                    .withColumn("__part", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("__part").count().orderBy("__part").collect()  # a row a partition
    drawn, first, starts = share[0] * sum(r["count"] for r in counts) // share[1], 0, []
    for r in counts:
        if first < drawn:
            starts.append((r["__part"], first))
        first += r["count"]
    starts = rows.sparkSession.createDataFrame(starts, "__part int, __first long")
    place = Window.partitionBy("__part").orderBy(*order)
    ranks = (dealt.join(F.broadcast(starts), "__part").withColumn("rank", F.row_number().over(place) + F.col("__first"))
             .where(F.col("rank") <= drawn).select("__row", "rank"))
    return numbered.join(ranks, "__row", "left").select(*names, "rank")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
             buckets: int = BUCKETS, seed: int = SEED, share: tuple[int, int] = SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of `docs` but the text, plus n_words, n_features, weight, score and rank (null: not drawn).

    `target` needs the text column only.  Null and empty texts have no features and weight 0; texts are
    split whole, a very long one in parts whose windows run on.  Rows that repeat an id share their noise
    and are ranked each for itself; a null id draws the noise of the empty text and loses ties.  An empty
    table gives an empty result, an empty target makes frequent features light.  Columns of `docs` that
    are named like the new ones are replaced.
    """
    docs = docs.drop(*({*ADDED, "buckets"} - {id_col, text_col}))
    rows = written(bucket_rows(docs, text_col, width, buckets), "buckets")
    wanted = bucket_rows(target.select(text_col), text_col, width, buckets)
    gains = bucket_gains(histogram(rows, buckets), histogram(wanted, buckets), buckets)
    return ranked(score(rows, gains, id_col, buckets, seed), id_col, share, min_words)
