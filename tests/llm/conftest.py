import os

import pytest
from pyspark.sql import types as T

EDGE_TEXTS = [None, "", " ", "\n\t", "one", "one two", "a  b\tc\nd", "é ß 漢字 𝒳", "x " * 3000, "y" * 40000]
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture
def make_docs(spark):
    """(id, text[, lang, source]) rows as a documents table."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0",
                 None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture
def table_dir(tmp_path):
    """Writes tables as <name>.parquet under a fresh folder and returns it."""
    def write(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(os.path.join(str(tmp_path), f"{name}.parquet"))
        return str(tmp_path)
    return write
