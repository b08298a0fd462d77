import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

#: Extra columns carry names that the operators use themselves.
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()), T.StructField("n_words", T.StringType()),
                     T.StructField("_g", T.StringType()), T.StructField("score", T.StringType()),
                     T.StructField("_id", T.StringType()), T.StructField("_spans", T.StringType())])


@pytest.fixture
def docs_of(spark):
    """A documents table (with clashing extra columns) of (doc_id, text[, source]) rows."""

    def make(rows, partitions=3):
        rows = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", None, "y", "z", None) for r in rows]
        return spark.createDataFrame(rows, DOCS).repartition(partitions)

    return make


@pytest.fixture
def folder(spark, tmp_path):
    """Writes tables as parquet under one folder, as the driver lays them out."""

    def make(**tables):
        for name, df in tables.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return make
