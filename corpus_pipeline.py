"""The corpus pipeline: reject toxic documents, keep one of each group of near
copies, cut repeated passages, reject documents contaminated by the benchmark,
and pack what is left into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run`
writes it as Parquet under the shared checkpoint folder and reads it again as
the next one's ``docs``. All but the last return the columns they were given.

Defined results: rows with null or empty texts pass the filters, and pack as
an end id alone; rows with a null id are kept by the filters; a row present
more than once (same id and text) counts as one after the second stage; of
different texts under one id each is judged by itself, and all of them stay
unless they are near copies; an empty table gives an empty result. A model of
toxicity, the classes of near copies and the repeats are those of the
documents that the stage is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finspark.llm import decontaminate, minhash, packing, suffix, toxicity
from finspark.llm.common import read_table, stored
from finspark.llm.queries import tokenizer_path, toxicity_model

#: Shortest repeated passage that is cut. Passages of over 50 words count as
#: repeats; 51 words take 305 bytes (median; 5 % take less than 267) in the
#: English documents, more in the other languages.
REPEAT_BYTES = 256


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    score = toxicity.score_column(toxicity_model(spark, sf_dir, docs), F.col("text"))
    return docs.filter(score < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class stays: of the smallest id and, within an id, of
    the smallest hash of its text. Classes are of rows, not of ids: each row
    gets a number, stored with it so that it is the same in every later scan."""
    row = "_row"
    while row in docs.columns:
        row += "_"
    i = F.col("doc_id").cast("bigint")
    numbered = stored(docs.withColumn(row, F.when(i.isNotNull(), F.monotonically_increasing_id())), "numbered")
    found = minhash.near_duplicates(numbered, id_col=row).filter("doc_id is not null").withColumnRenamed("doc_id", "r")
    rows = numbered.filter(F.col(row).isNotNull()).select(F.col(row).alias("r"), i.alias("i"), F.xxhash64("text").alias("t"))
    # A row without shingles has no class; its repetitions share id and text.
    some = F.col("n_shingles") > 0
    first = found.join(rows, "r").groupBy(F.when(some, F.col("component_id")), F.when(~some, F.col("i")), F.when(~some, F.col("t"))).agg(
        F.min(F.struct("i", "t", "r")).alias("first")).select("first.r")
    gone = rows.select("r").join(first, "r", "left_anti").withColumnRenamed("r", row)
    return numbered.join(gone, row, "left_anti").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = suffix.without_repeats(docs, REPEAT_BYTES)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def reject_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return docs.filter(~decontaminate.contaminated_column(read_table(spark, sf_dir, "benchmark"), F.col("text")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", reject_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", reject_contaminated),
    ("best_fit_packing", pack_sequences),
]

#: The stages (a fitted model, components, a tokenizer) have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
