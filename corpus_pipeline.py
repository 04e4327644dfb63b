"""Corpus pipeline: toxicity, MinHash near-dedup, suffix-array dedup, mixing, packing.

``STAGES`` lists (name, function); every function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and reread as the next
stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civora.llm import mixing, packing, probminhash, suffixes, toxicity
from civora.llm.common import read, shared_table


#: Rows of an Arrow batch: whole documents pass through, and a batch lies in memory on both sides of the pipe.
BATCH_ROWS = 1_000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar, fitted on the labels, does not reject."""
    _small_batches(spark)
    return toxicity.reject(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    _small_batches(spark)
    return probminhash.deduplicate(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that occur more than once; n_chars follows the text."""
    _small_batches(spark)
    cut = suffixes.remove(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.sample(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences with their token ids."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("MinHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: Learned scores and suffix comparisons have no SQL form: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and reread."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
