"""A cleaning pipeline over ``documents``: five operators, one after another.

Toxic documents go, then documents of no clear language, exact copies and near
copies (one of each group stays), and the rest is packed into windows. Each
stage reads all that the one before it kept; all but the last return the
columns of ``documents`` unchanged.

A stage is given the frame of files that the one before wrote. ``sf_dir``
holds the tables; the toxicity labels are read from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostermill.llm import exact_dedup, langid, ngram_join, packing, toxicity
from rostermill.llm.queries import TOKENIZER
from rostermill.workdir import staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of being toxic is below one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def keep_clear_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told by more than a narrow margin.

    The dictionaries come from the labelled rows of the stage's input.
    """
    return langid.keep_known(docs, langid.train(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that of the largest id."""
    return exact_dedup.keep_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles, 0.8 and above."""
    return ngram_join.keep_rows(docs, ngram_join.Join(words=5, share=4, of=5))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 4096 ids."""
    pieces = packing.pack(docs, TOKENIZER)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_clear_language),
    ("exact dedup", drop_copies),
    ("n-gram join", drop_near_copies),
    ("packing", pack),
]

#: SQL has neither the models nor the tokenizer
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written and reread.

    Texts are long, so tasks pass few of them to Python at a time.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = staged(docs, name.replace(" ", "-"))
    return docs
