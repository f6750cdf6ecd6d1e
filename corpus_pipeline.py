"""From raw documents to packed training sequences.

Five stages, each an operator of ``starloom.llm`` applied to all that its
predecessor kept. Every stage is written as Parquet in the shared folder and
read again, so that a lost executor costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import written
from starloom.llm.jaccard import keep_one_each
from starloom.llm.mixing import mixed
from starloom.llm.packing import pack_documents
from starloom.llm.pii import mask_pii
from starloom.llm.quality_lines import clean_lines

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without rejected documents, and without the failing lines of the others."""
    good = clean_lines(docs.select(*COLUMNS)).where("quality.kept")
    return _documents(good.withColumn("text", F.col("quality.clean_text")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one_each(docs.select(*COLUMNS), shingle=5, percent=80)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return _documents(mask_pii(docs.select(*COLUMNS)))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents repeated or left out."""
    return mixed(docs.select(*COLUMNS))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of 2048: doc_id, piece, start, length, ids,
    sequence_id, offset and ids_crc32."""
    return pack_documents(docs, length=2048, end_id=0).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("pii", pii), ("mixing", mixing),
          ("packing", packing)]

#: Near duplicates, tokens and hash thresholds can't be expressed in SQL; the
#: tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
