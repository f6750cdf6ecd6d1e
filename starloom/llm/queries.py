"""The registered queries of this package: thin digests of the operators' outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, jaccard, lm_score, mixing, orchard, packing, pii, quality_lines, resample, sharding, simhash,
               substring, token_files)
from .oracle import ORACLE_SQL  # noqa: F401 - __spark_entry__ takes both from here


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_substring(spark: SparkSession, d: str) -> DataFrame:
    left = substring.remove_repeats(_table(spark, d, "documents"), window=20)
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_pack(spark: SparkSession, d: str) -> DataFrame:
    packed = packing.pack_documents(_table(spark, d, "documents"), length=2048, end_id=0)
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "sequence_id", "offset")


def op3_token_files(spark: SparkSession, d: str) -> DataFrame:
    files = token_files.write_token_files(_table(spark, d, "documents"), end_id=2)
    return files.read().select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, d, "documents"), shingle=5, percent=80).select(
        "doc_id", "n_shingles", "component_id")


def op5_lm_score(spark: SparkSession, d: str) -> DataFrame:
    return lm_score.score_documents(_table(spark, d, "documents"))


def op6_nearest(spark: SparkSession, d: str) -> DataFrame:
    return ann.nearest(_table(spark, d, "embeddings"), top=20, every=20)


def _of_kind(spans: str, kind: int) -> Column:
    """Spans of the kind. (``F.filter`` hands a function of two parameters, a default
    one included, the place in the list too: this one takes one.)"""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op7_pii(spark: SparkSession, d: str) -> DataFrame:
    found = pii.find_pii(_table(spark, d, "documents"))
    of_kind = [_of_kind("base", k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return found.select("doc_id", *of_kind, F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"),
                        pii.span_text(F.col("spans")).alias("spans"))


def op8_mix(spark: SparkSession, d: str) -> DataFrame:
    mix = mixing.mix_sources(_table(spark, d, "documents"))
    return mix.select("doc_id", "size", "source_size", "target",
                      (F.col("size") * F.col("copies")).alias("taken"))


def op9_quality(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents").select("doc_id", "text")
    return quality_lines.clean_lines(docs).select("doc_id", *[f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op10_shard(spark: SparkSession, d: str) -> DataFrame:
    return sharding.shard_rows(_table(spark, d, "documents"), shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op11_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_fingerprints(_table(spark, d, "documents"), shingle=3, distance=3, seed=42)


def op12_resample(spark: SparkSession, d: str) -> DataFrame:
    return resample.resample(_table(spark, d, "documents"), _table(spark, d, "benchmark"), percent=25,
                             least_words=20, buckets=10_000, seed=7)


def op13_cluster(spark: SparkSession, d: str) -> DataFrame:
    return orchard.cluster(_table(spark, d, "embeddings"), k=16, rounds=3, dim=64, scale=64, seed=1)


def pipeline(spark: SparkSession, d: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, d)


QUERIES = {"op1_substring": op1_substring, "op2_pack": op2_pack, "op3_token_files": op3_token_files, "op4_near_duplicates": op4_near_duplicates,
           "op5_lm_score": op5_lm_score, "op6_nearest": op6_nearest, "op7_pii": op7_pii, "op8_mix": op8_mix,
           "op9_quality": op9_quality, "op10_shard": op10_shard, "op11_simhash": op11_simhash,
           "op12_resample": op12_resample, "op13_cluster": op13_cluster, "pipeline": pipeline}
