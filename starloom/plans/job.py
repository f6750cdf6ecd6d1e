"""The end-to-end job: read the extract, build the star, write it, report.

Row counts of the raw and the cleaned rows are collected with ``observe``
while the data flows through the other jobs, instead of two extra scans.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..contracts import STAR
from ..sinks.snapshots import publish_star, read_star
from ..sinks.writers import write_star
from ..sources.raw import CORRUPT, read_raw_csv, read_raw_table
from .prep import preprocess
from .quality import DIM_COMPLETENESS_COLUMNS, FACT_COMPLETENESS_COLUMNS, check_all, completeness
from .star import build_star


def read_source(spark: SparkSession, source: str, fmt: str = "csv", *, mode: str = "PERMISSIVE",
                multi_line: bool = False) -> DataFrame:
    """``fmt``: ``csv`` (headered extract, with its rejected records),
    ``parquet``, or ``table`` (``database.table`` in the catalog)."""
    if fmt == "csv":
        return read_raw_csv(spark, source, mode=mode, multi_line=multi_line,
                            keep_rejects=mode == "PERMISSIVE")
    if fmt == "parquet":
        return spark.read.parquet(source)
    if fmt == "table":
        db, _, table = source.rpartition(".")
        return read_raw_table(spark, db or "default", table)
    raise ValueError(f"unknown source format {fmt!r}")


def run(spark: SparkSession, source: str, target: str, *, source_format: str = "csv",
        target_format: str = "parquet", database: str | None = None,
        reports: bool = True, fact_by_year: bool = False, csv_mode: str = "PERMISSIVE",
        multi_line: bool = False, **star_options) -> dict:
    """Build and write the star; optionally write the completeness and rule
    reports next to it. Returns locations and row counts; ``rejected_rows``
    are CSV records that didn't fit the schema (their fields became NULL). Their
    texts, files and what could be read of them are kept below ``_rejects`` of
    the target."""
    raw_obs, clean_obs = Observation("raw"), Observation("clean")
    raw = read_source(spark, source, source_format, mode=csv_mode, multi_line=multi_line)
    bad = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    as_read = raw
    raw = raw.observe(raw_obs, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("rejected")).drop(CORRUPT)
    run_ts = star_options.pop("run_ts", None) or datetime.now(timezone.utc)
    star = build_star(raw, run_ts=run_ts, **star_options)
    fact = star["fact_orders"].observe(clean_obs, F.count(F.lit(1)).alias("rows"))
    if target_format == "snapshot":  # later loads go on from the products' costs
        keys = {"product_name": "product", "category": "category", "brand": "brand"}
        costs = preprocess(as_read.drop(CORRUPT)).dropna(how="any", subset=list(keys.values())).groupBy(
            *[F.col(c).alias(k) for k, c in keys.items()]).agg(F.min("cost").alias("lo"), F.max("cost").alias("hi"))
        made = publish_star(spark, {**star, "fact_orders": fact}, target, costs=costs)
        written = {n: f"{target}/{p.path}" for n in star for p in made.parts(n)}
    else:
        written = write_star({**star, "fact_orders": fact}, target, target_format, database=database,
                             fact_by_year=fact_by_year)
    result = {"written": written, "raw_rows": raw_obs.get.get("rows"),
              "rejected_rows": raw_obs.get.get("rejected"),
              "fact_rows": clean_obs.get.get("rows")}
    if result["rejected_rows"]:  # rare, so a scan of its own
        result["rejects"] = f"{target}/_rejects" if target else "_rejects"
        kept = as_read.where(F.col(CORRUPT).isNotNull()).withColumnRenamed(CORRUPT, "record")
        kept.withColumn("file", F.input_file_name()).write.mode("overwrite").parquet(result["rejects"])
    if reports:
        # reports read the written tables back: no recomputation of the star
        if target_format == "table":
            names = {n: spark.table(loc) for n, loc in written.items()}
        elif target_format == "snapshot":
            names = read_star(spark, target)
        elif target_format == "csv":
            names = {n: spark.read.option("header", True).schema(STAR[n].schema).csv(loc)
                     for n, loc in written.items()}
        else:
            names = {n: spark.read.parquet(loc) for n, loc in written.items()}
        report_root = f"{target}/_reports" if target else "_reports"
        completeness(names, DIM_COMPLETENESS_COLUMNS + FACT_COMPLETENESS_COLUMNS) \
            .write.mode("overwrite").option("header", True).csv(f"{report_root}/completeness")
        check_all(names).write.mode("overwrite").option("header", True).csv(
            f"{report_root}/checks")
        result["reports"] = report_root
    return result
