"""Seed rows shipped with the package (geography members)."""

from __future__ import annotations

import csv
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

GEO_SEED_SCHEMA = T.StructType([
    T.StructField("state_code", T.StringType(), False),
    T.StructField("country", T.StringType(), False),
    T.StructField("state_name", T.StringType(), False),
    T.StructField("capital_city", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("iso_code", T.StringType(), True),
])


def geo_rows() -> list[tuple]:
    """The 107 seed rows; an empty field is NULL."""
    text = resources.files("starloom").joinpath("seeds/geo.csv").read_text(encoding="utf-8")
    lines = [ln for ln in text.splitlines() if ln and not ln.startswith("#")]
    reader = csv.reader(lines)
    header = next(reader)
    assert header == [f.name for f in GEO_SEED_SCHEMA.fields], header
    return [tuple(v if v != "" else None for v in row) for row in reader]


def geo_seed(spark: SparkSession) -> DataFrame:
    """Literal rows -> DataFrame. The rows are a fixed, bounded list (107),
    read on the driver from the package, so no executor needs the file."""
    return spark.createDataFrame(geo_rows(), GEO_SEED_SCHEMA)
