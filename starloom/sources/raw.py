"""The raw order extract: 14 columns, as exported."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The extract's column names, in file order.
RAW_COLUMNS = [
    "Order_Number", "State_Code", "Customer_Name", "Order_Date", "Status",
    "Product", "Category", "Brand", "Cost", "Sales", "Quantity",
    "Total_Cost", "Total_Sales", "Assigned Supervisor",
]

_NUMERIC = {"Order_Number", "Cost", "Sales", "Quantity", "Total_Cost", "Total_Sales"}

# Explicit schema: no inference pass over the input, floats stay floats.
RAW_SCHEMA = T.StructType([
    T.StructField(c, T.DoubleType() if c in _NUMERIC else T.StringType(), True)
    for c in RAW_COLUMNS
])


#: Holds the text of a record that doesn't fit the schema.
CORRUPT = "_corrupt_record"


def csv_schema(spark: SparkSession, path: str, *, keep_rejects: bool = False) -> T.StructType:
    """The raw schema in the order of the files' header. Names match whatever
    their case; further columns are text. Raises ``ValueError`` with all
    names that are missing."""
    header = spark.read.option("header", True).csv(path).columns
    by_name = {f.name.lower(): f for f in RAW_SCHEMA}
    missing = [c for c in RAW_COLUMNS if c.lower() not in {h.lower() for h in header}]
    if missing:
        raise ValueError(f"column(s) not in the header of {path}: {missing}")
    fields = [T.StructField(h, by_name[h.lower()].dataType if h.lower() in by_name else T.StringType())
              for h in header]
    return T.StructType(fields + ([T.StructField(CORRUPT, T.StringType())] if keep_rejects else []))


def csv_options(mode: str = "PERMISSIVE", multi_line: bool = False) -> dict[str, object]:
    """Every file's header is held against the schema, so files with another
    order of columns raise instead of being read by position."""
    return {"header": True, "mode": mode, "multiLine": multi_line, "enforceSchema": False,
            "columnNameOfCorruptRecord": CORRUPT, "quote": '"', "escape": '"'}


def raw_columns(df: DataFrame, keep_rejects: bool = False) -> DataFrame:
    """The raw columns by name, and the corrupt record if asked for."""
    return df.select(*[F.col(f"`{c}`") for c in RAW_COLUMNS], *([CORRUPT] if keep_rejects else []))


def read_raw_csv(spark: SparkSession, path: str, *, mode: str = "PERMISSIVE",
                 multi_line: bool = False, keep_rejects: bool = False) -> DataFrame:
    """Headered CSV with the explicit raw schema, columns taken by name.

    ``mode="FAILFAST"`` raises on a malformed record; the default keeps the
    row and sets unparsable fields to NULL, and ``keep_rejects`` adds the
    record's text as ``_corrupt_record`` (NULL in good rows), so that rejects
    can be counted and kept. ``multi_line`` allows line breaks in quotes.
    """
    schema = csv_schema(spark, path, keep_rejects=keep_rejects)
    return raw_columns(spark.read.options(**csv_options(mode, multi_line)).schema(schema).csv(path),
                       keep_rejects)


def read_raw_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    """A catalog table holding the extract (``database.table``)."""
    return spark.table(f"{database}.{table}")
