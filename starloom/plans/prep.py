"""Cleaning of the raw extract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import ORDER_DATE_FORMAT, parse_date
from ..functions.missing import is_missing


def require_columns(df: DataFrame, cols: list[str]) -> None:
    """Raise ``ValueError`` naming every required column that is absent."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"required column(s) not found in the input data: {missing}")


def lower_columns(df: DataFrame) -> DataFrame:
    """All column names lower-cased in one projection."""
    return df.toDF(*[c.lower() for c in df.columns])


NUMERIC_COLUMNS = ["order_number", "cost", "sales", "quantity", "total_cost", "total_sales"]


def _typed(df: DataFrame, date_col: str, date_format: str, strict_dates: bool) -> DataFrame:
    """Numbers as doubles and the order date as a date, whatever the source
    typed them as: text from a crawled catalog table is converted with
    ``try_cast`` (junk -> NULL), a real date or timestamp is kept."""
    cols = {}
    for c in NUMERIC_COLUMNS:
        if c in df.columns and isinstance(df.schema[c].dataType, T.StringType):
            cols[c] = F.col(c).try_cast("double")
    dtype = df.schema[date_col].dataType
    if isinstance(dtype, T.StringType):
        cols[date_col] = parse_date(F.col(date_col), date_format, strict_dates)
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        cols[date_col] = F.col(date_col).cast("date")
    return df.withColumns(cols) if cols else df


def preprocess(raw: DataFrame, *, key: str = "order_number", date_col: str = "order_date",
               date_format: str = ORDER_DATE_FORMAT, strict_dates: bool = False) -> DataFrame:
    """Lower-case the names, drop rows without an order number (NULL or NaN),
    parse the order date (impossible or junk dates -> NULL unless strict).
    Narrow transformations only: no shuffle, filter pushed into the scan."""
    df = lower_columns(raw)
    require_columns(df, [key, date_col])
    df = _typed(df, date_col, date_format, strict_dates)
    return df.filter(~is_missing(key, df.schema[key].dataType))


def preprocess_counts(raw: DataFrame, key: str = "order_number") -> DataFrame:
    """Rows before and after cleaning, both from one scan."""
    df = lower_columns(raw)
    require_columns(df, [key])
    keep = ~is_missing(key, df.schema[key].dataType)
    return df.agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(keep).alias("clean_rows"))
