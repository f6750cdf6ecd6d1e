"""Single-valued attribute: the attribute if it is unique within a key, else NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def single_valued(df: DataFrame, key_cols: list[str], value_col: str, out_col: str,
                  default=None) -> DataFrame:
    """One row per key with ``out_col`` = the value when exactly one distinct
    non-NULL value exists for the key, else ``default`` (NULL).

    ``count(DISTINCT v) = 1`` is the same as ``min(v) = max(v)`` (both skip
    NULLs), and min/max are plain partial aggregates: one map-side-combined
    shuffle, no Expand, no self-join. {NULL, x} counts as single-valued x.
    """
    lo, hi = F.min(value_col), F.max(value_col)
    out = F.when(lo == hi, lo)
    if default is not None:
        out = F.coalesce(out, F.lit(default))
    return df.groupBy(*key_cols).agg(out.alias(out_col))


def distinct_count(df: DataFrame, key_cols: list[str], value_col: str, out_col: str) -> DataFrame:
    """``count(DISTINCT value)`` per key (NULLs not counted)."""
    return df.groupBy(*key_cols).agg(F.count_distinct(value_col).alias(out_col))
