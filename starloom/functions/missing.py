"""Missing values: NULL, plus NaN on floating columns (NaN is not NULL in Spark)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_missing(name: str, dtype: T.DataType) -> Column:
    c = F.col(name)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()
