"""Order measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def profit(total_sales: Column, total_cost: Column) -> Column:
    return total_sales - total_cost


def profit_margin(total_sales: Column, total_cost: Column, mode: str = "guarded") -> Column:
    """(sales - cost) / sales.

    ``guarded``: 0 unless sales > 0 (zero, negative or NULL sales give 0).
    ``unguarded``: plain division; a zero divisor gives NULL instead of inf/NaN.
    """
    if mode == "guarded":
        return F.when(total_sales > 0, (total_sales - total_cost) / total_sales).otherwise(F.lit(0.0))
    if mode == "unguarded":
        return F.try_divide(total_sales - total_cost, total_sales)
    raise ValueError(f"unknown margin mode {mode!r}")
