"""Date parsing and calendar attributes for the date dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day/month of one or two digits, four-digit year: 05/03/2024 and 5/3/2024.
ORDER_DATE_FORMAT = "d/M/yyyy"


def parse_date(text: Column | str, fmt: str = ORDER_DATE_FORMAT, strict: bool = False) -> Column:
    """Text to DATE. Lenient: impossible dates (31/02) and junk become NULL.

    ``strict=True`` raises on bad input instead (ANSI ``to_date``).
    """
    text = F.col(text) if isinstance(text, str) else text
    return F.to_date(text, fmt) if strict else F.try_to_date(text, fmt)


def weekday_number(d: Column, week_start: str = "monday") -> Column:
    """1..7. ``monday``: 1=Monday (ISO, the contract); ``sunday``: 1=Sunday."""
    if week_start == "monday":
        return F.weekday(d) + 1
    if week_start == "sunday":
        return F.dayofweek(d)
    raise ValueError(f"week_start must be 'monday' or 'sunday', not {week_start!r}")


def date_attributes(d: Column, week_start: str = "monday") -> dict[str, Column]:
    """All calendar columns of the date dimension, keyed by output name."""
    return {
        "day_of_week": weekday_number(d, week_start),
        "day_name": F.date_format(d, "EEEE"),
        "day_of_month": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "week_of_year": F.weekofyear(d),  # ISO week: 2021-01-03 -> 53
        "month_num": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "quarter": F.quarter(d),
        "year": F.year(d),
        "is_weekend": F.weekday(d).isin(5, 6),  # Saturday, Sunday
    }
