"""Column-level helpers; every one returns a JVM-side ``Column`` (no Python UDFs)."""

from .dates import date_attributes, parse_date, weekday_number
from .keys import stable_uuid
from .measures import profit, profit_margin
from .missing import is_missing
from .names import first_token, last_token

__all__ = [
    "date_attributes", "parse_date", "weekday_number", "stable_uuid", "profit",
    "profit_margin", "is_missing", "first_token", "last_token",
]
