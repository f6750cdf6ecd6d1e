"""Table contracts of the star schema.

One ``Contract`` per table: column names and Spark types, NOT NULL flags,
VARCHAR byte limits, primary key, foreign keys, range rules and the physical
layout hints of the warehouse DDL. Builders end with :func:`conform`, the
quality module turns the same objects into checks, and the sinks generate
``CREATE TABLE`` statements from them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INT = T.IntegerType()
DBL = T.DoubleType()
STR = T.StringType()
DATE = T.DateType()
TS = T.TimestampType()
BOOL = T.BooleanType()


@dataclass(frozen=True)
class Col:
    name: str
    dtype: T.DataType
    not_null: bool = False
    max_bytes: int | None = None  # VARCHAR(n): a byte limit, as in the warehouse
    default_now: bool = False     # DEFAULT CURRENT_TIMESTAMP


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[Col, ...]
    primary_key: str
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)
    # (rule name, SQL predicate); like SQL CHECK, a NULL outcome passes
    checks: tuple[tuple[str, str], ...] = ()
    distribution: str = "even"          # "key" | "all" (replicated) | "even"
    dist_key: str | None = None
    sort_keys: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def col(self, name: str) -> Col:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    @property
    def audit_columns(self) -> list[str]:
        return [c for c in ("create_date", "update_date") if c in self.names]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype, not c.not_null)
                             for c in self.columns])


# The warehouse DDL of the seven tables (types, NOT NULL, VARCHAR
# lengths, keys, checks, distribution and sort keys).
DIM_CUST = Contract(
    "dim_cust",
    (
        Col("customer_id", INT, True),
        Col("customer_name", STR, max_bytes=100),
        Col("first_name", STR, max_bytes=50),
        Col("last_name", STR, max_bytes=50),
        Col("create_date", TS, True, default_now=True),
        Col("update_date", TS),
    ),
    primary_key="customer_id",
    distribution="key", dist_key="customer_id", sort_keys=("customer_id",),
)

DIM_DATE = Contract(
    "dim_date",
    (
        Col("date_full", DATE, True),
        Col("day_of_week", INT, True),
        Col("day_name", STR, True, max_bytes=10),
        Col("day_of_month", INT, True),
        Col("day_of_year", INT, True),
        Col("week_of_year", INT, True),
        Col("month_num", INT, True),
        Col("month_name", STR, True, max_bytes=10),
        Col("quarter", INT, True),
        Col("year", INT, True),
        Col("is_weekend", BOOL, True),
    ),
    primary_key="date_full",
    checks=(
        ("check_day_of_week", "day_of_week BETWEEN 1 AND 7"),
        ("check_month_num", "month_num BETWEEN 1 AND 12"),
        ("check_quarter", "quarter BETWEEN 1 AND 4"),
    ),
    distribution="all", sort_keys=("date_full",),
)

DIM_EMP = Contract(
    "dim_emp",
    (
        Col("employee_id", INT, True),
        Col("employee_name", STR, max_bytes=100),
        Col("employee_first_name", STR, max_bytes=50),
        Col("employee_last_name", STR, max_bytes=50),
        Col("create_date", TS, True, default_now=True),
        Col("update_date", TS),
    ),
    primary_key="employee_id",
    distribution="all", sort_keys=("employee_id",),
)

DIM_GEO = Contract(
    "dim_geo",
    (
        Col("state_id", STR, True, max_bytes=40),
        Col("state_code", STR, True, max_bytes=2),
        Col("country", STR, True, max_bytes=30),
        Col("state_name", STR, True, max_bytes=50),
        Col("capital_city", STR, max_bytes=50),
        Col("status", STR, max_bytes=30),
        Col("iso_code", STR, max_bytes=10),
    ),
    primary_key="state_id",
    distribution="all", sort_keys=("state_id",),
)

DIM_OSTATUS = Contract(
    "dim_ostatus",
    (
        Col("status_id", INT, True),
        Col("status_name", STR, True, max_bytes=15),
        Col("status_description", STR, max_bytes=50),
        Col("create_date", TS, True, default_now=True),
        Col("update_date", TS),
    ),
    primary_key="status_id",
    distribution="all", sort_keys=("status_id",),
)

DIM_PROD = Contract(
    "dim_prod",
    (
        Col("product_id", INT, True),
        Col("product_name", STR, True, max_bytes=30),
        Col("category", STR, True, max_bytes=15),
        Col("brand", STR, True, max_bytes=20),
        Col("standard_cost", DBL, True),
        Col("create_date", TS, True, default_now=True),
        Col("update_date", TS),
    ),
    primary_key="product_id",
    distribution="key", dist_key="product_id", sort_keys=("product_id",),
)

FACT_ORDERS = Contract(
    "fact_orders",
    (
        Col("order_number", INT, True),
        Col("order_date", DATE, True),
        Col("customer_id", INT, True),
        Col("state_id", STR, True, max_bytes=40),
        Col("product_id", INT, True),
        Col("status_id", INT, True),
        Col("employee_id", INT, True),
        Col("unit_cost", DBL, True),
        Col("unit_sales", DBL, True),
        Col("quantity", INT, True),
        Col("total_cost", DBL, True),
        Col("total_sales", DBL, True),
        Col("profit", DBL, True),
        Col("profit_margin", DBL, True),
    ),
    primary_key="order_number",
    foreign_keys={
        "order_date": ("dim_date", "date_full"),
        "customer_id": ("dim_cust", "customer_id"),
        "state_id": ("dim_geo", "state_id"),
        "product_id": ("dim_prod", "product_id"),
        "status_id": ("dim_ostatus", "status_id"),
        "employee_id": ("dim_emp", "employee_id"),
    },
    checks=(
        ("check_quantity_positive", "quantity > 0"),
        ("check_profit_margin", "profit_margin >= -1 AND profit_margin <= 1"),
    ),
    distribution="key", dist_key="product_id", sort_keys=("order_date", "product_id"),
)

# Dimensions before the fact, the order the warehouse creates them in.
STAR: dict[str, Contract] = {c.name: c for c in (
    DIM_CUST, DIM_DATE, DIM_EMP, DIM_GEO, DIM_OSTATUS, DIM_PROD, FACT_ORDERS)}


def checked_cast(value: Column, name: str, dtype: T.DataType) -> Column:
    """``value`` as ``dtype``; a number that doesn't fit an INTEGER raises,
    whatever the session's ANSI setting (which would wrap or saturate it)."""
    if dtype != INT:
        return value.cast(dtype)
    wide = value.cast("double")
    fits = wide.isNull() | ((wide > -(2.0 ** 31) - 1) & (wide < 2.0 ** 31))
    return F.when(fits, value.cast(INT)).otherwise(F.raise_error(F.concat(
        F.lit(f"{name} does not fit an INTEGER: "), value.cast("string"))).cast(INT))


def is_key(contract: Contract, name: str) -> bool:
    return name == contract.primary_key or name in contract.foreign_keys


def conform(df: DataFrame, contract: Contract, *, drop_audit: bool = False,
            wide_keys: bool = False) -> DataFrame:
    """Project ``df`` onto the contract: column order, names and types.

    Missing audit columns are allowed only with ``drop_audit``. ``wide_keys``
    makes the INTEGER keys BIGINT, for more than 2**31 members or orders;
    without it, a key that doesn't fit raises.
    """
    cols: list[Column] = []
    for c in contract.columns:
        if drop_audit and c.name in ("create_date", "update_date"):
            continue
        wide = wide_keys and c.dtype == INT and is_key(contract, c.name)
        cols.append(checked_cast(F.col(c.name), c.name, T.LongType() if wide else c.dtype).alias(c.name))
    return df.select(*cols)
