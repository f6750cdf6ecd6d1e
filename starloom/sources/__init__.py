"""Sources: the raw order extract (CSV, catalog table, driver-table adapter) and seeds."""

from .harness import orders_from_tables
from .raw import RAW_COLUMNS, RAW_SCHEMA, read_raw_csv, read_raw_table
from .seeds import geo_seed

__all__ = ["orders_from_tables", "RAW_COLUMNS", "RAW_SCHEMA", "read_raw_csv",
           "read_raw_table", "geo_seed"]
