"""Sinks: Parquet / CSV datasets, managed tables and their DDL, snapshots."""

from .snapshots import ConcurrentChange, StarLog, publish_star, read_star
from .upkeep import compact, expire
from .writers import create_star_tables, create_table_ddl, save, write_star, write_table

__all__ = ["ConcurrentChange", "StarLog", "compact", "create_star_tables", "create_table_ddl", "expire",
           "publish_star", "read_star", "save", "write_star", "write_table"]
