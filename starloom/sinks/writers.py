"""Writing the star.

Layout follows the warehouse hints of each contract without adding a shuffle
that a hot key could overload:

* path datasets: rows are sorted inside each write task on the table's sort
  keys, so Parquet row groups carry tight min/max ranges (date pruning);
* managed tables: with ``bucketed=True`` the tables distributed by key are
  bucketed on it (``bucketBy``), with the sort keys inside each bucket; a
  later join on the key reads co-located buckets without a shuffle, and the
  write itself needs no exchange (every task writes its own bucket files).
  Off by default: a key holding a large share of the rows (one product with a
  third of all orders) makes one bucket that large, and a bucketed scan is
  one task per bucket, out of reach of AQE's skew splitting. Unbucketed
  files are split by size on read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C
from ..session import shuffles_released
from .snapshots import publish_star

FORMATS = ("parquet", "csv", "both", "table", "snapshot")


def _laid_out(df: DataFrame, contract: C.Contract | None,
              partition_by: list[str] | None = None) -> DataFrame:
    """Sorted in each task on the partition columns and then the sort keys (a
    partitioned write would otherwise sort on the former alone)."""
    keys = [*(partition_by or []), *(contract.sort_keys if contract else ())]
    return df.sortWithinPartitions(*keys) if keys else df


YEAR_PARTITION = "order_year"


def _year_partitioned(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumn(YEAR_PARTITION, F.year(date_col))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", *,
                contract: C.Contract | None = None, partition_by: list[str] | None = None,
                csv_compression: str = "none") -> None:
    """One dataset at ``path``: Snappy Parquet or headered CSV, optionally in
    one directory per value of ``partition_by`` (readers filtering on it skip
    the other directories)."""
    out = _laid_out(df, contract, partition_by)
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_released(df.sparkSession):
        if fmt == "parquet":
            w.option("compression", "snappy").parquet(path)
        elif fmt == "csv":
            w.option("header", True).option("compression", csv_compression).csv(path)
        else:
            raise ValueError(f"unknown format {fmt!r}")


def write_managed(df: DataFrame, table: str, contract: C.Contract | None, *,
                  mode: str = "overwrite", buckets: int = 16, bucketed: bool = False,
                  partition_by: list[str] | None = None) -> None:
    """A catalog table. One that exists (made by :func:`create_star_tables`)
    is loaded by insert, so its types, defaults and buckets stay. A new one is
    bucketed on request if its contract is distributed by key; otherwise rows
    are sorted within each write task."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        names = spark.table(table).columns
        _laid_out(df, contract, partition_by).select(*names).write.insertInto(
            table, overwrite=mode == "overwrite")
        return
    if not bucketed:
        w = _laid_out(df, contract, partition_by).write.mode(mode).format("parquet")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.saveAsTable(table)
        return
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if contract is not None and contract.distribution == "key" and contract.dist_key:
        w = w.bucketBy(buckets, contract.dist_key)
        if contract.sort_keys:
            w = w.sortBy(*contract.sort_keys)
    w.saveAsTable(table)


def write_star(tables: dict[str, DataFrame], root: str, fmt: str = "parquet", *,
               mode: str = "overwrite", database: str | None = None,
               buckets: int = 16, bucketed: bool = False,
               fact_by_year: bool = False, csv_compression: str = "none") -> dict[str, str]:
    """Write every table under ``root/<name>`` (or as ``database.<name>``).

    Dimensions are written before the fact. ``fmt="both"`` writes Parquet
    under ``root/parquet`` and CSV under ``root/csv``. ``fmt="snapshot"``
    publishes all tables in one step (:func:`publish_star`); with the others
    each table is its own job, so a failure leaves earlier tables written and
    the rest untouched. ``fact_by_year`` adds
    ``order_year`` to the fact and writes one directory per year, so
    date-filtered readers prune whole years (no shuffle: every task writes
    the years it holds). ``csv_compression`` is the codec of CSV files, each of
    which one task then reads. Returns the locations written.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    order = sorted(tables, key=lambda n: (n.startswith("fact"), n))
    written: dict[str, str] = {}
    if fmt == "snapshot":
        if fact_by_year or mode != "overwrite":
            raise ValueError("a snapshot replaces whole tables and has no year folders")
        spark = next(iter(tables.values())).sparkSession
        made = publish_star(spark, tables, root)
        return {n: f"{root}/{p.path}" for n in order for p in made.parts(n)}
    for name in order:
        contract = C.STAR.get(name)
        df = tables[name]
        parts = None
        if fact_by_year and name.startswith("fact"):
            df, parts = _year_partitioned(df, "order_date"), [YEAR_PARTITION]
        if fmt == "table":
            target = f"{database}.{name}" if database else name
            write_managed(df, target, contract, mode=mode, buckets=buckets, bucketed=bucketed,
                          partition_by=parts)
            written[name] = target
        elif fmt == "both":
            write_table(df, f"{root}/parquet/{name}", "parquet", mode, contract=contract,
                        partition_by=parts)
            # the CSV comes from what was written: the plan runs once
            stored = df.sparkSession.read.schema(df.schema).parquet(f"{root}/parquet/{name}")
            write_table(stored, f"{root}/csv/{name}", "csv", mode, contract=contract,
                        partition_by=parts, csv_compression=csv_compression)
            written[name] = f"{root}/parquet/{name}"
        else:
            write_table(df, f"{root}/{name}", fmt, mode, contract=contract, partition_by=parts,
                        csv_compression=csv_compression)
            written[name] = f"{root}/{name}"
    return written


def save(dataframes: list[DataFrame], names: list[str], root: str, fmt: str = "parquet",
         **kw) -> dict[str, str]:
    """List form of :func:`write_star`; the two lists must have equal length."""
    if len(dataframes) != len(names):
        raise ValueError(f"Number of dataframes ({len(dataframes)}) must match number of "
                         f"file names ({len(names)})")
    return write_star(dict(zip(names, dataframes)), root, fmt, **kw)


def _sql_type(col: C.Col) -> str:
    if col.max_bytes and col.dtype == C.STR:
        return f"VARCHAR({col.max_bytes})"
    return col.dtype.simpleString().upper()


def create_table_ddl(contract: C.Contract, *, database: str | None = None,
                     buckets: int = 16, location: str | None = None,
                     bucketed: bool = False) -> str:
    """``CREATE TABLE`` for a contract: NOT NULL, VARCHAR(n), DEFAULT
    CURRENT_TIMESTAMP on audit columns, bucketing for key-distributed tables.
    Spark does not enforce the keys or CHECK rules on Parquet tables; run
    :mod:`starloom.plans.quality` for those."""
    cols = []
    for c in contract.columns:
        spec = f"  {c.name} {_sql_type(c)}"
        if c.not_null:
            spec += " NOT NULL"
        if c.default_now:
            spec += " DEFAULT CURRENT_TIMESTAMP"
        cols.append(spec)
    name = f"{database}.{contract.name}" if database else contract.name
    ddl = f"CREATE TABLE IF NOT EXISTS {name} (\n" + ",\n".join(cols) + "\n) USING parquet"
    if bucketed and contract.distribution == "key" and contract.dist_key:
        ddl += f"\nCLUSTERED BY ({contract.dist_key})"
        if contract.sort_keys:
            ddl += f" SORTED BY ({', '.join(contract.sort_keys)})"
        ddl += f" INTO {buckets} BUCKETS"
    if location:
        ddl += f"\nLOCATION '{location}'"
    return ddl


def create_star_tables(spark: SparkSession, *, database: str | None = None,
                       buckets: int = 16, bucketed: bool = False) -> list[str]:
    """Create the seven tables, dimensions first; returns the statements run.
    ``write_star(fmt="table")`` then loads them by insert."""
    stmts = [create_table_ddl(c, database=database, buckets=buckets, bucketed=bucketed)
             for c in sorted(C.STAR.values(), key=lambda c: c.name.startswith("fact"))]
    for s in stmts:
        spark.sql(s)
    return stmts
