"""Upkeep of a star's files: compaction, clustering, and the removal of old ones.

All three go through the commits of :mod:`starloom.sinks.snapshots`: new parts
are written beside the old ones and swapped in one step, while readers and loads
go on.
"""

from __future__ import annotations

import math
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import file_system
from .snapshots import COMMITS, PROD_COST, Part, Snapshot, StarLog, delete

TARGET_BYTES = 128 << 20


# ------------------------------------------------------------------ layouts

def _cell(df: DataFrame, names: list[str], bits: int) -> list[Column]:
    """For each column its place between the least and the largest value, as a
    number of ``bits`` bits. NULL is 0. One pass finds all the bounds."""
    def number(c: str) -> Column:
        kind = df.schema[c].dataType
        if isinstance(kind, T.DateType):
            return F.unix_date(c)
        if isinstance(kind, T.TimestampType):
            return F.unix_micros(c)
        if isinstance(kind, T.NumericType):
            return F.col(c)
        raise TypeError(f"{c}: only dates, timestamps and numbers can be interleaved, not {kind.simpleString()}")

    bounds = df.agg(*[f(number(c)).cast("double") for c in names for f in (F.min, F.max)]).first()
    out = []
    for i, c in enumerate(names):
        low, high = bounds[2 * i], bounds[2 * i + 1]
        if low is None or high == low:
            out.append(F.lit(0).cast("long"))
            continue
        step = (number(c).cast("double") - F.lit(low)) * F.lit((1 << bits) / (high - low))
        out.append(F.least(F.coalesce(F.floor(step), F.lit(0)), F.lit((1 << bits) - 1)))
    return out


def z_value(df: DataFrame, names: list[str], bits: int = 12) -> Column:
    """The bits of all columns' places, interleaved: rows that are near each
    other in every column get near numbers."""
    cells = _cell(df, names, bits)
    z = F.lit(0).cast("long")
    for b in range(bits):
        for i, cell in enumerate(cells):
            bit = F.shiftright(cell, b).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(bit, b * len(cells) + i))
    return z


def clustered(df: DataFrame, names: list[str], files: int, *, interleave: bool = False) -> DataFrame:
    """``df`` in ``files`` ranges of ``names`` (of their interleaved bits with
    ``interleave``), sorted within each. Spark samples the ranges, so they hold
    about as many rows each; a value with many rows, which one range couldn't
    hold, is cut along a hash of the row. Min and max of the columns in the
    files' footers then tell readers which files to pass over."""
    # neither the hash nor the bits move with the rows: both are made of what is in a row
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    if not interleave:
        return df.repartitionByRange(files, *names, spread).sortWithinPartitions(*names)
    z = z_value(df, names)
    ranged = df.repartitionByRange(files, z, spread).withColumn("_z", z)
    return ranged.sortWithinPartitions("_z", *names).drop("_z")


# ------------------------------------------------------------------ compaction

def compact(spark: SparkSession, root: str, table: str, *, target_bytes: int = TARGET_BYTES,
            cluster_by: list[str] | None = None, interleave: bool = False,
            everything: bool = False) -> Snapshot:
    """Rewrite the parts of ``table`` whose files are on average smaller than
    half of ``target_bytes`` (all parts with ``everything``) as files of about
    that size, and swap them in one commit. Returns the newest snapshot.

    Without ``cluster_by`` nothing is shuffled: Spark's scan puts small files
    together up to the target, and each such bin becomes a file. With it, rows
    are dealt to ranges of these columns (see :func:`clustered`). If another
    commit has taken one of the parts meanwhile, nothing changes. The partial
    costs of ``prod_cost`` are merged to one row a product."""
    log = StarLog(spark, root)
    base = log.latest()
    chosen = [p for p in base.parts(table) if everything or p.bytes < p.files * target_bytes / 2]
    total, files = sum(p.bytes for p in chosen), sum(p.files for p in chosen)
    wanted = max(1, math.ceil(total / target_bytes))
    if not chosen or (files <= wanted and not cluster_by):
        return base
    paths = [f"{log.root}/{p.path}" for p in chosen]
    if table == PROD_COST:
        whole = spark.read.parquet(*paths)
        keys = [c for c in whole.columns if c not in ("lo", "hi")]
        out = whole.groupBy(*keys).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    elif cluster_by:
        out = clustered(spark.read.parquet(*paths), cluster_by, wanted, interleave=interleave)
    else:
        packing = spark.newSession()  # the same application with settings of its own
        packing.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
        packing.conf.set("spark.sql.files.openCostInBytes", "1")
        packing.conf.set("spark.sql.files.minPartitionNum", "1")
        out = packing.read.parquet(*paths)
    part = log.write_part(out, table, in_order=not cluster_by)

    def swap(now: Snapshot) -> Snapshot | None:
        if not set(p.path for p in chosen) <= {p.path for p in now.parts(table)}:
            if part:
                log.discard(part.path)
            return None
        return now.with_parts({table: [part] if part else []}, {table: chosen})

    return log.update("compact", swap)


# ------------------------------------------------------------------ removal

def expire(spark: SparkSession, root: str, *, keep: int = 10, older_than_hours: float = 24.0) -> int:
    """Delete commits but for the newest ``keep``, and parts that none of those
    names. A part younger than ``older_than_hours`` stays: it may be of a writer
    that hasn't committed yet. Returns how many parts were deleted."""
    log = StarLog(spark, root)
    versions = log.versions()
    kept = versions[-keep:]
    named = {_folder(p) for v in kept for ps in log.at(v).tables.values() for p in ps}
    limit = (time.time() - 3600 * older_than_hours) * 1000
    fs, top = file_system(spark, log.root)
    gone = 0
    for table in [s.getPath() for s in fs.listStatus(top) if s.isDirectory()]:
        if table.getName() == COMMITS:
            continue
        for status in fs.listStatus(table):
            name = f"{table.getName()}/{status.getPath().getName()}"
            if "/part=" in name and name not in named and status.getModificationTime() < limit:
                delete(spark, f"{log.root}/{name}")
                gone += 1
    for v in versions[:-keep]:
        delete(spark, f"{log.root}/{COMMITS}/{v:020d}.json")
    return gone


def _folder(part: Part) -> str:
    return "/".join(part.path.split("/")[:2])
