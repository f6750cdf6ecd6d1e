"""Snapshots of the star: all tables change together, and loads may run at once.

Every write puts whole Parquet folders, *parts*, under ``root/<table>/part=<id>``
and never touches one that is there. What a reader sees is decided by the newest
file of ``root/_commits``: it names the parts of every table. A writer makes the
file of the next version; the file system lets exactly one writer create it
(compare and set), and whoever comes second starts again from what the first one
committed. A writer that dies leaves folders that no commit names; readers never
see them, and :func:`starloom.sinks.upkeep.expire` deletes them.

A commit file holds a few numbers for every part. Compaction keeps the number of
parts small; rows and per-file lists are in Parquet and never in it.

The file system has to refuse to create a file twice: HDFS and others with an
atomic rename that doesn't overwrite, or a local or mounted one with hard links.
A plain object store without that needs a catalog's own commits instead.
"""

from __future__ import annotations

import json
import random
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contracts as C
from ..functions.missing import is_missing
from ..session import file_system, shuffles_released

COMMITS = "_commits"


class ConcurrentChange(RuntimeError):
    """Another writer's commit doesn't allow this one, or too many came first."""


@dataclass(frozen=True)
class Part:
    """One immutable folder of a table. Of a star table, ``missing`` counts the
    NULL (and NaN) values of each column, and ``low`` and ``high`` are the ends
    of a primary key that is a number."""
    path: str  # below the root
    rows: int
    bytes: int
    files: int
    load_id: str | None = None
    batch_id: int | None = None
    missing: dict[str, int] = field(default_factory=dict)
    low: int | None = None
    high: int | None = None

    def may_share_keys(self, other: Part) -> bool:
        """Whether a key can be in both parts, by the ends of their ranges."""
        ends = (self.low, self.high, other.low, other.high)
        return None in ends or (self.low <= other.high and other.low <= self.high)


@dataclass(frozen=True)
class Snapshot:
    version: int = 0
    action: str = "empty"
    at: str = ""
    tables: dict[str, tuple[Part, ...]] = field(default_factory=dict)
    #: Highest key given so far, by key column.
    keys: dict[str, int] = field(default_factory=dict)
    #: By load id: its last batch and the counts of all its batches.
    loads: dict[str, dict] = field(default_factory=dict)
    #: Distinct primary keys, of the tables where every writer has counted them.
    distinct: dict[str, int] = field(default_factory=dict)
    #: By source table: partitions that have been loaded.
    bookmarks: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def parts(self, table: str) -> tuple[Part, ...]:
        return self.tables.get(table, ())

    def with_parts(self, add: dict[str, list[Part]], drop: dict[str, list[Part]] | None = None) -> Snapshot:
        """Parts added at the end of their tables, others taken out."""
        tables = dict(self.tables)
        for name, gone in (drop or {}).items():
            tables[name] = tuple(p for p in tables.get(name, ()) if p not in gone)
        for name, new in add.items():
            tables[name] = (*tables.get(name, ()), *new)
        return replace(self, tables=tables)

    def done(self, load_id: str, batch_id: int) -> bool:
        return self.loads.get(load_id, {}).get("batch", -1) >= batch_id

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Snapshot:
        raw = json.loads(text)
        raw["tables"] = {n: tuple(Part(**p) for p in ps) for n, ps in raw["tables"].items()}
        raw["bookmarks"] = {n: tuple(ps) for n, ps in raw["bookmarks"].items()}
        return Snapshot(**raw)


# --------------------------------------------------------------- file system

def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make the file ``path`` with this content; False if it is there already.
    It appears whole or not at all, and of several writers one succeeds."""
    jvm = spark.sparkContext._jvm
    folder, _, name = path.rpartition("/")
    fs, target = file_system(spark, path)
    _, draft = file_system(spark, f"{folder}/.{name}-{uuid.uuid4().hex}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            at = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, draft)]
            jvm.java.nio.file.Files.createLink(*at)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
            options = spark.sparkContext._gateway.new_array(
                getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
            options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
            context.rename(draft, target, options)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(draft, False)  # gone already where it was renamed


# --------------------------------------------------------------- the log

class StarLog:
    """The commits of the star under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> list[int]:
        fs, p = file_system(self.spark, f"{self.root}/{COMMITS}")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[:-len(".json")]) for n in names if n.endswith(".json") and not n.startswith("."))

    def _file(self, version: int) -> str:
        return f"{self.root}/{COMMITS}/{version:020d}.json"

    def at(self, version: int) -> Snapshot:
        return Snapshot.from_json(read_text(self.spark, self._file(version)))

    def latest(self) -> Snapshot:
        known = self.versions()
        return self.at(known[-1]) if known else Snapshot()

    def commit(self, new: Snapshot, base: Snapshot, action: str) -> Snapshot | None:
        """``new`` as the version after ``base``, or None if somebody else has
        made that version."""
        now = datetime.now(timezone.utc).isoformat()
        made = replace(new, version=base.version + 1, action=action, at=now)
        return made if create_once(self.spark, self._file(made.version), made.to_json()) else None

    def update(self, action: str, change: Callable[[Snapshot], Snapshot | None], attempts: int = 50) -> Snapshot:
        """Commit what ``change`` makes of the newest snapshot, calling it again
        with the newer one whenever somebody else was first. ``change`` returns
        None where nothing is left to do. The wait between attempts grows, with
        a random share, so that writers don't meet again and again."""
        for attempt in range(attempts):
            base = self.latest()
            new = change(base)
            if new is None:
                return base
            made = self.commit(new, base, action)
            if made is not None:
                return made
            time.sleep(random.random() * min(2.0, 0.05 * 2 ** attempt))
        raise ConcurrentChange(f"{action}: {attempts} other commits came first")

    # ------------------------------------------------------------ parts

    @staticmethod
    def new_id() -> str:
        return uuid.uuid4().hex

    def write_part(self, df: DataFrame, table: str, *, load_id: str | None = None, batch_id: int | None = None,
                   in_order: bool = True, compression: str = "snappy") -> Part | None:
        """``df`` as a new part, which nobody sees before a commit names it; None
        for no rows. ``in_order`` sorts each file of a star table by its keys."""
        path = f"{table}/part={self.new_id()}"
        keys = C.STAR[table].sort_keys if table in C.STAR and in_order else ()
        out = df.sortWithinPartitions(*keys) if keys else df
        out.write.option("compression", compression).parquet(f"{self.root}/{path}")
        return self.described(path, df.schema, table, load_id=load_id, batch_id=batch_id)

    def described(self, path: str, schema: T.StructType, table: str, *, load_id: str | None = None,
                  batch_id: int | None = None) -> Part | None:
        """The part in a written folder. One pass over it counts rows and what
        is missing."""
        names = [c for c in C.STAR[table].names if c in schema.names] if table in C.STAR else []
        stored = self.spark.read.schema(schema).parquet(f"{self.root}/{path}")
        key = F.lit(None)
        if names and isinstance(schema[C.STAR[table].primary_key].dataType, (T.IntegerType, T.LongType)):
            key = F.col(C.STAR[table].primary_key)
        row = stored.agg(F.count(F.lit(1)), F.min(key), F.max(key), *[
            F.count_if(is_missing(c, schema[c].dataType)) for c in names]).first()
        if not row[0]:
            self.discard(path)
            return None
        fs, p = file_system(self.spark, f"{self.root}/{path}")
        files = [s.getLen() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-")]
        return Part(path, row[0], sum(files), len(files), load_id, batch_id,
                    dict(zip(names, row[3:])), row[1], row[2])

    def discard(self, *paths: str) -> None:
        """Delete folders of this writer that no commit names."""
        for path in paths:
            delete(self.spark, f"{self.root}/{path}")

    def read(self, table: str, schema: T.StructType | str, snapshot: Snapshot | None = None,
             parts: tuple[Part, ...] | None = None) -> DataFrame:
        """A table of a snapshot (default: the newest), or some parts of it."""
        if parts is None:
            parts = (snapshot or self.latest()).parts(table)
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{p.path}" for p in parts])


def part_of(column: str = "_metadata.file_path") -> F.Column:
    """The folder name of the part that a row comes from."""
    return F.regexp_extract(F.col(column), r"part=([0-9a-f]+)", 1)


# --------------------------------------------------------------- whole stars

#: Least and largest cost of each product over all loads: its standard cost
#: follows from them, and they can be merged.
PROD_COST = "prod_cost"


def _costs_of(products: DataFrame) -> DataFrame:
    """What the standard costs alone say of the products' costs: 0 stands for
    several or for none, and stays 0 whatever later loads bring."""
    cost, far = F.col("standard_cost"), F.lit(float("inf"))
    return products.select("product_name", "category", "brand", F.when(cost != 0, cost).otherwise(-far).alias("lo"),
                           F.when(cost != 0, cost).otherwise(far).alias("hi"))


def publish_star(spark: SparkSession, tables: dict[str, DataFrame], root: str, *,
                 expect: int | None = None, costs: DataFrame | None = None,
                 track_keys: bool = False, compression: str = "snappy") -> Snapshot:
    """All of ``tables`` in one step: readers have the old star until every
    table is written, and then the new one. A run that fails or is killed leaves
    the old one. Tables that aren't named stay as they are, and so does what is
    known of files and partitions loaded so far.

    ``costs`` (product_name, category, brand, lo, hi) is what later loads need
    to go on with the standard costs; without it, they take a standard cost
    other than 0 as the product's only cost so far. ``track_keys`` counts the
    distinct primary keys of every table, so that loads can go on counting.

    ``expect`` is the version that the rows were derived from: if another one
    has been committed since, a :class:`ConcurrentChange` is raised and nothing
    changes. Without it the last publication wins."""
    log = StarLog(spark, root)
    made: dict[str, list[Part]] = {}
    try:
        for name in sorted(tables, key=lambda n: (n.startswith("fact"), n)):
            with shuffles_released(spark):
                part = log.write_part(tables[name], name, compression=compression)
            made[name] = [part] if part else []
        if "dim_prod" in made:
            known = costs if costs is not None else _costs_of(
                log.read("dim_prod", C.DIM_PROD.schema, parts=tuple(made["dim_prod"])))
            part = log.write_part(known, PROD_COST, compression=compression)
            made[PROD_COST] = [part] if part else []
    except BaseException:
        log.discard(*[p.path for ps in made.values() for p in ps])
        raise
    keys = {c.primary_key: _highest(log, c, made[n]) for n, c in C.STAR.items()
            if n in made and n.startswith("dim_") and isinstance(c.col(c.primary_key).dtype, T.IntegerType)}

    distinct = {n: _distinct_keys(log, C.STAR[n], ps) for n, ps in made.items() if track_keys and n in C.STAR}

    def change(base: Snapshot) -> Snapshot:
        if expect is not None and base.version != expect:
            log.discard(*[p.path for ps in made.values() for p in ps])
            raise ConcurrentChange(f"the star is at version {base.version}, not {expect}")
        return replace(base, tables={**base.tables, **{n: tuple(ps) for n, ps in made.items()}},
                       keys={**base.keys, **keys},
                       distinct={**{n: k for n, k in base.distinct.items() if n not in made}, **distinct})

    return log.update("publish", change)


def _distinct_keys(log: StarLog, contract: C.Contract, parts: list[Part]) -> int:
    key = contract.primary_key
    return log.read(contract.name, contract.schema, parts=tuple(parts)).agg(F.count_distinct(key)).first()[0]


def _highest(log: StarLog, contract: C.Contract, parts: list[Part]) -> int:
    key = contract.primary_key
    found = log.read(contract.name, T.StructType([T.StructField(key, T.LongType())]), parts=tuple(parts))
    return found.agg(F.max(key)).first()[0] or 0


def read_star(spark: SparkSession, root: str, version: int | None = None,
              names: list[str] | None = None) -> dict[str, DataFrame]:
    """The seven tables of one snapshot: the newest, or an earlier version."""
    log = StarLog(spark, root)
    snapshot = log.latest() if version is None else log.at(version)
    return {n: log.read(n, C.STAR[n].schema, snapshot) for n in names or C.STAR}
