"""Incremental loads: new extract files -> existing star, keys kept stable.

A file-source stream with ``trigger(availableNow=True)`` processes every file
not yet seen (the checkpoint location remembers which), then stops. Several
loads, from sources of their own, may run at once into one star: what they write
becomes visible by commits (:mod:`starloom.sinks.snapshots`). Each micro-batch,
in ``foreachBatch``:

1. leaves out the rows of files that another load has brought (their names are
   kept with the batch that brought them), and sets aside records that don't fit
   the schema or have no order number (``_rejects``: the record's text, the
   reasons, load and batch). Every row read is loaded or set aside;
2. commits new members of the dimensions, numbered after the highest key of the
   snapshot that it started from. If another load commits first, the members
   are looked up again in what that one has stored, so no member gets two keys
   and no key two members;
3. looks the rows up against the dimensions as committed and commits the fact
   part, the rejects, the files' names and the counts in one step, so a batch
   is there with all that belongs to it or not at all. A commit of somebody else
   in between only moves the base, unless it brought one of the same files: then
   the batch starts again without them.

A batch that has been committed is not loaded again, so a replay after a failure
changes nothing. Members that were committed for a batch that failed stay; its
replay finds them. Never overwrite targets from a partial read: the full rebuild
is :func:`starloom.plans.star.build_star`.

A product's standard cost depends on all batches. Each batch stores the least
and the largest cost of its products (``prod_cost``); products whose standard
cost changes by that are updated in ``dim_prod``, with ``update_date``, by
rewriting the parts that hold them. A file is known by its path: delivered again
under the same path it is skipped, under another path it is new.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import contracts as C
from ..functions.dates import date_attributes
from ..functions.names import first_token, last_token
from ..operators.dense_keys import extend_key
from ..operators.lookup import bounded_broadcast, size_of
from ..plans.dims import STATUS_DESCRIPTIONS, UNKNOWN_STATUS, build_dim_geo
from ..plans.fact import LOOKED_UP, build_fact_orders
from ..plans.prep import preprocess
from ..plans.quality import (DIM_COMPLETENESS_COLUMNS, FACT_COMPLETENESS_COLUMNS, completeness_of_parts,
                             row_violations)
from ..session import ensure_checkpoint_dir, exists
from ..sinks.snapshots import PROD_COST, Part, Snapshot, StarLog, delete, part_of
from ..sources.raw import CORRUPT, RAW_COLUMNS, RAW_SCHEMA, csv_options, csv_schema

FILE = "_sl_file"
FILES = "_loaded_files"
REJECTS = "_rejects"
BATCH = "load_id string, batch_id long"
FILES_SCHEMA = f"{FILE} string, {BATCH}"
REJECTS_SCHEMA = f"file string, reasons array<string>, record string, {BATCH}"
COST_SCHEMA = "product_name string, category string, brand string, lo double, hi double"
PRODUCT = ["product_name", "category", "brand"]


class _SameFile(Exception):
    """Another load has committed a file of this batch meanwhile."""


def _audit(run_ts: datetime) -> dict:
    ts = F.lit(run_ts).cast("timestamp")
    return {"create_date": ts, "update_date": ts}


# ------------------------------------------------------------------ members

class _Members:
    """The commit of a batch's new members. Called with a snapshot it writes the
    parts that are missing there. Called again after another commit, it keeps
    them if that one left the dimensions alone, else it deletes them and writes
    the ones that are missing now."""

    WATCHED = (*[t for t in C.STAR if t.startswith("dim_")], PROD_COST)

    def __init__(self, log: StarLog, clean: DataFrame, run_ts: datetime, week_start: str, split_mode: str):
        self.log, self.clean, self.run_ts = log, clean, run_ts
        self.week_start, self.split_mode = week_start, split_mode
        self.mine: list[Part] = []
        self.state, self.found = None, []

    def __call__(self, base: Snapshot) -> Snapshot | None:
        state = ([base.parts(t) for t in self.WATCHED], base.keys)
        if state != self.state:
            self.discard()
            self.state, self.found = state, self.find(base)
        add: dict[str, list[Part]] = {}
        drop: dict[str, list[Part]] = {}
        keys = dict(base.keys)
        for new, gone, given in self.found:
            add.update(new)
            drop.update(gone)
            keys.update(given)
        if not add:
            return None
        distinct = dict(base.distinct)
        for table in add:  # a new member has a new key
            more = sum(p.rows for p in add[table]) - sum(p.rows for p in drop.get(table, []))
            if table in distinct or not base.parts(table):
                distinct[table] = distinct.get(table, 0) + more
        distinct.pop(PROD_COST, None)
        return replace(base.with_parts(add, drop), keys=keys, distinct=distinct)

    def find(self, base: Snapshot) -> list[tuple[dict, dict, dict]]:
        """Parts to add and to drop, and the highest keys, of each dimension."""
        jobs = [self._geo, self._dates, self._products, self._statuses,
                lambda b: self._people(b, C.DIM_CUST, "customer_name"),
                lambda b: self._people(b, C.DIM_EMP, "assigned supervisor")]
        with ThreadPoolExecutor(max_workers=len(jobs)) as pool:  # separate targets, side by side
            futures = [pool.submit(job, base) for job in jobs]
            return [f.result() for f in futures]

    def discard(self) -> None:
        self.log.discard(*[p.path for p in self.mine])
        self.mine, self.state = [], None

    def _write(self, df: DataFrame, table: str) -> list[Part]:
        part = self.log.write_part(df, table)
        if part:
            self.mine.append(part)
        return [part] if part else []

    def _stored(self, base: Snapshot, contract: C.Contract) -> DataFrame:
        return self.log.read(contract.name, contract.schema, base)

    def _keyed(self, base: Snapshot, contract: C.Contract, members: DataFrame, names: list[str],
               more: Callable[[DataFrame], DataFrame]) -> tuple[dict, dict, dict]:
        """New members under keys after the snapshot's highest."""
        key = contract.primary_key
        highest = base.keys.get(key, 0)
        new = extend_key(self._stored(base, contract), members, names, key, highest=highest)
        parts = self._write(C.conform(more(new), contract), contract.name)
        given = {key: highest + sum(p.rows for p in parts)} if parts else {}
        return ({contract.name: parts} if parts else {}), {}, given

    def _geo(self, base: Snapshot):
        if base.parts("dim_geo"):
            return {}, {}, {}
        return {"dim_geo": self._write(build_dim_geo(self.log.spark), "dim_geo")}, {}, {}

    def _dates(self, base: Snapshot):
        new = (self.clean.select(F.col("order_date").alias("date_full")).dropna().distinct()
               .join(self._stored(base, C.DIM_DATE).select("date_full"), "date_full", "left_anti"))
        made = C.conform(new.withColumns(date_attributes(F.col("date_full"), self.week_start)), C.DIM_DATE)
        parts = self._write(made, "dim_date")
        return ({"dim_date": parts} if parts else {}), {}, {}

    def _people(self, base: Snapshot, contract: C.Contract, source: str):
        _, name, first, last = contract.names[:4]
        return self._keyed(base, contract, self.clean.select(F.col(f"`{source}`").alias(name)), [name],
                           lambda new: new.withColumns({first: first_token(F.col(name), self.split_mode),
                                                        last: last_token(F.col(name), self.split_mode),
                                                        **_audit(self.run_ts)}))

    def _statuses(self, base: Snapshot):
        mapping = F.create_map(*[F.lit(x) for kv in STATUS_DESCRIPTIONS.items() for x in kv])
        described = F.coalesce(mapping[F.col("status_name")], F.lit(UNKNOWN_STATUS))
        return self._keyed(base, C.DIM_OSTATUS, self.clean.select(F.col("status").alias("status_name")),
                           ["status_name"],
                           lambda new: new.withColumns({"status_description": described, **_audit(self.run_ts)}))

    def _products(self, base: Snapshot):
        """New products, and copies of the parts that hold products whose
        standard cost changes (one distinct cost over all loads, else 0)."""
        log, run_ts = self.log, F.lit(self.run_ts).cast("timestamp")
        seen = self.clean.select(F.col("product").alias("product_name"), "category", "brand", "cost")
        own = seen.dropna(how="any", subset=PRODUCT).groupBy(*PRODUCT).agg(
            F.min("cost").alias("lo"), F.max("cost").alias("hi"))
        cost_parts = self._write(own, PROD_COST)
        if not cost_parts:
            return {}, {}, {}
        own = log.read(PROD_COST, COST_SCHEMA, parts=tuple(cost_parts))
        past = log.read(PROD_COST, COST_SCHEMA, base).join(own.select(*PRODUCT), PRODUCT, "left_semi")
        single = F.coalesce(F.when(F.min("lo") == F.max("hi"), F.min("lo")), F.lit(0.0))
        now = past.unionByName(own).groupBy(*PRODUCT).agg(single.alias("cost_now"))

        add, _, keys = self._keyed(
            base, C.DIM_PROD, own, PRODUCT, lambda new: new.join(now, PRODUCT, "left").withColumns(
                {"standard_cost": F.col("cost_now"), **_audit(self.run_ts)}))
        add[PROD_COST] = cost_parts
        if not base.parts("dim_prod"):
            return add, {}, keys
        changed = self._stored(base, C.DIM_PROD).withColumn("_part", part_of()).join(now, PRODUCT).where(
            "standard_cost != cost_now").select("product_id", "cost_now", "_part")
        names = {r[0] for r in changed.select("_part").distinct().collect()}  # of parts, in the commit anyway
        held = [p for p in base.parts("dim_prod") if p.path.rpartition("part=")[2] in names]
        if not held:
            return add, {}, keys
        old = log.read("dim_prod", C.DIM_PROD.schema, parts=tuple(held))
        moved = F.col("cost_now").isNotNull()
        copied = old.join(changed.select("product_id", "cost_now"), "product_id", "left").withColumns(
            {"standard_cost": F.coalesce("cost_now", "standard_cost"),
             "update_date": F.when(moved, run_ts).otherwise(F.col("update_date"))})
        add["dim_prod"] = [*add.get("dim_prod", []), *self._write(C.conform(copied, C.DIM_PROD), "dim_prod")]
        return add, {"dim_prod": held}, keys


# ------------------------------------------------------------------ batches

def _unknown_files(batch: DataFrame, log: StarLog, seen: Snapshot) -> DataFrame:
    """``batch`` without the rows of files that the snapshot knows. The batch's
    own files are looked up among all that were ever loaded, and the rows are
    joined only if some were found, with those alone."""
    if FILE not in batch.columns or not seen.parts(FILES):
        return batch
    mine = batch.select(FILE).distinct()
    known = mine.join(log.read(FILES, FILES_SCHEMA, seen).select(FILE), FILE, "left_semi")
    size = size_of(known)
    return batch.join(bounded_broadcast(known, known_size=size)[0], FILE, "left_anti") if size[0] else batch


def _reasons(raw: DataFrame) -> Column:
    """Why a raw row can't be loaded; an empty array if it can."""
    key = next(c for c in raw.columns if c.lower() == "order_number")
    number = F.col(f"`{key}`")
    if isinstance(raw.schema[key].dataType, T.StringType):
        number = number.try_cast("double")
    none = number.isNull() | F.isnan(number.cast("double"))
    bad = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    return F.array_compact(F.array(F.when(bad, F.lit("malformed")),
                                   F.when(~bad & none, F.lit("no_order_number"))))


def _raw_rejects(rows: DataFrame) -> DataFrame:
    names = [c for c in rows.columns if c not in (FILE, CORRUPT, "_reasons")]
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in names]))
    return rows.select(
        (F.col(FILE) if FILE in rows.columns else F.lit(None).cast("string")).alias("file"),
        F.col("_reasons").alias("reasons"),
        (F.coalesce(F.col(CORRUPT), whole) if CORRUPT in rows.columns else whole).alias("record"))


def process_batch(batch: DataFrame, epoch_id: int, root: str, *, load_id: str = "0",
                  run_ts: datetime | None = None, country: str = "India",
                  week_start: str = "monday", split_mode: str = "whitespace",
                  on_violation: str = "keep", bookmark: dict[str, list[str]] | None = None,
                  track_keys: bool = False, **fact_options) -> dict[str, int]:
    """Load one micro-batch of raw rows into the star under ``root`` and return
    its counts: ``read`` = ``loaded`` + ``rejected``.

    ``load_id`` names the source's checkpoint. ``on_violation="quarantine"``
    also sets aside fact rows that break a NOT NULL, CHECK or length rule of the
    contract, with the names of the rules; ``"keep"`` loads them. ``bookmark``
    names source partitions that count as loaded with this batch. ``track_keys``
    keeps count of the fact's distinct keys (:func:`key_uniqueness_so_far`):
    the batch's keys are held against those parts only whose range meets theirs.
    ``fact_options`` go to :func:`build_fact_orders`."""
    if on_violation not in ("keep", "quarantine"):
        raise ValueError(f"unknown on_violation {on_violation!r}")
    spark = batch.sparkSession
    ensure_checkpoint_dir(spark)
    run_ts = run_ts or datetime.now(timezone.utc)
    log = StarLog(spark, root)
    stored = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        while True:
            seen = log.latest()
            if seen.done(load_id, epoch_id):
                return dict(seen.loads[load_id]["last"])
            try:
                return _load(log, seen, stored, epoch_id, load_id, run_ts, country, week_start, split_mode,
                             on_violation, bookmark or {}, track_keys, fact_options)
            except _SameFile:
                continue
    finally:
        stored.unpersist()


def _load(log: StarLog, seen: Snapshot, stored: DataFrame, epoch_id: int, load_id: str, run_ts: datetime,
          country: str, week_start: str, split_mode: str, on_violation: str,
          bookmark: dict[str, list[str]], track_keys: bool, fact_options: dict) -> dict[str, int]:
    own = {"load_id": load_id, "batch_id": epoch_id}
    labels = {"load_id": F.lit(load_id), "batch_id": F.lit(epoch_id).cast("long")}
    fresh = _unknown_files(stored, log, seen)
    joined = fresh is not stored
    fresh = fresh.withColumn("_reasons", _reasons(fresh))  # from the cached batch each time
    good = fresh.where(F.size("_reasons") == 0).drop("_reasons", FILE, CORRUPT)
    clean = preprocess(good)  # narrow, and from the cached batch: a second cache of the rows would cost more
    if joined:
        clean = clean.persist(StorageLevel.MEMORY_AND_DISK)
    members = _Members(log, clean, run_ts, week_start, split_mode)
    made: dict[str, list[Part]] = {}
    try:
        read, bad = fresh.agg(F.count(F.lit(1)), F.count_if(F.size("_reasons") > 0)).first()
        if joined:
            clean.count()  # fill the cache once before the concurrent readers
        try:
            base = log.update("members", members)
        except BaseException:
            members.discard()
            raise
        dims = {c.name: log.read(c.name, c.schema, base) for c in (
            C.DIM_CUST, C.DIM_GEO, C.DIM_PROD, C.DIM_OSTATUS, C.DIM_EMP)}
        with ThreadPoolExecutor(max_workers=len(dims)) as pool:
            sizes = {name: pool.submit(size_of, df.select(*LOOKED_UP[name])) for name, df in dims.items()}
            dim_sizes = {name: f.result() for name, f in sizes.items()}
        fact = build_fact_orders(clean, dims, country=country, dim_sizes=dim_sizes, **fact_options)
        fact = fact.withColumns(labels)
        if bad:
            rejects = _raw_rejects(fresh.where(F.size("_reasons") > 0)).withColumns(labels)
            made[REJECTS] = [log.write_part(rejects, REJECTS, **own)]
        if on_violation == "keep":
            part = log.write_part(fact, "fact_orders", **own)
            made["fact_orders"] = [part] if part else []
        else:
            _write_split(log, fact, made, own, labels)
        if FILE in fresh.columns:
            part = log.write_part(fresh.select(FILE).distinct().withColumns(labels), FILES, **own)
            made[FILES] = [part] if part else []
        counts = {"read": read, "loaded": sum(p.rows for p in made["fact_orders"]),
                  "rejected": sum(p.rows for p in made.get(REJECTS, []))}

        def change(now: Snapshot) -> Snapshot | None:
            if now.done(load_id, epoch_id):  # the same batch, run twice at once
                log.discard(*[p.path for ps in made.values() for p in ps])
                return None
            others = tuple(p for p in now.parts(FILES) if p not in seen.parts(FILES))
            if made.get(FILES) and others:
                names = log.read(FILES, FILES_SCHEMA, parts=tuple(made[FILES])).select(FILE)
                if names.join(log.read(FILES, FILES_SCHEMA, parts=others), FILE, "left_semi").limit(1).count():
                    raise _SameFile
            total = now.loads.get(load_id, {}).get("total", dict.fromkeys(counts, 0))
            entry = {"batch": epoch_id, "last": counts, "total": {k: v + total[k] for k, v in counts.items()}}
            distinct = dict(now.distinct)
            before = now.parts("fact_orders")
            if track_keys and ("fact_orders" in distinct or not before):
                distinct["fact_orders"] = distinct.get("fact_orders", 0) + new_keys(log, before, made["fact_orders"])
            else:
                distinct.pop("fact_orders", None)
            marks = {t: (*now.bookmarks.get(t, ()), *ps) for t, ps in bookmark.items()}
            return replace(now.with_parts(made), loads={**now.loads, load_id: entry},
                           bookmarks={**now.bookmarks, **marks}, distinct=distinct)

        log.update("load", change)
        return counts
    except BaseException:
        log.discard(*[p.path for ps in made.values() for p in ps])
        raise
    finally:
        if joined:
            clean.unpersist()


def new_keys(log: StarLog, before: tuple[Part, ...], own: list[Part]) -> int:
    """Distinct order numbers of ``own`` parts that none of the parts ``before``
    has. Only the key column is read, and of the parts before only those whose
    range of keys meets the new one's."""
    key = C.FACT_ORDERS.primary_key
    if not own:
        return 0

    def keys(parts) -> DataFrame:
        return log.spark.read.parquet(*[f"{log.root}/{p.path}" for p in parts]).select(key).where(
            F.col(key).isNotNull())

    mine = keys(own).distinct()
    near = [p for p in before if any(p.may_share_keys(o) for o in own)]
    return (mine.join(keys(near), key, "left_anti") if near else mine).count()


def _write_split(log: StarLog, fact: DataFrame, made: dict, own: dict, labels: dict) -> None:
    """Fact rows and those that break a rule, told apart in one pass over them."""
    rules = row_violations(C.FACT_ORDERS, fact.columns)
    both = fact.withColumn("_broken", rules).withColumn("rejected", F.size("_broken") > 0)
    path = f"fact_orders/part={log.new_id()}"
    (both.sortWithinPartitions("rejected", *C.FACT_ORDERS.sort_keys).write.partitionBy("rejected")
         .option("compression", "snappy").parquet(f"{log.root}/{path}"))
    made["fact_orders"] = []
    if exists(log.spark, f"{log.root}/{path}/rejected=false"):
        made["fact_orders"] = [log.described(f"{path}/rejected=false", fact.schema, "fact_orders", **own)]
    aside = f"{log.root}/{path}/rejected=true"
    if exists(log.spark, aside):
        broken = log.spark.read.schema(both.drop("rejected").schema).parquet(aside)
        names = C.FACT_ORDERS.names
        rows = broken.select(F.lit(None).cast("string").alias("file"), F.col("_broken").alias("reasons"),
                             F.to_json(F.struct(*names)).alias("record"), *[v.alias(k) for k, v in labels.items()])
        made.setdefault(REJECTS, []).append(log.write_part(rows, REJECTS, **own))
        delete(log.spark, aside)


# ------------------------------------------------------------------ sources

def run_incremental(spark: SparkSession, source_path: str, root: str, checkpoint_location: str,
                    *, source_format: str = "csv", max_files_per_trigger: int | None = None,
                    csv_mode: str = "PERMISSIVE", multi_line: bool = False,
                    **options) -> StreamingQuery:
    """Process all new files under ``source_path`` into the star at ``root``
    and return the finished query. ``checkpoint_location`` must be on shared
    storage on a cluster. CSV columns are taken by name; records that don't fit
    are set aside (:func:`read_rejects`) or, with ``csv_mode="FAILFAST"``,
    raise. ``options`` go to :func:`process_batch`."""
    reader, more = spark.readStream, []
    if source_format == "csv":
        keep = csv_mode == "PERMISSIVE"
        more = [CORRUPT] if keep else []
        reader = reader.schema(csv_schema(spark, source_path, keep_rejects=keep)).options(
            **csv_options(csv_mode, multi_line))
    else:
        reader = reader.schema(RAW_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.format(source_format).load(source_path).select(
        *[F.col(f"`{c}`") for c in RAW_COLUMNS], *more, F.col("_metadata.file_path").alias(FILE))

    def load(df: DataFrame, epoch_id: int) -> None:
        # the stream has written its own id before its first batch
        text = df.sparkSession.read.text(f"{checkpoint_location}/metadata", wholetext=True).first()[0]
        process_batch(df, epoch_id, root, load_id=json.loads(text)["id"], **options)

    query = (stream.writeStream.foreachBatch(load)
             .option("checkpointLocation", checkpoint_location)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return query


def _of_partitions(spark: SparkSession, table: str, wanted: list[str]) -> Column:
    """Rows of the partitions that ``SHOW PARTITIONS`` names so."""
    any_of = F.lit(False)
    for spec in wanted:
        one = F.lit(True)
        for pair in spec.split("/"):
            name, _, value = pair.partition("=")
            text = F.col(f"`{name}`").cast("string")
            none = value == "__HIVE_DEFAULT_PARTITION__"
            one = one & (text.isNull() if none else text == unquote(value))
        any_of = any_of | one
    return any_of


def load_table(spark: SparkSession, table: str, root: str, **options) -> dict[str, int]:
    """Load the partitions of a catalog table that no run has loaded yet, as one
    batch, and return its counts. Which ones they are is kept with the commit
    that brings their rows, so a run that fails has loaded none of them. A
    partition that gains rows afterwards is not read again."""
    log = StarLog(spark, root)
    names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    seen = log.latest()
    new = sorted(set(names) - set(seen.bookmarks.get(table, ())))
    if not new:
        return {"read": 0, "loaded": 0, "rejected": 0}
    load_id = f"table:{table}"
    rows = spark.table(table).where(_of_partitions(spark, table, new)).select(
        *[F.col(f"`{c}`") for c in RAW_COLUMNS])
    batch = seen.loads.get(load_id, {}).get("batch", -1) + 1
    return process_batch(rows, batch, root, load_id=load_id, bookmark={table: new}, **options)


# ------------------------------------------------------------------ readers

def read_table(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A table of the star as last committed, or of an earlier version."""
    log = StarLog(spark, root)
    snapshot = log.latest() if version is None else log.at(version)
    return log.read(name, C.STAR[name].schema, snapshot)


def read_fact(spark: SparkSession, root: str) -> DataFrame:
    """The incrementally loaded fact, without load and batch."""
    log = StarLog(spark, root)
    parts = log.latest().parts("fact_orders")
    if not parts:
        return spark.createDataFrame([], C.FACT_ORDERS.schema)
    return spark.read.parquet(*[f"{log.root}/{p.path}" for p in parts]).select(*C.FACT_ORDERS.names)


def read_dim_prod(spark: SparkSession, root: str) -> DataFrame:
    """The products with the standard cost of all loads so far: the cost if
    there is exactly one distinct value, else 0."""
    return read_table(spark, root, "dim_prod")


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """What was set aside: file, reasons, record, load_id, batch_id."""
    return StarLog(spark, root).read(REJECTS, REJECTS_SCHEMA)


def load_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows read, loaded and rejected by each load so far."""
    loads = StarLog(spark, root).latest().loads
    return spark.createDataFrame([(k, v["batch"], *[v["total"][c] for c in ("read", "loaded", "rejected")])
                                  for k, v in sorted(loads.items())],
                                 "load_id string, last_batch long, read long, loaded long, rejected long")


def key_uniqueness_so_far(spark: SparkSession, root: str) -> DataFrame:
    """Rows and distinct primary keys of each table over all loads, from the
    counts kept with the commits: no table is read. A table to which some writer
    added without counting raises."""
    snapshot = StarLog(spark, root).latest()
    unknown = [t for t in C.STAR if t not in snapshot.distinct]
    if unknown:
        raise ValueError(f"not every writer has counted the keys of {unknown}")
    return spark.createDataFrame(
        [(t, c.primary_key, sum(p.rows for p in snapshot.parts(t)), snapshot.distinct[t]) for t, c in C.STAR.items()],
        "table_name string, key_column string, row_count long, distinct_keys long")


def completeness_so_far(spark: SparkSession, root: str,
                        columns: list[tuple[str, str]] | None = None) -> DataFrame:
    """The completeness report of all loads, from the counts kept with the
    commits: no table is read."""
    snapshot = StarLog(spark, root).latest()
    return completeness_of_parts(spark, {t: list(snapshot.parts(t)) for t in C.STAR},
                                 columns or DIM_COMPLETENESS_COLUMNS + FACT_COMPLETENESS_COLUMNS)
