"""

Every query reads the driver's tables through the adapter in
``starloom.sources.harness`` (a 5-way join of lineitem, orders, customer,
part and supplier into the 14-column raw order extract), so its work grows
with the tables. ``oracle_sql()`` re-derives each result in DuckDB SQL
written independently of the Spark code, the rules of the DDL included; only
the status labels, the geography seed rows and the columns of the completeness
report are shared.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone
from functools import partial

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from starloom import contracts as C  # noqa: E402
from starloom.operators.dense_keys import number_rows  # noqa: E402
from starloom.operators.lookup import bounded_broadcast, lookup_key  # noqa: E402
from starloom.operators.single_valued import distinct_count, single_valued  # noqa: E402
from starloom.plans import quality as Q  # noqa: E402
from starloom.plans.dims import (STATUS_DESCRIPTIONS, UNKNOWN_STATUS,  # noqa: E402
                                 build_dim_cust, build_dim_date, build_dim_emp,
                                 build_dim_geo, build_dim_prod, build_dim_status)
from starloom.plans.fact import build_fact_orders  # noqa: E402
from starloom.plans.prep import preprocess, preprocess_counts  # noqa: E402
from starloom.plans.star import build_star  # noqa: E402
from starloom.session import ensure_checkpoint_dir, exists, scratch_folder, shuffles_released  # noqa: E402
from starloom.plans.job import run as run_job  # noqa: E402
from starloom.sinks import StarLog, compact, create_star_tables, publish_star, read_star, write_star  # noqa: E402
from starloom.sinks.snapshots import delete  # noqa: E402
from starloom.sources.harness import STATE_CODES, joined_lines, orders_from_tables, with_defects  # noqa: E402
from starloom.sources.raw import read_raw_csv  # noqa: E402
from starloom.sources.seeds import geo_rows  # noqa: E402
from starloom.streaming import (completeness_so_far, key_uniqueness_so_far, load_counts, load_table, process_batch,  # noqa: E402
                                read_dim_prod, read_fact, read_rejects, read_table, run_incremental)

try:  # the one place that allows for the subpackage being taken out
    from starloom.llm import queries as _llm
except ModuleNotFoundError as _missing:
    if not (_missing.name or "").startswith("starloom.llm"):
        raise
    _llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
RUN_TS = datetime(2025, 3, 31, 12, 0, 0, tzinfo=timezone.utc)  # one fixed run, so that the oracle can name it


NATURAL_FACT = ["order_number", "order_date", "customer_name", "state_id", "product_name", "category",
                "brand", "status_name", "employee_name", "unit_cost", "unit_sales", "quantity",
                "total_cost", "total_sales", "profit", "profit_margin"]

#: The natural key of each numbered dimension.
MEMBERS = {"dim_cust": ["customer_name"], "dim_emp": ["employee_name"], "dim_ostatus": ["status_name"],
           "dim_prod": ["product_name", "category", "brand"]}


# --------------------------------------------------------------------------- Spark side

#: Of rows landed for one query: a quarter smaller than with the star's own snappy.
SCRATCH = "zstd"

def _prep(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)


def _raw(spark, d, dirty=False) -> DataFrame:
    _prep(spark)
    return orders_from_tables(spark, d, dirty=dirty)


def _clean(spark, d, dirty=False) -> DataFrame:
    return preprocess(_raw(spark, d, dirty))


#: Numbers the rows of the landed extract.
ROW = "_row"


def _landed_at(df: DataFrame, path: str) -> DataFrame:
    """The rows written once as files, and read from there."""
    with shuffles_released(df.sparkSession):
        df.write.option("compression", SCRATCH).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as files of the shared folder."""
    return _landed_at(df, scratch_folder(df.sparkSession, name))


def _star(spark, d, dirty=False, path=None, **kw) -> dict[str, DataFrame]:
    # the adapter is a 5-way join and read twice: land its rows once
    numbered = _raw(spark, d, dirty).withColumn(ROW, F.monotonically_increasing_id())
    return build_star(_landed_at(numbered, path or scratch_folder(spark, "extract")), run_ts=RUN_TS, row_id=ROW, **kw)


def _shown(dim: DataFrame) -> DataFrame:
    """A dimension with its audit columns as UTC times without a zone, which
    both engines show alike."""
    return dim.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("create_date", "update_date")})


def q_raw_orders(spark, d):
    return _raw(spark, d)


def q_preprocess_orders(spark, d):
    return _clean(spark, d, dirty=True)


def q_preprocess_counts(spark, d):
    return preprocess_counts(_raw(spark, d, dirty=True))


def q_dim_date(spark, d, week_start="monday"):
    return build_dim_date(_clean(spark, d, dirty=True), week_start=week_start)


def q_dim_cust(spark, d):
    return _shown(build_dim_cust(_clean(spark, d, dirty=True), run_ts=RUN_TS))


def q_dim_emp(spark, d):
    return _shown(build_dim_emp(_clean(spark, d), run_ts=RUN_TS))


def q_dim_emp_first_seen(spark, d):
    return _shown(build_dim_emp(_clean(spark, d, dirty=True), run_ts=RUN_TS, key_order="first_seen",
                         seen_cols=["order_date", "order_number"]))


def q_surrogate_key_scalable(spark, d):
    _prep(spark)
    li = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    return number_rows(li.distinct(), ["l_orderkey", "l_linenumber"], "line_id")


def q_geo_lookup(spark, d):
    clean = _clean(spark, d)
    geo = build_dim_geo(spark).filter(F.col("country") == "India")
    out = lookup_key(clean, geo, {"state_code": "state_code"}, "state_id")
    return out.select(F.col("order_number").cast("int").alias("order_number"), "state_code",
                      F.coalesce("state_id", F.lit("-1")).alias("state_id"))


def q_product_cost_variants(spark, d):
    return distinct_count(_clean(spark, d, dirty=True), ["product", "category", "brand"], "cost",
                          "cost_variants")


def q_single_valued_cost(spark, d):
    sv = single_valued(_clean(spark, d, dirty=True), ["product", "category", "brand"], "cost",
                       "standard_cost")
    return sv.filter(F.col("standard_cost").isNotNull())


def q_dim_prod(spark, d):
    return _shown(build_dim_prod(_clean(spark, d, dirty=True), run_ts=RUN_TS))


def q_dim_ostatus(spark, d, dirty=False):
    return _shown(build_dim_status(_clean(spark, d, dirty=dirty), run_ts=RUN_TS))


def q_fact(spark, d, dirty=False, **kw):
    return _star(spark, d, dirty, **kw)["fact_orders"]


def q_fact_margin_unguarded(spark, d):
    raw = _stored(_raw(spark, d, dirty=True), "extract")
    star, clean = build_star(raw, run_ts=RUN_TS), preprocess(raw)
    dims = {k: v for k, v in star.items() if k != "fact_orders"}
    return build_fact_orders(clean, dims, margin="unguarded", fill=False)


def q_fact_preview(spark, d):
    fact = q_fact(spark, d)
    return fact.orderBy(*fact.columns).limit(5)


def q_key_uniqueness(spark, d):
    return Q.key_uniqueness(_star(spark, d))


def q_completeness(spark, d, which):
    star = _star(spark, d, dirty=True)
    cols = {"dims": Q.DIM_COMPLETENESS_COLUMNS, "fact": Q.FACT_COMPLETENESS_COLUMNS,
            "star": Q.DIM_COMPLETENESS_COLUMNS + Q.FACT_COMPLETENESS_COLUMNS}[which]
    return Q.completeness(star, cols)


def q_check(spark, d, fn):
    star = _star(spark, d, dirty=True)
    if fn is Q.check_all:  # it reads the fact three times: its lookups run once
        star["fact_orders"] = _stored(star["fact_orders"], "fact")
    return fn(star)


def q_incremental_fact(spark, d):
    """The extract landed as files, then loaded by the streaming job
    (readStream + foreachBatch, availableNow). One batch from empty targets
    numbers members exactly as the full build, so the fact equals
    ``fact_orders``. Files go under the shared checkpoint folder."""
    base = scratch_folder(spark, "incremental")
    _raw(spark, d).write.mode("overwrite").option("compression", SCRATCH).parquet(f"{base}/landing")
    run_incremental(spark, f"{base}/landing", f"{base}/star", f"{base}/stream-checkpoint",
                    source_format="parquet", run_ts=RUN_TS)
    return read_fact(spark, f"{base}/star")


def _turn(column) -> F.Column:
    """Which of three loads a row comes with: any split will do that SQL can name too."""
    return F.pmod(F.coalesce(column.cast("int"), F.lit(0)), F.lit(3))


def _landed(spark, d, name: str) -> tuple[str, list[int]]:
    """All rows of the dirty extract as files, in a folder for each of three
    turns (every task writes its own), and the number of files of each."""
    base = scratch_folder(spark, name)
    raw = _raw(spark, d, dirty=True)
    raw.withColumn("turn", _turn(F.col("Quantity"))).write.partitionBy("turn").option(
        "compression", SCRATCH).parquet(f"{base}/landing")
    return base, [len(spark.read.parquet(f"{base}/landing/turn={k}").inputFiles()) for k in range(3)]


def _loaded_in_batches(spark, d, **options) -> str:
    """The three turns dealt to two sources: the first one loaded in two
    micro-batches, the second one with a checkpoint of its own."""
    base, files = _landed(spark, d, "batches")
    for k, (turns, at_once) in enumerate((("turn=[01]", max(files[:2])), ("turn=2", None))):
        run_incremental(spark, f"{base}/landing/{turns}", f"{base}/star", f"{base}/checkpoint{k}",
                        source_format="parquet", max_files_per_trigger=at_once, run_ts=RUN_TS, **options)
    return f"{base}/star"


def _loaded_at_once(spark, d) -> str:
    """The three turns as three sources, loaded at the same time into one star.
    Their members overlap, so commits collide and the later ones start again."""
    base, _ = _landed(spark, d, "at-once")
    with ThreadPoolExecutor(max_workers=3) as pool:
        for f in [pool.submit(run_incremental, spark, f"{base}/landing/turn={k}", f"{base}/star",
                              f"{base}/checkpoint{k}", source_format="parquet", run_ts=RUN_TS) for k in range(3)]:
            f.result()
    return f"{base}/star"


def _natural_fact(spark, root: str) -> DataFrame:
    """The fact with natural keys in place of surrogate ones."""
    def dim(name, *cols):  # no broadcast beyond the lookups' bounds, and no merge below them
        return bounded_broadcast(read_table(spark, root, name).select(*cols))[0]

    fact = read_fact(spark, root)
    fact = fact.join(dim("dim_cust", "customer_id", "customer_name"), "customer_id", "left")
    fact = fact.join(dim("dim_prod", "product_id", "product_name", "category", "brand"), "product_id", "left")
    fact = fact.join(dim("dim_ostatus", "status_id", "status_name"), "status_id", "left")
    fact = fact.join(dim("dim_emp", "employee_id", "employee_name"), "employee_id", "left")
    return fact.select(*NATURAL_FACT)


def q_incremental_multi_batch(spark, d):
    """The fact of three batches from two sources, by natural keys."""
    return _natural_fact(spark, _loaded_in_batches(spark, d))


def q_incremental_dim_prod(spark, d):
    """The products' costs after three batches, as the full build has them."""
    return read_dim_prod(spark, _loaded_in_batches(spark, d)).select(
        "product_name", "category", "brand", "standard_cost")


def q_concurrent_loads(spark, d):
    """The fact of three loads that ran at once, by natural keys."""
    return _natural_fact(spark, _loaded_at_once(spark, d))


def q_concurrent_load_keys(spark, d):
    """Rows, distinct keys and distinct members of each numbered dimension
    after three loads that ran at once, and the highest key."""
    root, out = _loaded_at_once(spark, d), None
    for name, members in MEMBERS.items():
        key = C.STAR[name].primary_key
        row = read_table(spark, root, name).agg(
            F.count(F.lit(1)).alias("row_count"), F.count_distinct(key).alias("distinct_keys"),
            F.count_distinct(*members).alias("distinct_members"), F.max(key).alias("highest_key")).select(
                F.lit(name).alias("table_name"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def q_stream_quarantine(spark, d):
    """What became of every record of a CSV extract with unreadable order
    numbers, loaded as a stream: read = loaded + malformed + no_order_number."""
    base = scratch_folder(spark, "quarantine")
    raw = _raw(spark, d, dirty=True)
    text = raw.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in raw.columns])
    broken = F.pmod(F.col("Quantity").cast("double").cast("int"), F.lit(7)) == 3
    text = text.withColumn("Order_Number", F.when(broken, F.concat(F.coalesce("Order_Number", F.lit("")), F.lit("x")))
                           .otherwise(F.col("Order_Number")))
    # half the size for no more time than plain text; one file a task, so the readers stay as many
    text.write.option("header", True).option("compression", "lz4").csv(f"{base}/landing")
    run_incremental(spark, f"{base}/landing", f"{base}/star", f"{base}/checkpoint", run_ts=RUN_TS)
    counts = load_counts(spark, f"{base}/star").select(F.explode(F.create_map(
        F.lit("read"), "read", F.lit("loaded"), "loaded", F.lit("rejected"), "rejected")).alias("outcome", "n"))
    reasons = read_rejects(spark, f"{base}/star").select(F.explode("reasons").alias("outcome"))
    return counts.unionByName(reasons.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")))


def q_rules_at_load(spark, d):
    """Rows that break each rule of the fact, found while they are loaded."""
    base = scratch_folder(spark, "rules")
    process_batch(_raw(spark, d, dirty=True), 0, f"{base}/star", on_violation="quarantine", run_ts=RUN_TS)
    broken = read_rejects(spark, f"{base}/star").where(F.col("file").isNull()).select(F.explode("reasons").alias("rule"))
    return broken.where("rule != 'no_order_number'").groupBy("rule").agg(F.count(F.lit(1)).alias("violations"))


def q_completeness_by_load(spark, d):
    """The completeness report from the counts that three loads have left."""
    return completeness_so_far(spark, _loaded_in_batches(spark, d))


def q_key_uniqueness_by_load(spark, d):
    """Rows and distinct keys from the counts that three loads have kept."""
    return key_uniqueness_so_far(spark, _loaded_in_batches(spark, d, track_keys=True))


def q_product_upserts(spark, d):
    """Products after three loads, one a day, whose costs change on the way:
    an update moves ``update_date`` of exactly the products that it changes."""
    base = scratch_folder(spark, "upserts")
    raw = _raw(spark, d, dirty=True)
    later = (_turn(F.col("Quantity")) > 0) & (F.pmod(F.col("Quantity").cast("int"), F.lit(5)) == 0)
    raw = raw.withColumn("Cost", F.when(later, F.col("Cost") + 1).otherwise(F.col("Cost")))
    raw.withColumn("turn", _turn(F.col("Quantity"))).write.partitionBy("turn").option(
        "compression", SCRATCH).parquet(f"{base}/landing")
    for k in range(3):
        rows = spark.read.schema(raw.schema).parquet(f"{base}/landing/turn={k}")
        process_batch(rows, k, f"{base}/star", run_ts=RUN_TS + timedelta(days=k))
    return _shown(read_dim_prod(spark, f"{base}/star")).drop("product_id")


def q_table_bookmark(spark, d):
    """A catalog table loaded twice, a partition having come in between, and a
    third time with nothing new: its rows by natural keys."""
    base, name = scratch_folder(spark, "bookmark"), f"starloom_extract_{uuid.uuid4().hex}"
    raw = _raw(spark, d, dirty=True).withColumn("turn", _turn(F.col("Quantity")))
    raw.write.partitionBy("turn").option("compression", SCRATCH).parquet(f"{base}/rows")
    columns = ", ".join(f"`{c}` {t}" for c, t in raw.dtypes)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (turn) LOCATION '{base}/table'")
    try:
        for turns in ([0, 1], [2], []):
            for k in turns:  # a partition's files become the table's where they are
                if exists(spark, f"{base}/rows/turn={k}"):
                    spark.sql(f"ALTER TABLE {name} ADD PARTITION (turn={k}) LOCATION '{base}/rows/turn={k}'")
            load_table(spark, name, f"{base}/star", run_ts=RUN_TS)
    finally:
        spark.sql(f"DROP TABLE {name}")
    return _natural_fact(spark, f"{base}/star")


def q_published_versions(spark, d):
    """Two stars published one after the other, each in one step: the fact of
    both versions, the earlier one read after the later was there."""
    root, out = scratch_folder(spark, "published"), None
    _prep(spark)
    lines = _stored(joined_lines(spark, d), "lines")  # both extracts are projections of the same rows
    first = publish_star(spark, build_star(with_defects(lines), run_ts=RUN_TS), root)
    publish_star(spark, build_star(with_defects(lines, dirty=True), run_ts=RUN_TS), root, expect=first.version)
    for version in (1, 2):
        fact = read_star(spark, root, version)["fact_orders"].withColumn("version", F.lit(version))
        out = fact if out is None else out.unionByName(fact)
    return out


def _in_small_parts(spark, d, parts: int = 12) -> str:
    """The fact as that many parts of a star, as that many loads would leave it."""
    root, extract = scratch_folder(spark, "upkeep"), scratch_folder(spark, "extract")
    publish_star(spark, {"fact_orders": _star(spark, d, path=extract)["fact_orders"]}, f"{root}/whole",
                 compression=SCRATCH)
    delete(spark, extract)
    whole = read_star(spark, f"{root}/whole", names=["fact_orders"])["fact_orders"]
    log = StarLog(spark, f"{root}/star")
    for k in range(parts):
        part = log.write_part(whole.where(F.pmod(F.col("order_number"), F.lit(parts)) == k), "fact_orders")
        log.update("load", lambda now, p=part: now.with_parts({"fact_orders": [p] if p else []}))
    delete(spark, f"{root}/whole")
    return f"{root}/star"


def q_compacted_fact(spark, d):
    """The fact after many small parts have been put together."""
    root = _in_small_parts(spark, d)
    compact(spark, root, "fact_orders")
    return read_fact(spark, root)


def q_clustered_point(spark, d):
    """The orders of one product on the first day that it was ordered, from a
    fact clustered on (order_date, product_id) by interleaved bits."""
    root = _in_small_parts(spark, d)
    compact(spark, root, "fact_orders", target_bytes=256 << 10, cluster_by=["order_date", "product_id"],
            interleave=True, everything=True)
    fact = read_fact(spark, root)
    first = fact.where("product_id = 7").agg(F.min("order_date").alias("order_date"))
    return fact.where("product_id = 7").join(F.broadcast(first), "order_date").select(*fact.columns)


def q_ddl_tables(spark, d):
    """The star loaded into tables made from the DDL, whose lengths are enforced
    (the extract's categories are cut to fit), and the products read back: their
    audit columns have the table's default."""
    base, database = scratch_folder(spark, "ddl"), f"starloom_{uuid.uuid4().hex}"
    _raw(spark, d).withColumn("Category", F.substring("Category", 1, 15)).write.parquet(f"{base}/extract")
    star = build_star(spark.read.parquet(f"{base}/extract"), run_ts=RUN_TS)
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}/tables'")
    try:
        create_star_tables(spark, database=database)
        write_star(star, base, "table", database=database)
        spark.sql(f"INSERT INTO {database}.dim_prod (product_id, product_name, category, brand, standard_cost) "
                  "VALUES (0, 'one more', 'by hand', 'none', 0.0)")
        products = spark.table(f"{database}.dim_prod")
        stamped = (F.col("create_date") == F.lit(RUN_TS)) | (
            (F.col("product_id") == 0) & (F.abs(F.timestamp_diff("HOUR", F.col("create_date"), F.current_timestamp())) < 2))
        sold = spark.table(f"{database}.fact_orders").groupBy("product_id").agg(
            F.count(F.lit(1)).alias("orders"), F.sum("quantity").alias("quantity"))
        out = products.select(*C.DIM_PROD.names[:5], stamped.alias("stamped")).join(sold, "product_id", "left")
        out.write.parquet(f"{base}/result")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.read.parquet(f"{base}/result")


def q_job_reports(spark, d):
    """The whole job: extract in files, star published, report written as CSV
    and read back."""
    base = scratch_folder(spark, "job")
    _raw(spark, d, dirty=True).write.parquet(f"{base}/landing")
    done = run_job(spark, f"{base}/landing", f"{base}/star", source_format="parquet",
                   target_format="snapshot", run_ts=RUN_TS)
    return spark.read.option("header", True).schema(
        "column_name string, table_name string, total_records long, null_count long, "
        "null_percentage double, null_share double").csv(f"{done['reports']}/completeness")


def q_csv_round_trip(spark, d):
    """The extract written as CSV with its columns in another order, read back by name."""
    raw = _raw(spark, d, dirty=True)
    path = scratch_folder(spark, "csv")
    raw.select(*[F.col(f"`{c}`") for c in reversed(raw.columns)]).write.option("header", True).csv(path)
    return read_raw_csv(spark, path)


#: In how many buckets two tables are compared: as few numbers come to the driver.
_BUCKETS = 1024


def _united(a: DataFrame, b: DataFrame) -> DataFrame:
    """Every row as often as the one of the two that has it more often (what
    intersectAll and exceptAll both ways make together). A first pass deals the
    rows to buckets and compares what both have there: how many rows, and the sums
    of two 64-bit hashes of them. Where all agree, these are ``b``'s rows; those of
    the other buckets are compared themselves, in one shuffle."""
    both = a.withColumn("_in_a", F.lit(1)).unionByName(b.withColumn("_in_a", F.lit(0)))
    content = [F.col(f"`{c}`") for c in a.columns]  # a hash passes over NULLs, so where they are is hashed too
    hashes = [F.xxhash64(F.lit(k), *content, *[c.isNull() for c in content]) for k in range(2)]
    bucket = F.pmod(hashes[0], F.lit(_BUCKETS))
    halves = [half for h in hashes for half in (h.bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(h, 32))]
    sign = 2 * F.col("_in_a") - 1
    sums = both.groupBy(bucket.alias("_bucket")).agg(F.array(F.sum(sign), *[F.sum(sign * h) for h in halves]).alias("_s"))
    odd = [r[0] for r in sums.where(F.exists("_s", lambda s: s != 0)).select("_bucket").collect()]
    same = b.where(~bucket.isin(odd)) if odd else b
    # grouped rows have 0.0 for -0.0
    same = same.select(*[(F.col(f"`{c}`") + F.lit(0).cast(t)).alias(c) if t in ("double", "float") else F.col(f"`{c}`")
                         for c, t in b.select(*a.columns).dtypes])
    if not odd:
        return same
    times = both.where(bucket.isin(odd)).groupBy(*a.columns).agg(
        F.greatest(F.sum("_in_a"), F.sum(1 - F.col("_in_a"))).cast("int").alias("_times"))
    return same.unionByName(
        times.select(*a.columns, F.explode(F.sequence(F.lit(1), "_times")).alias("_copy")).drop("_copy"))


def q_star_round_trip(spark, d, fmt):
    """The star written to files, dimensions first, and the fact read back."""
    path, extract = scratch_folder(spark, "star"), scratch_folder(spark, "extract")
    write_star(_star(spark, d, dirty=True, path=extract), path, fmt, csv_compression="gzip" if fmt == "both" else "none")
    delete(spark, extract)
    reader = spark.read.schema(C.FACT_ORDERS.schema)
    if fmt == "both":
        # what each of the two formats holds and the other doesn't, and what both hold
        return _united(reader.option("header", True).csv(f"{path}/csv/fact_orders"),
                       reader.parquet(f"{path}/parquet/fact_orders"))
    return (reader.option("header", True).csv if fmt == "csv" else reader.parquet)(f"{path}/fact_orders")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the order fact table at sf0.001."""
    return q_fact(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "raw_orders": q_raw_orders,
        "preprocess_orders": q_preprocess_orders,
        "preprocess_counts": q_preprocess_counts,
        "dim_date": q_dim_date,
        "dim_date_sunday": partial(q_dim_date, week_start="sunday"),
        "dim_cust": q_dim_cust,
        "dim_emp": q_dim_emp,
        "dim_emp_first_seen": q_dim_emp_first_seen,
        "surrogate_key_scalable": q_surrogate_key_scalable,
        "geo_lookup": q_geo_lookup,
        "product_cost_variants": q_product_cost_variants,
        "single_valued_cost": q_single_valued_cost,
        "dim_prod": q_dim_prod,
        "dim_ostatus": q_dim_ostatus,
        "status_unmapped": partial(q_dim_ostatus, dirty=True),
        "product_last_wins": partial(q_fact, product_match="last_wins"),
        "fact_orders": q_fact,
        "fact_orders_dirty": partial(q_fact, dirty=True),
        # the large-dimension paths, forced at test scale: same result as fact_orders
        "fact_orders_shuffled": partial(q_fact, broadcast_max_rows=0),
        "fact_orders_salted": partial(q_fact, dirty=True, broadcast_max_rows=0, salt_buckets=8),
        "fact_orders_hot_salted": partial(q_fact, dirty=True, broadcast_max_rows=0,
                                          salt_buckets=8, hot_share=0.05),
        "fact_orders_together": partial(q_fact, dirty=True, broadcast_max_rows=0, lookups="together"),
        "fact_margin_unguarded": q_fact_margin_unguarded,
        "incremental_fact": q_incremental_fact,
        "incremental_multi_batch": q_incremental_multi_batch,
        "incremental_dim_prod": q_incremental_dim_prod,
        "concurrent_loads": q_concurrent_loads,
        "concurrent_load_keys": q_concurrent_load_keys,
        "stream_quarantine": q_stream_quarantine,
        "rules_at_load": q_rules_at_load,
        "completeness_by_load": q_completeness_by_load,
        "key_uniqueness_by_load": q_key_uniqueness_by_load,
        "product_upserts": q_product_upserts,
        "table_bookmark": q_table_bookmark,
        "published_versions": q_published_versions,
        "compacted_fact": q_compacted_fact,
        "clustered_point": q_clustered_point,
        "ddl_tables": q_ddl_tables,
        "job_reports": q_job_reports,
        "csv_round_trip": q_csv_round_trip,
        "star_parquet_round_trip": partial(q_star_round_trip, fmt="parquet"),
        "star_csv_round_trip": partial(q_star_round_trip, fmt="csv"),
        "star_both_round_trip": partial(q_star_round_trip, fmt="both"),
        "fact_preview": q_fact_preview,
        "key_uniqueness": q_key_uniqueness,
        "completeness_dims": partial(q_completeness, which="dims"),
        "completeness_fact": partial(q_completeness, which="fact"),
        "completeness_star": partial(q_completeness, which="star"),
        "check_not_null": partial(q_check, fn=Q.check_not_null),
        "check_primary_key": partial(q_check, fn=Q.check_primary_key),
        "check_foreign_keys": partial(q_check, fn=Q.check_foreign_keys),
        "check_ranges": partial(q_check, fn=Q.check_ranges),
        "check_lengths": partial(q_check, fn=Q.check_lengths),
        "check_all": partial(q_check, fn=Q.check_all),
        **(_llm.QUERIES if _llm else {}),
    }


# --------------------------------------------------------------------------- DuckDB oracle

# The warehouse DDL once more, so that the oracle doesn't take a
# rule from the library that it checks.
_DDL = {
    "dim_cust": "customer_id INTEGER NOT NULL, customer_name VARCHAR(100), first_name VARCHAR(50), "
                "last_name VARCHAR(50), create_date TIMESTAMP NOT NULL, update_date TIMESTAMP",
    "dim_date": "date_full DATE NOT NULL, day_of_week INTEGER NOT NULL, day_name VARCHAR(10) NOT NULL, "
                "day_of_month INTEGER NOT NULL, day_of_year INTEGER NOT NULL, week_of_year INTEGER NOT NULL, "
                "month_num INTEGER NOT NULL, month_name VARCHAR(10) NOT NULL, quarter INTEGER NOT NULL, "
                "year INTEGER NOT NULL, is_weekend BOOLEAN NOT NULL",
    "dim_emp": "employee_id INTEGER NOT NULL, employee_name VARCHAR(100), employee_first_name VARCHAR(50), "
               "employee_last_name VARCHAR(50), create_date TIMESTAMP NOT NULL, update_date TIMESTAMP",
    "dim_geo": "state_id VARCHAR(40) NOT NULL, state_code VARCHAR(2) NOT NULL, country VARCHAR(30) NOT NULL, "
               "state_name VARCHAR(50) NOT NULL, capital_city VARCHAR(50), status VARCHAR(30), iso_code VARCHAR(10)",
    "dim_ostatus": "status_id INTEGER NOT NULL, status_name VARCHAR(15) NOT NULL, status_description VARCHAR(50), "
                   "create_date TIMESTAMP NOT NULL, update_date TIMESTAMP",
    "dim_prod": "product_id INTEGER NOT NULL, product_name VARCHAR(30) NOT NULL, category VARCHAR(15) NOT NULL, "
                "brand VARCHAR(20) NOT NULL, standard_cost FLOAT NOT NULL, create_date TIMESTAMP NOT NULL, "
                "update_date TIMESTAMP",
    "fact_orders": "order_number INTEGER NOT NULL, order_date DATE NOT NULL, customer_id INTEGER NOT NULL, "
                   "state_id VARCHAR(40) NOT NULL, product_id INTEGER NOT NULL, status_id INTEGER NOT NULL, "
                   "employee_id INTEGER NOT NULL, unit_cost FLOAT NOT NULL, unit_sales FLOAT NOT NULL, "
                   "quantity INTEGER NOT NULL, total_cost FLOAT NOT NULL, total_sales FLOAT NOT NULL, "
                   "profit FLOAT NOT NULL, profit_margin FLOAT NOT NULL",
}
_PRIMARY_KEYS = {"dim_cust": "customer_id", "dim_date": "date_full", "dim_emp": "employee_id", "dim_geo": "state_id",
                 "dim_ostatus": "status_id", "dim_prod": "product_id", "fact_orders": "order_number"}
_REFERENCES = {"order_date": ("dim_date", "date_full"), "customer_id": ("dim_cust", "customer_id"),
               "state_id": ("dim_geo", "state_id"), "product_id": ("dim_prod", "product_id"),
               "status_id": ("dim_ostatus", "status_id"), "employee_id": ("dim_emp", "employee_id")}
_CHECKS = [("dim_date", "check_day_of_week", "day_of_week BETWEEN 1 AND 7"),
           ("dim_date", "check_month_num", "month_num BETWEEN 1 AND 12"),
           ("dim_date", "check_quarter", "quarter BETWEEN 1 AND 4"),
           ("fact_orders", "check_quantity_positive", "quantity > 0"),
           ("fact_orders", "check_profit_margin", "profit_margin >= -1 AND profit_margin <= 1")]


def _columns(table: str) -> list[tuple[str, str, bool]]:
    """(name, type, not null) by the DDL."""
    specs = [c.strip().split(" ", 2) for c in _DDL[table].split(",")]
    return [(c[0], c[1], c[2:] == ["NOT NULL"]) for c in specs]


_AUDIT = ("TIMESTAMP '2025-03-31 12:00:00' AS create_date, "
          "TIMESTAMP '2025-03-31 12:00:00' AS update_date")


def _lit(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def _sql_raw(dirty: bool, category: str = "p.p_type") -> str:
    codes = ", ".join(_lit(c) for c in STATE_CODES)
    ts = "l.l_extendedprice * (1 - l.l_discount)"
    cust = "replace(c.c_name, '#', ' ')"
    date = "strftime(CAST(o.o_orderdate AS DATE), '%d/%m/%Y')"
    status = ("CASE WHEN o.o_orderstatus = 'O' THEN 'Order' WHEN o.o_orderstatus = 'P' "
              "THEN 'Processing' WHEN l.l_linestatus = 'O' THEN 'Shipped' ELSE 'Delivered' END")
    cost, qty, total_sales = "p.p_retailprice", "l.l_quantity", ts
    if dirty:
        h = "(l.l_orderkey * 7 + l.l_linenumber)"
        cust = f"CASE WHEN {h} % 89 = 0 THEN NULL ELSE {cust} END"
        date = (f"CASE WHEN {h} % 103 = 0 THEN '31/02/2024' WHEN {h} % 107 = 0 THEN NULL "
                f"ELSE {date} END")
        status = f"CASE WHEN {h} % 83 = 0 THEN 'Returned' ELSE {status} END"
        cost = f"CASE WHEN {h} % 79 = 0 THEN NULL ELSE {cost} END"
        qty = f"CASE WHEN {h} % 113 = 0 THEN 0.0 ELSE {qty} END"
        total_sales = (f"CASE WHEN {h} % 101 = 0 THEN 0.0 WHEN {h} % 109 = 0 THEN NULL "
                       f"WHEN {h} % 127 = 0 THEN -({ts}) ELSE {ts} END")
    return f"""
SELECT
  CASE WHEN (l.l_orderkey + l.l_linenumber) % 97 = 0 THEN NULL
       ELSE CAST(l.l_orderkey AS DOUBLE) END AS "Order_Number",
  [{codes}][c.c_nationkey % 5 + 1] AS "State_Code",
  {cust} AS "Customer_Name",
  {date} AS "Order_Date",
  {status} AS "Status",
  p.p_name AS "Product", {category} AS "Category", p.p_brand AS "Brand",
  {cost} AS "Cost",
  CASE WHEN l.l_quantity = 0 THEN NULL ELSE l.l_extendedprice / l.l_quantity END AS "Sales",
  {qty} AS "Quantity",
  p.p_retailprice * l.l_quantity AS "Total_Cost",
  {total_sales} AS "Total_Sales",
  replace(s.s_name, '#', ' ') AS "Assigned Supervisor"
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey"""


_SQL_CLEAN = """
SELECT "Order_Number" AS order_number, "State_Code" AS state_code,
  "Customer_Name" AS customer_name,
  CAST(try_strptime("Order_Date", '%d/%m/%Y') AS DATE) AS order_date,
  "Status" AS status, "Product" AS product, "Category" AS category, "Brand" AS brand,
  "Cost" AS cost, "Sales" AS sales, "Quantity" AS quantity, "Total_Cost" AS total_cost,
  "Total_Sales" AS total_sales, "Assigned Supervisor" AS "assigned supervisor"
FROM raw
WHERE "Order_Number" IS NOT NULL AND NOT isnan("Order_Number")"""


def _sql_names(col: str) -> tuple[str, str]:
    space = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
    trimmed = f"regexp_replace({col}, '^{space}+|{space}+$', '', 'g')"
    tok = f"string_split_regex({trimmed}, '{space}+')"
    cond = f"{trimmed} <> ''"
    return (f"CASE WHEN {cond} THEN {tok}[1] END", f"CASE WHEN {cond} THEN {tok}[-1] END")


def _sql_dim_date(week_start: str) -> str:
    dow = "isodow(date_full)" if week_start == "monday" else "dayofweek(date_full) + 1"
    return f"""
SELECT date_full, CAST({dow} AS INTEGER) AS day_of_week, dayname(date_full) AS day_name,
  CAST(dayofmonth(date_full) AS INTEGER) AS day_of_month,
  CAST(dayofyear(date_full) AS INTEGER) AS day_of_year,
  CAST(weekofyear(date_full) AS INTEGER) AS week_of_year,
  CAST(month(date_full) AS INTEGER) AS month_num, monthname(date_full) AS month_name,
  CAST(quarter(date_full) AS INTEGER) AS quarter, CAST(year(date_full) AS INTEGER) AS year,
  isodow(date_full) IN (6, 7) AS is_weekend
FROM (SELECT DISTINCT order_date AS date_full FROM clean WHERE order_date IS NOT NULL)"""


def _sql_person(src: str, id_col: str, name: str, first: str, last: str,
                first_seen: bool = False) -> str:
    f, la = _sql_names(name)
    if first_seen:
        members = f"""
SELECT {src} AS {name},
  min({{'d': order_date, 'n': order_number}}) FILTER (WHERE order_date IS NOT NULL) AS _f
FROM clean WHERE {src} IS NOT NULL GROUP BY {src}"""
        order = f"_f.d NULLS FIRST, _f.n NULLS FIRST, {name}"
    else:
        members = f"SELECT DISTINCT {src} AS {name} FROM clean WHERE {src} IS NOT NULL"
        order = name
    return f"""
SELECT CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS {id_col}, {name},
  {f} AS {first}, {la} AS {last}, {_AUDIT}
FROM ({members})"""


def _sql_dim_geo() -> str:
    rows = ",\n  ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in geo_rows())
    h = "sha256(concat_ws('|', country, iso_code))"
    sid = (f"substr({h},1,8) || '-' || substr({h},9,4) || '-' || substr({h},13,4) || '-' || "
           f"substr({h},17,4) || '-' || substr({h},21,12)")
    return f"""
SELECT {sid} AS state_id, state_code, country, state_name, capital_city, status, iso_code
FROM (VALUES
  {rows}
) AS g(state_code, country, state_name, capital_city, status, iso_code)"""


_SQL_DIM_PROD = """
SELECT CAST(row_number() OVER (ORDER BY product, category, brand) AS INTEGER) AS product_id,
  product AS product_name, category, brand,
  COALESCE(CASE WHEN count(DISTINCT cost) = 1 THEN max(cost) END, 0.0) AS standard_cost, """ + _AUDIT + """
FROM clean
WHERE product IS NOT NULL AND category IS NOT NULL AND brand IS NOT NULL
GROUP BY product, category, brand"""


def _sql_dim_status() -> str:
    whens = " ".join(f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in STATUS_DESCRIPTIONS.items())
    return f"""
SELECT CAST(row_number() OVER (ORDER BY status) AS INTEGER) AS status_id,
  status AS status_name,
  COALESCE(CASE status {whens} END, {_lit(UNKNOWN_STATUS)}) AS status_description, {_AUDIT}
FROM (SELECT DISTINCT status FROM clean WHERE status IS NOT NULL)"""


def _fill(expr: str, fill: bool, value: str) -> str:
    return f"COALESCE({expr}, {value})" if fill else expr


def _fill_dbl(expr: str, fill: bool) -> str:
    if not fill:
        return expr
    return f"CASE WHEN {expr} IS NULL OR isnan({expr}) THEN 0.0 ELSE {expr} END"


def _sql_fact(product_match: str = "triple", margin: str = "guarded", fill: bool = True) -> str:
    if product_match == "triple":
        pj = ("LEFT JOIN dim_prod p ON c.product = p.product_name AND c.category = p.category "
              "AND c.brand = p.brand")
    else:  # last_wins
        pj = ("LEFT JOIN (SELECT product_name, max(product_id) AS product_id FROM dim_prod "
              "GROUP BY product_name) p ON c.product = p.product_name")
    ts, tc = "c.total_sales", "c.total_cost"
    if margin == "guarded":
        m = f"CASE WHEN {ts} > 0 THEN ({ts} - {tc}) / {ts} ELSE 0.0 END"
    else:
        m = f"CASE WHEN {ts} = 0 THEN NULL ELSE ({ts} - {tc}) / {ts} END"
    return f"""
SELECT CAST(c.order_number AS INTEGER) AS order_number, c.order_date,
  {_fill('dc.customer_id', fill, '-1')} AS customer_id,
  {_fill('g.state_id', fill, "'-1'")} AS state_id,
  {_fill('p.product_id', fill, '-1')} AS product_id,
  {_fill('s.status_id', fill, '-1')} AS status_id,
  {_fill('e.employee_id', fill, '-1')} AS employee_id,
  {_fill_dbl('c.cost', fill)} AS unit_cost,
  {_fill_dbl('c.sales', fill)} AS unit_sales,
  CAST(c.quantity AS INTEGER) AS quantity,
  {_fill_dbl(tc, fill)} AS total_cost,
  {_fill_dbl(ts, fill)} AS total_sales,
  {_fill_dbl(f'({ts} - {tc})', fill)} AS profit,
  {_fill_dbl(f'({m})', fill)} AS profit_margin
FROM clean c
LEFT JOIN dim_cust dc ON c.customer_name = dc.customer_name
LEFT JOIN (SELECT state_code, state_id FROM dim_geo WHERE country = 'India') g
  ON c.state_code = g.state_code
{pj}
LEFT JOIN dim_ostatus s ON c.status = s.status_name
LEFT JOIN dim_emp e ON c."assigned supervisor" = e.employee_name"""


def _ctes(dirty: bool, star: bool = True, fact: str | None = None, **raw: str) -> str:
    parts = [f"raw AS ({_sql_raw(dirty, **raw)})", f"clean AS ({_SQL_CLEAN})"]
    if star:
        parts += [
            f"dim_date AS ({_sql_dim_date('monday')})",
            "dim_cust AS (" + _sql_person("customer_name", "customer_id", "customer_name",
                                          "first_name", "last_name") + ")",
            "dim_emp AS (" + _sql_person('"assigned supervisor"', "employee_id",
                                         "employee_name", "employee_first_name",
                                         "employee_last_name") + ")",
            f"dim_geo AS ({_sql_dim_geo()})",
            f"dim_prod AS ({_SQL_DIM_PROD})",
            f"dim_ostatus AS ({_sql_dim_status()})",
            f"fact_orders AS ({fact or _sql_fact()})",
        ]
    return "WITH " + ",\n".join(parts) + "\n"


def _sql_not_null() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'not_null' AS rule, '{c}' AS column_name, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS violations FROM {t}"
        for t in _DDL for c, _, required in _columns(t) if required)


def _sql_primary_key() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'primary_key' AS rule, '{k}' AS column_name, "
        f"CAST(COALESCE(sum(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) AS violations "
        f"FROM (SELECT {k}, count(*) AS n FROM {t} GROUP BY {k})" for t, k in _PRIMARY_KEYS.items())


def _sql_foreign_keys() -> str:
    sel = []
    for k, (dt, dc) in _REFERENCES.items():
        orphan = f"f.{k} IS NOT NULL AND d.{dc} IS NULL"
        for rule, cond in (("foreign_key", "<>"), ("foreign_key_unassigned", "=")):
            sel.append(
                f"SELECT 'fact_orders' AS table_name, '{rule}' AS rule, '{k}' AS column_name, "
                f"count(*) FILTER (WHERE {orphan} AND CAST(f.{k} AS VARCHAR) {cond} '-1') "
                f"AS violations FROM fact_orders f LEFT JOIN {dt} d ON f.{k} = d.{dc}")
    return "\nUNION ALL ".join(sel)


def _sql_ranges() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{rule}' AS rule, CAST(NULL AS VARCHAR) AS column_name, "
        f"count(*) FILTER (WHERE NOT ({pred})) AS violations FROM {t}" for t, rule, pred in _CHECKS)


def _sql_lengths() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'max_length' AS rule, '{c}' AS column_name, "
        f"count(*) FILTER (WHERE strlen({c}) > {kind[8:-1]}) AS violations FROM {t}"
        for t in _DDL for c, kind, _ in _columns(t) if kind.startswith("VARCHAR("))


def _sql_completeness(cols: list[tuple[str, str]]) -> str:
    sel = []
    for col, t in cols:
        kind = next(k for c, k, _ in _columns(t) if c == col)
        miss = f"{col} IS NULL" + (f" OR isnan({col})" if kind == "FLOAT" else "")
        sel.append(f"SELECT '{col}' AS column_name, '{t}' AS table_name, "
                   f"count(*) FILTER (WHERE NOT ({miss})) AS total_records, "
                   f"count(*) FILTER (WHERE {miss}) AS null_count FROM {t}")
    body = "\nUNION ALL ".join(sel)
    return f"""
SELECT column_name, table_name, total_records, null_count,
  CASE WHEN total_records = 0 THEN NULL
       ELSE round_even(100.0 * null_count / total_records, 2) END AS null_percentage,
  CASE WHEN total_records + null_count = 0 THEN NULL
       ELSE round_even(100.0 * null_count / (null_count + total_records), 2) END AS null_share
FROM ({body})"""


def _sql_key_uniqueness() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{k}' AS key_column, count(*) AS row_count, "
        f"count(DISTINCT {k}) AS distinct_keys FROM {t}" for t, k in _PRIMARY_KEYS.items())


def _sql_natural_fact() -> str:
    return (f"SELECT {', '.join(NATURAL_FACT)} FROM fact_orders f "
            "LEFT JOIN dim_cust c ON c.customer_id = f.customer_id "
            "LEFT JOIN dim_prod p ON p.product_id = f.product_id "
            "LEFT JOIN dim_ostatus s ON s.status_id = f.status_id "
            "LEFT JOIN dim_emp e ON e.employee_id = f.employee_id")


def _sql_member_keys() -> str:
    keys = {"dim_cust": "customer_id", "dim_emp": "employee_id", "dim_ostatus": "status_id", "dim_prod": "product_id"}
    return "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, count(DISTINCT {k}) AS distinct_keys, "
        f"count(DISTINCT ({', '.join(MEMBERS[t])})) AS distinct_members, CAST(count(*) AS INTEGER) AS highest_key FROM {t}"
        for t, k in keys.items())


def _sql_quarantine() -> str:
    broken = "CAST(\"Quantity\" AS INTEGER) % 7 = 3"
    none = "(\"Order_Number\" IS NULL OR isnan(\"Order_Number\"))"
    return f"""WITH raw AS ({_sql_raw(True)}),
o AS (SELECT CASE WHEN {broken} THEN 'malformed' WHEN {none} THEN 'no_order_number' ELSE 'loaded' END AS outcome FROM raw)
SELECT outcome, count(*) AS n FROM o GROUP BY outcome
UNION ALL SELECT 'read', count(*) FROM o UNION ALL SELECT 'rejected', count(*) FROM o WHERE outcome <> 'loaded'"""


def _sql_rules_at_load() -> str:
    rows = " UNION ALL ".join(f"SELECT * FROM ({q})" for q in (_sql_not_null(), _sql_ranges(), _sql_lengths()))
    return (f"SELECT CASE WHEN column_name IS NULL THEN rule ELSE rule || ':' || column_name END AS rule, violations "
            f"FROM ({rows}) WHERE table_name = 'fact_orders' AND violations > 0")


def _sql_upserts() -> str:
    day = "TIMESTAMP '2025-03-31 12:00:00' + INTERVAL 1 DAY * CAST({} AS INTEGER)"
    return f"""WITH raw AS ({_sql_raw(True)}), clean AS ({_SQL_CLEAN}),
p AS (SELECT product, category, brand, CAST(quantity AS INTEGER) % 3 AS turn,
  CASE WHEN CAST(quantity AS INTEGER) % 3 > 0 AND CAST(quantity AS INTEGER) % 5 = 0 THEN cost + 1 ELSE cost END AS cost
  FROM clean WHERE product IS NOT NULL AND category IS NOT NULL AND brand IS NOT NULL),
c AS (SELECT product, category, brand, k.turn, min(p.turn) AS first_turn,
  coalesce(CASE WHEN count(DISTINCT cost) = 1 THEN max(cost) END, 0.0) AS cost
  FROM p JOIN (SELECT unnest(range(3)) AS turn) k ON p.turn <= k.turn GROUP BY product, category, brand, k.turn),
l AS (SELECT *, lag(cost) OVER (PARTITION BY product, category, brand ORDER BY turn) AS before FROM c)
SELECT product AS product_name, category, brand, max_by(cost, turn) AS standard_cost,
  {day.format("min(first_turn)")} AS create_date,
  {day.format("max(CASE WHEN before IS NULL OR before <> cost THEN turn ELSE 0 END)")} AS update_date
FROM l GROUP BY product, category, brand"""


def _sql_both_versions() -> str:
    cols = ", ".join(c for c, _, _ in _columns("fact_orders"))
    one, two = (f"SELECT {v} AS version, {cols} FROM ({_ctes(dirty)} SELECT {cols} FROM fact_orders)"
                for v, dirty in ((1, False), (2, True)))
    return f"{one}\nUNION ALL {two}"


def oracle_sql() -> dict[str, str]:
    clean_only = _ctes(False, star=False)
    dirty_only = _ctes(True, star=False)
    star_clean = _ctes(False)
    star_dirty = _ctes(True)
    fact_cols = ", ".join(c for c, _, _ in _columns("fact_orders"))
    emp_first_seen = _sql_person('"assigned supervisor"', "employee_id", "employee_name",
                                 "employee_first_name", "employee_last_name", first_seen=True)
    return {
        "raw_orders": f"WITH raw AS ({_sql_raw(False)}) SELECT * FROM raw",
        "preprocess_orders": dirty_only + "SELECT * FROM clean",
        "preprocess_counts": f"WITH raw AS ({_sql_raw(True)}) SELECT count(*) AS raw_rows, "
                             "count(*) FILTER (WHERE \"Order_Number\" IS NOT NULL AND NOT "
                             "isnan(\"Order_Number\")) AS clean_rows FROM raw",
        "dim_date": dirty_only + _sql_dim_date("monday"),
        "dim_date_sunday": dirty_only + _sql_dim_date("sunday"),
        "dim_cust": dirty_only + _sql_person("customer_name", "customer_id", "customer_name",
                                             "first_name", "last_name"),
        "dim_emp": clean_only + _sql_person('"assigned supervisor"', "employee_id",
                                            "employee_name", "employee_first_name",
                                            "employee_last_name"),
        "dim_emp_first_seen": dirty_only + emp_first_seen,
        "surrogate_key_scalable": (
            "SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (ORDER BY l_orderkey, "
            "l_linenumber) AS BIGINT) AS line_id FROM (SELECT DISTINCT l_orderkey, l_linenumber "
            "FROM lineitem)"),
        "geo_lookup": clean_only.rstrip() + f",\ndim_geo AS ({_sql_dim_geo()})\n" + (
            "SELECT CAST(c.order_number AS INTEGER) AS order_number, c.state_code, "
            "COALESCE(g.state_id, '-1') AS state_id FROM clean c LEFT JOIN "
            "(SELECT state_code, state_id FROM dim_geo WHERE country = 'India') g "
            "ON c.state_code = g.state_code"),
        "product_cost_variants": dirty_only + (
            "SELECT product, category, brand, count(DISTINCT cost) AS cost_variants "
            "FROM clean GROUP BY product, category, brand"),
        "single_valued_cost": dirty_only + (
            "SELECT product, category, brand, max(cost) AS standard_cost FROM clean "
            "GROUP BY product, category, brand HAVING count(DISTINCT cost) = 1"),
        "dim_prod": dirty_only + _SQL_DIM_PROD,
        "dim_ostatus": clean_only + _sql_dim_status(),
        "status_unmapped": dirty_only + _sql_dim_status(),
        "product_last_wins": _ctes(False, fact=_sql_fact("last_wins")) +
        f"SELECT {fact_cols} FROM fact_orders",
        "fact_orders": star_clean + f"SELECT {fact_cols} FROM fact_orders",
        "fact_orders_dirty": star_dirty + f"SELECT {fact_cols} FROM fact_orders",
        "fact_orders_shuffled": star_clean + f"SELECT {fact_cols} FROM fact_orders",
        "fact_orders_salted": star_dirty + f"SELECT {fact_cols} FROM fact_orders",
        "fact_orders_together": star_dirty + f"SELECT {fact_cols} FROM fact_orders",
        "fact_orders_hot_salted": star_dirty + f"SELECT {fact_cols} FROM fact_orders",
        "incremental_fact": star_clean + f"SELECT {fact_cols} FROM fact_orders",
        "incremental_multi_batch": star_dirty + _sql_natural_fact(),
        "incremental_dim_prod": star_dirty + "SELECT product_name, category, brand, standard_cost FROM dim_prod",
        "concurrent_loads": star_dirty + _sql_natural_fact(),
        "concurrent_load_keys": star_dirty + _sql_member_keys(),
        "stream_quarantine": _sql_quarantine(),
        "rules_at_load": star_dirty + _sql_rules_at_load(),
        "completeness_by_load": star_dirty + _sql_completeness(
            Q.DIM_COMPLETENESS_COLUMNS + Q.FACT_COMPLETENESS_COLUMNS),
        "key_uniqueness_by_load": star_dirty + _sql_key_uniqueness(),
        "product_upserts": _sql_upserts(),
        "table_bookmark": star_dirty + _sql_natural_fact(),
        "published_versions": _sql_both_versions(),
        "compacted_fact": star_clean + f"SELECT {fact_cols} FROM fact_orders",
        "clustered_point": star_clean + f"SELECT {fact_cols} FROM fact_orders WHERE product_id = 7 AND order_date = "
                           "(SELECT min(order_date) FROM fact_orders WHERE product_id = 7)",
        "ddl_tables": _ctes(False, category="substr(p.p_type, 1, 15)") + (
            "SELECT p.product_id, product_name, category, brand, standard_cost, true AS stamped, "
            "count(f.order_number) AS orders, CAST(sum(quantity) AS BIGINT) AS quantity FROM dim_prod p "
            "LEFT JOIN fact_orders f ON f.product_id = p.product_id GROUP BY ALL "
            "UNION ALL SELECT 0, 'one more', 'by hand', 'none', 0.0, true, NULL, NULL"),
        "job_reports": star_dirty + _sql_completeness(Q.DIM_COMPLETENESS_COLUMNS + Q.FACT_COMPLETENESS_COLUMNS),
        "csv_round_trip": f"WITH raw AS ({_sql_raw(True)}) SELECT * FROM raw",
        "star_parquet_round_trip": star_dirty + f"SELECT {fact_cols} FROM fact_orders",
        "star_csv_round_trip": star_dirty + f"SELECT {fact_cols} FROM fact_orders",
        "star_both_round_trip": star_dirty + f"SELECT {fact_cols} FROM fact_orders",
        "fact_margin_unguarded": _ctes(True, fact=_sql_fact(margin="unguarded", fill=False)) +
        f"SELECT {fact_cols} FROM fact_orders",
        "fact_preview": star_clean + f"SELECT {fact_cols} FROM fact_orders ORDER BY "
                                     f"{fact_cols} LIMIT 5",
        "key_uniqueness": star_clean + _sql_key_uniqueness(),
        "completeness_dims": star_dirty + _sql_completeness(Q.DIM_COMPLETENESS_COLUMNS),
        "completeness_fact": star_dirty + _sql_completeness(Q.FACT_COMPLETENESS_COLUMNS),
        "completeness_star": star_dirty + _sql_completeness(
            Q.DIM_COMPLETENESS_COLUMNS + Q.FACT_COMPLETENESS_COLUMNS),
        "check_not_null": star_dirty + _sql_not_null(),
        "check_primary_key": star_dirty + _sql_primary_key(),
        "check_foreign_keys": star_dirty + _sql_foreign_keys(),
        "check_ranges": star_dirty + _sql_ranges(),
        "check_lengths": star_dirty + _sql_lengths(),
        "check_all": star_dirty + "\nUNION ALL ".join(
            f"SELECT * FROM ({q})" for q in (_sql_not_null(), _sql_primary_key(),
                                             _sql_foreign_keys(), _sql_ranges(),
                                             _sql_lengths())),
        **(_llm.ORACLE_SQL if _llm else {}),
    }
