"""Dimension builders. Input: the cleaned order frame (lower-case columns)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.dates import date_attributes
from ..functions.keys import stable_uuid
from ..functions.names import first_token, last_token
from ..operators.dense_keys import (FIRST_SEEN, dense_key, first_seen_agg, first_seen_key,
                                   first_seen_order, number_rows)
from ..operators.single_valued import single_valued
from ..sources.seeds import geo_seed
from ..session import ensure_checkpoint_dir, exists, scratch_folder, shuffles_released
from .prep import require_columns

# Order status descriptions and the label for any other status.
STATUS_DESCRIPTIONS = {
    "Delivered": "Order has been delivered",
    "Order": "Order has been placed",
    "Processing": "Order is being processed",
    "Shipped": "Order has been shipped",
}
UNKNOWN_STATUS = "Unknown status"


def _audit(run_ts: datetime | Column | None) -> dict[str, Column]:
    """create_date/update_date: one timestamp for every table of a run."""
    if run_ts is None:
        ts = F.current_timestamp()
    elif isinstance(run_ts, Column):
        ts = run_ts
    else:
        ts = F.lit(run_ts).cast("timestamp")
    return {"create_date": ts, "update_date": ts}


def _finish(df: DataFrame, contract: C.Contract, run_ts, audit: bool,
            wide_keys: bool = False) -> DataFrame:
    if audit:
        df = df.withColumns(_audit(run_ts))
    return C.conform(df, contract, drop_audit=not audit, wide_keys=wide_keys)


def build_dim_date(clean: DataFrame | None, *, week_start: str = "monday",
                   members: DataFrame | None = None) -> DataFrame:
    """One row per distinct, non-NULL order date with its calendar attributes.
    ``members`` (column ``order_date``) replaces the scan of ``clean``."""
    if members is None:
        require_columns(clean, ["order_date"])
        members = clean.select("order_date").dropna().distinct()
    dates = members.select(F.col("order_date").alias("date_full"))
    return C.conform(dates.withColumns(date_attributes(F.col("date_full"), week_start)), C.DIM_DATE)


def build_person_dim(clean: DataFrame | None, source_col: str, contract: C.Contract, *,
                     key_order: str = "sorted", seen_cols: list[str] | None = None,
                     split_mode: str = "whitespace", run_ts=None, audit: bool = True,
                     num_buckets: int | None = None, wide_keys: bool = False,
                     members: DataFrame | None = None) -> DataFrame:
    """Customer or employee dimension: distinct names, dense key, first/last name.

    ``key_order="sorted"`` numbers names alphabetically; ``"first_seen"``
    numbers them by first appearance per ``seen_cols``. ``members`` (one row
    per non-NULL ``source_col``, plus the first-seen struct for
    ``first_seen``) replaces the scan of ``clean``.
    """
    id_col, name_col, first_col, last_col = contract.names[:4]
    seen = seen_cols or ["order_date"]
    if key_order not in ("sorted", "first_seen"):
        raise ValueError(f"unknown key_order {key_order!r}")
    if members is not None:
        m = members.withColumnRenamed(source_col, name_col)
        order = [name_col] if key_order == "sorted" else first_seen_order(seen, [name_col])
        keyed = number_rows(m.select(name_col, *([FIRST_SEEN] if key_order == "first_seen"
                                                  else [])), order, id_col, num_buckets)
        keyed = keyed.drop(FIRST_SEEN)
    else:
        require_columns(clean, [source_col])
        src = clean.select(F.col(f"`{source_col}`").alias(name_col), *seen)
        if key_order == "sorted":
            keyed = dense_key(src, [name_col], id_col, num_buckets=num_buckets)
        else:
            keyed = first_seen_key(src, [name_col], seen, id_col, num_buckets=num_buckets)
    keyed = keyed.withColumns({
        first_col: first_token(F.col(name_col), split_mode),
        last_col: last_token(F.col(name_col), split_mode),
    })
    return _finish(keyed, contract, run_ts, audit, wide_keys)


def build_dim_cust(clean: DataFrame, **kw) -> DataFrame:
    return build_person_dim(clean, "customer_name", C.DIM_CUST, **kw)


def build_dim_emp(clean: DataFrame, **kw) -> DataFrame:
    return build_person_dim(clean, "assigned supervisor", C.DIM_EMP, **kw)


def build_dim_geo(spark: SparkSession, *, key: str = "stable") -> DataFrame:
    """Geography members of the three countries.

    ``key="stable"``: SHA-256-derived UUID text of ``country|iso_code`` (same
    on every run); ``key="random"``: a fresh random UUID per run.
    """
    seed = geo_seed(spark)
    if key == "stable":
        return C.conform(seed.withColumn("state_id", stable_uuid("country", "iso_code")),
                         C.DIM_GEO)
    if key == "random":
        # uuid() is drawn anew on every evaluation: checkpoint once, so the
        # dimension and every fact lookup see the same ids
        ensure_checkpoint_dir(spark)
        return C.conform(seed.withColumn("state_id", F.expr("uuid()")), C.DIM_GEO) \
            .checkpoint(eager=True)
    raise ValueError(f"unknown key {key!r}")


def build_dim_prod(clean: DataFrame | None, *, run_ts=None, audit: bool = True,
                   num_buckets: int | None = None, wide_keys: bool = False,
                   members: DataFrame | None = None) -> DataFrame:
    """One row per (product, category, brand); standard_cost is the product's
    cost if it has exactly one distinct value, else 0. One aggregation yields
    both the members and their cost. ``members`` (the three keys plus
    ``standard_cost``) replaces the scan of ``clean``."""
    keys = ["product", "category", "brand"]
    if members is None:
        require_columns(clean, keys + ["cost"])
        members = single_valued(clean.dropna(how="any", subset=keys), keys, "cost",
                                "standard_cost")
    keyed = number_rows(members, keys, "product_id", num_buckets)
    keyed = (keyed.withColumnRenamed("product", "product_name")
                  .na.fill({"standard_cost": 0.0}))
    return _finish(keyed, C.DIM_PROD, run_ts, audit, wide_keys)


def build_dim_status(clean: DataFrame | None, *, descriptions: dict[str, str] | None = None,
                     default: str | None = UNKNOWN_STATUS, run_ts=None, audit: bool = True,
                     num_buckets: int | None = None, wide_keys: bool = False,
                     members: DataFrame | None = None) -> DataFrame:
    """Distinct statuses, dense key, description from a literal map (an
    unlisted status gets ``default``; ``default=None`` leaves it NULL).
    ``members`` (column ``status``) replaces the scan of ``clean``."""
    descriptions = STATUS_DESCRIPTIONS if descriptions is None else descriptions
    if members is None:
        require_columns(clean, ["status"])
        keyed = dense_key(clean.select(F.col("status").alias("status_name")), ["status_name"],
                          "status_id", num_buckets=num_buckets)
    else:
        keyed = number_rows(members.select(F.col("status").alias("status_name")),
                            ["status_name"], "status_id", num_buckets)
    mapping = F.create_map(*[F.lit(x) for kv in descriptions.items() for x in kv])
    desc = mapping[F.col("status_name")]
    if default is not None:
        desc = F.coalesce(desc, F.lit(default))
    return _finish(keyed.withColumn("status_description", desc), C.DIM_OSTATUS, run_ts, audit,
                   wide_keys)


# Member sets of the data-derived dimensions: the grouping columns of each.
MEMBER_SETS = {
    "dim_date": ["order_date"],
    "dim_cust": ["customer_name"],
    "dim_emp": ["assigned supervisor"],
    "dim_ostatus": ["status"],
    "dim_prod": ["product", "category", "brand"],
}


def dimension_members(clean: DataFrame, *, seen_cols: list[str] | None = None
                      ) -> dict[str, DataFrame]:
    """The members of all five data-derived dimensions from ONE scan and ONE
    shuffle of ``clean``: a ``GROUPING SETS`` aggregation (Expand, then
    map-side partial aggregation, so a hot member is one row per task before
    the exchange). The result, a few rows per member, is written once, a folder
    a dimension, and each dimension reads its own. Members with a NULL key are
    dropped.
    """
    cols = list(dict.fromkeys(c for keys in MEMBER_SETS.values() for c in keys))
    require_columns(clean, cols + ["cost"])
    gid = "_sl_gid"
    aggs = [F.grouping_id().alias(gid), F.min("cost").alias("_sl_lo"),
            F.max("cost").alias("_sl_hi")]
    if seen_cols:
        require_columns(clean, seen_cols)
        aggs.append(first_seen_agg(seen_cols))
    grouped = clean.groupingSets([[F.col(f"`{c}`") for c in keys]
                                  for keys in MEMBER_SETS.values()],
                                 *[F.col(f"`{c}`") for c in cols])
    spark, path = clean.sparkSession, scratch_folder(clean.sparkSession, "members")
    every = grouped.agg(*aggs)
    with shuffles_released(spark):
        every.write.partitionBy(gid).parquet(path)
    schema = every.drop(gid).schema
    out = {}
    for dim, keys in MEMBER_SETS.items():
        # grouping_id: one bit per grouping column, set when it is NOT grouped
        bits = sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in keys)
        folder = f"{path}/{gid}={bits}"  # not there without any row
        part = spark.read.schema(schema).parquet(folder) if exists(spark, folder) else spark.createDataFrame([], schema)
        part = part.dropna(how="any", subset=keys)
        extra = [FIRST_SEEN] if seen_cols and dim in ("dim_cust", "dim_emp") else []
        if dim == "dim_prod":
            lo, hi = F.col("_sl_lo"), F.col("_sl_hi")
            out[dim] = part.select(*keys, F.when(lo == hi, lo).alias("standard_cost"))
        else:
            out[dim] = part.select(*[F.col(f"`{k}`") for k in keys], *extra)
    return out
