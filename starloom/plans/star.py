"""The whole job: raw extract -> cleaned orders -> six dimensions -> fact."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..operators.lookup import DEFAULT_BROADCAST_MAX_ROWS, size_of
from .dims import (build_dim_cust, build_dim_date, build_dim_emp, build_dim_geo,
                   build_dim_prod, build_dim_status, dimension_members)
from .fact import LOOKED_UP, build_fact_orders
from .prep import preprocess

STAR_ORDER = ["dim_date", "dim_cust", "dim_geo", "dim_prod", "dim_ostatus", "dim_emp",
              "fact_orders"]


def build_star(raw: DataFrame, *, run_ts: datetime | None = None, audit: bool = True,
               week_start: str = "monday", country: str = "India",
               product_match: str = "triple", margin: str = "guarded",
               person_key_order: str = "sorted", geo_key: str = "stable",
               status_default: str | None = "Unknown status",
               broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
               salt_buckets: int | None = None, persist_clean: bool = False,
               num_buckets: int | None = None,
               parallel_dims: bool = True,
               member_pass: str = "shared", strict_dates: bool = False,
               sentinel: int = -1, hot_share: float | None = None,
               wide_keys: bool = False, allow_fan_out: bool = False, lookups: str = "each",
               row_id: str | None = None) -> dict[str, DataFrame]:
    """Build the seven tables (lazily, except the checkpointed key numbering).

    ``persist_clean`` keeps the cleaned rows (memory, then disk) for the five
    readers of it; worth it when the source is expensive to re-read (a join,
    compressed CSV), not for a plain columnar scan. A lost cached block is
    recomputed from lineage, so executor loss costs time, not correctness.

    ``member_pass="shared"`` finds the members of all five data-derived
    dimensions in one grouping-sets aggregation (one scan, one shuffle of
    the cleaned rows); ``"per_dimension"`` lets every builder scan on its own
    (cheaper only when the source is cached or columnar and tiny).
    ``strict_dates`` raises on an unparsable order date instead of NULL;
    ``sentinel`` is the key given to rows without a dimension member.
    ``wide_keys`` makes the INTEGER keys BIGINT; ``lookups`` and ``row_id``, a column
    that numbers the rows in the files of ``raw``, are the fact's
    (:func:`build_fact_orders`).
    """
    run_ts = run_ts or datetime.now(timezone.utc)
    spark = raw.sparkSession
    clean = preprocess(raw, strict_dates=strict_dates)
    seen = ["order_date", "order_number"]
    if member_pass not in ("shared", "per_dimension"):
        raise ValueError(f"unknown member_pass {member_pass!r}")
    if persist_clean:
        clean = clean.persist(StorageLevel.MEMORY_AND_DISK)
        if parallel_dims and member_pass == "per_dimension":
            clean.count()  # fill the cache once, before concurrent readers start
    members: dict[str, DataFrame] = {}
    if member_pass == "shared":
        members = dimension_members(
            clean, seen_cols=seen if person_key_order == "first_seen" else None)
    common = dict(run_ts=run_ts, audit=audit, num_buckets=num_buckets, wide_keys=wide_keys)
    builders = {
        "dim_date": lambda: build_dim_date(clean, week_start=week_start,
                                           members=members.get("dim_date")),
        "dim_cust": lambda: build_dim_cust(clean, key_order=person_key_order, seen_cols=seen,
                                           members=members.get("dim_cust"), **common),
        "dim_geo": lambda: build_dim_geo(spark, key=geo_key),
        "dim_prod": lambda: build_dim_prod(clean, members=members.get("dim_prod"), **common),
        "dim_ostatus": lambda: build_dim_status(clean, default=status_default,
                                                members=members.get("dim_ostatus"), **common),
        "dim_emp": lambda: build_dim_emp(clean, key_order=person_key_order, seen_cols=seen,
                                         members=members.get("dim_emp"), **common),
    }
    def built(name):
        # the measured size of what is looked up in each materialized dimension decides broadcast
        df = builders[name]()
        return df, size_of(df.select(*LOOKED_UP[name])) if name in LOOKED_UP else None

    if parallel_dims:
        # The keyed dimensions run a few small jobs each (range sample,
        # checkpoint, partition sizes, row count); submitted from threads they
        # share the executors instead of queueing one after another.
        with ThreadPoolExecutor(max_workers=len(builders)) as pool:
            futures = {name: pool.submit(built, name) for name in builders}
            results = {name: f.result() for name, f in futures.items()}
    else:
        results = {name: built(name) for name in builders}
    dims = {name: r[0] for name, r in results.items()}
    dim_sizes = {name: r[1] for name, r in results.items()}
    fact = build_fact_orders(clean, dims, country=country, product_match=product_match,
                             margin=margin, broadcast_max_rows=broadcast_max_rows,
                             salt_buckets=salt_buckets, hot_share=hot_share,
                             dim_sizes=dim_sizes, sentinel=sentinel, wide_keys=wide_keys,
                             allow_fan_out=allow_fan_out, lookups=lookups, row_id=row_id)
    return {**dims, "fact_orders": fact}


def register_views(star: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Expose the tables to ``spark.sql`` as temporary views (``prefix`` +
    table name); returns the view names."""
    names = []
    for name, df in star.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
