"""The order fact: one row per cleaned order row, keys looked up, measures added."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.measures import profit, profit_margin
from ..operators.lookup import (DEFAULT_BROADCAST_MAX_ROWS, bounded_broadcast, hot_keys_of, last_wins, lookup_apart,
                                lookup_key, lookup_together, size_of)
from .prep import require_columns

FACT_KEYS = ["customer_id", "state_id", "product_id", "status_id", "employee_id"]
#: What a lookup takes of each dimension: the natural key and the surrogate one.
LOOKED_UP = {"dim_cust": ["customer_name", "customer_id"], "dim_geo": ["state_code", "country", "state_id"],
             "dim_prod": ["product_name", "category", "brand", "product_id"],
             "dim_ostatus": ["status_name", "status_id"], "dim_emp": ["employee_name", "employee_id"]}
FACT_MEASURES = ["unit_cost", "unit_sales", "total_cost", "total_sales", "profit", "profit_margin"]


def build_fact_orders(clean: DataFrame, dims: dict[str, DataFrame], *,
                      country: str = "India", product_match: str = "triple",
                      margin: str = "guarded", sentinel: int = -1, fill: bool = True,
                      broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                      salt_buckets: int | None = None, hot_share: float | None = None,
                      dim_sizes: dict[str, tuple[int, int]] | None = None,
                      wide_keys: bool = False, allow_fan_out: bool = False,
                      lookups: str = "each", row_id: str | None = None) -> DataFrame:
    """Fact rows with surrogate keys and measures, conformed to the contract.

    product_match
      ``triple``     join on (product, category, brand): one key per row (default)
      ``last_wins``  join on name; a name with several products keeps the highest key
      ``name``       join on name only: a name with several products MULTIPLIES
                     fact rows; kept only to reproduce that behaviour, and only
                     with ``allow_fan_out=True``
    Unmatched keys become ``sentinel`` (``'-1'`` for the text state key) and
    NULL or NaN measures 0, after profit and margin are computed. The geography
    lookup is restricted to ``country`` because state codes repeat across
    countries. ``dim_sizes`` (rows and bytes of the dimensions' ``LOOKED_UP``
    columns, when the caller has them) saves the size check a job per
    dimension; a filtered dimension is no larger. ``hot_share`` finds the hot keys of all
    lookups in one pass over the cleaned rows. ``lookups="together"`` resolves
    all dimensions that are too large to broadcast with two shuffles of the
    fact in all; ``"each"`` joins them one after the other. ``row_id`` names a
    column that numbers the rows in the files they come from: then ``"each"``
    sends only numbers and natural keys to several large dimensions, and the rest
    of a row moves once, to what was found for its number.
    """
    require_columns(clean, ["customer_name", "state_code", "product", "category", "brand",
                            "status", "assigned supervisor", "cost", "sales", "quantity",
                            "total_cost", "total_sales", "order_number", "order_date"])
    kw = dict(broadcast_max_rows=broadcast_max_rows, salt_buckets=salt_buckets)
    sizes = dim_sizes or {}
    f = clean
    product = ["product", "category", "brand"] if product_match == "triple" else ["product"]
    keys = {"dim_cust": ["customer_name"], "dim_geo": ["state_code"], "dim_prod": product,
            "dim_ostatus": ["status"], "dim_emp": ["assigned supervisor"]}
    hot: dict[str, DataFrame] = {}
    if salt_buckets and hot_share:
        hot = dict(zip(keys, hot_keys_of(clean, list(keys.values()), hot_share)))
    if lookups not in ("each", "together"):
        raise ValueError(f"unknown lookups {lookups!r}")
    prod = dims["dim_prod"]
    steps = [("dim_cust", dims["dim_cust"], {"customer_name": "customer_name"}, "customer_id"),
             ("dim_geo", dims["dim_geo"].filter(F.col("country") == country), {"state_code": "state_code"},
              "state_id")]
    if product_match == "triple":
        steps.append(("dim_prod", prod, {"product": "product_name", "category": "category", "brand": "brand"},
                      "product_id"))
    elif product_match == "last_wins":
        steps.append(("dim_prod", last_wins(prod, "product_name", "product_id"), {"product": "product_name"},
                      "product_id"))
    elif product_match == "name":
        if not allow_fan_out:
            raise ValueError("product_match='name' multiplies fact rows; pass allow_fan_out=True "
                             "to accept that")
        f = f.join(prod.select(F.col("product_name").alias("product"), "product_id"),
                   "product", "left")
    else:
        raise ValueError(f"unknown product_match {product_match!r}")
    steps += [("dim_ostatus", dims["dim_ostatus"], {"status": "status_name"}, "status_id"),
              ("dim_emp", dims["dim_emp"], {"assigned supervisor": "employee_name"}, "employee_id")]
    if lookups == "together":
        large = [(dim, on, key) for name, dim, on, key in steps
                 if not bounded_broadcast(dim, broadcast_max_rows, sizes.get(name))[1]]
        if large:
            f = lookup_together(f, large, keep_keys=False, row_id=row_id if product_match != "name" else None)
        found = {key for _, _, key in large}
        steps = [s for s in steps if s[3] not in found]
    # A lookup that moves the rows takes them along whole. So what is broadcast comes first, and of the
    # others the one with the most natural keys; natural keys that were looked up stay behind, and the
    # geography's wide key comes last.
    known = {name: sizes.get(name) or size_of(dim.select(*on.values(), key)) for name, dim, on, key in steps}
    moved = {name: not bounded_broadcast(dim, broadcast_max_rows, known[name])[1] for name, dim, _, _ in steps}
    apart = row_id is not None and sum(moved.values()) > 1
    found = []
    for name, dim, on, key in sorted(steps, key=lambda s: (s[0] == "dim_geo", moved[s[0]], -len(s[2]))):
        options = dict(known_size=known[name], hot=hot.get(name), **kw)
        if apart and moved[name]:
            found.append(lookup_apart(clean, row_id, dim, on, key, **options))
            f = f.drop(*on)
        else:
            f = lookup_key(f, dim, on, key, **options).drop(*on)
    for keys in found:  # all by number, so each of them and the rows are shuffled once
        f = f.join(keys.hint("merge"), row_id, "left")

    ts, tc = F.col("total_sales"), F.col("total_cost")
    q = F.col("quantity")
    f = f.select(
        "order_number", "order_date", *FACT_KEYS,
        F.col("cost").alias("unit_cost"), F.col("sales").alias("unit_sales"),
        F.when(~F.isnan(q), q).alias("quantity"),  # NaN has no integer form
        "total_cost", "total_sales",
        profit(ts, tc).alias("profit"),
        profit_margin(ts, tc, margin).alias("profit_margin"),
    )
    if fill:
        defaults = {k: sentinel for k in FACT_KEYS}
        defaults["state_id"] = str(sentinel)
        defaults.update({m: 0.0 for m in FACT_MEASURES})
        f = f.na.fill(defaults)
    return C.conform(f, C.FACT_ORDERS, wide_keys=wide_keys)
