"""Dense surrogate keys (1..n) without a single-partition window.

``row_number().over(Window.orderBy(k))`` moves every member into one task.
Here the members are range-partitioned on the order columns, sorted inside
each partition and checkpointed, so partition boundaries are fixed on
reliable storage (a recomputation after executor loss reads the same files,
so numbers cannot shift). Each row's number is its position inside its
partition plus the number of rows in all earlier partitions. The partition
sizes are one integer per partition, bounded by the partition count and not
by the data, the same bookkeeping ``zipWithIndex`` does; they become a
literal offset array, so the numbering itself is a narrow projection.

The result equals ``row_number() OVER (ORDER BY order_cols)`` as long as the
order columns identify a member (ties would be numbered in an arbitrary but
fixed order).
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_PART, _POS = "_sl_part", "_sl_pos"


def number_rows(members: DataFrame, order_cols: list[str | Column], id_col: str,
                num_buckets: int | None = None) -> DataFrame:
    """Add ``id_col`` (bigint) = 1..n in ``order_cols`` order (ascending, NULLs first).

    ``members`` must already hold one row per member. Without
    ``num_buckets`` the range count starts at the shuffle partitions and AQE
    coalesces adjacent ranges to its advisory size, so it follows the data
    (a handful for a few thousand members, thousands for billions); ranges
    stay in order either way.
    """
    spark = members.sparkSession
    ensure_checkpoint_dir(spark)
    by_range = (members.repartitionByRange(num_buckets, *order_cols) if num_buckets
                else members.repartitionByRange(*order_cols))
    ranged = by_range.sortWithinPartitions(*order_cols).checkpoint(eager=True)
    # monotonically_increasing_id = (partition index << 33) + position in partition
    tagged = (ranged.withColumn(_PART, F.spark_partition_id())
                    .withColumn(_POS, F.monotonically_increasing_id()
                                - F.shiftleft(F.col(_PART).cast("long"), 33)))
    sizes = dict(tagged.groupBy(_PART).count().collect())  # <= one row per partition
    parts = max(sizes) + 1 if sizes else 0  # empty trailing partitions need no offset
    offsets = [0] + list(accumulate(sizes.get(i, 0) for i in range(parts)))[:-1]
    # one SQL literal (constant-folded), not one driver round trip per partition
    offset_of = F.expr("array(" + ", ".join(f"{o}L" for o in offsets) + ")")
    return (tagged.withColumn(id_col, (F.element_at(offset_of, F.col(_PART) + 1)
                                       + F.col(_POS) + 1))
                  .drop(_PART, _POS))


def dense_key(df: DataFrame, key_cols: list[str], id_col: str, *,
              drop_null: bool = True, num_buckets: int | None = None) -> DataFrame:
    """Distinct ``key_cols`` of ``df`` numbered 1..n in sorted key order.

    ``drop_null`` leaves out members with a NULL in any key column (they get
    the sentinel in the fact instead of a dimension row).
    """
    members = df.select(*key_cols)
    if drop_null:
        members = members.dropna(how="any", subset=key_cols)
    return number_rows(members.distinct(), key_cols, id_col, num_buckets)


FIRST_SEEN = "_sl_first"


def first_seen_agg(seen_cols: list[str]) -> Column:
    """Aggregate: the earliest ``struct(seen_cols)`` of a member. Rows with a
    NULL "seen" value are no appearance; a member seen only so gets NULL and
    sorts first."""
    seen_ok = F.lit(True)
    for c in seen_cols:
        seen_ok = seen_ok & F.col(c).isNotNull()
    return F.min(F.when(seen_ok, F.struct(*seen_cols))).alias(FIRST_SEEN)


def first_seen_order(seen_cols: list[str], key_cols: list[str]) -> list[Column]:
    return [F.col(f"{FIRST_SEEN}.{c}") for c in seen_cols] + [F.col(k) for k in key_cols]


def first_seen_key(df: DataFrame, key_cols: list[str], seen_cols: list[str], id_col: str, *,
                   drop_null: bool = True, num_buckets: int | None = None) -> DataFrame:
    """Keys in order of first appearance, where ``seen_cols`` say when a row
    appeared (e.g. order date, then order number). Ties on first appearance
    are broken by the key itself. Map-side partial ``min`` keeps hot keys
    cheap before the shuffle.
    """
    src = df.dropna(how="any", subset=key_cols) if drop_null else df
    members = src.groupBy(*key_cols).agg(first_seen_agg(seen_cols))
    return number_rows(members, first_seen_order(seen_cols, key_cols), id_col,
                       num_buckets).drop(FIRST_SEEN)


def extend_key(existing: DataFrame, candidates: DataFrame, key_cols: list[str], id_col: str, *,
               num_buckets: int | None = None, highest: int | None = None) -> DataFrame:
    """New members of ``candidates`` (absent from ``existing``) numbered after
    the current maximum id, so existing keys never move between runs.
    ``highest`` is that id where the caller knows it. Of two callers that start
    from the same ``existing`` at most one may keep its result: see
    :meth:`starloom.sinks.snapshots.StarLog.update`."""
    new = (candidates.select(*key_cols).dropna(how="any", subset=key_cols).distinct()
           .join(existing.select(*key_cols), key_cols, "left_anti"))
    # one scalar, so the driver round trip is bounded
    base = highest if highest is not None else existing.agg(F.max(id_col)).first()[0] or 0
    numbered = number_rows(new, key_cols, id_col, num_buckets)
    return numbered.withColumn(id_col, F.col(id_col) + F.lit(base).cast("long"))
