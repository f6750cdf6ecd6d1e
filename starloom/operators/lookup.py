"""Surrogate-key lookups: fact rows -> dimension keys by natural key.

A lookup is a LEFT join on a key-unique dimension, so the fact keeps its
grain; unmatched (and NULL) natural keys get NULL, which the fact builder
turns into the sentinel. How the join runs depends on the dimension's size:

* small (rows and bytes checked against bounds): broadcast hash join, the fact
  is not shuffled at all;
* several large ones: all keys of all rows resolved in one shuffle and the rows put
  together again in a second one (:func:`lookup_together`), instead of a shuffle
  of whole rows for each; or, for rows stored with a number, each natural key sent
  to its dimension with that number alone (:func:`lookup_apart`);
* large: sort-merge join (hinted, so that adaptive execution doesn't turn it
  into a broadcast of more than the bounds), with AQE splitting a skewed fact
  partition. Rows with a NULL key, which match nothing, are spread over all
  tasks. ``salt_buckets`` also spreads the natural keys and replicates each
  dimension row that many times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_folder, shuffles_released

DEFAULT_BROADCAST_MAX_ROWS = 2_000_000
_SALT = "_sl_salt"


DEFAULT_BROADCAST_MAX_BYTES = 64 << 20


def size_of(dim: DataFrame) -> tuple[int, int]:
    """Rows and bytes (8 a fixed-width column, 32 a row, the lengths of texts)."""
    size = F.lit(32 + 8 * len(dim.columns))
    for name, kind in dim.dtypes:
        if kind == "string":
            size = size + F.coalesce(F.octet_length(f"`{name}`"), F.lit(0))
    return tuple(dim.agg(F.count(F.lit(1)), F.coalesce(F.sum(size.cast("long")), F.lit(0))).first())


def bounded_broadcast(dim: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                      known_size: tuple[int, int] | None = None,
                      max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> tuple[DataFrame, bool]:
    """Return ``(dim, True)`` with a broadcast hint if the dimension is within
    both bounds, else ``(dim, False)`` with a merge hint.

    The size is measured (``known_size``, rows and bytes at most, skips the
    job), so the hint never rests on a guess. Call it on materialized
    (checkpointed or written) dimensions, where measuring is a cheap scan.
    """
    rows, size = known_size if known_size is not None else size_of(dim)
    if rows <= max_rows and size <= max_bytes:
        return F.broadcast(dim), True
    return dim.hint("merge"), False


def hot_keys_of(fact: DataFrame, keys: list[list[str]], share: float) -> list[DataFrame]:
    """For each list of key columns the natural keys that may hold at least
    ``share`` of the fact's rows.

    One pass for all of them with Spark's frequent-items sketch; an answer has
    at most 1/``share`` entries by construction (a proven bound), may contain
    false positives (harmless: they are only salted) and never misses a key
    above the share. NULL keys are left out: they never match a dimension.
    """
    names = [f"_sl_k{i}" for i in range(len(keys))]
    columns = [F.struct(*[F.col(f"`{c}`") for c in cols]).alias(n) for n, cols in zip(names, keys)]
    found = fact.select(*columns).freqItems(names, share).first()
    out = []
    for cols, items in zip(keys, found):
        rows = [tuple(k) for k in items if k is not None and all(v is not None for v in k)]
        out.append(fact.sparkSession.createDataFrame(
            rows, fact.select(*[F.col(f"`{c}`") for c in cols]).schema))
    return out


def hot_keys(fact: DataFrame, cols: list[str], share: float) -> DataFrame:
    """:func:`hot_keys_of` for one key."""
    return hot_keys_of(fact, [cols], share)[0]


def lookup_key(fact: DataFrame, dim: DataFrame, on: dict[str, str], key_col: str, *,
               broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
               known_size: tuple[int, int] | None = None,
               salt_buckets: int | None = None,
               hot: DataFrame | None = None, hot_share: float | None = None) -> DataFrame:
    """Add ``key_col`` to ``fact``; ``on`` maps fact column -> dimension column.

    ``dim`` must be unique on the ``on`` columns (dimensions are). For a
    dimension too large to broadcast, ``salt_buckets`` spreads each natural
    key over that many tasks; with ``hot`` only these keys (see
    :func:`hot_keys_of`; ``hot_share`` finds them here) are spread, and only
    their dimension rows replicated.
    """
    dim_k = dim.select(*[F.col(d).alias(f) for f, d in on.items()], F.col(key_col))
    fact_cols = list(on)
    small_dim, small = bounded_broadcast(dim_k, broadcast_max_rows, known_size)
    if small:
        return fact.join(small_dim, fact_cols, "left")
    # Salts come from the row's content, so a recomputed task assigns the same ones again.
    content = F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns])
    tasks = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    no_key = F.lit(False)
    for c in fact_cols:
        no_key = no_key | F.col(f"`{c}`").isNull()
    salted = bool(salt_buckets and salt_buckets > 1)
    spread = F.pmod(content, F.lit(salt_buckets if salted else 1))
    zero = F.lit(0).cast("long")
    all_salts = F.sequence(zero, F.lit((salt_buckets or 1) - 1).cast("long"))
    if salted and hot is None and hot_share is not None:
        hot = hot_keys(fact, fact_cols, hot_share)
    is_hot, salted_fact, salted_dim = F.lit(salted), fact, dim_k
    if salted and hot is not None:
        marks = F.broadcast(hot.withColumn("_sl_hot", F.lit(True)))  # at most 1/share rows
        is_hot = F.coalesce(F.col("_sl_hot"), F.lit(False))
        salted_fact, salted_dim = fact.join(marks, fact_cols, "left"), dim_k.join(marks, fact_cols, "left")
    salted_fact = salted_fact.withColumn(_SALT, F.when(no_key, F.pmod(content, F.lit(max(tasks, 2)))).when(
        is_hot, spread).otherwise(zero)).drop("_sl_hot")
    salted_dim = salted_dim.withColumn(_SALT, F.explode(F.when(is_hot, all_salts).otherwise(
        F.array(zero)))).drop("_sl_hot")
    return salted_fact.join(salted_dim.hint("merge"), fact_cols + [_SALT], "left").drop(_SALT)


def lookup_apart(fact: DataFrame, row: str, dim: DataFrame, on: dict[str, str], key_col: str, **options) -> DataFrame:
    """The number ``row`` of every row of ``fact`` that ``dim`` has a member for,
    and its ``key_col``: :func:`lookup_key` (whose ``options`` these are) of rows
    that are only their number and natural key. Rows with a NULL natural key
    match nothing and aren't sent."""
    asked = fact.select(row, *[F.col(f"`{c}`") for c in on]).dropna(subset=[f"`{c}`" for c in on])
    found = lookup_key(asked, dim, on, key_col, **options)
    return found.select(row, key_col).where(F.col(key_col).isNotNull())


def lookup_together(fact: DataFrame, lookups: list[tuple[DataFrame, dict[str, str], str]], *,
                    keep_keys: bool = True, row_id: str | None = None) -> DataFrame:
    """Add the key columns of several dimensions, each (dimension, {fact column:
    dimension column}, key column), with two shuffles of the fact however many
    there are.

    The rows are landed once as Parquet, with a number each, unless they come from
    files that hold a number of their own, ``row_id``. Their natural keys go, one narrow entry a row and dimension, to the members of all dimensions
    in one sort-merge join (a hot key's entries can be split by adaptive
    execution; NULL keys match nothing and aren't sent). What they find goes back
    to the row's number, where the rest of the row comes too, without the natural
    keys if they aren't to be kept. Natural keys must be text, and members unique
    on them, as in :func:`lookup_key`."""
    spark = fact.sparkSession
    for _, on, _ in lookups:
        wrong = [c for c in on if not isinstance(fact.schema[c].dataType, T.StringType)]
        if wrong:
            raise TypeError(f"natural keys must be text: {wrong}")
    landed, row = fact, row_id
    if row is None:
        path, row = scratch_folder(spark, "lookups"), "_sl_row"
        numbered = fact.withColumn(row, F.monotonically_increasing_id())
        with shuffles_released(spark):
            numbered.write.option("compression", "zstd").parquet(path)
        landed = spark.read.schema(numbered.schema).parquet(path)
    width = max(len(on) for _, on, _ in lookups)
    names = [f"_k{j}" for j in range(width)]

    def padded(columns: list[str]) -> list:
        parts = [F.col(f"`{c}`") for c in columns] + [F.lit("")] * (width - len(columns))
        return [p.alias(n) for p, n in zip(parts, names)]

    entries = F.array(*[F.when(
        F.forall(F.array(*[F.col(f"`{c}`").isNotNull() for c in on]), lambda known: known),
        F.struct(F.lit(i).alias("_which"), *padded(list(on)))) for i, (_, on, _) in enumerate(lookups)])
    asked = landed.select(row, F.explode(F.array_compact(entries)).alias("e")).select(row, "e.*")
    members = None
    for i, (dim, on, key) in enumerate(lookups):
        some = dim.select(F.lit(i).alias("_which"), *padded(list(on.values())), F.col(key).cast("string").alias("_key"))
        members = some if members is None else members.unionByName(some)
    found = asked.join(members.hint("merge"), ["_which", *names]).select(row, "_which", "_key")
    gone = {row} if keep_keys else {row} | {c for _, on, _ in lookups for c in on}
    whole = landed.select(row, F.struct(*[F.col(f"`{c}`") for c in fact.columns if c not in gone]).alias("_rest"))
    both = found.withColumn("_rest", F.lit(None).cast(whole.schema["_rest"].dataType)).unionByName(
        whole, allowMissingColumns=True)
    # dealt by number first, so that the rows aren't sorted once more before they are sent
    back = both.repartition(row).groupBy(row).agg(
        F.first("_rest", ignorenulls=True).alias("_rest"),
        *[F.max(F.when(F.col("_which") == i, F.col("_key"))).alias(f"_f{i}") for i in range(len(lookups))])
    return back.select("_rest.*", *[F.col(f"_f{i}").cast(dim.schema[key].dataType).alias(key)
                                    for i, (dim, _, key) in enumerate(lookups)])


def last_wins(dim: DataFrame, name_col: str, key_col: str) -> DataFrame:
    """Name -> key map where a name held by several members keeps the last
    member (highest key), like a dictionary built in key order. Aggregated with
    a map-side partial ``max``."""
    return dim.groupBy(name_col).agg(F.max(key_col).alias(key_col))
