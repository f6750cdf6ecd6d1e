"""Mixing sources to target weights by hash-threshold histograms [native].

Every document has a fixed 60-bit hash. A source that is to give the share
``f`` of its words takes every document ``floor(f)`` times, and once more
those whose hash lies below a threshold. The threshold is found without
sorting: words are summed by (source, hash bucket), the running sums show the
bucket that crosses the budget, and only this bucket is split into finer ones,
until single hashes are left. A smaller budget has a smaller threshold, so the
mixes of two budgets are nested.

Only DataFrame functions are used. What meets in one task is at most
``2**LEVEL_BITS`` sums of one source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.dense_keys import number_rows
from .common import n_words, written

HASH_BITS, LEVEL_BITS = 60, 12


def _hash(doc_id: str, text: str) -> Column:
    """The first 60 bits of an MD5 over id and text: the same in every run and engine."""
    key = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"),
                   F.coalesce(F.col(text), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(totals: DataFrame, weights: tuple[float, ...], share: float,
                   most: float) -> DataFrame:
    """``totals`` (source, source_size) with ``target``: the words each source
    is to give. The n-th source by code point (NULL last) has weight
    ``weights[n % len]``; together they give ``share`` of all words; no source
    gives more than ``most`` times its size, and what it can't give goes to
    the others by weight. The rounds below end when no source is newly
    limited; each one brings two sums to the driver, whatever the number of
    sources."""
    ranked = number_rows(totals.withColumn("_null", F.col("source").isNull()),
                         ["_null", "source"], "_rank")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    ranked = written(ranked.select("source", "source_size", w.alias("_w")), "mix-sources")
    limit = F.col("source_size") * F.lit(float(most))
    wanted = float(ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]) * share
    rate, free = 0.0, -1.0
    while True:  # the limited set only grows, so this ends
        bound = (limit <= F.col("_w") * F.lit(rate)) if free >= 0 else F.lit(False)
        given, now = ranked.agg(
            F.coalesce(F.sum(F.when(bound, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~bound, F.col("_w"))), F.lit(0.0))).first()
        if now == 0.0 or now == free:
            break
        rate, free = (wanted - given) / now, now
    return ranked.select("source", "source_size",
                         F.least(limit, F.col("_w") * F.lit(rate)).alias("target"))


def _plan(docs: DataFrame, weights, share, most, doc_id, text, source):
    """The narrow table of documents, and per source its target, how often it
    is taken whole and the hash below which its documents are taken once more."""
    sized = written(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        n_words(F.col(text)).alias("size"), _hash(doc_id, text).alias("_h")), "mix-sized")
    targets = source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    whole = F.when(F.col("source_size") > 0,
                   F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = written(targets.select("*", whole.cast("long").alias("_whole")).withColumn(
        "_rest", F.col("target") - F.col("_whole") * F.col("source_size")), "mix-targets")
    bounds = _thresholds(sized, targets)
    return sized, F.broadcast(bounds) if _small(bounds) else bounds


def mix_sources(docs: DataFrame, *, weights: tuple[float, ...] = (3.0, 1.0, 2.0),
                share: float = 1.5, most: float = 2.0, doc_id: str = "doc_id",
                text: str = "text", source: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size (words),
    source_size, target (of the source) and copies (how often the mix takes
    the document). The words taken from a source differ from its target by at
    most half the document at the threshold.

    NULL and empty texts have size 0. NULL sources are one source, the last.
    Rows equal in id and text share a hash and are taken or left together. An
    empty table gives an empty one. Other columns are not read."""
    sized, bounds = _plan(docs, weights, share, most, doc_id, text, source)
    return sized.alias("d").join(
        bounds.alias("b"), F.col("d.source").eqNullSafe(F.col("b.source"))).select(
            "d.doc_id", "d.source", "d.size", "b.source_size", "b.target",
            (F.col("b._whole") + (F.col("d._h") < F.col("b._below")).cast("long")).alias("copies"))


def mixed(docs: DataFrame, *, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5,
          most: float = 2.0, doc_id: str = "doc_id", text: str = "text",
          source: str = "source") -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as
    often as ``mix_sources`` takes it."""
    _, bounds = _plan(docs, weights, share, most, doc_id, text, source)
    inner = docs.select(F.struct("*").alias("_row"), F.col(source).alias("_source"),
                        _hash(doc_id, text).alias("_h"))
    times = F.col("b._whole") + (F.col("d._h") < F.col("b._below")).cast("long")
    return inner.alias("d").join(
        bounds.alias("b"), F.col("d._source").eqNullSafe(F.col("b.source"))).select(
            "d._row", F.explode(F.array_repeat(F.lit(0), times.cast("int")))).select("_row.*")


def _small(table: DataFrame, rows: int = 10_000) -> bool:
    """Whether a table of narrow rows is proven small enough to broadcast."""
    return table.limit(rows + 1).count() <= rows


def _thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with ``_below``: a document is taken once more if its hash is less."""
    small = _small(targets)
    state = targets.select("source", F.lit(0).cast("long").alias("_prefix"),
                           F.col("_rest").alias("_left"), F.lit(0).cast("long").alias("_size"))
    digits = F.lit(1 << LEVEL_BITS)
    order = Window.partitionBy("source").orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        bucket = F.shiftright("d._h", shift)
        inside = sized.alias("d").join(
            F.broadcast(state.alias("s")) if small else state.alias("s"),
            F.col("d.source").eqNullSafe(F.col("s.source"))
            & (F.shiftright(bucket, LEVEL_BITS) == F.col("s._prefix")))
        sums = inside.groupBy("d.source", (bucket % digits).alias("_digit")).agg(
            F.sum("d.size").alias("_sum"))
        before = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(order), F.lit(0)))
        # the first bucket that the budget doesn't hold whole; without one, all of them fit
        crossing = before.alias("c").join(
            F.broadcast(state.alias("t")) if small else state.alias("t"),
            F.col("c.source").eqNullSafe(F.col("t.source"))).where(
                F.col("c._before") + F.col("c._sum") > F.col("t._left")).groupBy("c.source").agg(
                    F.min(F.struct("_digit", "_before", "_sum")).alias("_at"))
        state = written(state.alias("s").join(
            F.broadcast(crossing.alias("c")) if small else crossing.alias("c"),
            F.col("s.source").eqNullSafe(F.col("c.source")), "left").select(
                "s.source",
                (F.col("s._prefix") * digits
                 + F.coalesce(F.col("_at._digit"), digits)).alias("_prefix"),
                (F.col("s._left") - F.coalesce(F.col("_at._before"), F.lit(0))).alias("_left"),
                F.coalesce(F.col("_at._sum"), F.lit(0)).alias("_size")), "mix-bounds")
    # the document at the threshold goes in if that comes nearer to the budget
    end = F.col("_prefix") + (F.col("_size") < 2 * F.col("_left")).cast("long")
    last = state.select("source", end.alias("_below"))
    return written(targets.alias("t").join(
        F.broadcast(last.alias("l")) if small else last.alias("l"),
        F.col("t.source").eqNullSafe(F.col("l.source"))).select("t.*", "l._below"), "mix-thresholds")
