"""Substring dedup by recompression.

The words of all documents are renamed in rounds. A run of equal symbols
becomes one symbol; then every symbol is left or right by a bit of its name,
and each left symbol followed by a right one becomes one symbol with it. A new
symbol's name is a 64-bit hash of what it stands for, so every task gives it
the same name and the rounds need no shuffle. Whether two neighbours join
depends on these two alone; so equal passages get equal symbols inside, apart
from a few at their ends. Each symbol knows the words that it depends on.

A window of ``window`` words is represented by its anchor: of the symbols that
depend on no word outside it, the one with the smallest name (a window without
one is its own anchor). Equal windows have equal anchors. Spark first tells
which anchors occur more than once; only windows of these are hashed as a
whole and compared. The earliest of equal windows stays, the others are
removed with all their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (WordHashes, gram_hashes, mix, pack_sorted, power_of_two, ship, slices,
                     unpack_sorted, words, written)

#: Pair rounds; before those in RUN_ROUNDS, runs become symbols first.
ROUNDS, RUN_ROUNDS = 4, (0,)


@dataclass
class Symbols:
    """Symbols of several documents in a row: name, the first word, and the
    first and last word they depend on (all within the batch; a document's
    ends count as words outside)."""
    name: np.ndarray
    start: np.ndarray
    low: np.ndarray
    high: np.ndarray
    doc: np.ndarray


def _outside(s: Symbols) -> tuple[np.ndarray, ...]:
    """Where the next symbol is of the same document, and what is known of the
    neighbours' dependencies."""
    same = np.concatenate([s.doc[1:] == s.doc[:-1], [False]])
    before = np.concatenate([[-1], s.low[:-1]])
    before = np.where(np.concatenate([[False], same[:-1]]), before, s.start - 1)
    behind = np.concatenate([s.high[1:], [0]])
    end = np.concatenate([s.start[1:], [np.iinfo(np.int64).max]])
    behind = np.where(same, behind, end)
    return same, before, behind


def join_runs(s: Symbols) -> Symbols:
    same, before, behind = _outside(s)
    equal = same & np.concatenate([s.name[1:] == s.name[:-1], [False]])
    first = np.flatnonzero(np.concatenate([[True], ~equal[:-1]]))
    last = np.concatenate([first[1:], [len(equal)]]) - 1
    length = (last - first + 1).astype(np.uint64)
    with np.errstate(over="ignore"):
        name = np.where(length > 1, mix(s.name[first] * np.uint64(3) + length), s.name[first])
    return Symbols(name, s.start[first], np.minimum(s.low[first], before[first]),
                   np.maximum(s.high[last], behind[last]), s.doc[first])


def join_pairs(s: Symbols, turn: int) -> Symbols:
    same, before, behind = _outside(s)
    with np.errstate(over="ignore"):
        right = (mix(s.name + np.uint64(turn + 1) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(1)).astype(bool)
    joins = same & ~right & np.concatenate([right[1:], [False]])
    second = np.concatenate([[False], joins[:-1]])
    keep = ~second
    nxt = np.minimum(np.arange(1, len(right) + 1), len(right) - 1)
    with np.errstate(over="ignore"):
        name = np.where(joins, mix(s.name * np.uint64(5) + mix(s.name[nxt]) + np.uint64(turn)), s.name)
    # a left symbol that stays alone depends on the next one, a right one on the one before
    low = np.where(right & keep, np.minimum(s.low, before), s.low)
    high = np.where(joins, np.maximum(s.high, s.high[nxt]), np.where(~right, np.maximum(s.high, behind), s.high))
    low = np.where(joins, np.minimum(low, s.low[nxt]), low)
    return Symbols(name[keep], s.start[keep], low[keep], high[keep], s.doc[keep])


def recompress(per_doc: list[np.ndarray]) -> Symbols:
    sizes = [len(h) for h in per_doc]
    # one place between documents, so that "outside" never is a word of another one
    starts = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64) + 1)])
    at = np.concatenate([np.zeros(0, np.int64)] + [
        np.arange(a, a + n) for a, n in zip(starts.tolist(), sizes, strict=False)])
    doc = np.repeat(np.arange(len(sizes)), sizes)
    s = Symbols(np.concatenate([np.zeros(0, np.uint64), *per_doc]), at, at.copy(), at.copy(), doc)
    for turn in range(ROUNDS):
        if not len(s.name):
            break
        if turn in RUN_ROUNDS:
            s = join_runs(s)
        s = join_pairs(s, turn)
    return s


def anchors(per_doc: list[np.ndarray], window: int) -> tuple[np.ndarray, ...]:
    """For each window of each document, in order: document, first word (in
    the document), its hash, the name of its anchor and the anchor's place (a
    number that tells it from all others of the document)."""
    sizes = np.array([len(h) for h in per_doc], np.int64)
    counts = np.maximum(sizes - window + 1, 0)
    doc = np.repeat(np.arange(len(sizes)), counts)
    first = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    base = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    at = first + base[doc] if len(doc) else first
    flat = np.zeros(int(sizes.sum() + len(sizes)), np.uint64)
    for b, h in zip(base.tolist(), per_doc, strict=True):
        flat[b:b + len(h)] = h
    whole = gram_hashes(flat, window)[at] if len(at) else np.zeros(0, np.uint64)
    s = recompress(per_doc)
    lo = np.searchsorted(s.low, at)
    hi = np.searchsorted(s.high, at + window - 1, "right")
    many = hi - lo
    none = many <= 0
    lo = np.minimum(lo, max(len(s.name) - 1, 0))
    order = mix(s.name)
    best = np.arange(len(order))
    tables = [best]
    step = 1
    while len(order) and 2 * step <= max(1, int(many.max(initial=1))):
        other = np.minimum(np.arange(len(order)) + step, len(order) - 1)
        a, b = tables[-1], tables[-1][other]
        tables.append(np.where(order[a] <= order[b], a, b))
        step *= 2
    if len(order) and len(at):
        level = np.zeros(len(at), np.int64)
        wide = np.maximum(many, 1)
        for j in range(1, len(tables)):
            level[wide >= (1 << j)] = j
        table = np.stack(tables)
        a = table[level, lo]
        b = table[level, np.maximum(lo, np.minimum(hi, len(order)) - (1 << level))]
        chosen = np.where(order[a] <= order[b], a, b)
        name = np.where(none, mix(whole + np.uint64(1)), s.name[chosen])
        place = np.where(none, -1 - first, s.start[chosen] - base[doc])
    else:
        name, place = mix(whole + np.uint64(1)), -1 - first
    return doc, first, whole, name, place


def _batches(batches: Iterator[pa.RecordBatch], hashes: WordHashes, column: int,
             step: int = 400) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Some rows and their words' hashes at a time, about ``step`` rows or as
    many as have 400,000 words."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            got, held, n = [], 0, 0
            while at + n < batch.num_rows and n < step and held < 400_000:
                h = hashes.of(batch.column(column)[at + n].as_py())
                got.append(h)
                held += len(h)
                n += 1
            yield batch.slice(at, n), got
            at += n


BLOBS = "bucket int, keys binary, docs binary, places binary, ids binary, nulls binary, hashes binary"


def _blobs(keys, docs, places, ids, hashes, buckets) -> pa.RecordBatch:
    """One row per bucket of keys: the keys in order, and for each the number
    of its document in the row's own list, and its place."""
    order = np.argsort(keys, kind="stable")
    keys, docs, places = keys[order], docs[order], places[order]
    rows = []
    for b, c in slices(keys, buckets):
        own, index = np.unique(docs[c], return_inverse=True)
        rows.append((b, pack_sorted(keys[c]), index.astype("<u4").tobytes(), places[c].astype("<i4").tobytes(),
                     np.array([ids[k] or 0 for k in own], "<i8").tobytes(),
                     np.array([ids[k] is None for k in own], np.uint8).tobytes(),
                     np.array([hashes[k] for k in own], "<i8").tobytes()))
    cols = list(zip(*rows, strict=True)) or [()] * 7
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
        ["bucket", "keys", "docs", "places", "ids", "nulls", "hashes"])


def _unblob(part: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """keys, rank of the document in order of (NULL last, doc_id, text hash),
    place, and the documents by rank: id, null, text hash."""
    keys = np.concatenate([unpack_sorted(x) for x in part["keys"]])
    place = np.concatenate([np.frombuffer(x, "<i4") for x in part["places"]])
    ids = [np.frombuffer(x, "<i8") for x in part["ids"]]
    shift = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    index = np.concatenate([np.frombuffer(x, "<u4").astype(np.int64) + a
                            for x, a in zip(part["docs"], shift, strict=False)])
    ids, nulls = np.concatenate(ids), np.concatenate([np.frombuffer(x, np.uint8) for x in part["nulls"]])
    hashes = np.concatenate([np.frombuffer(x, "<i8") for x in part["hashes"]])
    order = np.lexsort((hashes, ids, nulls))
    new = np.ones(len(order), bool)
    new[1:] = ((np.diff(hashes[order]) != 0) | (np.diff(ids[order]) != 0)
               | (np.diff(nulls[order].astype(int)) != 0))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) - 1
    return keys, rank[index], place, ids[order][new], nulls[order][new], hashes[order][new]


def _per_doc(rank, place, ids, nulls, hashes) -> pd.DataFrame:
    """One row per document with its places as signed 32-bit numbers."""
    order = np.argsort(rank, kind="stable")
    rank, place = rank[order], place[order].astype("<i4")
    first = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]])) if len(rank) else rank
    parts = np.split(place, first[1:]) if len(rank) else []
    own = rank[first] if len(rank) else rank
    return pd.DataFrame({"doc_id": ids[own], "is_null": nulls[own] > 0, "text_hash": hashes[own],
                         "places": [p.tobytes() for p in parts]})


DOC_PLACES = "doc_id long, is_null boolean, text_hash long, places binary"


def _collected(part: DataFrame) -> DataFrame:
    return part.groupBy("doc_id", "is_null", "text_hash").agg(F.collect_list("places").alias("places"))


def _bounded(df: DataFrame, size) -> DataFrame:
    """``df``, whose rows have ``size`` bytes, marked for broadcasting if it is
    proven to have 32 MB at most; beyond that Spark shuffles both sides."""
    total = df.agg(F.coalesce(F.sum(size + F.lit(64)), F.lit(0))).first()[0]
    return F.broadcast(df) if total <= 32 << 20 else df


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, is_null, text_hash, t) and whether the row is a later copy of
    a whole text. Copies need no windows: all of theirs start earlier."""
    body = F.col(text).cast("binary")
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("doc_id"),
                       F.col(doc_id).isNull().alias("is_null"), F.xxhash64(body).alias("text_hash"),
                       F.xxhash64(F.lit(1), body).alias("h2"), body.alias("t"))
    own = F.struct("is_null", "doc_id")
    copied = written(rows.groupBy("text_hash", "h2").agg(F.min(own).alias("first"), F.count("*").alias("n")).where(
        "n > 1").drop("n"), "substring-copies")
    return rows.join(_bounded(copied, F.lit(32)), ["text_hash", "h2"], "left").select(
        "doc_id", "is_null", "text_hash", "t", F.coalesce(own != F.col("first"), F.lit(False)).alias("copy"))


def repeated_windows(rows: DataFrame, window: int) -> DataFrame:
    """doc_id, is_null, text_hash and places: the first words of those windows
    of each document that also start earlier. Documents without any, and
    copies, are left out."""
    keys = ["doc_id", "is_null", "text_hash"]
    rows = rows.where(~F.col("copy")).select(*keys, "t")
    total = rows.count()

    def ids_of(r: pa.RecordBatch) -> tuple[list, list]:
        return ([None if z else i for i, z in zip(r.column(0).to_pylist(), r.column(1).to_pylist(), strict=True)],
                r.column(2).to_pylist())

    def emit_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for r, per_doc in _batches(batches, hashes, 3):
            doc, _, _, name, place = anchors(per_doc, window)
            if not len(doc):
                continue
            # consecutive windows mostly share their anchor: one entry for each
            new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])])
            yield _blobs(name[new], doc[new], place[new], *ids_of(r), buckets)

    def repeated(part: pd.DataFrame) -> pd.DataFrame:
        keys, rank, place, ids, nulls, text_hashes = _unblob(part)
        order = np.lexsort((place, rank, keys))
        k, r, p = keys[order], rank[order], place[order]
        new = np.ones(len(k), bool)  # an anchor may be named again after another one's windows
        new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1]) | (p[1:] != p[:-1])
        k, r, p = k[new], r[new], p[new]
        start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        size = np.diff(np.append(start, len(k)))
        many = np.repeat(size > 1, size)
        return _per_doc(r[many], p[many], ids, nulls, text_hashes)

    buckets = power_of_two(total * 64 / 1e6, 32)
    shared = written(_collected(rows.mapInArrow(emit_anchors, BLOBS).groupBy("bucket").applyInPandas(
        repeated, DOC_PLACES)), "substring-anchors")
    # the places grow with the texts, so both sides go through a shuffle at every size
    marked = rows.join(shared, keys).select(*keys, "t", "places")

    def emit_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for r, per_doc in _batches(batches, hashes, 3):
            doc, first, whole, _, place = anchors(per_doc, window)
            if not len(doc):
                continue
            # (document, place) of the shared anchors as one number
            places = [np.frombuffer(b"".join(x), "<i4").astype(np.int64) for x in r.column(4).to_pylist()]
            known = np.concatenate([(k << 33) + x for k, x in enumerate(places)])
            take = np.isin((doc << 33) + place, known)
            if take.any():
                yield _blobs(whole[take], doc[take], first[take], *ids_of(r), buckets)

    def later(part: pd.DataFrame) -> pd.DataFrame:
        keys, rank, place, ids, nulls, text_hashes = _unblob(part)
        at = (rank << 32) + place
        order = np.lexsort((at, keys))
        k, a = keys[order], at[order]
        start = np.concatenate([[True], k[1:] != k[:-1]])
        first = a[np.flatnonzero(start)][np.cumsum(start) - 1]
        late = a != first  # a repeated row has the very place of the first
        return _per_doc(rank[order][late], place[order][late], ids, nulls, text_hashes)

    return written(_collected(marked.mapInArrow(emit_windows, BLOBS).groupBy("bucket").applyInPandas(
        later, DOC_PLACES)), "substring-windows")


def remove_repeats(docs: DataFrame, *, window: int = 20, doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed and kept (the
    words that are left, joined by one blank): every word covered by a window
    of ``window`` words that also starts earlier is removed. Earlier is a
    smaller doc_id (NULL: after all others; equal ids: the smaller hash of the
    text) or an earlier place in the document.

    A NULL or empty text has no words. Rows equal in id and text count as one
    document and get equal results. An empty table gives an empty one. Other
    columns are not read. Windows are compared by 64-bit hashes."""
    ship(docs.sparkSession)
    keys = ["doc_id", "is_null", "text_hash"]
    rows = _rows(docs, doc_id, text)
    late = repeated_windows(rows, window)
    marked = rows.join(late, keys, "left").select(
        F.when(~F.col("is_null"), F.col("doc_id")).alias("doc_id"), "t", "places", "copy")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                n, removed, kept = [], [], []
                for t, places, copy in zip(*[part.column(c).to_pylist() for c in (1, 2, 3)], strict=True):
                    w = words(t)
                    n.append(len(w))
                    if copy and len(w) >= window:
                        w = []
                    elif places:
                        p = np.frombuffer(b"".join(places), "<i4")
                        edge = np.zeros(len(w) + 1, np.int64)
                        np.add.at(edge, p, 1)
                        np.add.at(edge, p + window, -1)
                        stays = np.cumsum(edge)[:-1] == 0
                        w = [x for x, s in zip(w, stays.tolist(), strict=True) if s]
                    removed.append(n[-1] - len(w))
                    kept.append(b" ".join(w))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(kept, pa.binary())], ["doc_id", "n_words", "n_removed", "kept"])

    return marked.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept binary").withColumn(
        "kept", F.col("kept").cast("string"))
