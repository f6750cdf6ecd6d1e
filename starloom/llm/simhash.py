"""SimHash near-duplicates, found with BK-trees.

A text's fingerprint has 64 bits: a bit is 1 if more than half of the hashes of
its word shingles have it. Texts link when their fingerprints differ in a few
bits at most. Equal fingerprints are one node from the start, so any number of
copies costs one.

Fingerprints that differ in at most ``distance`` bits agree in all but
``distance`` of the blocks that the bits are cut into. Each choice of the
agreeing blocks is a table, and the fingerprints with one value of them are a
shard; two that link meet in a shard of at least one table. The number of
blocks follows from the number of fingerprints, so that shards stay small.

A shard is searched with a BK-tree: a node's children hang on edges that bear
their Hamming distance to it (an integer, one child each), and a search goes
from a node that is d bits away only along edges from d - distance to
d + distance. A task holds a forest of many shards' trees, built and searched
level by level with array operations.

A shard of more than ``chunk`` fingerprints (a hot block value) is dealt to
chunks: each chunk's tree is sent to as many tasks as there are chunks of
queries, so that no task holds more than one tree of bounded size and one
chunk of queries. All trees together hold every fingerprint, so they go through
a shuffle to the tasks that query them, and not through the driver.

A task gives the links as a spanning forest of what it has found, which says
the same about reachability as all pairs of a group of many near copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, power_of_two, ship, small_enough, words, written

BITS = 64
#: Of the eight bytes of a hash, one bit each.
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes | None, n: int, seed: int) -> np.ndarray:
    """XXH64 of all runs of ``n`` words, A-Z lower-cased and joined by one
    space, repeats included; of fewer words, the whole sequence."""
    found = words(text.lower() if text else None)
    if not found:
        return np.zeros(0, np.uint64)
    whole = b" ".join(found)
    if len(found) <= n:
        return np.array([xxhash.xxh64_intdigest(whole, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    cut = map(whole.__getitem__, map(slice, starts[:len(found) - n + 1].tolist(), ends[n - 1:].tolist()))
    return np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(seed)), np.uint64, len(found) - n + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit by bit, what more than half of ``hashes`` have; of none, zero."""
    many = len(hashes)
    if not many:
        return 0
    starts = np.arange(0, many, 255)  # a byte counts to 255
    out = 0
    for k in range(8):
        lanes = (hashes >> np.uint64(k)) & _LANES
        counts = np.add.reduceat(lanes, starts).view(np.uint8).reshape(-1, 8).sum(0, dtype=np.int64)
        for byte in np.flatnonzero(2 * counts > many).tolist():
            out |= 1 << (8 * byte + k)
    return out


def fingerprints(docs: DataFrame, *, shingle: int, seed: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``; fp as a signed 64-bit number."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                made = [fingerprint(shingle_hashes(t.as_py(), shingle, seed)) for t in some.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(np.array(made, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary")).mapInArrow(
        measure, "doc_id long, fp long")


def blocks_for(fps: int, distance: int, wanted: int = 1024) -> int:
    """Into how many blocks to cut, so that a shard of evenly spread
    fingerprints has about ``wanted`` at most."""
    for blocks in range(distance + 1, 2 * distance + 2):
        if fps >> (BITS * (blocks - distance) // blocks) <= wanted:
            break
    return blocks


def masks(blocks: int, distance: int) -> list[int]:
    """The bits that each table compares."""
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - distance)]


class Forest:
    """BK-trees of many shards. ``fp`` are the nodes in the order in which they
    came; the root of a shard is its first. Children are sorted by parent and
    edge, so that a range of a node's edges is one stretch of them."""

    def __init__(self, shard: np.ndarray, fp: np.ndarray):
        self.fp = fp
        self.shards, root, of = np.unique(shard, return_index=True, return_inverse=True)
        self.roots = root
        node = np.arange(len(fp))
        at = root[of]  # where each one stands now; it goes down until it has a place
        left = node[at != node]
        keys, children = [], []
        while len(left):
            key = at[left] * (BITS + 1) + np.bitwise_count(fp[left] ^ fp[at[left]])
            edge, first, of = np.unique(key, return_index=True, return_inverse=True)
            keys.append(edge)
            children.append(left[first])
            at[left] = left[first][of]
            left = left[at[left] != left]
        keys = np.concatenate([np.zeros(0, np.int64), *keys])
        order = np.argsort(keys)
        self.edges, self.children = keys[order], np.concatenate([node[:0], *children])[order]

    def search(self, shard: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(query, node) of all nodes of a query's shard within ``distance``
        bits, and how many nodes were looked at."""
        place = np.minimum(np.searchsorted(self.shards, shard), max(len(self.shards) - 1, 0))
        query = np.flatnonzero(self.shards[place] == shard) if len(self.shards) else np.zeros(0, np.int64)
        node = self.roots[place[query]]
        hits, looked = [], 0
        while len(query):
            looked += len(query)
            d = np.bitwise_count(fp[query] ^ self.fp[node]).astype(np.int64)
            near = d <= distance
            hits.append((query[near], node[near]))
            base = node * (BITS + 1)
            low = np.searchsorted(self.edges, base + np.maximum(d - distance, 0))
            many = np.searchsorted(self.edges, base + np.minimum(d + distance, BITS), "right") - low
            step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            query, node = np.repeat(query, many), self.children[np.repeat(low, many) + step]
        u, v = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*hits)) if hits else (query, query)
        return u, v, looked


def spanning(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the smallest that the links u, v lead to."""
    label = np.arange(n)
    while len(u):
        low = np.minimum(label[u], label[v])
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        while (label != label[label]).any():
            label = label[label]
        apart = label[u] != label[v]
        u, v = u[apart], v[apart]
    return label


def _links_within(part: pd.DataFrame, distance: int, pairs: int = 500_000) -> pd.DataFrame:
    """The links between the trees (role 1), queries (role 2) or both (3)."""
    role = part["role"].to_numpy()
    shard, fp = part["shard"].to_numpy(), part["fp"].to_numpy().view(np.uint64)
    names = np.unique(fp)
    tree, ask = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
    forest = Forest(shard[tree], fp[tree])
    sizes = np.unique(shard[tree], return_counts=True)
    load = np.ones(len(ask), np.int64)
    if len(tree):
        at = np.minimum(np.searchsorted(sizes[0], shard[ask]), len(sizes[0]) - 1)
        load = sizes[1][at]
    cut = np.flatnonzero(np.diff(np.cumsum(load) // pairs)) + 1  # as many queries at once as memory allows
    label = np.arange(len(names))
    for some in np.split(ask, cut):
        q, t, _ = forest.search(shard[some], fp[some], distance)
        u, v = np.searchsorted(names, fp[some][q]), np.searchsorted(names, fp[tree][t])
        apart = label[u] != label[v]
        label = spanning(np.concatenate([np.arange(len(names)), u[apart]]),
                         np.concatenate([label, v[apart]]), len(names))
    linked = label != np.arange(len(names))
    return pd.DataFrame({"a": names[label[linked]].view(np.int64), "b": names[linked].view(np.int64)})


def links(fps: DataFrame, *, distance: int, chunk: int, blocks: int | None = None) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp), which lead
    from each one to all that links lead to."""
    n = fps.count()
    chosen = masks(blocks or blocks_for(n, distance), distance)

    def shard_of(table: int, mask: int) -> Column:
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        return F.xxhash64(F.lit(table), F.col("fp").bitwiseAND(F.lit(signed).cast("long")))

    entries = fps.select("fp", F.explode(F.array(*[shard_of(i, m) for i, m in enumerate(chosen)])).alias("shard"))
    hot = written(entries.groupBy("shard").agg(F.count("*").alias("k")).where(F.col("k") > chunk).select(
        "shard", F.ceil(F.col("k") / chunk).cast("int").alias("chunks")), "simhash-hot")
    known = entries.join(small_enough(hot), "shard", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    mine = F.pmod(F.xxhash64(F.lit(1), "fp"), "chunks").cast("int")
    buckets = power_of_two(n * len(chosen) / 32_768)
    meets = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda i: F.struct(
        F.least(i, "own").alias("tree"), F.greatest(i, "own").alias("ask"),
        F.when(i < F.col("own"), 2).when(i == F.col("own"), 3).otherwise(1).alias("role")))
    dealt = known.withColumn("own", mine).select("fp", "shard", "chunks", F.explode(meets).alias("m")).select(
        "fp", "shard", "m.role", "m.tree", "m.ask",
        F.when(F.col("chunks") == 1, F.pmod("shard", F.lit(buckets))).otherwise(F.col("shard")).alias("bucket"))
    return dealt.groupBy("bucket", "tree", "ask").applyInPandas(
        lambda part: _links_within(part, distance), "a long, b long")


def near_fingerprints(docs: DataFrame, *, shingle: int = 3, distance: int = 3, seed: int = 42,
                      doc_id: str = "doc_id", text: str = "text", chunk: int = 8192,
                      blocks: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits) and
    component_id, the smallest doc_id that links lead to, itself included.

    Case of A-Z doesn't count. A text of fewer words than a shingle has its
    whole sequence as one. A text without words, or NULL, has fingerprint zero
    and links like any other. Equal texts and repeated rows link. A NULL doc_id
    is no component_id unless all of the component are NULL. An empty table
    gives an empty one. Other columns are not read.

    ``chunk`` bounds a tree, ``blocks`` sets the number of blocks; neither
    affects the result."""
    ship(docs.sparkSession)
    rows = written(fingerprints(docs, shingle=shingle, seed=seed, doc_id=doc_id, text=text), "simhash-rows")
    least = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-fps")
    found = written(links(least.select("fp"), distance=distance, chunk=chunk, blocks=blocks), "simhash-links")
    groups = components(found).select(F.col("node").alias("fp"), F.col("component"))
    classes = least.join(groups, "fp", "left").withColumn("c", F.coalesce("component", "fp"))
    ids = classes.groupBy("c").agg(F.min("least").alias("component_id"))
    to = written(classes.join(ids, "c").select("fp", "component_id"), "simhash-classes")
    return rows.join(small_enough(to), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
