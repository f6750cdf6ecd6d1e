"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``2**RING_BITS`` cells; every shard owns ``virtual`` of them, and
a key belongs to the shard of the first owned cell at or after its own. A
shard takes no more rows than its share: keys that come to a full shard
continue clockwise. Shares differ by one row at most, so the counts do too
(law "rows"), and with one shard more most rows stay where they are.

The result is the one of putting in the keys one by one, in ring order from
cell 0. It needs no such loop over keys: Spark counts the keys per cell, a
loop over the owned cells, whose number is fixed by the parameters, finds
which runs of keys go where, and each key finds its run by its rank on the
ring, which is the count of the cells before plus its rank in its cell.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

RING_BITS = 16


def _point(s: str) -> int:
    import hashlib
    return int.from_bytes(hashlib.md5(s.encode()).digest()[:8], "big") >> (64 - RING_BITS)


def ring(shards: int, virtual: int) -> list[tuple[int, int]]:
    """(cell, shard) of the owned cells in ring order. Of shards that draw the
    same cell, the smallest number has it."""
    owner: dict[int, int] = {}
    for shard in range(shards):
        for v in range(virtual):
            owner.setdefault(_point(f"shard-{shard}/{v}"), shard)
    return sorted(owner.items())


def place_runs(counts: np.ndarray, shards: int, virtual: int) -> pd.DataFrame:
    """Runs of keys in ring order: first (rank of its first key), shard and
    slot (of that key). ``counts``: keys per cell."""
    total = int(counts.sum())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled = [0] * shards
    nodes = ring(shards, virtual)
    before = np.concatenate([[0], np.cumsum(counts)])
    runs, waiting, last = [], deque(), 0
    for turn in range(2):  # whoever finds no room up to the end of the ring goes on from its start
        for cell, shard in nodes:
            if turn == 0 and before[cell + 1] > last:
                waiting.append((last, int(before[cell + 1])))
                last = int(before[cell + 1])
            while waiting and filled[shard] < room[shard]:
                a, b = waiting.popleft()
                n = min(b - a, room[shard] - filled[shard])
                runs.append((a, shard, filled[shard]))
                filled[shard] += n
                if a + n < b:
                    waiting.appendleft((a + n, b))
        if turn == 0 and last < total:
            waiting.append((last, total))
    return pd.DataFrame(sorted(runs), columns=["first", "shard", "slot"])


def stretches(counts: np.ndarray, runs: pd.DataFrame) -> pd.DataFrame:
    """The ranks of each cell, cut where runs begin: cell, from, to (ranks in
    the cell), shard and slot (of the first)."""
    before = np.concatenate([[0], np.cumsum(counts)])
    first = runs["first"].to_numpy(np.int64)
    full = np.flatnonzero(counts)
    at = np.union1d(before[full], first)
    cell = full[np.searchsorted(before[full], at, "right") - 1]
    run = np.searchsorted(first, at, "right") - 1
    end = np.append(at[1:], before[-1])
    return pd.DataFrame({
        "_cell": cell.astype(np.int32), "_from": at - before[cell], "_to": end - before[cell],
        "shard": runs["shard"].to_numpy(np.int64)[run],
        "_slot": runs["slot"].to_numpy(np.int64)[run] + at - first[run]})


def shard_rows(docs: DataFrame, *, shards: int = 40, virtual: int = 64, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size (UTF-8 bytes of the text plus
    16), text_crc32, shard and slot (0, 1, ... within the shard).

    A key is id and text together, so that copies of a text spread. NULL ids
    and texts are keys like others; a NULL text has no bytes. Rows equal in
    both lie side by side on the ring. An empty table gives an empty one.
    Other columns are not read."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    if docs.limit(1).count() == 0:
        return docs.select(F.col(doc_id).alias("doc_id"), F.lit(0).cast("long").alias("size"),
                           F.lit(0).cast("long").alias("text_crc32"), F.lit(0).alias("shard"),
                           F.lit(0).cast("long").alias("slot"))
    point: Column = F.shiftrightunsigned(F.xxhash64(F.col(doc_id), F.col(text)), 1)
    rows = written(docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"), point.alias("_h"),
        F.shiftright(point, 63 - RING_BITS).cast("int").alias("_cell")), "shard-rows")
    counts = np.zeros(1 << RING_BITS, np.int64)
    for cell, n in rows.groupBy("_cell").count().collect():  # at most 2**RING_BITS rows
        counts[cell] = n
    where = docs.sparkSession.createDataFrame(stretches(counts, place_runs(counts, shards, virtual)))
    where = F.broadcast(written(where, "shard-stretches"))  # 2**RING_BITS rows and one per run at most

    # a cell holds 1/2**RING_BITS of the keys
    rank = F.row_number().over(Window.partitionBy("_cell").orderBy("_h", "doc_id", "text_crc32", "size"))
    ranked = rows.withColumn("_rank", rank - 1).join(where, "_cell").where(
        (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    return ranked.select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                         (F.col("_slot") + F.col("_rank") - F.col("_from")).alias("slot"))
