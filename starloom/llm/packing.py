"""Best-fit packing by the sum-of-squares rule.

Documents become token ids with an end id, are cut where longer than a
sequence, and the pieces are packed: each goes where the sum of the squared
numbers of open bins per remaining gap becomes smallest. That keeps open bins
of every gap at hand, so that most bins close without waste.

Only lengths are packed. They are dealt to groups of about ``group_size``
pieces by a hash, one task a group; a group wastes less than a few bins, so
groups of this size lose next to nothing against one global packing. The ids
meet their places again in a join on the piece's number, which is unique.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, small_enough, written
from .tokens import column_stretches, encoder, place

#: Words that a worker remembers: about 115 MB.
WORDS = 600_000
PIECES = "doc_id long, piece int, start long, length long, ids binary"


def token_pieces(docs: DataFrame, *, length: int = 2048, end_id: int = 0, doc_id: str = "doc_id",
                 text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece (from 0), start (ids of the document
    before it), length and ids (little-endian unsigned 32-bit). Only documents
    of more than ``length`` ids, end id included, have more than one."""
    ship(docs.sparkSession)
    end, step = np.asarray([end_id], "<u4").tobytes(), 4 * length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(place(tokenizer), WORDS)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = batch.column(1)
            for at, to in column_stretches(texts):  # small outputs, whatever the texts' lengths
                ids = [x + end for x in encode(texts.slice(at, to - at).to_pylist())]
                rows = [(k, p // step, p // 4, x[p:p + step]) for k, x in
                        zip(keys[at:to], ids, strict=True) for p in range(0, len(x), step)]
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                     pa.array(cols[2], pa.int64()),
                     pa.array([len(x) // 4 for x in cols[3]], pa.int64()),
                     pa.array(cols[3], pa.binary())],
                    ["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary")).mapInArrow(cut, PIECES)


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, packed longest first into bins of
    ``size``."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(size)]
    count = np.zeros(size, np.int64)  # open bins by gap; count[0] stays 0
    n = 0
    far = np.iinfo(np.int64).max
    for k in order:
        s = int(lengths[k])
        if s >= size:
            bins[k], offsets[k] = n, 0
            n += 1
            continue
        have, then = count[s:], count[:size - s]
        # half the change of the sum of squares, for a bin of each gap from s on
        change = np.where(have > 0, then - have + 1, far)
        if have[0]:
            change[0] = -have[0]  # the bin closes: no gap gains one
        best = int(change.argmin())
        if change[best] <= count[size - s]:
            gap = s + best
            b = open_bins[gap].pop()
            count[gap] -= 1
        else:
            gap, b = size, n
            n += 1
        bins[k], offsets[k] = b, size - gap
        if gap > s:
            open_bins[gap - s].append(b)
            count[gap - s] += 1
    return bins, offsets


def pack_documents(docs: DataFrame, *, length: int = 2048, end_id: int = 0,
                   group_size: int = 50_000, doc_id: str = "doc_id", text: str = "text",
                   tokenizer: str | None = None) -> DataFrame:
    """The rows of ``token_pieces`` with sequence_id (a number of no meaning)
    and offset: each piece's place in its sequence of at most ``length`` ids,
    without gaps from 0.

    A NULL or empty text is the end id alone. Rows with equal ids are packed
    like any others. An empty table gives an empty one. Other columns are not
    read."""
    made = token_pieces(docs, length=length, end_id=end_id, doc_id=doc_id, text=text,
                        tokenizer=tokenizer)
    pieces = written(made.withColumn("_key", F.monotonically_increasing_id()), "pack-pieces")
    groups = max(1, math.ceil(pieces.count() / group_size))

    def pack(key: tuple[int], part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_key", ignore_index=True)  # the same in every run
        bins, offsets = sum_of_squares(part["length"].to_numpy(), length)
        return pd.DataFrame({"_at": part["_key"], "sequence_id": bins * groups + key[0],
                             "offset": offsets})

    places = pieces.select("_key", "length", F.pmod(F.xxhash64("_key"), F.lit(groups)).alias("_g"))
    places = places.groupBy("_g").applyInPandas(pack, "_at long, sequence_id long, offset long")
    places = written(places, "pack-places")
    return pieces.join(small_enough(places), F.col("_key") == F.col("_at")).drop("_key", "_at")
