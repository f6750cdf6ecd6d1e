"""Importance resampling towards a target distribution, by segments.

Texts are bags of hashed word n-grams (runs of one and two words). A bucket's
gain is the log ratio of its share in the target texts to that in all
documents; a document's weight is the mean gain of its features. Drawing the
highest of weight plus Gumbel noise, without replacement, is a draw in
proportion to the exponential of the weights; the noise comes from a hash of
the id, so that reruns agree.

Newlines separate words, so they cut a text into lines that share no word.
Spark counts equal lines of the whole corpus first; the features of a distinct
line are hashed once and count as often as the line occurs. Pairs of words
across a line break, the last word of one line and the first of the next one
that has any, are added on the side. A document's weight comes from the same
parts: the gains of a batch's distinct lines, each summed once, and of the
pairs across breaks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dense_keys import number_rows
from .common import ship, written

#: A-Z become a-z; ASCII other than letters and digits separates words.
_WORD_BYTES = bytes(c if chr(c).islower() or chr(c).isdigit() else c + 32 if chr(c).isupper() else 32
                    for c in range(128)) + bytes(range(128, 256))


def line_words(line: bytes) -> list[bytes]:
    """Runs of letters a-z, digits and characters beyond ASCII, lower-cased."""
    return line.translate(_WORD_BYTES).split()


def line_features(lines: list[list[bytes]], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all words and of all neighbours of each line, and the
    number of the line that each one belongs to."""
    flat = [w for line in lines for w in line]
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    of = np.repeat(np.arange(len(lines)), sizes)
    one = np.fromiter(map(crc32, flat), np.uint32, len(flat))
    if len(flat) < 2:
        return one % buckets, of
    # the CRC of "a b" goes on from that of "a"
    two = np.fromiter(map(crc32, map(b" ".__add__, flat[1:]), one[:-1].tolist()), np.uint32, len(flat) - 1)
    same = of[1:] == of[:-1]
    return np.concatenate([one, two[same]]) % buckets, np.concatenate([of, of[1:][same]])


def break_pairs(lines: list[bytes]) -> list[bytes]:
    """The pairs of words across the line breaks of a text."""
    out, last = [], None
    for line in lines:
        found = line.translate(_WORD_BYTES)
        first = found.split(None, 1)
        if first:
            if last is not None:
                out.append(last + b" " + first[0])
            last = found.rsplit(None, 1)[-1]
    return out


def _texts(batches: Iterator[pa.RecordBatch], column: int, bytes_at_once: int = 4 << 20) -> Iterator[tuple]:
    """Row numbers and texts of a batch, some at a time: few where they are long."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            some, held, start = [], 0, at
            while at < batch.num_rows and held < bytes_at_once:
                value = batch.column(column)[at].as_py() or b""
                held += len(value) + 64
                some.append(value)
                at += 1
            yield batch.slice(start, at - start), some


def _histogram(batches: Iterator[pa.RecordBatch], buckets: int,
               add: Callable[[pa.RecordBatch, list[bytes], np.ndarray], None]) -> Iterator[pa.RecordBatch]:
    """One task's counts by bucket, where there are any."""
    counts = np.zeros(buckets, np.int64)
    for rows, texts in _texts(batches, 0):
        add(rows, texts, counts)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some])], ["bucket", "n"])


def feature_counts(texts: DataFrame, text: str, buckets: int) -> dict[int, int]:
    """How many features of all texts fall into each bucket (at most
    ``buckets`` numbers, which is all that reaches the driver)."""

    def of_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def add(rows: pa.RecordBatch, lines: list[bytes], counts: np.ndarray) -> None:
            found, of = line_features([line_words(x) for x in lines], buckets)
            times = rows.column(1).to_numpy()
            # exact: the products stay far below 2**53
            counts += np.bincount(found, times[of], buckets).astype(np.int64)
        yield from _histogram(batches, buckets, add)

    def of_breaks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def add(_rows: pa.RecordBatch, whole: list[bytes], counts: np.ndarray) -> None:
            pairs = [p for t in whole for p in break_pairs(t.split(b"\n"))]
            found = np.fromiter(map(crc32, pairs), np.uint32, len(pairs)) % buckets
            counts += np.bincount(found, minlength=buckets)
        yield from _histogram(batches, buckets, add)

    schema = "bucket int, n long"
    lines = texts.select(F.explode(F.split(F.col(text), "\n")).alias("line")).where(F.length("line") > 0)
    distinct = lines.groupBy("line").agg(F.count("*").alias("times"))
    inside = distinct.select(F.col("line").cast("binary"), "times").mapInArrow(of_lines, schema)
    broken = texts.where(F.contains(F.col(text), F.lit("\n"))).select(F.col(text).cast("binary"))
    both = inside.unionByName(broken.mapInArrow(of_breaks, schema))
    return {r[0]: r[1] for r in both.groupBy("bucket").agg(F.sum("n")).collect()}


def bucket_gains(own: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """Thousandths of the natural log of the ratio of smoothed shares, target
    to own, rounded down."""
    s_all, t_all = sum(own.values()), sum(target.values())
    return np.array([math.floor(1000 * math.log(
        (target.get(b, 0) + 1) * (s_all + buckets) / ((own.get(b, 0) + 1) * (t_all + buckets))))
        for b in range(buckets)], np.int64)


def document_weights(docs: DataFrame, gains: np.ndarray, *, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text_hash, n_features, weight) of each row."""
    buckets = len(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _texts(batches, 2):
            split = [t.split(b"\n") for t in texts]
            number: dict[bytes, int] = {}
            lines = [number.setdefault(x, len(number)) for t in split for x in t]
            of = np.repeat(np.arange(len(split)), [len(t) for t in split])
            found, line = line_features([line_words(x) for x in number], buckets)
            many = np.bincount(line, minlength=len(number))
            total = np.zeros(len(number), np.int64)
            np.add.at(total, line, gains[found])
            n, gained = np.zeros(len(split), np.int64), np.zeros(len(split), np.int64)
            np.add.at(n, of, many[lines])
            np.add.at(gained, of, total[lines])
            pairs = [break_pairs(t) if len(t) > 1 else [] for t in split]
            flat = [p for some in pairs for p in some]
            at = np.repeat(np.arange(len(split)), [len(x) for x in pairs])
            np.add.at(n, at, 1)
            np.add.at(gained, at, gains[np.fromiter(map(crc32, flat), np.uint32, len(flat)) % buckets])
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(n), pa.array(gained // np.maximum(n, 1))],
                ["doc_id", "text_hash", "n_features", "weight"])

    return docs.select(F.col(doc_id).cast("long"), F.xxhash64(F.col(text)), F.col(text).cast("binary")).mapInArrow(
        weigh, "doc_id long, text_hash long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, *, percent: int = 25, least_words: int = 20,
             buckets: int = 10_000, seed: int = 7, doc_id: str = "doc_id", text: str = "text",
             target_text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_features, weight (thousandths),
    score (weight plus noise) and rank: 1, 2, 3 ... by falling score, then
    doc_id, for the ``percent`` of the documents with at least ``least_words``
    words that are drawn, else NULL.

    A NULL or empty text has no features and weight 0. A NULL doc_id is hashed
    as the empty string and comes before others of its score; of rows equal in
    id and score the one with the smaller hash of the text goes first, and equal
    rows are ranked one after the other. Empty tables (``target`` too) are
    allowed: without target texts the gains only say what is rare in ``docs``.
    Other columns are not read."""
    ship(docs.sparkSession)
    gains = bucket_gains(feature_counts(docs, text, buckets), feature_counts(target, target_text, buckets), buckets)
    weighed = document_weights(docs, gains, doc_id=doc_id, text=text)
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000.0) * F.ln(-F.ln(u)))
    scored = written(weighed.withColumn("score", F.col("weight") + noise), "resample-scores")
    # n words have n runs of one word and n - 1 of two
    enough = F.col("n_features") >= 2 * least_words - 1
    drawn = scored.where(enough).count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("text_hash")]
    ranked = number_rows(scored.where(enough), order, "rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")).unionByName(
        scored.where(~enough).select(*columns, F.lit(None).cast("long").alias("rank")))
