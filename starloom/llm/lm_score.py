"""LM scoring by masked pseudo-likelihood.

A small window network, trained in numpy, predicts a token from the two before
and the two behind it. A document's score is the sum over all its words of
the log-probability of the word given both sides.

The network knows ``TOKENS`` tokens: the most frequent words of the corpus, and
hash buckets that the rarer words share. A word of a bucket has the bucket's
probability times its share in the bucket's words, so every distinct word of the
corpus has a probability of its own. The counts behind the shares are of all words
of all documents, in a table that grows with the corpus; no task and not the
driver holds it whole.

Texts are read once. They become blocks of some 300,000 words; Spark counts the
words by ranges of their hashes, and each block gets the counts of its own words
back and is written as token numbers. Training and scoring read only those.

Training goes in ``rounds``. Each block takes part in one, with all its
tokens, so that every token is a target once (its window leaves it out, so
nothing has to be masked). Every task starts a round from the same weights and
runs mini-batches over its blocks; the tasks' weights are averaged by their numbers
of tokens, ``FAN`` at a time, until the driver gets one average.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, mix, pack_sorted, power_of_two, ship, slices, unpack_sorted, written

CLASSES, MEMBERS, HIDDEN, SIDE = 32, 32, 24, 2
TOKENS = CLASSES * MEMBERS
RARE = 256          # hash buckets of the words that are not in the vocabulary
FAN = 16            # weights summed by one task
BLOCK = 300_000     # words of a block, unless a single text has more

BLOCKS = "block long, ids array<long>, sizes array<long>, tokens binary, keys binary, counts binary"
CODED = "block long, ids array<long>, sizes array<long>, shares array<double>, tokens binary"


def blocks_of(rows: DataFrame) -> DataFrame:
    """Texts (doc_id, t) as blocks: the documents' ids and numbers of words, their
    words as places in the block's sorted distinct hashes, the hashes, and how often
    each occurs in the block."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, task, made = WordHashes(), TaskContext.get().partitionId(), 0
        ids, found, held = [], [], 0

        def block() -> pa.RecordBatch:
            keys, places, counts = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + made], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([[len(x) for x in found]], pa.list_(pa.int64())),
                 *[pa.array([x], pa.binary()) for x in (
                     _planes(places), pack_sorted(keys), _planes(counts))]],
                ["block", "ids", "sizes", "tokens", "keys", "counts"])

        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(k)
                found.append(hashes.of(t.as_py()))
                held += len(found[-1])
                if held >= BLOCK or len(ids) >= 20_000:
                    yield block()
                    made, ids, found, held = made + 1, [], [], 0
        if ids:
            yield block()

    return rows.mapInArrow(cut, BLOCKS)


def _planes(x: np.ndarray) -> bytes:
    """Numbers below 2**32 as byte planes, whose upper ones compress to little."""
    return np.asarray(x, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def bucket_of(keys: np.ndarray) -> np.ndarray:
    """The token of words that are not in the vocabulary."""
    return (TOKENS - RARE + (mix(keys) % np.uint64(RARE))).astype(np.int64)


@dataclass
class Vocabulary:
    """``words``: hashes of the most frequent words of the corpus, most frequent
    first; the other words' tokens are buckets, of which ``total`` holds the
    numbers of occurrences."""
    words: np.ndarray
    total: np.ndarray

    def tokens(self, keys: np.ndarray) -> np.ndarray:
        out = bucket_of(keys)
        if len(keys) and len(self.words):
            order = np.argsort(self.words)
            own = self.words[order]
            at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
            out = np.where(own[at] == keys, order[at], out)
        return out


def count_words(blocks: DataFrame) -> tuple[DataFrame, Vocabulary]:
    """How often each of a block's words occurs in the whole corpus, and the
    vocabulary. First (block, part, n): the counts of the words of one range
    of hashes (``part``, in the order of the block's hashes)."""
    words = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    parts = power_of_two(words / 10_000_000, 32)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys, counts = unpack_sorted(keys), _numbers(counts)
                cuts = slices(keys, parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(cuts), pa.int64()), pa.array([p for p, _ in cuts], pa.int32()),
                     pa.array([pack_sorted(keys[c]) for _, c in cuts], pa.binary()),
                     pa.array([_planes(counts[c]) for _, c in cuts], pa.binary())],
                    ["block", "part", "keys", "counts"])

    def total(part: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_sorted(x) for x in part["keys"]]
        own, at = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(at, np.concatenate([_numbers(x) for x in part["counts"]])).astype(np.int64)
        cuts = np.cumsum([0, *map(len, keys)])
        rows = [(b, int(p), n[at[i:j]].astype("<i8").tobytes(), None, None, None)
                for b, p, i, j in zip(part["block"], part["part"], cuts, cuts[1:], strict=False)]
        best = np.lexsort((own, -n))[:TOKENS - RARE]
        rows += [(None, None, None, int(w), None, int(k))
                 for w, k in zip(own[best].view(np.int64), n[best], strict=True)]
        sums = np.bincount(bucket_of(own) - (TOKENS - RARE), n, RARE).astype(np.int64)
        rows += [(None, None, None, None, b, int(k)) for b, k in enumerate(sums) if k]
        return pd.DataFrame(rows, columns=["block", "part", "counts", "word", "bucket", "n"], dtype=object)

    counted = written(blocks.select("block", "keys", "counts").mapInArrow(
        emit, "block long, part int, keys binary, counts binary").groupBy("part").applyInPandas(
            total, "block long, part int, counts binary, word long, bucket int, n long"), "lm-counts")
    top = counted.where("word is not null").orderBy(F.desc("n"), "word").limit(TOKENS - RARE).collect()
    frequent = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    rare = np.zeros(RARE, np.int64)
    for r in counted.where("bucket is not null").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        rare[r["bucket"]] = r["n"]  # RARE rows
    np.subtract.at(rare, bucket_of(frequent) - (TOKENS - RARE), np.array([r["n"] for r in top], np.int64))
    return counted.where("block is not null").select("block", "part", "counts"), Vocabulary(frequent, rare)


def coded(blocks: DataFrame, counts: DataFrame, vocab: Vocabulary, tasks: int) -> DataFrame:
    """Blocks as token numbers (16 bits each), with the sum of the log shares of
    each document's words in their buckets."""
    def code(part: pa.Table) -> pa.Table:
        rows = part.select(["part", "counts"]).to_pylist()
        whole = part.filter(pc.equal(part["part"], -1))
        keys = unpack_sorted(whole["keys"][0].as_py())
        n = np.concatenate([np.zeros(0, "<i8"), *[np.frombuffer(r["counts"], "<i8") for r in sorted(
            rows, key=lambda r: r["part"]) if r["part"] >= 0]])
        token, share = vocab.tokens(keys), np.zeros(len(keys))
        rare = token >= TOKENS - RARE
        share[rare] = np.log(n[rare] / vocab.total[token[rare] - (TOKENS - RARE)])
        places, sizes = _numbers(whole["tokens"][0].as_py()), whole["sizes"][0].as_py()
        each, ends = share[places], np.cumsum(sizes).tolist()
        # each document by itself, so that equal texts get the very same sum
        sums = [float(each[b - k:b].sum()) for b, k in zip(ends, sizes, strict=True)]
        return pa.table([whole["block"], whole["ids"], whole["sizes"], pa.array([sums], pa.list_(pa.float64())),
                         pa.array([token[places].astype("<u2").tobytes()], pa.binary())],
                        ["block", "ids", "sizes", "shares", "tokens"])

    both = blocks.drop("counts").withColumn("part", F.lit(-1)).unionByName(counts, allowMissingColumns=True)
    return both.repartition(tasks, "block").groupBy("block").applyInArrow(code, CODED)


def contexts(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of some documents and the tokens around each; ``TOKENS``
    stands for what lies outside the document."""
    pad = np.full(SIDE, TOKENS, np.int16)
    flat = np.concatenate([pad, *[x for d in docs for x in (d.astype(np.int16), pad)]])
    at = np.flatnonzero(flat != TOKENS)
    return flat[at], np.stack([flat[at + k] for k in range(-SIDE, SIDE + 1) if k]).T


class Net:
    """Context -> tanh layer -> class of the token -> token in its class."""
    SHAPES = {"embed": (2 * SIDE, TOKENS + 1, HIDDEN), "bias": (HIDDEN,), "out": (HIDDEN, CLASSES),
              "out_bias": (CLASSES,), "word": (CLASSES, HIDDEN, MEMBERS), "word_bias": (CLASSES, MEMBERS)}

    def __init__(self, weights: np.ndarray | None = None):
        n = sum(int(np.prod(s)) for s in self.SHAPES.values())
        if weights is None:
            weights = np.random.default_rng(3).normal(0, 0.08, n)
        self.flat = np.array(weights, np.float32)
        self.w, at = {}, 0
        for name, shape in self.SHAPES.items():
            size = int(np.prod(shape))
            self.w[name] = self.flat[at:at + size].reshape(shape)
            at += size

    def hidden(self, around: np.ndarray) -> np.ndarray:
        h = self.w["bias"] + self.w["embed"][0][around[:, 0]]
        for k in range(1, 2 * SIDE):
            h += self.w["embed"][k][around[:, k]]
        return np.tanh(h)

    @staticmethod
    def _log_softmax(z: np.ndarray) -> np.ndarray:
        z = z - z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))

    def log_probability(self, token: np.ndarray, around: np.ndarray) -> np.ndarray:
        """Of each token given its context."""
        out = np.empty(len(token))
        for at in range(0, len(token), 16_384):
            t, h = token[at:at + 16_384], self.hidden(around[at:at + 16_384])
            c, m = t // MEMBERS, t % MEMBERS
            got = self._log_softmax(h @ self.w["out"] + self.w["out_bias"])[np.arange(len(t)), c].astype(float)
            order = np.argsort(c, kind="stable")
            cuts = np.searchsorted(c[order], np.arange(CLASSES + 1))
            for k in range(CLASSES):
                rows = order[cuts[k]:cuts[k + 1]]
                if len(rows):
                    z = self._log_softmax(h[rows] @ self.w["word"][k] + self.w["word_bias"][k])
                    got[rows] += z[np.arange(len(rows)), m[rows]]
            out[at:at + 16_384] = got
        return out

    def train(self, token: np.ndarray, around: np.ndarray, state: np.ndarray, rate: float = 0.1,
              batch: int = 4096) -> None:
        """One pass of Adagrad; ``state``: sums of squared gradients."""
        step = Net(np.zeros_like(self.flat))
        for at in range(0, len(token), batch):
            t, a = token[at:at + batch], around[at:at + batch]
            h, n = self.hidden(a), len(t)
            c, m = t // MEMBERS, t % MEMBERS
            step.flat[:] = 0
            d = np.exp(self._log_softmax(h @ self.w["out"] + self.w["out_bias"]))
            d[np.arange(n), c] -= 1
            step.w["out"][:], step.w["out_bias"][:] = h.T @ d, d.sum(0)
            back = d @ self.w["out"].T
            order = np.argsort(c, kind="stable")
            cuts = np.searchsorted(c[order], np.arange(CLASSES + 1))
            for k in range(CLASSES):
                rows = order[cuts[k]:cuts[k + 1]]
                if len(rows):
                    d = np.exp(self._log_softmax(h[rows] @ self.w["word"][k] + self.w["word_bias"][k]))
                    d[np.arange(len(rows)), m[rows]] -= 1
                    step.w["word"][k], step.w["word_bias"][k] = h[rows].T @ d, d.sum(0)
                    back[rows] += d @ self.w["word"][k].T
            back *= 1 - h * h
            step.w["bias"][:] = back.sum(0)
            for k in range(2 * SIDE):  # sums by context token
                order = np.argsort(a[:, k], kind="stable")
                own = a[order, k]
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                step.w["embed"][k][own[first]] = np.add.reduceat(back[order], first, axis=0)
            g = step.flat / np.float32(n)
            state += g * g
            self.flat -= np.float32(rate) * g / (np.sqrt(state) + np.float32(1e-6))


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[list, list[np.ndarray], list[float]]]:
    """Ids, token numbers and shares of each block's documents."""
    for ids, sizes, shares, tokens in zip(*(batch.column(c).to_pylist() for c in (1, 2, 3, 4)), strict=True):
        yield ids, np.split(np.frombuffer(tokens, "<u2"), np.cumsum(sizes)[:-1]), shares


def train(blocks: DataFrame, rounds: int) -> Net:
    """The network after all rounds over the coded blocks."""
    net = Net()
    turn_of = F.pmod(F.xxhash64("block"), F.lit(rounds))

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((g, k, w.as_py()) for batch in batches for g, k, w in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True))
        for group, own in itertools.groupby(rows, lambda r: r[0]):
            n, sums = 0, 0.0
            for _, k, w in own:
                n, sums = n + k, sums + k * np.frombuffer(w, np.float32).astype(float)
            yield pa.RecordBatch.from_arrays(
                [pa.array([group], pa.int64()), pa.array([n], pa.int64()),
                 pa.array([(sums / n).astype(np.float32).tobytes()], pa.binary())], ["task", "n", "w"])

    for turn in range(rounds):
        start = net.flat.copy()

        def learn(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            own, state, seen = Net(start), np.zeros(len(start), np.float32), 0
            for batch in batches:
                for _, docs, _ in _documents(batch):
                    token, around = contexts(docs)
                    own.train(token, around, state)
                    seen += len(token)
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([seen], pa.int64()),
                     pa.array([own.flat.tobytes()], pa.binary())], ["task", "n", "w"])

        learnt = written(blocks.where(turn_of == turn).mapInArrow(learn, "task long, n long, w binary"), "lm-weights")
        left = (learnt.agg(F.max("task")).first()[0] or 0) + 1
        while left > 1:
            # in the order of the tasks, so that sums don't depend on what arrives first
            left = -(-left // FAN)
            learnt = written(
                learnt.withColumn("group", F.floor(F.col("task") / FAN)).repartition(left, "group")
                .sortWithinPartitions("group", "task").select("group", "n", "w")
                .mapInArrow(mean, "task long, n long, w binary"), "lm-weights")
        last = learnt.select("w").first()
        if last:
            net = Net(np.frombuffer(last["w"], np.float32))
    return net


def score_blocks(blocks: DataFrame, net: Net) -> DataFrame:
    """doc_id, n_tokens and log_likelihood of the documents of coded blocks."""
    weights = net.flat

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Net(weights)
        for batch in batches:
            for ids, words, shares in _documents(batch):
                sizes = np.array([len(x) for x in words])
                ends = np.cumsum(sizes)
                each = net.log_probability(*contexts(words))
                sums = [float(each[b - n:b].sum()) + s
                        for b, n, s in zip(ends.tolist(), sizes.tolist(), shares, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums, pa.float64())],
                    ["doc_id", "n_tokens", "log_likelihood"])

    return blocks.mapInArrow(score, "doc_id long, n_tokens long, log_likelihood double")


def score_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                    rounds: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens (words), log_likelihood (the
    pseudo-log-likelihood of the whole text) and mean_log_likelihood (a word;
    NULL without words).

    A NULL or empty text has no words and log_likelihood 0. Equal texts get
    equal scores (up to rounding). An empty table gives an empty one. Other columns are not
    read."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("t"))
    raw = written(blocks_of(rows), "lm-blocks")
    counts, vocab = count_words(raw)
    blocks = written(coded(raw, counts, vocab, max(1, raw.count() // 5)), "lm-coded")
    return written(score_blocks(blocks, train(blocks, rounds)), "lm-scores").select("*", F.when(
        F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")).alias("mean_log_likelihood"))
