"""Approximate nearest neighbours by learned partitions.

A bounded, hash-chosen sample of ``fit_rows`` vectors gives a graph of nearest
neighbours, which is cut into balanced partitions by recursive spectral
bisection. A small network learns to tell from a vector in which partitions
its neighbours lie. It puts every row of the table into one partition, and
routes each query to its most probable ones, where all rows are scored
exactly. How many partitions are probed is set so that a held-out part of the
sample reaches ``recall`` (on vectors without structure that is about half of
them).

Rows of a partition are dealt to blocks of bounded size, and so are the
queries that probe it; one task scores one block of rows with one block of
queries. A partition that holds a third of all rows is only more blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import power_of_two, ship, written


def neighbours(x: np.ndarray, k: int, queries: np.ndarray | None = None) -> np.ndarray:
    """The k rows of ``x`` with the largest inner products, for each query
    (default: each row, without itself)."""
    own = queries is None
    q = x if own else queries
    k = min(k, len(x) - own)
    out = np.empty((len(q), k), np.int64)
    for at in range(0, len(q), 1024):
        s = q[at:at + 1024] @ x.T
        if own:
            s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at:at + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else 0
    return out


def cut_graph(graph: np.ndarray, parts: int) -> np.ndarray:
    """Balanced partition of a neighbour graph: halve along the second
    eigenvector of its random walk, again and again."""
    n = len(graph)
    label = np.zeros(n, np.int64)
    rng = np.random.default_rng(7)
    flat = graph.ravel()
    source = np.repeat(np.arange(n), graph.shape[1])
    for _ in range(int(math.log2(parts))):
        inside = label[source] == label[flat]
        a, b = source[inside], flat[inside]
        degree = np.bincount(a, minlength=n) + np.bincount(b, minlength=n) + 1.0
        x = rng.normal(size=n)
        for _ in range(60):
            x = x / degree
            x = x * 1.0 + np.bincount(a, x[b], n) + np.bincount(b, x[a], n)
            # within each part, leave out the constant vector and keep the length
            total, weight = np.bincount(label, x), np.bincount(label, degree)
            x -= degree * (total / np.maximum(weight, 1))[label]
            size = np.sqrt(np.bincount(label, x * x))
            x /= np.maximum(size, 1e-30)[label]
        order = np.lexsort((x / degree, label))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        start = np.concatenate([[0], np.cumsum(np.bincount(label))])
        half = (place - start[label]) * 2 >= np.diff(start)[label]
        label = 2 * label + half
    return label


class Router:
    """Two layers: vector -> ReLU -> probabilities of the partitions."""

    def __init__(self, inputs: int, parts: int, hidden: int = 128):
        rng = np.random.default_rng(11)
        self.w = [rng.normal(0, math.sqrt(2 / inputs), (inputs, hidden)), np.zeros(hidden),
                  rng.normal(0, math.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts)]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3]

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 40, batch: int = 256) -> None:
        """Adam on the cross entropy with the soft labels ``y``."""
        rng = np.random.default_rng(13)
        m, v, t = [0 * w for w in self.w], [0 * w for w in self.w], 0
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                some = order[at:at + batch]
                h = np.maximum(x[some] @ self.w[0] + self.w[1], 0)
                z = h @ self.w[2] + self.w[3]
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                d = (p - y[some]) / len(some)
                back = (d @ self.w[2].T) * (h > 0)
                grads = [x[some].T @ back, back.sum(0), h.T @ d, d.sum(0)]
                t += 1
                rate = 3e-3 * (1 - epoch / epochs)
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.w[i] = self.w[i] - rate * (m[i] / (1 - 0.9 ** t)) / (
                        np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)


def fit_router(sample: np.ndarray, parts: int, top: int, recall: float) -> tuple[Router, int]:
    """The router and the number of partitions that a query has to probe."""
    held = max(1, len(sample) // 8)
    test, train = sample[:held], sample[held:]
    scale = float(np.sqrt((train * train).sum(1).mean())) or 1.0
    graph = neighbours(train, min(10, len(train) - 1))
    label = cut_graph(graph, parts)
    y = np.zeros((len(train), parts))
    near = neighbours(train, min(top, len(train) - 1))
    np.add.at(y, (np.repeat(np.arange(len(train)), near.shape[1]), label[near].ravel()), 1)
    y[np.arange(len(train)), label] += 1
    router = Router(sample.shape[1], parts)
    router.fit(train / scale, y / y.sum(1, keepdims=True))
    router.w[0] = router.w[0] / scale  # from here on it takes the vectors as they are
    home = router.logits(train).argmax(1)
    order = np.argsort(-router.logits(test), axis=1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(parts)[None, :], 1)
    wanted = np.take_along_axis(rank, home[neighbours(train, min(top, len(train)), test)], 1)
    for probes in range(1, parts):
        if (wanted < probes).mean() >= recall:
            return router, probes
    return router, parts


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def usable(table: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v): rows with an id and a vector of finite components that
    aren't all zero, in double precision."""
    v = F.col(embedding).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return table.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def _probed(rows: dict[int, int], parts: int, probes: int, top: int) -> Column:
    """The first ``probes`` of a query's partitions (``best``), and as many more
    as it takes until they hold ``top`` rows besides the ``own`` ones with its id."""
    held = F.array(*[F.lit(rows.get(p, 0)).cast("long") for p in range(parts)])
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("k"))
    enough = F.aggregate("best", start, lambda s, p: F.when(
        (s["k"] >= probes) & (s["n"] >= top + F.col("own")), s).otherwise(
            F.struct((s["n"] + F.get(held, p)).alias("n"), (s["k"] + 1).alias("k"))))
    return F.slice("best", 1, enough["k"])


def nearest(table: DataFrame, *, top: int = 20, every: int = 20, vec_id: str = "vec_id",
            embedding: str = "embedding", recall: float = 0.95, fit_rows: int = 8192,
            block: int = 4096) -> DataFrame:
    """For each row whose id is divisible by ``every``: the ``top`` other rows
    with the largest inner products among those in the probed partitions.
    query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id.

    Vectors that are NULL, zero, or hold NULL or non-finite components take no
    part, nor do rows without an id, nor vectors of another length than most
    have. Rows equal in id and vector count once; a row with the query's id is
    its own. A query whose probed partitions hold too few rows goes on to its
    next ones, so it gets ``top`` rows wherever there are that many. An empty table gives an empty one. Other columns are not read."""
    spark = ship(table.sparkSession)
    good = written(usable(table, vec_id, embedding).distinct(), "ann-vectors")
    lengths = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    schema = "query_id long, vec_id long, score double"
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n = lengths[0]
    good = good.where(F.size("v") == dim)
    some = good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(fit_rows).toPandas()
    sample = np.stack(some["v"].to_numpy())
    parts = min(power_of_two(fit_rows / 16), power_of_two(n / 4096, 16))  # 16 rows of the sample each, at least
    if len(sample) < 8 * parts:  # too few rows to learn from: one partition, scored whole
        parts, router, probes = 1, Router(dim, 1), 1
    else:
        router, probes = fit_router(sample, parts, top, recall)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _vectors(batch.column(1), dim)
            best = np.argsort(-router.logits(v), axis=1, kind="stable").astype(np.int32)
            asks = batch.column(0).to_numpy() % every == 0  # only queries need more than their home
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(best[:, 0]),
                 pa.array([b if a else None for b, a in zip(best, asks, strict=True)], pa.list_(pa.int32()))],
                ["vec_id", "v", "home", "best"])

    routed = written(good.mapInArrow(
        route, "vec_id long, v array<double>, home int, best array<int>"), "ann-routed")
    rows = {r[0]: r[1] for r in routed.groupBy("home").count().collect()}  # one row per partition
    asked = routed.where(F.col("vec_id") % every == 0).withColumn(
        "own", F.count("*").over(Window.partitionBy("vec_id")))
    queries = asked.select(
        F.col("vec_id").alias("query_id"), F.col("v").alias("q"),
        F.explode(_probed(rows, parts, probes, top)).alias("part"))
    asked = {r[0]: r[1] for r in queries.groupBy("part").count().collect()}
    blocks = [(p, max(1, math.ceil(rows[p] / block)), max(1, math.ceil(asked[p] / block)))
              for p in sorted(rows) if p in asked]
    deal = F.broadcast(spark.createDataFrame(blocks, "part int, row_blocks int, query_blocks int"))
    left = routed.select("vec_id", "v", F.col("home").alias("part")).alias("r").join(deal.alias("d"), "part").select(
        "part", "vec_id", "v", F.pmod(F.xxhash64("vec_id"), "row_blocks").cast("int").alias("rb"),
        F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("qb"))
    right = queries.alias("q").join(deal.alias("d"), "part").select(
        "part", "query_id", "q", F.pmod(F.xxhash64("query_id"), "query_blocks").cast("int").alias("qb"),
        F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)).alias("rb"))

    def score(own: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own) and len(ask):
            ids, x = own["vec_id"].to_numpy(), np.stack(own["v"].to_numpy())
            asks = ask["query_id"].to_numpy()
            for at in range(0, len(ask), 256):
                q, qi = np.stack(ask["q"].iloc[at:at + 256].to_numpy()), asks[at:at + 256]
                s = q @ x.T
                s[qi[:, None] == ids[None, :]] = -np.inf
                k = min(top, len(ids))
                bound = -np.partition(-s, k - 1, axis=1)[:, k - 1]
                slack = 1e-9 * (1 + np.abs(bound)) if len(bound) else bound
                i, j = np.nonzero((s >= (bound - slack)[:, None]) & (s > -np.inf))
                exact = np.zeros(len(i))
                for d in range(dim):  # in one order for all, so that equal vectors tie
                    exact += q[i, d] * x[j, d]
                order = np.lexsort((ids[j], -exact, i))
                i, j, exact = i[order], j[order], exact[order]
                first = np.searchsorted(i, np.arange(len(q)))
                keep = np.arange(len(i)) - first[i] < top
                out.append(pd.DataFrame({"query_id": qi[i[keep]], "vec_id": ids[j[keep]],
                                         "score": exact[keep]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    keys = ["part", "rb", "qb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(score, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top).select(
        "query_id", "rank", "vec_id", "score")
