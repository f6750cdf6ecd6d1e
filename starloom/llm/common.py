"""Small helpers that several operators of this package share."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import hashlib
import math
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: A word is a run of characters other than blank, \t, \n, \v, \f and \r.
WORD = r"[^\x20\x09-\x0D]+"

_SHIPPED: dict[str, str] = {}
_SCRATCH: list[tuple[SparkSession, str]] = []


def ship(spark: SparkSession) -> SparkSession:
    """Make the library importable in Python workers, once per application. (A
    job submitted with --py-files has it anyway.)"""
    context = spark.sparkContext
    if _SHIPPED.get("app") != context.applicationId:
        package = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="starloom-code-")) / "starloom_code.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(package.rglob("*")):
                if f.suffix in (".py", ".csv"):
                    z.write(f, f"{package.name}/{f.relative_to(package)}")
        context.addPyFile(str(target))
        _SHIPPED["app"] = context.applicationId
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/starloom-{name}-{uuid.uuid4().hex}"
    _SCRATCH.append((spark, path))
    return path


#: Rows that a Python task gets at a time, at most: whole texts, so that Spark's
#: default of 10,000 would hold tens of MB, several times over, in every task.
ROWS_AT_ONCE = 1000


@contextlib.contextmanager
def few_rows_at_once(spark: SparkSession) -> Iterator[None]:
    """Python tasks of jobs that run inside get ``ROWS_AT_ONCE`` rows at a time, at most."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    if not 0 < int(before) <= ROWS_AT_ONCE:
        spark.conf.set(setting, ROWS_AT_ONCE)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again, so
    that later jobs neither repeat its work nor depend on lost executors."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    with few_rows_at_once(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Hand memory that this Python worker has freed back to the machine: the
    worker outlives its task, and what it holds on to counts against the
    executor while other stages run."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


def clear_scratch() -> None:
    """Delete the scratch folders made so far. Call it when the results that
    read them have been written; it also runs when the driver ends."""
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        context = spark.sparkContext
        if context._jsc is None:  # the session has ended
            continue
        at = context._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _clear_at_exit() -> None:
    try:
        clear_scratch()
    except Exception:  # noqa: BLE001 - the JVM may be gone already; the files only take room
        _SCRATCH.clear()


def n_words(text: Column) -> Column:
    """Number of words of a text, NULL counting as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text: ``bytes.split`` cuts at exactly the six
    characters that ``WORD`` leaves out."""
    return text.split() if text else []


@functools.cache
def _empty() -> np.ndarray:
    return np.zeros(0, np.uint64)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to ``limit`` words so that a
    task's memory stays bounded whatever its vocabulary."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value

    def of(self, text: bytes | None) -> np.ndarray:
        found = words(text)
        if not found:
            return _empty()
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (the finalizer of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _weights(n: int) -> np.ndarray:
    return np.random.default_rng(20).integers(0, 2**64, n, np.uint64, endpoint=False) | np.uint64(1)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` neighbouring words, from the words' hashes
    (64 bits: two different runs share one with probability 2**-64)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return _empty()
    out = np.full(m, n, np.uint64)
    with np.errstate(over="ignore"):
        for i, w in enumerate(_weights(n)):
            out += hashes[i:i + m] * w
    return mix(out)


def grams_of(per_doc: list[np.ndarray], n: int) -> list[np.ndarray]:
    """``gram_hashes`` of many texts, hashed in one go."""
    sizes = np.array([len(h) for h in per_doc])
    flat = gram_hashes(np.concatenate([_empty(), *per_doc]), n)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    return [flat[a:max(a, a + k - n + 1)] for a, k in zip(starts, sizes, strict=False)]


def pack_sorted(x: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit numbers as byte planes of their differences,
    whose upper planes are zeros that the shuffle's compression removes."""
    return np.diff(x, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_sorted(b: bytes) -> np.ndarray:
    planes = np.frombuffer(b, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def slices(sorted_hashes: np.ndarray, buckets: int) -> list[tuple[int, slice]]:
    """The stretch of each of ``buckets`` (a power of two) equal ranges of the
    64-bit numbers, where it isn't empty."""
    if not len(sorted_hashes):
        return []
    top = (sorted_hashes >> np.uint64(64 - (buckets.bit_length() - 1))) if buckets > 1 else (
        np.zeros(len(sorted_hashes), np.uint64))
    cuts = np.flatnonzero(np.diff(top)) + 1
    edges = [0, *cuts.tolist(), len(top)]
    return [(int(top[a]), slice(a, b)) for a, b in zip(edges, edges[1:], strict=False)]


def power_of_two(n: float, least: int = 1) -> int:
    return 1 << max(0, math.ceil(math.log2(max(n, least, 1))))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that the edges lead to. Alternates
    large-star and small-star steps, as joins, so that a hub's edges need not
    meet in one task; each round halves the height of the trees, and the
    driver sees two numbers of it."""
    now = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                  .where("u > v").distinct(), "edges")
    state = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state or seen[0] == 0:
            break
        state = seen
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(low, "u").where("v > u").select(
            F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(
            "u > v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        now = written(small, "edges")
    return now.groupBy("u").agg(F.min("v").alias("component")).select(
        F.col("u").alias("node"), "component").union(
            now.select("v", F.col("v").alias("component")).distinct().join(
                now.select(F.col("u").alias("v")).distinct(), "v", "left_anti"))


def small_enough(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """``df``, a table of a few numbers a row, marked for broadcasting if it is
    proven to have ``rows`` at most; beyond that Spark shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
