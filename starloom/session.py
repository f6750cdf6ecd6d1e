"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library depends on for correct and scalable plans.
#   UTC session zone: audit timestamps and date parsing must not drift with the host.
#   AQE: runtime coalescing, skew-join splitting and broadcast demotion.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove the checkpoint files of key numbering once nothing refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "starloom",
                shuffle_partitions: int | None = None,
                extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster leave ``master`` as None so spark-submit decides; tests pass
    ``local[N]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a home, and return it.

    The cluster names its shared folder in ``spark.checkpoint.dir``; that wins.
    Only a local-mode session without one (tests, a laptop) gets a fresh
    temporary folder: a machine-local folder is never valid on a cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="starloom-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every executor "
            "can reach (HDFS, S3, ABFS, ...)")
    return sc.getCheckpointDir()


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_RELEASING: dict[int, tuple[int, str | None]] = {}  # by session: how many are inside, the setting before
_RELEASING_LOCK = threading.Lock()


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries made and run inside are deleted as each one
    ends, and not when the driver happens to collect garbage. For writes: what
    is read afterwards are the written files."""
    with _RELEASING_LOCK:
        depth, before = _RELEASING.get(id(spark), (0, None))
        if not depth:
            before = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _RELEASING[id(spark)] = (depth + 1, before)
    try:
        yield
    finally:
        with _RELEASING_LOCK:
            depth, before = _RELEASING.pop(id(spark))
            if depth > 1:
                _RELEASING[id(spark)] = (depth - 1, before)
            elif before is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, before)


_FOLDERS: list[tuple[SparkSession, str]] = []


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder, deleted when the
    driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/starloom-{name}-{uuid.uuid4().hex}"
    _FOLDERS.append((spark, path))
    return path


@atexit.register
def _delete_folders() -> None:
    while _FOLDERS:
        spark, path = _FOLDERS.pop()
        context = spark.sparkContext
        if context._jsc is None:  # the session has ended before
            continue
        try:
            fs, at = file_system(spark, path)
            fs.delete(at, True)
        except Exception:  # noqa: BLE001 - the JVM may be gone; the files only take room
            return
