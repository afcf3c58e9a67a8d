"""Session helpers: build a local session for tests/bench, find the shared
checkpoint folder of a cluster session."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings the engine relies on; on a cluster they come from the job config.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "qualis") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "16g"))
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    A cluster names it in ``spark.checkpoint.dir``; only when it is unset in a
    local run (tests) a fresh scratch folder is created and registered. On a
    cluster without that setting this is an error: executors share no other folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="qualis-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def cut(df, frugal: bool = True):
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and
    return a DataFrame that reads it back.

    Later plans start from a scan (with column pruning and filter pushdown)
    instead of the whole upstream lineage, and a lost executor never re-runs
    that lineage. Unlike ``DataFrame.checkpoint``, the data is computed once.
    ``frugal``: packed tightly, and the job's shuffle files go when it ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/qualis-{uuid.uuid4().hex}"
    if frugal:
        with shuffles_freed(spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    _CUTS.append(path)
    for noted in getattr(_NOTED, "lists", []):
        noted.append(path)
    return spark.read.parquet(path)


_CUTS: list[str] = []
_NOTED = threading.local()  # lists of the cuts that this thread makes inside ``landed``

FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FREEING = threading.Lock()
_USERS: dict[str, list] = {}  # by session: how many threads are inside, the setting before


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Writes inside delete their shuffle files when they end: what they wrote stands in for
    them, and they would fill the disks until the driver's next garbage collection. The setting
    is the session's: the first of several threads sets it, the last one puts it back."""
    session = spark._jsparkSession.sessionUUID()
    with _FREEING:
        users = _USERS.setdefault(session, [0, None])
        if not users[0]:
            users[1] = spark.conf.get(FREED)
            spark.conf.set(FREED, "true")
        users[0] += 1
    try:
        yield
    finally:
        with _FREEING:
            users[0] -= 1
            if not users[0]:
                spark.conf.set(FREED, users[1])
                del _USERS[session]


def landed(build: Callable[[], dict]) -> dict:
    """The tables of ``build``, each written once. What ``build`` itself cut on the way (in this
    thread) is deleted when they are: nothing reads it any more."""
    lists = _NOTED.__dict__.setdefault("lists", [])
    lists.append([])
    try:
        tables = build()
    finally:
        before = lists.pop()
    out = {t: cut(df) for t, df in tables.items()}
    for path in before:
        fs, p = file_system(next(iter(out.values())).sparkSession, path)
        fs.delete(p, True)
        _CUTS.remove(path)
    return out


def together(spark: SparkSession, *jobs: Callable) -> list:
    """Run independent jobs side by side and return their results in order. Each one
    leaves cores idle at its end (small last stages, commits); the others use them.
    The first error is raised once all have ended."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the jobs inside; what the caller had set comes back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def mark() -> int:
    """A point in the list of cuts; ``release`` deletes what was cut after it."""
    return len(_CUTS)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a path as Spark reads it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables cut since ``mark()``: at the end of a run, when nothing reads them any more."""
    for path in _CUTS[since:]:
        fs, p = file_system(spark, path)
        fs.delete(p, True)
    del _CUTS[since:]
