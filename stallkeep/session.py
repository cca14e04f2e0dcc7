"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

# Runtime re-planning does the size checks for us: a join side is broadcast only
# when its measured size is under the threshold, and hot partitions are split.
# `forceOptimizeSkewedJoin` keeps the splitting on when a later operator would
# have reused the partitioning (chains of joins on one key).
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# For jobs of many steps: a finished step's shuffle files are deleted at once, not when the
# driver's garbage is collected, and what is stored takes less room.
STEPWISE = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions_for(shuffle_bytes: int, total_cores: int) -> int:
    """Partitions of about 128 MB each, and at least two rounds of work per core."""
    by_size = -(-shuffle_bytes // TARGET_PARTITION_BYTES)
    return max(by_size, 2 * total_cores)


def tune(spark: SparkSession, **more: str) -> SparkSession:
    """Apply the settings above, and `more`, to a running session."""
    for name, value in {**SETTINGS, **more}.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session, where driver and executors are one process, may fall
    back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", context.master):  # not local-cluster, whose executors are processes of their own
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="stallkeep-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


#: Folders that `stored` has written, by the name of the work they are part of.
_written: dict[str, list[str]] = {}
_work: ContextVar[str | None] = ContextVar("work", default=None)


@contextmanager
def work(name: str) -> Iterator[None]:
    """What is stored inside is part of the named work, and can be released by `release`."""
    before = _work.set(name)
    try:
        yield
    finally:
        _work.reset(before)


def _reached(spark: SparkSession, address: str):
    """(file system, path) of an address, as Spark itself reaches it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(address)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, address: str) -> bool:
    """Whether there is a file or folder, without a read that fails."""
    system, path = _reached(spark, address)
    return system.exists(path)


def release(spark: SparkSession, name: str, *needed: DataFrame) -> None:
    """Delete what the named work has stored, but for folders that one of the needed frames reads."""
    files = [file for df in needed for file in df.inputFiles()]
    kept = []
    for folder in _written.pop(name, []):
        tail = f"/{folder.rsplit('/', 1)[-1]}/"
        if any(tail in file for file in files):
            kept.append(folder)
            continue
        system, path = _reached(spark, folder)
        system.delete(path, True)
    if kept:
        _written[name] = kept


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written once to the shared folder and read back.

    For a frame that several later passes read: they read the columns they need
    from there, and a lost executor costs no recomputation of `df`.
    """
    folder = new_folder(df.sparkSession, purpose)
    if name := _work.get():
        _written.setdefault(name, []).append(folder)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def side_by_side(spark: SparkSession, jobs: Iterable[Callable[[], object]], at_once: int = 6) -> list[object]:
    """Run independent jobs at the same time, so that small tables fill the gaps
    large ones leave. The first error is raised after all have ended."""
    # Wrapped one by one: each job needs thread properties of its own, and one
    # wrapper would share a single copy among all its jobs.
    wrapped = [inheritable_thread_target(spark)(job) for job in jobs]
    with ThreadPoolExecutor(at_once) as pool:
        return [f.result() for f in [pool.submit(job) for job in wrapped]]
