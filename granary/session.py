"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings that results, file formats or hot keys depend on. They are applied
# at run time, so they also work on a session that somebody else created.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Pandas writes nanosecond timestamps; without this Spark refuses the file.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.sql.parquet.int96RebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
    # Split a join's hot key even if the next step groups by the same key and
    # then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Adaptive execution does the work that hand tuning would do badly: it merges
# small shuffle partitions, splits the skewed ones of a join, and splits or
# merges the partitions of a rebalance before a write.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}

# What a write has shuffled is of no use after it, and would stay on disk until
# the driver happens to collect its garbage.
CLEANING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# Recording the Python line of every column expression makes building a plan a
# third slower.
CREATION_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

TARGET_SHUFFLE_BYTES = 128 * 1024 * 1024


def shuffle_partitions_for(shuffled_bytes: int, cores: int) -> int:
    """Shuffle partitions so that one fits in an executor core's memory share.

    Adaptive execution can merge partitions but never adds them to an
    aggregation, so the starting number has to follow the data.
    """
    by_size = -(-shuffled_bytes // TARGET_SHUFFLE_BYTES)
    return max(cores, by_size)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that fix results; leave sizing to whoever runs the cluster."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Other settings for the jobs started inside the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def create(
    app: str,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**RUNTIME_SETTINGS, **ADAPTIVE_SETTINGS, **CREATION_SETTINGS, **(extra or {})}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="granary-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for data that cuts lineage.

    Without that setting, a folder of this process that goes with it, if every
    task runs in this one process; on a cluster the setting has to be there.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return _own_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A folder no other run uses."""
    return f"{scratch_root(spark)}/granary-{purpose}-{uuid.uuid4().hex}"
