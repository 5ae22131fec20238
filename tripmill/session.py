"""Session settings: the time zone, settings held during a write, and the shared scratch folder."""

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_ZONE = "UTC"

# Without these a write would drop untouched partitions, null what does not fit, put a hot key
# into one task, or store timestamps without the statistics that row-group skipping needs.
WRITE_SETTINGS = {
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.storeAssignmentPolicy": "ANSI",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Asked for only where the table is one that Hive made.
    "hive.exec.dynamic.partition.mode": "nonstrict",
}

# Used where the session says nothing. How much a write task takes, and so the size of a file: Spark's
# own 64 MB would make over a million files of 100 TB. And how little it may take: with Spark's own 1 MB
# a small load of many days would write all its files one after the other.
WRITE_DEFAULTS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    # How much a task reads: fewer tasks of a large load leave fewer sizes on the driver. Small loads are
    # divided by the number of cores all the same.
    "spark.sql.files.maxPartitionBytes": "512m",
}

ZONE = "spark.sql.session.timeZone"

_NAME = "tripmill.session"

_lock = threading.Lock()
# By session and key: how many hold it, the caller's value, the held value.
_held: dict[tuple[str, str], list] = {}
_local_root: list[str] = []


def _session(spark: SparkSession) -> str:
    """The same for all objects of one session, to which the settings belong: a name kept among the session's own settings."""
    name = spark.conf.get(_NAME, None)
    if name is None:
        name = uuid.uuid4().hex
        spark.conf.set(_NAME, name)
    return name


def use_zone(spark: SparkSession, zone: str | None = None) -> str:
    """Set the session zone (UTC unless told otherwise), so days and hours mean the same everywhere."""
    zone = zone or DEFAULT_ZONE
    spark.conf.set(ZONE, zone)
    return zone


def held_zone(spark: SparkSession, zone: str | None = None):
    """Hold the session zone (UTC unless told otherwise) while a job runs, then give the caller's back.

    Jobs that overlap in one session must be of one zone, as it is the session's: another is refused.
    """
    return held_settings(spark, {ZONE: zone or DEFAULT_ZONE}, {})


@contextmanager
def held_settings(
    spark: SparkSession,
    settings: Mapping[str, str] = WRITE_SETTINGS,
    defaults: Mapping[str, str] = WRITE_DEFAULTS,
) -> Iterator[None]:
    """Hold settings while a write runs, then give the caller's values back.

    The defaults are held only where the caller has no value. Writes of one session may overlap in
    threads or through several objects of the session: the first one in remembers the caller's value and
    the last one out restores it, so no write sees dynamic overwrite switched off while it runs. A zone
    other than the one that is held is an error.
    """
    entered = []
    with _lock:
        session = _session(spark)
    try:
        with _lock:
            chosen = _with_defaults(spark, settings, defaults)
            for key, value in chosen.items():
                entry = _held.get((session, key))
                if key == ZONE and entry is not None and entry[2] != value:
                    raise ValueError(f"{key} is held at {entry[2]!r} by what runs in this session, and cannot be {value!r}")
            for key, value in chosen.items():
                before = spark.conf.get(key, None)
                spark.conf.set(key, value)
                _held.setdefault((session, key), [0, before, value])[0] += 1
                entered.append(key)
        yield
    finally:
        with _lock:
            for key in entered:
                entry = _held[(session, key)]
                entry[0] -= 1
                if entry[0] == 0:
                    del _held[(session, key)]
                    if entry[1] is None:
                        spark.conf.unset(key)
                    else:
                        spark.conf.set(key, entry[1])


def _with_defaults(
    spark: SparkSession, settings: Mapping[str, str], defaults: Mapping[str, str]
) -> dict[str, str]:
    chosen = dict(settings)
    for key, value in defaults.items():
        now = spark.conf.get(key, None)
        if now is None or (now == value and (_session(spark), key) in _held):
            chosen.setdefault(key, value)
    return chosen


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder the cluster names; a local folder only where none is named."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        with _lock:
            if not _local_root:
                # One for all local sessions of the process. What reads it ends with the process at the latest.
                _local_root.append(tempfile.mkdtemp(prefix="tripmill-"))
                atexit.register(shutil.rmtree, _local_root[0], ignore_errors=True)
        shared = _local_root[0]
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
