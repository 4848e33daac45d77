"""Session defaults and the shared scratch location.

Everything that must survive an executor loss (pinned sort layouts, round-trip
files) is written below the cluster's ``spark.checkpoint.dir``.  The setting is
read from the session; only a local session without one gets a private folder.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Library settings (session conf keys).  Values are read at plan-build time.
KEY_PARTITIONS = "spark.mercata.key.partitions"
LOOKUP_SALTS = "spark.mercata.lookup.salts"  # explicit split of hot lookup keys (unset: left to AQE)
SCRATCH_RUN = "spark.mercata.scratch.run"  # set by run_scratch: the folder of a run's scratch

_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # Spark's own
_releasing: dict[int, list] = {}  # session -> [open shuffles_released, the setting before them]
_releasing_lock = threading.Lock()


def build_session(master: str = "local[8]", app: str = "mercata", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests, the bench and local runs (UI off, AQE on)."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root, setting a private one only for local masters."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return configured or current
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="mercata-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", root)
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared checkpoint root (never reused)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    run = spark.conf.get(SCRATCH_RUN, None)
    return f"{root}/scratch/{run + '/' if run else ''}{label}-{uuid.uuid4().hex}"


@contextmanager
def run_scratch(spark: SparkSession, delete: Callable[[SparkSession, str], None]) -> Iterator[str]:
    """Scratch folders made inside lie below one folder, which ``delete`` removes at the end, after a failure too."""
    root, run = ensure_checkpoint_dir(spark).rstrip("/"), f"run-{uuid.uuid4().hex}"
    spark.conf.set(SCRATCH_RUN, run)
    try:
        yield f"{root}/scratch/{run}"
    finally:
        spark.conf.unset(SCRATCH_RUN)
        delete(spark, f"{root}/scratch/{run}")


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a write inside go when the write ends, not when the driver happens to collect its garbage.

    For writes whose rows are read back from their files only.  May be entered by several threads;
    the session has its own setting again when the last one leaves.
    """
    session = spark._jsparkSession.hashCode()
    with _releasing_lock:
        if session not in _releasing:
            _releasing[session] = [0, spark.conf.get(_SHUFFLE_CLEANUP, None)]
            spark.conf.set(_SHUFFLE_CLEANUP, "true")
        _releasing[session][0] += 1
    try:
        yield
    finally:
        with _releasing_lock:
            _releasing[session][0] -= 1
            if not _releasing[session][0]:
                before = _releasing.pop(session)[1]
                if before is None:
                    spark.conf.unset(_SHUFFLE_CLEANUP)
                else:
                    spark.conf.set(_SHUFFLE_CLEANUP, before)


def key_partitions(spark: SparkSession) -> int | None:
    """Fixed number of range partitions used to pin a sort layout, if configured.

    Unset (the default) leaves the count to the shuffle width and AQE, which
    merges neighbouring ranges of small inputs (order is kept: only contiguous
    ranges are merged), so a five-row dimension does not become thousands of files.
    """
    v = spark.conf.get(KEY_PARTITIONS, None)
    return int(v) if v not in (None, "") else None
