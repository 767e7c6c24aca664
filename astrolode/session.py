"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import math
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Semantics every job relies on: UTC clock, errors instead of silent overflow, and
# run-time re-planning (partition coalescing, skew splitting, join switching).
RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

SHUFFLE_PARTITION_BYTES = 200 * 1024 * 1024


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the run-time defaults on an existing session."""
    for key, value in RUNTIME_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Shuffle partitions so that one holds about 200 MB; AQE merges small ones later."""
    return max(cores, math.ceil(input_bytes / SHUFFLE_PARTITION_BYTES))


def build_session(app: str, master: str | None = None, input_bytes: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with the defaults; `input_bytes` (the largest table) sizes the shuffles."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if input_bytes is not None:
        partitions = shuffle_partitions(input_bytes, spark.sparkContext.defaultParallelism)
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return apply_defaults(spark)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder path under the cluster's `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):  # not local-cluster
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        base = tempfile.mkdtemp(prefix="astrolode-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it a query's shuffle files go when it ends, not when the driver next collects garbage.

    For jobs that write one large table after another. A frame that runs twice shuffles twice.
    """
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def run_each(spark: SparkSession, work: Callable, items: Iterable, parallel: int = 1) -> list:
    """Run `work` per item, up to `parallel` Spark jobs at a time, results in order.

    For the handful of tables of a catalog: small ones fill the gaps a large one leaves.
    """
    items = list(items)
    if parallel <= 1 or len(items) <= 1:
        return [work(item) for item in items]
    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))
