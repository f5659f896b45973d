"""Session set-up: the few settings the operators rely on.

* ``spark.sql.session.timeZone=UTC`` - naive texts are parsed as UTC wall time.
* AQE on, with skew-join splitting and partition coalescing, from 400 parts on,
  and bounds on what a task reads.
* A folder that all executors share, below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

_SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # shuffles begin in small parts, which AQE puts together: a task's share doesn't grow with the input
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
}

#: Bytes that a task reads of a file, and of a shuffle, at most: what it sorts and groups doesn't
#: grow with the input. Sessions with less keep that.
_AT_MOST = {
    "spark.sql.files.maxPartitionBytes": 32 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
}


def get_session(master: str | None = None, app: str = "tallycheck",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Local/test session builder. On a cluster, use the session you are given
    and call :func:`configure` on it."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = (SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**_SQL_CONF, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Check that the session has the settings the operators need. A session
    that runs in this process alone (tests, bench) gets them; a cluster's session
    is its owner's, so a time zone that would change results is an error there."""
    local = spark.sparkContext.master.startswith("local")
    for k, v in _SQL_CONF.items():
        if spark.conf.get(k, None) == v:
            continue
        if local:
            spark.conf.set(k, v)
        elif k == "spark.sql.session.timeZone" and spark.conf.get(k) not in ("UTC", "Etc/UTC", "Z", "GMT"):
            raise ValueError(f"the session needs {k}=UTC")
    for k, most in _AT_MOST.items() if local else ():
        if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(k)) > most:
            spark.conf.set(k, f"{most}b")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors reach: below the one the cluster names in
    ``spark.checkpoint.dir``; only a session without a cluster that names none
    gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tallycheck-")
    return f"{root.rstrip('/')}/run-{uuid.uuid4().hex}"


#: What a query shuffled is deleted when it ends, not when the driver next collects its garbage.
_DELETE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def deletes_shuffles(job: Callable) -> Callable:
    """``job(spark, ...)`` with the shuffle files of each of its queries deleted when the
    query ends: a job of many steps needs room for the largest, not for all."""
    @functools.wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        before = spark.conf.get(_DELETE_SHUFFLES)
        spark.conf.set(_DELETE_SHUFFLES, "true")
        try:
            return job(spark, *args, **kwargs)
        finally:
            spark.conf.set(_DELETE_SHUFFLES, before)
    return run
