"""Session set-up and the shared staging location.

On a cluster the staging location is the shared folder named by
``spark.checkpoint.dir``; it is read from the session. Only when it is
unset (local runs, tests) is a private one created.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

import daybook

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app_name: str = "daybook",
                  shuffle_partitions: int | None = None,
                  driver_memory: str | None = None) -> SparkSession:
    """A session with adaptive execution on (runtime re-plan, skew split,
    partition coalescing). On a cluster, ``master`` stays None and the
    launcher's settings win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:  # local mode: the driver JVM is the whole cluster
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not path:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="daybook-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for one written table."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "staging", f"{name}-{uuid.uuid4().hex[:12]}")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors, once for each application
    (functions that run there are found by import)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(daybook.__file__))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="daybook-")), "daybook_source.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    f = os.path.join(folder, name)
                    z.write(f, os.path.join("daybook", os.path.relpath(f, top)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


DEFAULT_SHUFFLE_PARTITIONS = "200"


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (file-system metadata only)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def shuffle_partitions_for(total_bytes: int, target_bytes: int = 256 << 20,
                           floor: int = 200) -> int:
    """Partitions for the first (largest) shuffle so that each holds about
    ``target_bytes`` of input; AQE coalesces the later, smaller shuffles."""
    return max(floor, -(-total_bytes // target_bytes))


def size_shuffles(spark: SparkSession, path: str, target_bytes: int = 256 << 20) -> int:
    """Set ``spark.sql.shuffle.partitions`` from the input size, unless the
    session was given a value of its own. Returns the value in force."""
    given = spark.sparkContext.getConf().get("spark.sql.shuffle.partitions", None)
    current = spark.conf.get("spark.sql.shuffle.partitions")
    if given is not None or current != DEFAULT_SHUFFLE_PARTITIONS:
        return int(current)
    n = shuffle_partitions_for(input_bytes(spark, path), target_bytes)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


BROADCAST_CONF = "spark.sql.autoBroadcastJoinThreshold"
ADAPTIVE_BROADCAST_CONF = "spark.sql.adaptive.autoBroadcastJoinThreshold"
LOCAL_MAP_CONF = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
#: Spark's values where the session was given none of its own.
DEFAULT_BROADCAST, DEFAULT_LOCAL_MAP = "10485760b", "0b"
#: Most bytes of a side, as measured after its shuffle, that is broadcast, and of a
#: partition that is hashed: Spark's advisory size of one partition.
MEASURED_SIDE = "64m"


@contextmanager
def measured_joins(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside hash the smaller side of a shuffled join where every partition
    of it was measured at ``MEASURED_SIDE`` at most, and broadcast a whole side of that
    size, so the larger side is not sorted or not shuffled. Larger sides are sorted and
    merged as before. Values that the session was given stay in force."""
    raised = [LOCAL_MAP_CONF] if spark.conf.get(LOCAL_MAP_CONF) == DEFAULT_LOCAL_MAP else []
    if spark.conf.get(ADAPTIVE_BROADCAST_CONF, None) is None and spark.conf.get(BROADCAST_CONF) == DEFAULT_BROADCAST:
        raised.append(ADAPTIVE_BROADCAST_CONF)
    before = {key: spark.conf.get(key, None) for key in raised}
    try:
        for key in raised:
            spark.conf.set(key, MEASURED_SIDE)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
