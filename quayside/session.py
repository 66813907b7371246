"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter for correctness on every session this package runs in.
SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


#: Spark drops the shuffle files of a statement as soon as it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_HOLD, _HELD = threading.Lock(), {}


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """For writes: nothing reads a write's shuffle files after it, and else they stay until the
    driver happens to collect its garbage. Threads of one session may hold it at the same time."""
    key = id(spark._jsparkSession)
    with _HOLD:
        n, before = _HELD.get(key, (0, None))
        _HELD[key] = (n + 1, before if n else spark.conf.get(SHUFFLE_CLEANUP, None))
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _HOLD:
            n, before = _HELD.pop(key)
            if n > 1:
                _HELD[key] = (n - 1, before)
            elif before is None:
                spark.conf.unset(SHUFFLE_CLEANUP)
            else:
                spark.conf.set(SHUFFLE_CLEANUP, before)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a written folder that nothing will read again."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quayside",
                  extra_conf: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("QUAYSIDE_DRIVER_MEMORY", "8g"))
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**SQL_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir`` (or set on the context)."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    try:
        return spark.conf.get("spark.checkpoint.dir")
    except Exception:  # noqa: BLE001 - unset key
        return None


def current_session(app: str = "quayside") -> SparkSession:
    """The active session, or one with the settings of the submit command (no
    master is set here, so the same command line runs on a cluster)."""
    builder = SparkSession.builder.appName(app)
    for k, v in SQL_CONF.items():
        builder = builder.config(k, v)
    return SparkSession.getActiveSession() or builder.getOrCreate()


def is_local(master: str) -> bool:
    """One JVM: executors share the driver's folders (``local-cluster`` doesn't count)."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``. Only a local session without it
    gets a private folder; on a cluster executors could not see one."""
    d = checkpoint_dir(spark)
    if not d:
        if not is_local(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="quayside-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - core configs may be read-only at runtime
            pass
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for written tables and snapshots."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "quayside", *parts])
