"""Spark session helpers.

The library never invents a cluster layout.  It reads what the session
already says (``spark.checkpoint.dir``, shuffle partitions) and only fills
settings that are unset, which is what local runs and tests need.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every query relies on for engine-independent answers.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(master: str | None = None, app: str = "ratelens",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests/bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        for k, v in _REQUIRED.items():
            active.conf.set(k, v)
        ensure_checkpoint_dir(active)
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.driver.memory", os.environ.get("RATELENS_DRIVER_MEM", "16g"))
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8)))
    for k, v in _REQUIRED.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only if unset.

    On a cluster the setting names a shared folder that survives executor
    loss, and must be set.  Only local runs (tests, bench) fall back to a
    fresh temp folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="ratelens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def checkpoint_dir(spark: SparkSession, name: str = "work") -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/ratelens-{name}-{uuid.uuid4().hex[:12]}"
    _MADE.append(path)
    return path


#: Bytes of input files for one partition of narrow rows, and the partitions up to which the session's settings decide.
PART_BYTES, FEW_PARTS = 8 << 20, 16


def input_bytes(*inputs: DataFrame) -> int:
    """Bytes of the files that ``inputs`` read; 0 for none."""
    files = {f for df in inputs for f in df.inputFiles()}
    if not files:
        return 0
    spark = inputs[0].sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    size = 0
    for f in files:
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))
        size += at.getFileSystem(conf).getFileStatus(at).getLen()
    return size


def partitions_for(*inputs: DataFrame) -> int:
    """Partitions for narrow rows of large ``inputs``, in proportion to the files they read; 0 for small ones or none.

    Adaptive execution joins partitions by their compressed bytes.  Columns of
    keys and counts compress so well that the rows of one joined partition,
    once sorted or grouped, take a hundred times that in memory, and spill.
    """
    n = math.ceil(input_bytes(*inputs) / PART_BYTES)
    return n if n > FEW_PARTS else 0


_MADE: list[str] = []


def remove_staged(spark: SparkSession) -> int:
    """Delete the written tables that this process has made so far; how many there were.

    For the end of a job: frames that still read such a table are lost with it.
    """
    jvm, conf, n = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    while _MADE:
        at = jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        n += bool(at.getFileSystem(conf).delete(at, True))
    return n
