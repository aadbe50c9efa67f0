"""Session helpers.

On a cluster the session is built by the platform; these helpers only fill
in settings that are *unset*, so a cluster's own choices always win.
"""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on (Spark's own defaults agree); applied only where
# the session has no value.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # stream state off the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
_HEAP_STATE = "HDFSBackedStateStoreProvider"   # Spark's default counts as no choice


def get_session(master: str | None = None, app: str = "playstream",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session.

    With ``master`` (tests, the bench, local runs) the local settings are
    applied.  Without it (jobs under spark-submit on a cluster) the
    cluster's settings are kept; :data:`DEFAULTS` only fill keys that have
    no value at all.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = (b.master(master)
              .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
              .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
              .config("spark.driver.memory", os.environ.get("PLAYSTREAM_DRIVER_MEMORY", "8g")))
    spark = b.getOrCreate()
    for k, v in DEFAULTS.items():
        now = spark.conf.get(k, None)
        if now is None or now.endswith(_HEAP_STATE):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Read from the session.  Where it is unset, a local master (one machine,
    as in tests) gets a scratch folder; on a cluster, whose executors share
    no local disk, that is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None) or _local.get(spark.sparkContext.applicationId)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = _local[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="playstream-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return d


_local: dict[str, str] = {}   # scratch folders by application, local masters only


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder in whatever file system it is in."""
    sc = spark.sparkContext
    if sc._jsc is not None and not sc._jsc.sc().isStopped():
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a Parquet table under the shared checkpoint folder
    (``spark.checkpoint.dir``) and read it back: the lineage is cut, the data
    survives lost executors, and the re-read is columnar and prunable.  (An
    RDD checkpoint of an uncached plan would compute it twice.)  The table is
    removed when the driver ends."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    atexit.register(delete_path, spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
