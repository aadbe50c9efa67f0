"""Helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import gc
import os
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Name under which a worker process keeps things from task to task.
WORKER = "playstream_worker"

#: Rows of a record batch that a task turns into Python objects at once.
SLICE_ROWS = 256

_runs: dict[str, str] = {}
_recorders: list[list[str]] = []


def scratch(spark: SparkSession) -> str:
    """This session's folder for intermediate tables, under ``spark.checkpoint.dir``.

    The setting is read from the session.  Only a local master may go without
    it (tests); on a cluster a missing shared folder is an error.  The folder
    is deleted when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _runs:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith(("local[", "local")) \
                    or spark.sparkContext.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="playstream-")
        _runs[app] = f"{base.rstrip('/')}/llm-{app}-{os.getpid()}"
        atexit.register(_delete, spark, _runs[app])
    return _runs[app]


def _delete(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    if sc._jsc is None or sc._jsc.sc().isStopped():
        return
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def save(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a Parquet table in the scratch folder and read it back.

    Cuts the lineage; the files survive lost executors."""
    path = f"{scratch(df.sparkSession)}/{uuid.uuid4().hex}"
    for paths in _recorders:
        paths.append(path)
    df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def erase(*tables: DataFrame) -> None:
    """Delete saved tables from which everything has been computed and saved,
    and the shuffle files that were needed for that."""
    for df in tables:
        _delete(df.sparkSession, df._saved_at)
    release(tables[0].sparkSession)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS, remember: bool = False) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of at most ``rows`` rows, to bound memory.

    Unless told to ``remember``, the worker process first lets go of what tasks
    of another kind have left for later ones."""
    if not remember:
        sys.modules.pop(WORKER, None)
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def portions(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 1 << 24, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of at most ``rows`` rows whose ``column`` has
    at most ``most`` bytes together, or of one longer value."""
    for b in slices(batches, rows):
        sizes = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + most, "right")))
            yield b.slice(at, to - at)
            at = to


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def row_key() -> Column:
    """Tells rows of ``documents`` apart by doc_id and text; rows alike in both
    get the same result from every operator, so they may share a key."""
    return F.struct(F.col("doc_id"), F.xxhash64("doc_id", "text").alias("h"))


def rows_with(docs: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of ``docs`` whose key is (``left_anti``: is not) among ``keys(doc_id, h)``, all columns kept."""
    key = fresh(docs, "key")
    k = keys.select(F.struct("doc_id", "h").alias(key))
    return docs.join(k, F.struct(docs["doc_id"], F.xxhash64(docs["doc_id"], docs["text"])) == k[key], how)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files that nothing refers to any more, now
    rather than when the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def recorded(paths: list[str]) -> Iterator[None]:
    """Within it, the paths of saved tables are added to ``paths``."""
    _recorders.append(paths)
    try:
        yield
    finally:
        _recorders.remove(paths)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete recorded tables that nothing reads any more."""
    while paths:
        _delete(spark, paths.pop())
    release(spark)
