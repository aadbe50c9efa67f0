"""Sinks: event logs, keyed messages, recorded snapshots, scored documents (K1-K6).

Connectors are a ``format`` plus options; the message bus and search-index
connectors are not bundled with this install, so tests exercise the same
calls through file formats.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playstream.operators.codec import encode
from playstream.schemas import SNAP_FIELDS
from playstream.sinks.bulk import BulkDocuments, bulk_writer, read_bulk, sweep_bulk
from playstream.sinks.clustered import ClusteredTable, record_clustered


def write_events(df: DataFrame, path: str, mode: str = "append") -> None:
    """Normalised events as JSON lines; ``mode="overwrite"`` truncates the log first (K1, K2)."""
    df.write.mode(mode).json(path)


def publish(df: DataFrame, key: str = "game_id", fmt: str = "kafka",
            fields: Sequence[str] | None = None, path: str | None = None,
            mode: str = "append", **options) -> None:
    """Write rows as ``key, value`` JSON messages (K3, K4).

    ``fields=None`` publishes every column.  For a bus (``fmt="kafka"``)
    ``options`` name the brokers and topic; for files, ``path`` is required.
    """
    msgs = encode(df, key, fields if fields is not None else df.columns)
    w = msgs.write.format(fmt).options(**options)
    if path is not None:
        w.mode(mode).save(path)
    else:
        w.save()


def batch_writer(fmt: str, path: str | None = None, mode: str = "append",
                 partition_by: Sequence[str] = (), idempotent: bool = True,
                 **options) -> Callable[[DataFrame, int], None]:
    """A ``(batch_df, batch_id)`` writer for ``foreachBatch`` pipelines.

    With a ``path`` and ``idempotent`` (default), batch ``n`` is written to
    ``path/batch=n`` with overwrite, so a micro-batch re-run after a failure
    replaces its own output instead of appending a second copy.  Readers see
    ``batch`` as a partition column.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        target, m = path, mode
        if path is not None and idempotent:
            target, m = f"{path.rstrip('/')}/batch={batch_id}", "overwrite"
        out = df.repartition(*partition_by) if partition_by else df
        w = out.write.format(fmt).mode(m).options(**options)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(target) if target is not None else w.save()
    return write


def record_snapshots(sdf: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ("game_id",),
                     trigger: dict | None = None, fmt: str = "parquet") -> StreamingQuery:
    """Streaming recorder: append rows to a table partitioned by game, with a
    durable checkpoint so a restart resumes where it stopped (K5, ST2, ST5)."""
    clustered = sdf.repartition(*partition_by)   # one file a game and trigger
    w = (clustered.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
                  .partitionBy(*partition_by))
    if trigger:
        w = w.trigger(**trigger)
    return w.start(path)


def with_doc_id(df: DataFrame, keys: Sequence[str] = ("game_id", "team_code", "player_name",
                                                      "seconds_remaining")) -> DataFrame:
    """Deterministic document id for sinks that upsert (D8): re-emitted moments
    overwrite instead of piling up.  A hash of the keys as JSON with their
    nulls, so that neither a null nor a mark in a name makes two keys alike."""
    key = F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in keys]), {"ignoreNullFields": "false"})
    return df.withColumn("doc_id", F.sha2(key, 256))


def write_scores(df: DataFrame, fmt: str = "parquet", path: str | None = None, mode: str = "append",
                 doc_id: bool = False, **options) -> None:
    """Append scored documents to any sink (K6); ``doc_id`` adds the upsert key."""
    out = with_doc_id(df) if doc_id else df
    w = out.write.format(fmt).mode(mode).options(**options)
    w.save(path) if path is not None else w.save()


__all__ = ["write_events", "publish", "batch_writer", "record_snapshots", "with_doc_id",
           "write_scores", "SNAP_FIELDS", "BulkDocuments", "bulk_writer", "read_bulk", "sweep_bulk",
           "ClusteredTable", "record_clustered"]
