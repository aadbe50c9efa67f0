"""Event sources: JSON-lines files and message buses, batch or streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playstream.operators.codec import decode
from playstream.schemas import EVENT


def read_events(spark: SparkSession, path: str, schema=EVENT) -> DataFrame:
    """Batch read of normalised events written as JSON lines."""
    return spark.read.schema(schema).json(path)


def stream_events(spark: SparkSession, path: str | None = None, fmt: str = "json",
                  schema=EVENT, max_per_trigger: int | None = None,
                  starting: str | None = "earliest", **options) -> DataFrame:
    """Streaming event source.

    ``fmt="json"``: tail a directory of ``*.jsonl`` files; the position is
    kept by the query's checkpoint.  ``max_per_trigger`` maps to
    ``maxFilesPerTrigger``.

    Any other ``fmt`` (e.g. ``"kafka"``) is a message bus: ``options`` go to
    the connector, ``starting`` to ``startingOffsets`` (None keeps the
    connector default), ``max_per_trigger`` to ``maxOffsetsPerTrigger``, and
    the ``value`` column is decoded with ``schema`` (P1).
    """
    r = spark.readStream
    if fmt == "json":
        r = r.schema(schema).options(**options)
        if max_per_trigger:
            r = r.option("maxFilesPerTrigger", max_per_trigger)
        return r.json(path)
    r = r.format(fmt).options(**options)
    if starting is not None:
        r = r.option("startingOffsets", starting)
    if max_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_per_trigger)
    return decode(r.load(), schema)
