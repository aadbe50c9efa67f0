"""Recorded snapshot tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playstream.schemas import SNAP_RECORD, from_reference_names, reference_schema


def read_snapshots(spark: SparkSession, path: str, schema=SNAP_RECORD, reference_names: bool = False) -> DataFrame:
    """Scan a snapshot table partitioned by ``game_id``.

    The explicit schema keeps ``game_id`` a zero-padded string (partition
    inference would turn ``0022500349`` into an int).  Filters on
    ``game_id`` prune partition folders.  ``reference_names`` reads a table
    whose columns and folders have the reference's names.
    """
    if reference_names:
        return from_reference_names(spark.read.schema(reference_schema(schema)).parquet(path))
    return spark.read.schema(schema).parquet(path)
