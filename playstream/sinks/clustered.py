"""Recorded snapshots as a range-clustered table (K5, S7, ST2).

Rows are sorted by game into files of bounded size, each with its smallest
and largest game on record, and batches are merged by rank (see
:mod:`playstream.runs`).  Neither folders nor files grow with the number of
games or triggers, and reading a game opens the few files that may hold it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from playstream.runs import Run, Runs, folder

EVERY = 4             # folders of a rank that are merged into one of the next
FILE_ROWS = 1 << 20   # rows of a file, at most


class ClusteredTable:
    """The table at ``path``, sorted by the columns ``by``, the first of which readers ask for."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, by: Sequence[str] = ("game_id", "snapshot_id"),
                 every: int = EVERY, file_rows: int = FILE_ROWS) -> None:
        self.spark, self.path, self.schema, self.by, self.file_rows = spark, path.rstrip("/"), schema, list(by), file_rows
        self.runs = Runs(spark, self.path, every)

    def _write(self, rows: DataFrame, run: Run) -> None:
        """Sorted files, and what is in each."""
        where, key = f"{self.path}/{folder(run)}", F.col(self.by[0])
        (rows.select(*self.schema.names).repartitionByRange(*self.by).sortWithinPartitions(*self.by)
         .write.mode("overwrite").option("maxRecordsPerFile", self.file_rows).parquet(f"{where}/data"))
        (self.spark.read.schema(self.schema).parquet(f"{where}/data").groupBy(F.col("_metadata.file_name").alias("file"))
         .agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.when(key.isNull(), 1)).alias("nulls"), F.count("*").alias("rows"))
         .coalesce(1).write.mode("overwrite").parquet(f"{where}/files"))   # a row a file

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Add a batch's rows; a batch that runs again replaces its own."""
        def merged(runs: list[Run], new: Run) -> None:
            self._write(self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{folder(r)}/data" for r in runs]), new)
        self.runs.merge(batch_id, merged)
        self._write(rows, (batch_id, batch_id, 0))

    def _files(self, runs: list[Run]) -> DataFrame:
        return self.spark.read.schema(f"file string, low {self._kind()}, high {self._kind()}, nulls long, rows long").parquet(
            *[f"{self.path}/{folder(r)}/files" for r in runs]).withColumn("path", F.regexp_replace(F.col("_metadata.file_path"), "/files/[^/]*$", "/data/"))

    def _kind(self) -> str:
        return self.schema[self.by[0]].dataType.simpleString()

    def read(self, game=None) -> DataFrame:
        """All rows, or those of one game from the files whose range holds it."""
        runs = self.runs.known()
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        if game is None:
            return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{folder(r)}/data" for r in runs])
        held = self._files(runs).where((F.col("low") <= F.lit(game)) & (F.col("high") >= F.lit(game)))
        paths = [r[0] for r in held.select(F.concat("path", "file")).collect()]   # a few a run
        rows = self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)
        return rows.where(F.col(self.by[0]) == F.lit(game))


def record_clustered(sdf: DataFrame, table: ClusteredTable, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Streaming recorder into a clustered table; a restart resumes where it stopped."""
    w = sdf.writeStream.foreachBatch(table.append).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()
