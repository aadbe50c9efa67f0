"""Log-structured table of player statistics for update-mode streams (ST6, D6).

A batch's folder holds the rows that it has changed, a run the newest row of
every player in its batches (see :mod:`playstream.runs`).  Rows are dealt into
buckets by a null-safe hash of the game, and a trigger reads the touched
games' buckets only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from playstream.operators.stats import PLAYER_KEYS
from playstream.runs import Run, Runs, folder

BUCKETS = 256   # folders of a batch or run, by hash of the game; fixed for a table's life
EVERY = 8       # folders of a rank that are merged into one of the next


def game_of(game: str):
    """The game as a null-safe key."""
    return F.struct(F.col(game).alias("g"))


def bucket_of(game: str):
    return F.pmod(F.xxhash64(game_of(game)), F.lit(BUCKETS)).cast("int")


def latest_stats(versions: DataFrame, keys: Sequence[str] = PLAYER_KEYS) -> DataFrame:
    """Each player's newest version; null keys are keys like any other."""
    cols = [c for c in versions.columns if c not in ("batch", "bucket")]
    return (versions.groupBy(F.struct(*keys).alias("_k")).agg(F.max_by(F.struct(*cols), "batch").alias("_v"))
            .select("_v.*"))


class StatsTable:
    """The table at ``path``, whose rows have ``schema`` and the key columns ``keys``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, game: str = "game_id",
                 keys: Sequence[str] = PLAYER_KEYS, every: int = EVERY) -> None:
        self.spark, self.path, self.game, self.keys = spark, path.rstrip("/"), game, tuple(keys)
        self.schema = StructType([*schema.fields, StructField("bucket", IntegerType())])
        self.runs = Runs(spark, self.path, every)

    def _versions(self, runs: Sequence[Run]) -> DataFrame:
        out = self.spark.createDataFrame([], self.schema).withColumn("batch", F.lit(0).cast("long"))
        for run in runs:
            rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder(run)}")
            out = out.unionByName(rows.withColumn("batch", F.lit(run[1]).cast("long")))
        return out

    def read(self, before: int | None = None) -> DataFrame:
        """All versions that count, with ``bucket`` and the ``batch`` that a
        version is as new as; with ``before`` those of batches before that one."""
        return self._versions(self.runs.known(before))

    def current(self) -> DataFrame:
        """Every player's newest row."""
        return latest_stats(self.read(), self.keys)

    def _write(self, rows: DataFrame, run: Run) -> None:
        (rows.withColumn("bucket", bucket_of(self.game)).repartition("bucket").write.mode("overwrite").partitionBy("bucket")
         .parquet(f"{self.path}/{folder(run)}"))

    def compact(self, before: int) -> Run | None:
        """Merge batches before ``before`` where enough of a rank are there; the new run if so."""
        return self.runs.merge(before, lambda merged, new: self._write(latest_stats(self._versions(merged), self.keys), new))

    def add(self, changed: DataFrame, batch_id: int) -> DataFrame:
        """Add the rows that a batch has changed; the touched games' whole current rows.

        A batch that runs again replaces its own folder only and reads only
        batches before it, so neither a crash nor a re-run loses or doubles
        rows."""
        self.compact(batch_id)
        self._write(changed, (batch_id, batch_id, 0))
        touched = [r[0] for r in changed.select(bucket_of(self.game)).distinct().collect()]   # BUCKETS rows at most
        games = changed.select(game_of(self.game).alias("_g")).distinct()
        kept = (self.read(batch_id).where(F.col("bucket").isin(touched)).drop("bucket")
                .withColumn("_g", game_of(self.game)).join(games, "_g", "left_semi").drop("_g"))
        return latest_stats(kept.unionByName(changed.withColumn("batch", F.lit(batch_id).cast("long"))), self.keys)
