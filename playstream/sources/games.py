"""Game-document scan."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstream import files
from playstream.schemas import GAME_DOC

# Fixed value: game id used when a document carries none.
UNKNOWN_GAME = "UNKNOWN_GAME"


def flatten_actions(docs: DataFrame) -> DataFrame:
    """``{game: {gameId, actions[]}}`` rows -> one raw action per row.

    Documents without ``game`` or ``actions`` (or malformed ones, which the
    permissive JSON reader turns into nulls) yield no rows.
    """
    a = F.col("a")
    return (docs
            .select(F.coalesce(F.col("game.gameId"), F.lit(UNKNOWN_GAME)).alias("game_id"),
                    F.explode("game.actions").alias("a"))
            .select("game_id",
                    a["actionNumber"].alias("action_number"), a["period"].alias("period"),
                    a["clock"].alias("clock_raw"), a["teamTricode"].alias("team_code"),
                    a["playerNameI"].alias("player_name"), a["actionType"].alias("action_type"),
                    a["shotResult"].alias("shot_result"), a["description"].alias("description"),
                    a["x"].alias("x"), a["y"].alias("y")))


def read_games(spark: SparkSession, paths: "str | Iterable[str]",
               game_ids: Iterable[str] | None = None, multiline: bool = True) -> DataFrame:
    """Scan one or many game documents in a single parallel read.

    ``game_ids`` keeps only the listed games.  A document that cannot be
    parsed contributes no rows, one that is missing or cannot be read is
    skipped; :func:`missing_games` lists the former paths.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    gone = set(missing_games(spark, paths))
    present = [p for p in paths if p not in gone]
    if not present:
        out = flatten_actions(spark.createDataFrame([], GAME_DOC))
    else:
        docs = (spark.read.schema(GAME_DOC).option("multiLine", multiline).option("mode", "PERMISSIVE")
                .option("ignoreMissingFiles", True).option("ignoreCorruptFiles", True).json(present))
        out = flatten_actions(docs)
    if game_ids is not None:
        out = out.filter(F.col("game_id").isin(list(game_ids)))
    return out


def missing_games(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Those of the paths (patterns allowed) that match no file.

    One look-up per folder, not per document; a pattern is one of its own."""
    paths = list(paths)
    found: dict[str, set[str]] = {}
    for folder in dict.fromkeys(_parts(p)[0] for p in paths if not _PATTERN.search(p)):
        found[folder] = set(files.names(spark, folder or "."))
    return [p for p in paths if (not files.matches(spark, p) if _PATTERN.search(p) else _parts(p)[1] not in found[_parts(p)[0]])]


_PATTERN = re.compile(r"[*?\[{]")


def _parts(path: str) -> tuple[str, str]:
    """Folder and name."""
    folder, slash, name = path.rstrip("/").rpartition("/")
    return folder or slash, name
