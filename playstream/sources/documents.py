"""Game documents that grow, as a stream (S1, S2, L6, ST4).

A live feed rewrites a game's document with ever more actions, and Spark's
file source never reads a file twice.  The source here takes a document's
time of change as its version: a trigger reads the documents that have
changed since the one before, split over tasks, and the offset is a single
time however many documents there are.  The last action number of every game
is kept as state, so that of all versions together each action comes once,
also after a restart or when a batch runs again.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from playstream.sources.games import UNKNOWN_GAME

#: Columns of a raw action, and the fields of a document's action that they come from.
_FIELDS = {"action_number": "actionNumber", "period": "period", "clock_raw": "clock", "team_code": "teamTricode", "player_name": "playerNameI",
           "action_type": "actionType", "shot_result": "shotResult", "description": "description", "x": "x", "y": "y"}
_NUMBERS = {"action_number": int, "period": int, "x": float, "y": float}
_SCHEMA = ("game_id string, action_number int, period int, clock_raw string, team_code string, player_name string, action_type string, "
           "shot_result string, description string, x double, y double, version long")


def _value(column: str, value):
    """The value if it has the column's type, else null, as the permissive JSON reader has it."""
    kind = _NUMBERS.get(column, str)
    if value is None or isinstance(value, bool):
        return None
    if kind is float and isinstance(value, int):
        return float(value)
    if kind is str and not isinstance(value, str):
        return json.dumps(value)
    return value if isinstance(value, kind) else None


class _Documents(InputPartition):
    def __init__(self, found: list[tuple[str, int]]) -> None:
        self.found = found


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.folder = options["path"]
        self.settle = float(options.get("settle", 1.0))
        self.per_task = int(options.get("documentspertask", 64))
        self.suffix = options.get("suffix", ".json")

    def _files(self):
        """``(path, version)`` of every document; a version is a time in microseconds."""
        from pyarrow import fs
        system, root = self._at()
        found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        return [(f.path, f.mtime_ns // 1000) for f in found if f.is_file and f.path.endswith(self.suffix) and not f.base_name.startswith((".", "_"))]

    def initialOffset(self) -> dict:
        return {"until": -1}

    def latestOffset(self) -> dict:
        # what changed just now may change again within the clock's grain: it waits
        ripe = int((time.time() - self.settle) * 1e6)
        return {"until": max([v for _, v in self._files() if v <= ripe], default=-1)}

    def partitions(self, start: dict, end: dict) -> list[_Documents]:
        changed = sorted((p, v) for p, v in self._files() if start["until"] < v <= end["until"])
        return [_Documents(changed[k:k + self.per_task]) for k in range(0, len(changed), self.per_task)]

    def read(self, partition: _Documents) -> Iterator[tuple]:
        system, _ = self._at()
        for path, version in partition.found:
            try:
                with system.open_input_stream(path) as f:
                    game = json.loads(f.read())["game"]
                actions, name = game["actions"], game.get("gameId")
            except (OSError, ValueError, KeyError, TypeError, AttributeError):
                continue   # gone, half written (it will change again) or no game document
            game_id = UNKNOWN_GAME if name is None else str(name)
            for a in actions if isinstance(actions, list) else []:
                if isinstance(a, dict):
                    yield (game_id, *(_value(c, a.get(f)) for c, f in _FIELDS.items()), version)

    def _at(self):
        """File system and folder."""
        from pyarrow import fs
        return fs.FileSystem.from_uri(self.folder) if "://" in self.folder else (fs.LocalFileSystem(), self.folder.removeprefix("file:"))


class GameDocuments(DataSource):
    """``spark.readStream.format("game_documents")``: raw actions of the documents
    in the folder ``path``, all of a document whenever it has changed.  What is
    put in place with a time before the newest one read is not seen as changed.

    Options: ``settle`` (seconds that a change waits, 1), ``documentsPerTask``
    (64), ``suffix`` (.json)."""

    @classmethod
    def name(cls) -> str:
        return "game_documents"

    def schema(self) -> str:
        return _SCHEMA

    def streamReader(self, schema: StructType) -> _Reader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def new_actions(raw: DataFrame) -> DataFrame:
    """Each game's actions after the last one seen of it, in order (L6 for streams
    of whole documents); the state is one number per game.  Actions without a
    number cannot be placed and are left out."""
    def run(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(pdfs))   # the versions of one game's document
        rows = rows[rows["action_number"].notna()]
        if last is not None:
            rows = rows[rows["action_number"] > last]
        rows = rows.sort_values(["action_number", "version"], kind="stable").drop_duplicates("action_number", keep="last")
        if len(rows):
            state.update((int(rows["action_number"].iloc[-1]),))
        yield rows

    return raw.groupBy("game_id").applyInPandasWithState(run, raw.schema, "last long", "append", GroupStateTimeout.NoTimeout).drop("version")


def follow_games(spark: SparkSession, folder: str, **options) -> DataFrame:
    """Raw actions of the growing game documents in ``folder``, each once, as a stream."""
    spark.dataSource.register(GameDocuments)
    return new_actions(spark.readStream.format("game_documents").option("path", folder).options(**options).load())
