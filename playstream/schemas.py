"""Declared schemas and the engine/reference column glossary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType)


def _s(name, t):
    return StructField(name, t, True)


# One action of a game document (``game.actions[]``), as published by the feed.
ACTION = StructType([
    _s("actionNumber", IntegerType()), _s("period", IntegerType()),
    _s("clock", StringType()), _s("teamTricode", StringType()),
    _s("actionType", StringType()), _s("playerNameI", StringType()),
    _s("shotResult", StringType()), _s("description", StringType()),
    _s("x", DoubleType()), _s("y", DoubleType()),
])

# Whole game document: {"game": {"gameId": ..., "actions": [...]}}.
GAME_DOC = StructType([
    _s("game", StructType([_s("gameId", StringType()), _s("actions", ArrayType(ACTION))])),
])

# Normalised event (12 fields).
EVENT = StructType([
    _s("game_id", StringType()), _s("event_id", IntegerType()),
    _s("quarter", IntegerType()), _s("team_code", StringType()),
    _s("player_name", StringType()), _s("event_type", StringType()),
    _s("shot_result", StringType()), _s("shot_value", IntegerType()),
    _s("assist_player", StringType()), _s("clock", StringType()),
    _s("x", DoubleType()), _s("y", DoubleType()),
])

SHOT = StructType([_s("x", DoubleType()), _s("y", DoubleType()), _s("r", IntegerType())])

# Enriched snapshot message (engine names), as decoded by the scoring job.
SNAP = StructType([
    _s("game_id", StringType()), _s("team_code", StringType()),
    _s("team_score", IntegerType()), _s("score_diff", IntegerType()),
    _s("seconds_remaining", IntegerType()), _s("game_quarter", IntegerType()),
    _s("game_clock", StringType()), _s("player_name", StringType()),
    _s("pts", IntegerType()), _s("ast", IntegerType()), _s("reb", IntegerType()),
    _s("stl", IntegerType()), _s("blk", IntegerType()), _s("tov", IntegerType()),
    _s("pf", IntegerType()), _s("fg_pct", DoubleType()), _s("efficiency", DoubleType()),
    _s("shots", ArrayType(SHOT)),
])

# Same message with the shot chart kept as raw JSON text (the recorder's view).
SNAP_RAW = StructType([f if f.name != "shots" else _s("shots", StringType()) for f in SNAP.fields])

# Snapshot message fields in payload order.
SNAP_FIELDS = [f.name for f in SNAP.fields]

# Messages and recorded rows also carry the snapshot (trigger) they were taken at.
SNAP_MESSAGE = StructType(SNAP.fields + [_s("snapshot_id", LongType())])
SNAP_RECORD = StructType(SNAP_RAW.fields + [_s("snapshot_id", LongType())])

# The reference's published column names for the engine names
# (messages, Parquet files and the scored documents use these).
REFERENCE_NAMES = {
    "game_id": "Partita",
    "team_code": "Squadra",
    "player_name": "Giocatore",
    "pts": "Punti",
    "ast": "Assist",
    "reb": "Rimb",
    "stl": "Palla_r",
    "blk": "Stopp",
    "tov": "Palla_p",
    "pf": "Falli",
    "fga": "FGA",
    "fgm": "FGM",
    "fg_pct": "%_Tiro",
    "shots": "Posizioni",
    "latest": "Info_recenti",
    "team_score": "Punteggio_Squadra",
    "opp_score": "Punteggio_Avversario",
    "score_diff": "Score_Diff",
    "seconds_remaining": "Seconds_Remaining",
    "game_quarter": "Quarto_globale",
    "game_clock": "Clock_globale",
    "efficiency": "Efficiency",
    "win_pct": "Win%",
    "mvp_pct": "MVP%",
}


def to_reference_names(df: DataFrame) -> DataFrame:
    """Rename engine columns to the reference's published names."""
    return df.withColumnsRenamed({c: REFERENCE_NAMES[c] for c in df.columns if c in REFERENCE_NAMES})


def from_reference_names(df: DataFrame) -> DataFrame:
    """Rename reference-named columns back to engine names."""
    back = {v: k for k, v in REFERENCE_NAMES.items()}
    return df.withColumnsRenamed({c: back[c] for c in df.columns if c in back})


def reference_schema(schema: StructType) -> StructType:
    """``schema`` with the reference's published names."""
    return StructType([StructField(REFERENCE_NAMES.get(f.name, f.name), f.dataType, f.nullable) for f in schema.fields])
