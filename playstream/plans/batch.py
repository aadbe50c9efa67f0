r"""Batch jobs: the reference's streaming pipeline as whole-table plans.

events --normalise--> credits --aggregate--> player stats --enrich--> snapshots
                         \--number + snapshot history--> historical snapshots
                              --dedupe/label--> training set --fit--> models --score--> documents
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playstream.operators import (enrich, normalize_events, number_events, player_credits,
                                  player_stats, snapshot_history, training_set)
from playstream.operators.models import score, train_models
from playstream.session import materialize
from playstream.sources.fixture import pbp_raw

HISTORY_KEYS = ("game_id", "snapshot_id")


def events_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised events of the play-by-play view over ``events``."""
    return normalize_events(pbp_raw(spark.read.parquet(f"{sf_dir}/events.parquet")))


def final_snapshots(events: DataFrame) -> DataFrame:
    """Every player's final statistics with team/opponent/clock context."""
    return enrich(player_stats(player_credits(events)))


def numbered_credits(events: DataFrame, chunk: int | None = None) -> DataFrame:
    """Credit rows carrying the event's position within its game."""
    kw = {} if chunk is None else {"chunk": chunk}
    return player_credits(number_events(events, **kw), keep=["seq", "n_events"])


def history_snapshots(events: DataFrame, every: int = 30, chunk: int | None = None,
                      shots: bool = True) -> DataFrame:
    """Enriched snapshot rows at every ``every`` events of each game (what the
    reference's stream emits per trigger and its recorder stores)."""
    kw = {} if chunk is None else {"chunk": chunk}
    hist = snapshot_history(numbered_credits(events, chunk), every=every, shots=shots, **kw)
    return enrich(hist, by=HISTORY_KEYS)


def training_from_events(events: DataFrame, every: int = 30) -> DataFrame:
    """Labelled training rows from the snapshot history."""
    return training_set(history_snapshots(events, every, shots=False))


def scored_history(events: DataFrame, every: int = 30, seed: int = 42) -> DataFrame:
    """Fit both models on the history and score it (21 scored columns, the
    shot charts among them).

    The history is computed once (checkpointed) and feeds both the training
    set, which reads no charts, and the scoring pass."""
    hist = materialize(history_snapshots(events, every))
    win, mvp = train_models(training_set(hist), seed)
    return score(hist, win, mvp)
