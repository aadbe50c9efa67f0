"""Structured Streaming jobs (ST1-ST9)."""

from playstream.streaming.closed import closed_games
from playstream.streaming.jobs import (foreach_enrich, foreach_merge_enrich, foreach_score, merge_stats,
                                       progress_after, read_stats, run_score_stream, run_stats_stream,
                                       snapshot_stream, watch)
from playstream.streaming.progress import Batch, Reports, follow, reports
from playstream.streaming.sessions import game_sessions
from playstream.streaming.table import StatsTable, latest_stats

__all__ = ["foreach_enrich", "foreach_merge_enrich", "merge_stats", "read_stats", "latest_stats", "StatsTable", "foreach_score",
           "run_score_stream", "run_stats_stream", "snapshot_stream", "progress_after", "watch",
           "Batch", "Reports", "follow", "reports", "game_sessions", "closed_games"]
