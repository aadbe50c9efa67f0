"""Sources: game documents, event streams, recorded snapshots."""

from playstream.sources.documents import GameDocuments, follow_games, new_actions
from playstream.sources.games import flatten_actions, missing_games, read_games
from playstream.sources.events import stream_events, read_events
from playstream.sources.snapshots import read_snapshots

__all__ = ["read_games", "flatten_actions", "missing_games", "stream_events", "read_events", "read_snapshots",
           "GameDocuments", "follow_games", "new_actions"]
