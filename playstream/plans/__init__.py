"""End-to-end batch plans composed from the operators."""

from playstream.plans.batch import (events_of, final_snapshots, history_snapshots, numbered_credits,
                                    scored_history, training_from_events)

__all__ = ["events_of", "final_snapshots", "history_snapshots", "numbered_credits",
           "scored_history", "training_from_events"]
