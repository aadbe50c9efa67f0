"""playstream: play-by-play event analytics on Spark.

Normalise nested game feeds, credit each event to the players involved,
keep per-player statistics with team/opponent/clock context, rebuild the
statistics history snapshot by snapshot, label/train/score two models and
write the results to any Spark sink -- as batch jobs and as Structured
Streaming queries.  Everything is DataFrame / Structured Streaming / MLlib
code; column names are arguments so the generic operators run over other
event tables too.
"""

import sys

from pyspark import cloudpickle

from playstream.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]

# Task functions travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
