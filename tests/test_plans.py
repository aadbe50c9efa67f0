"""Plan checks: no Python in the hot path, pruned scans, few shuffles."""

import re

import pytest

import __spark_entry__ as E
from playstream.plans.catalog import QUERIES
from tests.conftest import SF0001

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF", "pythonUDF")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"scored_history", "score_checks"}))
def test_no_python_in_plans(spark, name):
    p = _plan(QUERIES[name](spark, SF0001))
    assert not any(n in p for n in PYTHON_NODES), name


def _shuffles(p: str) -> int:
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", p))


def test_flagship_plan_shape(spark):
    p = _plan(E.entry(spark))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", p)
    assert len(scans) == 1 and len(scans[0].split(",")) == 4   # events: 4 of 6 columns
    assert _shuffles(p) == 2                                     # aggregate + one for all enrichment windows
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" not in p  # enrichment needs no join


def test_enrichment_windows_share_one_exchange(spark):
    from playstream.operators import enrich, player_credits, player_stats
    from playstream.plans.batch import events_of
    st = player_stats(player_credits(events_of(spark, SF0001)))
    p = _plan(enrich(st))
    windows = p.count("Window [")
    assert windows >= 2 and _shuffles(p) == 2


def test_no_per_game_window_over_events(spark):
    """Event numbering partitions by (game, chunk), never by the game alone."""
    from playstream.operators import number_events
    from playstream.plans.batch import events_of
    p = _plan(number_events(events_of(spark, SF0001)))
    assert "hashpartitioning(game_id" not in p
    assert re.search(r"hashpartitioning\(_key#\d+, _chunk#\d+", p)


@pytest.fixture(scope="module")
def recorded(spark):
    from playstream.plans.batch import events_of, history_snapshots, materialize
    return materialize(history_snapshots(events_of(spark, SF0001), shots=False))


def test_dedupe_and_shares_need_one_exchange(spark, recorded):
    from playstream.operators import by_moment, dedupe_moments, share_of_total
    d = dedupe_moments(by_moment(recorded))
    team = share_of_total(d, "efficiency", ("game_id", "team_code", "seconds_remaining"), "s", exact_scale=2)
    both = share_of_total(team, "pts", ("game_id", "seconds_remaining"), "p", percent=True)
    assert _shuffles(_plan(d)) == _shuffles(_plan(team)) == _shuffles(_plan(both)) == 1


def test_training_and_scoring_exchanges(spark, recorded):
    """One exchange for dedupe and shares; the labels' aggregate and join add theirs."""
    from playstream.operators import training_set
    from playstream.operators.models import score, train_models
    t = training_set(recorded)
    assert _shuffles(_plan(t)) <= 6
    win, mvp = train_models(t)
    assert _shuffles(_plan(score(recorded, win, mvp))) == 1


def test_history_carries_no_arrays(spark):
    """Running totals hold counters only; the shot chart is joined for payloads."""
    p = _plan(QUERIES["history_snapshots"](spark, SF0001))
    assert "collect_list" not in p
