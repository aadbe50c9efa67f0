"""Registered queries: ``name -> (spark query, oracle SQL or None)``.

Every query reads the driver's tables (the play-by-play view is derived from
``events``; the generic operators also run over the star schema), so its
work grows with the scale factor.  Arrays are exposed as JSON text and
structs are unpacked so results compare value by value with DuckDB.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstream.files import matches
from playstream.functions import display_pct, positive_prob
from playstream.operators import (add_grids, by_moment, cursor_of, decode, dedupe_moments, encode, enrich, fill_numeric,
                                  game_clock, grid_cells, latest_by, new_since, normalize_events,
                                  opponent_scores, ordered_stats, player_credits, player_stats, share_of_total,
                                  snapshot_history, snapshot_shots, team_scores, training_set, unpack_latest)
from playstream.operators.compiled import compile_model
from playstream.operators.models import score, score_win, train_models
from playstream.plans import oracle as O
from playstream.plans.batch import HISTORY_KEYS, materialize, numbered_credits, scored_history
from playstream.plans.fixed import FIXED_MVP, FIXED_WIN
from playstream.schemas import EVENT, GAME_DOC, SNAP, SNAP_FIELDS, SNAP_MESSAGE, SNAP_RECORD
from playstream.session import checkpoint_dir, delete_path
from playstream.sinks import batch_writer
from playstream.sources.games import flatten_actions
from playstream.sources.fixture import hard_raw, pbp_raw
from playstream.streaming import closed_games, run_score_stream, run_stats_stream

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _raw(spark, sf_dir):
    return pbp_raw(_t(spark, sf_dir, "events"))


def _events(spark, sf_dir):
    return normalize_events(_raw(spark, sf_dir))


def _stats(spark, sf_dir):
    return player_stats(player_credits(_events(spark, sf_dir)))


def _history(spark, sf_dir, shots=False, raw=_raw):
    return snapshot_history(numbered_credits(normalize_events(raw(spark, sf_dir))), shots=shots)


def _history_enriched(spark, sf_dir, shots=False, raw=_raw):
    return enrich(_history(spark, sf_dir, shots, raw), by=HISTORY_KEYS)


def _hard(spark, sf_dir):
    """Raw actions with irregular values."""
    return hard_raw(_t(spark, sf_dir, "events"))


def _shots_text(df: DataFrame) -> DataFrame:
    return df.withColumn("shots", F.to_json("shots"))


def _flat_latest(df: DataFrame) -> DataFrame:
    return unpack_latest(df).drop("latest")


# ---------------------------------------------------------------- Spark side

def q_pbp_raw(spark, sf_dir):
    """S1 over the fixture: raw actions of every game."""
    return _raw(spark, sf_dir)


def q_normalize_events(spark, sf_dir):
    """Raw actions -> normalised events."""
    return _events(spark, sf_dir)


def q_player_credits(spark, sf_dir):
    """Actor and assister credit rows."""
    return player_credits(_events(spark, sf_dir))


def q_player_stats(spark, sf_dir):
    """Per-player statistics, shot chart and latest event."""
    return _shots_text(_flat_latest(_stats(spark, sf_dir)))


def q_team_scores(spark, sf_dir):
    """A4: points per (game, team)."""
    return team_scores(_stats(spark, sf_dir))


def q_opponent_scores(spark, sf_dir):
    """Opponent score per (game, team)."""
    return opponent_scores(team_scores(_stats(spark, sf_dir)))


def q_game_clock(spark, sf_dir):
    """Current game quarter and clock from the players' latest events."""
    return game_clock(_stats(spark, sf_dir))


def q_final_snapshots(spark, sf_dir):
    """Final statistics with team, opponent and clock context."""
    return _shots_text(enrich(_stats(spark, sf_dir)))


def q_snapshot_payload(spark, sf_dir):
    """P10/K4: JSON messages keyed by game."""
    return encode(enrich(_stats(spark, sf_dir)))


def q_event_payload(spark, sf_dir):
    """K1/K3/P10: normalised events as JSON messages keyed by game (null fields omitted)."""
    return encode(_events(spark, sf_dir), key="game_id", fields=EVENT.names)


def q_snapshot_history(spark, sf_dir):
    """ST10: cumulative player statistics every 30 events of each game."""
    return _flat_latest(_history(spark, sf_dir))


def q_history_snapshots(spark, sf_dir):
    """ST10 + J4: enriched snapshot rows, one set per snapshot."""
    return _history_enriched(spark, sf_dir)


def q_snapshot_shots(spark, sf_dir):
    """ST10/A2 in long form: every attempt and the first snapshot that holds it."""
    return snapshot_shots(numbered_credits(_events(spark, sf_dir)))


def q_decoded_history(spark, sf_dir):
    """P10 -> P1/P3 -> P13: history encoded as messages, decoded with the
    shot chart kept as raw JSON text, numeric nulls filled."""
    msgs = encode(_history_enriched(spark, sf_dir, shots=True), fields=[*SNAP_FIELDS, "snapshot_id"])
    return fill_numeric(decode(msgs, SNAP_RECORD))


def q_dedupe_moments(spark, sf_dir):
    """A5: one row per (game, player, team, moment); latest snapshot wins."""
    return dedupe_moments(by_moment(_history_enriched(spark, sf_dir)))


def q_training_set(spark, sf_dir):
    """M7 (A5, P13, M1/W4, W5, M2/W6): labelled training rows.

    As in the reference's flow (history recorded to a table, then read by
    the trainer) the history is written once -- a reliable checkpoint -- and
    the training set is built from it: the label aggregate joins back onto
    its input, and re-reading a written table is cheaper than recomputing
    the history on that branch."""
    return training_set(materialize(_history_enriched(spark, sf_dir)))


def q_training_hard(spark, sf_dir):
    """M1/M2/A5/J1 with null teams, third teams and unpadded clocks."""
    return training_set(materialize(_history_enriched(spark, sf_dir, raw=_hard)))


def q_normalize_hard(spark, sf_dir):
    """P5/F1/F4 on missing types, unpadded clocks and coordinates in hundredths."""
    return normalize_events(_hard(spark, sf_dir))


def q_snapshots_hard(spark, sf_dir):
    """J1-J4 with null teams and third teams: one row for each opponent; the
    numbers that may be null are shown as text."""
    out = _shots_text(enrich(player_stats(player_credits(normalize_events(_hard(spark, sf_dir))))))
    return out.withColumns({c: F.col(c).cast("string") for c in ("team_score", "score_diff")})


def q_ordered_stats(spark, sf_dir):
    """O1: statistics in batch-view order, with each row's place in it."""
    return _flat_latest(ordered_stats(player_stats(player_credits(_events(spark, sf_dir)), shots=False)))


def q_flatten_actions(spark, sf_dir):
    """Game documents (one per action here, as JSON text) flattened to raw actions."""
    raw = _raw(spark, sf_dir)
    action = F.struct(*[F.col(c).alias(f) for c, f in {
        "action_number": "actionNumber", "period": "period", "clock_raw": "clock", "team_code": "teamTricode",
        "action_type": "actionType", "player_name": "playerNameI", "shot_result": "shotResult",
        "description": "description", "x": "x", "y": "y"}.items()])
    docs = raw.select(F.to_json(F.struct(F.struct(F.col("game_id").alias("gameId"), F.array(action).alias("actions")).alias("game"))).alias("doc"))
    return flatten_actions(docs.select(F.from_json("doc", GAME_DOC).alias("d")).select("d.*"))


def q_event_round_trip(spark, sf_dir):
    """Events as messages of bytes, decoded again."""
    msgs = encode(_events(spark, sf_dir), fields=EVENT.names).select(F.encode("value", "utf-8").alias("value"))
    return decode(msgs, EVENT)


def q_snapshot_round_trip(spark, sf_dir):
    """Typed snapshots through messages with the reference's field names."""
    msgs = encode(enrich(_stats(spark, sf_dir)), reference_names=True)
    return _shots_text(decode(msgs, SNAP, reference_names=True))


def q_shot_grid(spark, sf_dir):
    """A2 in a fixed size: attempts and makes per player and court cell, the
    quarters' grids added up."""
    cr = player_credits(_events(spark, sf_dir), keep=())
    keys = ("game_id", "player_name", "team_code")
    halves = [player_stats(cr.where(c), shots=False, grid=5).select(F.struct(*keys).alias("k"), F.col("shot_grid").alias(g))
              for c, g in ((F.col("quarter") <= 2, "a"), (F.col("quarter") > 2, "b"))]
    both = halves[0].join(halves[1], "k", "full").select("k.*", add_grids("a", "b").alias("shot_grid"))
    return grid_cells(both)


def q_display_pct(spark, sf_dir):
    """F17 on eighths: percentages as shown in documents."""
    q = F.col("l_quantity").cast("double") / 8
    return (_t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", display_pct(q).alias("pct")))


TRIGGERS = 8   # triggers that a table is streamed in, or more


def _scratch(spark):
    """A folder of this run under the shared checkpoint folder, removed when the driver ends."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/streams/{uuid.uuid4().hex}"
    atexit.register(delete_path, spark, base)
    return base


def _per_trigger(files):
    """Files a trigger that read ``files`` of them in :data:`TRIGGERS` triggers or more."""
    return max(1, files // TRIGGERS)


def _feed(rows, by, path):
    """Write ``rows`` by ranges of ``by``, as many files a trigger as the session
    has cores; files a trigger.  One file a trigger would be read by one task, however large it is."""
    spark = rows.sparkSession
    rows.repartitionByRange(TRIGGERS * spark.sparkContext.defaultParallelism, by).write.parquet(path)
    return _per_trigger(matches(spark, f"{path}/part-*"))


def _run_stats(spark, sf_dir, mode, base):
    """Run the statistics stream over the events table in several triggers, to its end; its messages are in ``base/out``."""
    rows = _t(spark, sf_dir, "events")
    each = _feed(rows, "event_id", f"{base}/in")
    feed = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", each).parquet(f"{base}/in")
    q = run_stats_stream(normalize_events(pbp_raw(feed)), batch_writer("json", f"{base}/out"), mode=mode,
                         table=f"{base}/table" if mode == "update" else None,
                         trigger={"availableNow": True}, checkpoint=f"{base}/checkpoint")
    q.awaitTermination()
    done = len([p for p in q.recentProgress if p["numInputRows"]])
    if done < min(TRIGGERS, rows.count()):
        raise RuntimeError(f"the stream ran in {done} triggers only")


def _stream_stats(spark, sf_dir, mode):
    """The messages that the statistics stream wrote last of every game."""
    base = _scratch(spark)
    _run_stats(spark, sf_dir, mode, base)
    messages = decode(spark.read.schema("key string, value string, batch int").json(f"{base}/out"), SNAP_MESSAGE)
    last = messages.groupBy("game_id").agg(F.max("snapshot_id").alias("snapshot_id"))
    return _shots_text(messages.join(last, ["game_id", "snapshot_id"], "left_semi").drop("snapshot_id"))


def q_stream_complete(spark, sf_dir):
    """S3/ST1-ST3/ST6/ST8: the statistics stream in complete mode, read back."""
    return _stream_stats(spark, sf_dir, "complete")


def q_stream_update(spark, sf_dir):
    """ST6/D6: the statistics stream in update mode, merged and read back."""
    return _stream_stats(spark, sf_dir, "update")


def q_stream_closed(spark, sf_dir):
    """J1-J4/W1 inside the stream: finished games enriched by chained aggregates
    and a stream-stream join, over irregular actions, a game a day, in several triggers."""
    base = _scratch(spark)
    days = 36500   # files may come in any order: no event is late
    at = F.timestamp_seconds((F.col("game_id").cast("long") % 100000) * 86400 + F.col("event_id") * 60)
    ev = materialize(normalize_events(_hard(spark, sf_dir)).withColumn("at", at))
    each = _feed(ev, "at", f"{base}/in")
    for _ in range(2):
        feed = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", each).parquet(f"{base}/in")
        closed_games(feed, "at", delay=f"{days} days", shots=True).writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint") \
            .trigger(availableNow=True).start(f"{base}/out").awaitTermination()
        # a last event moves the watermark past all days
        end = ev.agg(F.max("at").alias("at")).select(F.lit("end").alias("game_id"), F.lit("end").alias("player_name"), (F.col("at") + F.make_dt_interval(F.lit(days + 2))).alias("at"))
        ev.limit(0).unionByName(end, allowMissingColumns=True).coalesce(1).write.mode("append").parquet(f"{base}/in")
    out = _shots_text(spark.read.parquet(f"{base}/out"))
    return out.withColumns({c: F.col(c).cast("string") for c in ("team_score", "score_diff")})


def q_two_hop_scores(spark, sf_dir):
    """ST7/ST8: events -> statistics stream -> messages -> scoring stream ->
    documents, both in several triggers; every game's last documents without the stamp."""
    base = _scratch(spark)
    _run_stats(spark, sf_dir, "update", base)
    # a game's messages of a batch are in one file
    each = _per_trigger(matches(spark, f"{base}/out/batch=*/part-*"))
    messages = spark.readStream.schema("key string, value string").option("maxFilesPerTrigger", each).json(f"{base}/out/batch=*")
    q = run_score_stream(messages, FIXED_WIN, FIXED_MVP, batch_writer("parquet", f"{base}/scored"),
                         trigger={"availableNow": True}, checkpoint=f"{base}/checkpoint2")
    q.awaitTermination()
    scored = spark.read.parquet(f"{base}/scored")
    # a trigger may hold several snapshots of a game: the last batch's least time left is the last of them
    last = (scored.groupBy("game_id").agg(F.min(F.struct((-F.col("batch")).alias("b"), "seconds_remaining")).alias("m"))
            .select("game_id", (-F.col("m.b")).cast("int").alias("batch"), "m.seconds_remaining"))
    return _shots_text(scored.join(last, ["game_id", "batch", "seconds_remaining"], "left_semi").drop("batch", "@timestamp"))


def q_scored_fixed(spark, sf_dir):
    """M8-M10/F15/F17/P11 by value: the history scored by models of given
    parameters, compiled to expressions (21 columns without the stamp)."""
    return _shots_text(score(_history_enriched(spark, sf_dir, shots=True), FIXED_WIN, FIXED_MVP).drop("@timestamp"))


def q_compiled_scores(spark, sf_dir):
    """M3-M6/M8/M9: both models fitted on the history; per moment, whether their
    compiled form gives every row the fitted pipelines' probabilities."""
    hist = materialize(_history_enriched(spark, sf_dir))
    train = materialize(training_set(hist))
    win, mvp = train_models(train)
    rows = score_win(train, win, "w0")
    rows = compile_model(win).transform(rows, "w1")
    rows = mvp.transform(rows).withColumn("m0", positive_prob("probability")).drop("rawPrediction", "probability", "prediction", "features_mvp")
    rows = compile_model(mvp).transform(rows, "m1")
    near = lambda a, b: F.expr(f"bool_and(coalesce(abs({a} - {b}) <= 1e-9, false))")
    return rows.groupBy("game_id", "seconds_remaining").agg(F.count("*").alias("n_rows"), near("w0", "w1").alias("win_equal"), near("m0", "m1").alias("mvp_equal"))


def q_score_checks(spark, sf_dir):
    """M3-M10/F15 checked by value: per moment of a game, rows, the MVP shares'
    total, and whether each team has one win percentage inside 0-100."""
    s = scored_history(_events(spark, sf_dir))
    teams = s.groupBy("game_id", "seconds_remaining", "team_code").agg(
        F.count("*").alias("n"), F.sum("mvp_pct").alias("mvp"), F.min("mvp_pct").alias("m0"), F.max("mvp_pct").alias("m1"),
        F.min("win_pct").alias("w0"), F.max("win_pct").alias("w1"))
    return teams.groupBy("game_id", "seconds_remaining").agg(
        F.sum("n").alias("n_rows"),
        # shares are shown with two places, so a total may be off by half a hundredth a row
        F.expr("abs(sum(mvp) - 100) <= 0.005 * sum(n) + 1e-6 OR sum(mvp) = 0").alias("mvp_total_ok"),
        F.expr("bool_and(m0 >= 0 AND m1 <= 100)").alias("mvp_in_range"),
        F.expr("bool_and(w0 = w1 AND w0 >= 0 AND w1 <= 100)").alias("win_ok"))


def q_team_efficiency_share(spark, sf_dir):
    """Efficiency share of the team at each moment."""
    d = dedupe_moments(by_moment(_history_enriched(spark, sf_dir)))
    return share_of_total(d, "efficiency", ("game_id", "team_code", "seconds_remaining"),
                                      "efficiency_share", exact_scale=2)


def q_team_efficiency_share_rounded(spark, sf_dir):
    """The training copy of the share, rounded to 4 places."""
    d = dedupe_moments(by_moment(_history_enriched(spark, sf_dir)))
    return share_of_total(d, "efficiency", ("game_id", "team_code", "seconds_remaining"),
                                      "efficiency_share", scale=4, exact_scale=2)


def q_game_points_share(spark, sf_dir):
    """A player's share of the game's points at each moment, x100."""
    d = dedupe_moments(by_moment(_history_enriched(spark, sf_dir)))
    return share_of_total(d, "pts", ("game_id", "seconds_remaining"), "pts_pct", percent=True)


def q_new_since(spark, sf_dir):
    """Actions after each game's cursor (the cursor = last action of the first half)."""
    raw = _raw(spark, sf_dir)
    return new_since(raw, cursor_of(raw.filter(F.col("period") <= 2)))


def q_scored_history(spark, sf_dir):
    """Fit both models on the history's training set and
    score every snapshot (21 columns; processing-time stamp -> rows-only check)."""
    return scored_history(_events(spark, sf_dir))


def q_nation_revenue_share(spark, sf_dir):
    """Generic W2/W3 over the star schema: revenue share of each nation in its region."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    rev = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey)
             .groupBy("c_nationkey")
             .agg(F.sum((F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(4,2)")))
                        .cast("decimal(24,4)")).cast("double").alias("revenue")))
    rev = rev.join(n, rev.c_nationkey == n.n_nationkey).select("n_regionkey", "n_name", "revenue")
    return share_of_total(rev, "revenue", ["n_regionkey"], "revenue_pct", scale=6, percent=True) \
        .withColumn("revenue", F.round("revenue", 2))


def q_latest_order_per_customer(spark, sf_dir):
    """Generic A3 over the star schema: each customer's latest order."""
    o = _t(spark, sf_dir, "orders")
    return (o.groupBy("o_custkey")
             .agg(latest_by("o_orderdate", "o_orderkey", "o_totalprice").alias("latest"),
                  F.count("*").alias("n_orders"))
             .select("o_custkey", "n_orders", F.col("latest.o_orderdate").alias("latest_orderdate"),
                     F.col("latest.o_orderkey").alias("latest_orderkey"),
                     F.col("latest.o_totalprice").alias("latest_totalprice")))


def q_customer_running_spend(spark, sf_dir):
    """Generic two-level running total (the ST10 machinery) over the star schema:
    every customer's cumulative spend and order count in order-date order,
    chunked by year so a customer with a huge history spreads over tasks."""
    from playstream.operators import cumulative
    o = (_t(spark, sf_dir, "orders")
         .select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice",
                 F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("_t"),
                 F.col("o_totalprice").cast("decimal(18,2)").alias("running_spend"),
                 F.lit(1).cast("long").alias("order_seq")))
    run = cumulative(o, ["o_custkey"], ["_t", "o_orderkey"], sums=["running_spend", "order_seq"],
                     chunk=365 * 86400)
    return run.withColumn("running_spend", F.col("running_spend").cast("double")).drop("_t")


# ---------------------------------------------------------------- oracle side

_HEN = O.enrich_sql("hs", ["game_id", "snapshot_id"], "hen")
_FULL_HISTORY = [*O.HISTORY, _HEN]
_SNAP = O.SNAP_COLS
_SNAP_TEXT = O.SNAP_COLS + ", CAST(to_json(shots) AS VARCHAR) AS shots"

# snapshots as the typed messages hold them
_TYPED = "SELECT " + ", ".join(
    f"CAST({c} AS INTEGER) AS {c}" if c in ("team_score", "score_diff", "seconds_remaining", "game_quarter", "pts", "ast", "reb", "stl", "blk", "tov", "pf")
    else c for c in O.SNAP_COLS.split(", ")) + ", CAST(to_json(shots) AS VARCHAR) AS shots FROM en"

ORACLE = {
    "pbp_raw": O.with_ctes(O.PBP_RAW, select="SELECT * FROM pbp_raw"),
    "normalize_events": O.with_ctes(*O.BASE, select="SELECT * FROM ev"),
    "player_credits": O.with_ctes(*O.BASE, O.credits_sql(), select="SELECT * FROM cr"),
    "player_stats": O.with_ctes(*O.STATS, select="SELECT * EXCLUDE (shots), CAST(to_json(shots) AS VARCHAR) AS shots FROM st"),
    "team_scores": O.with_ctes(*O.STATS, select="SELECT game_id, team_code, CAST(sum(pts) AS BIGINT) AS team_score FROM st GROUP BY game_id, team_code"),
    "opponent_scores": O.with_ctes(*O.STATS, O.enrich_sql("st", ["game_id"]), select="SELECT * FROM en_opp"),
    "game_clock": O.with_ctes(*O.STATS, O.enrich_sql("st", ["game_id"]), select="SELECT * FROM en_clk"),
    "final_snapshots": O.with_ctes(*O.STATS, O.enrich_sql("st", ["game_id"]),
                                   select=f"SELECT {_SNAP_TEXT} FROM en"),
    "snapshot_payload": O.with_ctes(*O.STATS, O.enrich_sql("st", ["game_id"]), select=(
        "SELECT game_id AS key, CAST(to_json({'game_id': game_id, 'team_code': team_code, "
        "'team_score': team_score, 'score_diff': score_diff, 'seconds_remaining': seconds_remaining, "
        "'game_quarter': game_quarter, 'game_clock': game_clock, 'player_name': player_name, "
        "'pts': pts, 'ast': ast, 'reb': reb, 'stl': stl, 'blk': blk, 'tov': tov, 'pf': pf, "
        "'fg_pct': fg_pct, 'efficiency': efficiency, 'shots': shots}) AS VARCHAR) AS value FROM en")),
    "event_payload": O.with_ctes(*O.BASE, select=(
        "SELECT game_id AS key, replace(regexp_replace(CAST(to_json({'game_id': game_id, 'event_id': event_id, "
        "'quarter': quarter, 'team_code': team_code, 'player_name': player_name, 'event_type': event_type, "
        "'shot_result': shot_result, 'shot_value': shot_value, 'assist_player': assist_player, 'clock': clock, "
        "'x': x, 'y': y}) AS VARCHAR), '\"[a-z_]+\":null,?', '', 'g'), ',}', '}') AS value FROM ev")),
    "snapshot_history": O.with_ctes(*O.HISTORY, select="SELECT * EXCLUDE (shots) FROM hs"),
    "history_snapshots": O.with_ctes(*_FULL_HISTORY, select=f"SELECT {_SNAP}, snapshot_id FROM hen"),
    "snapshot_shots": O.with_ctes(*O.BASE, O.EVN, O.credits_sql("evn", "crs", "seq"), select=(
        "SELECT game_id, player_name, team_code, CAST((seq - 1) // 30 + 1 AS BIGINT) AS snapshot_id, event_id, "
        "shot_x AS x, shot_y AS y, fgm AS r FROM crs WHERE shot_x IS NOT NULL")),
    "decoded_history": O.with_ctes(*_FULL_HISTORY, select=(
        "SELECT game_id, team_code, " + ", ".join(
            f"CAST(coalesce({c}, 0) AS INTEGER) AS {c}" for c in
            ["team_score", "score_diff", "seconds_remaining", "game_quarter"]) +
        ", game_clock, player_name, " + ", ".join(
            f"CAST(coalesce({c}, 0) AS INTEGER) AS {c}" for c in ["pts", "ast", "reb", "stl", "blk", "tov", "pf"]) +
        ", coalesce(fg_pct, 0) AS fg_pct, coalesce(efficiency, 0) AS efficiency, "
        "CAST(to_json(shots) AS VARCHAR) AS shots, coalesce(snapshot_id, 0) AS snapshot_id FROM hen")),
    "dedupe_moments": O.with_ctes(*_FULL_HISTORY, O.DEDUP,
                                  select=f"SELECT {_SNAP}, snapshot_id FROM dd"),
    "training_set": O.with_ctes(*_FULL_HISTORY, O.DEDUP, O.TRAIN, select=(
        f"SELECT {_SNAP}, snapshot_id, final_diff, label_win, efficiency_norm, max_game_eff, label_mvp FROM tr")),
    "team_efficiency_share": O.with_ctes(*_FULL_HISTORY, O.DEDUP, select=(
        f"SELECT {_SNAP}, snapshot_id, CASE WHEN CAST(sum(CAST(efficiency AS DECIMAL(30,2))) OVER w AS DOUBLE) > 0 THEN efficiency / CAST(sum(CAST(efficiency AS DECIMAL(30,2))) OVER w AS DOUBLE) "
        "ELSE CAST(0.0 AS DOUBLE) END AS efficiency_share FROM dd "
        "WINDOW w AS (PARTITION BY game_id, team_code, seconds_remaining)")),
    "team_efficiency_share_rounded": O.with_ctes(*_FULL_HISTORY, O.DEDUP, select=(
        f"SELECT {_SNAP}, snapshot_id, CASE WHEN CAST(sum(CAST(efficiency AS DECIMAL(30,2))) OVER w AS DOUBLE) > 0 THEN round(efficiency / CAST(sum(CAST(efficiency AS DECIMAL(30,2))) OVER w AS DOUBLE), 4) "
        "ELSE CAST(0.0 AS DOUBLE) END AS efficiency_share FROM dd "
        "WINDOW w AS (PARTITION BY game_id, team_code, seconds_remaining)")),
    "game_points_share": O.with_ctes(*_FULL_HISTORY, O.DEDUP, select=(
        f"SELECT {_SNAP}, snapshot_id, CASE WHEN sum(pts) OVER w > 0 THEN pts / sum(pts) OVER w * 100 "
        "ELSE CAST(0.0 AS DOUBLE) END AS pts_pct FROM dd WINDOW w AS (PARTITION BY game_id, seconds_remaining)")),
    "training_hard": O.with_ctes(*O.hard(_FULL_HISTORY), O.DEDUP.replace("dd AS (", "dd0 AS (", 1), (
        "dd AS (SELECT * REPLACE (coalesce(team_score, 0) AS team_score, coalesce(score_diff, 0) AS score_diff, "
        "coalesce(seconds_remaining, 0) AS seconds_remaining) FROM dd0)"), O.TRAIN, select=(
        f"SELECT {_SNAP}, snapshot_id, final_diff, label_win, efficiency_norm, max_game_eff, label_mvp FROM tr")),
    "normalize_hard": O.with_ctes(*O.hard(O.BASE), select="SELECT * FROM ev"),
    "snapshots_hard": O.with_ctes(*O.hard(O.STATS), O.enrich_sql("st", ["game_id"]), select=(
        f"SELECT * REPLACE (CAST(team_score AS VARCHAR) AS team_score, CAST(score_diff AS VARCHAR) AS score_diff) "
        f"FROM (SELECT {_SNAP_TEXT} FROM en)")),
    "ordered_stats": O.with_ctes(*O.STATS, select=(
        "SELECT * EXCLUDE (shots), row_number() OVER (ORDER BY game_id NULLS FIRST, team_code NULLS FIRST, player_name NULLS FIRST) AS place FROM st")),
    "flatten_actions": O.with_ctes(O.PBP_RAW, select="SELECT * FROM pbp_raw"),
    "event_round_trip": O.with_ctes(*O.BASE, select="SELECT * FROM ev"),
    "snapshot_round_trip": O.with_ctes(*O.STATS, O.enrich_sql("st", ["game_id"]), select=_TYPED),
    "stream_complete": O.with_ctes(*O.STATS, O.enrich_sql("st", ["game_id"]), select=_TYPED),
    "stream_update": O.with_ctes(*O.STATS, O.enrich_sql("st", ["game_id"]), select=_TYPED),
    "two_hop_scores": O.with_ctes(*O.STATS, O.enrich_sql("st", ["game_id"]), f"ty AS ({_TYPED.replace(', CAST(to_json(shots) AS VARCHAR) AS shots', ', shots')})",
                                  *O.scored_sql("ty", fill=True), select=f"SELECT {_SNAP_TEXT}, win_pct, mvp_pct FROM sc"),
    "scored_fixed": O.with_ctes(*_FULL_HISTORY, O.DEDUP, *O.scored_sql("dd"), select=f"SELECT {_SNAP_TEXT}, win_pct, mvp_pct FROM sc"),
    "compiled_scores": O.with_ctes(*_FULL_HISTORY, O.DEDUP, select=(
        "SELECT game_id, seconds_remaining, count(*) AS n_rows, true AS win_equal, true AS mvp_equal FROM dd GROUP BY game_id, seconds_remaining")),
    "stream_closed": O.with_ctes(*O.hard(O.STATS), O.enrich_sql("st", ["game_id"]), select=(
        f"SELECT * REPLACE (CAST(team_score AS VARCHAR) AS team_score, CAST(score_diff AS VARCHAR) AS score_diff) "
        f"FROM (SELECT {_SNAP_TEXT} FROM en)")),
    "shot_grid": O.with_ctes(*O.BASE, O.credits_sql(), select=(
        "SELECT game_id, player_name, team_code, CAST(least(floor(shot_x / 20), 4) AS INTEGER) AS cell_x, CAST(least(floor(shot_y / 20), 4) AS INTEGER) AS cell_y, "
        "CAST(sum(fgm) AS BIGINT) AS made, count(*) AS tried FROM cr WHERE shot_x IS NOT NULL GROUP BY ALL")),
    "display_pct": "SELECT l_orderkey, l_linenumber, CAST(printf('%.2f', CAST(l_quantity AS DOUBLE) / 8) AS FLOAT) AS pct FROM lineitem",
    "score_checks": O.with_ctes(*_FULL_HISTORY, O.DEDUP, select=(
        "SELECT game_id, seconds_remaining, CAST(count(*) AS BIGINT) AS n_rows, true AS mvp_total_ok, true AS mvp_in_range, "
        "true AS win_ok FROM dd GROUP BY game_id, seconds_remaining")),
    "new_since": O.with_ctes(O.PBP_RAW, select=(
        "SELECT r.* FROM pbp_raw r LEFT JOIN (SELECT game_id, max(action_number) AS cur FROM pbp_raw "
        "WHERE period <= 2 GROUP BY game_id) c ON r.game_id = c.game_id "
        "WHERE c.cur IS NULL OR r.action_number > c.cur")),
    "nation_revenue_share": (
        "WITH rev AS (SELECT c.c_nationkey, CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue "
        "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey "
        "GROUP BY c.c_nationkey), r2 AS (SELECT n.n_regionkey, n.n_name, r.revenue FROM rev r "
        "JOIN nation n ON r.c_nationkey = n.n_nationkey) "
        "SELECT n_regionkey, n_name, round(revenue, 2) AS revenue, CASE WHEN sum(revenue) OVER w > 0 "
        "THEN round(revenue / sum(revenue) OVER w, 6) * 100 ELSE CAST(0.0 AS DOUBLE) END AS revenue_pct "
        "FROM r2 WINDOW w AS (PARTITION BY n_regionkey)"),
    "customer_running_spend": (
        "SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, "
        "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) AS running_spend, "
        "count(*) OVER w AS order_seq FROM orders "
        "WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)"),
    "latest_order_per_customer": (
        "SELECT o_custkey, count(*) AS n_orders, max({'d': o_orderdate, 'k': o_orderkey, 'p': o_totalprice}).d AS latest_orderdate, "
        "max({'d': o_orderdate, 'k': o_orderkey, 'p': o_totalprice}).k AS latest_orderkey, "
        "max({'d': o_orderdate, 'k': o_orderkey, 'p': o_totalprice}).p AS latest_totalprice "
        "FROM orders GROUP BY o_custkey"),
}

QUERIES: dict[str, Query] = {
    "pbp_raw": q_pbp_raw,
    "normalize_events": q_normalize_events,
    "player_credits": q_player_credits,
    "player_stats": q_player_stats,
    "team_scores": q_team_scores,
    "opponent_scores": q_opponent_scores,
    "game_clock": q_game_clock,
    "final_snapshots": q_final_snapshots,
    "snapshot_payload": q_snapshot_payload,
    "event_payload": q_event_payload,
    "snapshot_history": q_snapshot_history,
    "history_snapshots": q_history_snapshots,
    "decoded_history": q_decoded_history,
    "dedupe_moments": q_dedupe_moments,
    "training_set": q_training_set,
    "team_efficiency_share": q_team_efficiency_share,
    "team_efficiency_share_rounded": q_team_efficiency_share_rounded,
    "game_points_share": q_game_points_share,
    "new_since": q_new_since,
    "scored_history": q_scored_history,
    "snapshot_shots": q_snapshot_shots,
    "training_hard": q_training_hard,
    "normalize_hard": q_normalize_hard,
    "snapshots_hard": q_snapshots_hard,
    "ordered_stats": q_ordered_stats,
    "flatten_actions": q_flatten_actions,
    "event_round_trip": q_event_round_trip,
    "snapshot_round_trip": q_snapshot_round_trip,
    "shot_grid": q_shot_grid,
    "display_pct": q_display_pct,
    "stream_complete": q_stream_complete,
    "stream_update": q_stream_update,
    "stream_closed": q_stream_closed,
    "two_hop_scores": q_two_hop_scores,
    "scored_fixed": q_scored_fixed,
    "compiled_scores": q_compiled_scores,
    "score_checks": q_score_checks,
    "nation_revenue_share": q_nation_revenue_share,
    "latest_order_per_customer": q_latest_order_per_customer,
    "customer_running_spend": q_customer_running_spend,
}
