"""Moments: event numbering, snapshot history, dedupe and shares (ST10, A5, W2, W3, W5).

Running totals are computed in two levels when ``chunk`` is given: inside
chunks of the ordering column (bounded window partitions) plus a prefix over
the per-chunk totals (one row per chunk).  A key that holds a third of the
feed is then spread over many tasks instead of one sorted partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playstream.functions import fg_pct, safe_ratio
from playstream.operators.stats import PLAYER_KEYS, STAT_COUNTERS, latest_by

SNAPSHOT_EVERY = 30          # fixed value: events per trigger of the reference's aggregation stream
DEFAULT_CHUNK = 1 << 16      # ordering values per first-level chunk


def cumulative(df: DataFrame, keys: Sequence[str], order: "str | Sequence[str]",
               sums: Sequence[str] = (), maxes: Sequence[str] = (),
               chunk: int | None = None, next_col: str | None = None,
               totals: dict[str, str] | None = None) -> DataFrame:
    """Running sum / max per ``keys`` in ``order`` (rows up to the current one).

    ``order`` is a column name or a list whose first (numeric) column is the
    one chunked on; the rest break ties.  ``next_col`` receives the next
    value of the first ordering column within the key (null on the last row).
    ``totals`` maps a summed column to an output column holding its total
    over the whole key.

    With ``chunk``: running values inside (key, chunk) partitions, chunk
    totals from a partial aggregate, a prefix over the chunk totals (one row
    per chunk), and a join back on (key, chunk).  The key is packed into one
    struct column -- struct equality is null-safe -- so the join reuses the
    window's partitioning and the rows are shuffled once.
    """
    order = [order] if isinstance(order, str) else list(order)
    keys = list(keys)
    unb, cur = Window.unboundedPreceding, Window.currentRow

    def running(w, wr):
        cols = {c: F.sum(c).over(wr) for c in sums}
        cols.update({c: F.max(c).over(wr) for c in maxes})
        if next_col:
            cols[next_col] = F.lead(order[0]).over(w)
        return cols

    totals = totals or {}
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        whole = Window.partitionBy(*keys)
        return df.withColumns({**{t: F.sum(c).over(whole) for c, t in totals.items()},
                               **running(w, w.rowsBetween(unb, cur))})

    kk, ck = "_key", "_chunk"
    d = df.withColumns({kk: F.struct(*keys), ck: F.floor(F.col(order[0]) / chunk)})
    w = Window.partitionBy(kk, ck).orderBy(*order)
    within = d.withColumns(running(w, w.rowsBetween(unb, cur)))
    tot = d.groupBy(kk, ck).agg(*[F.sum(c).alias(c) for c in sums],
                                *[F.max(c).alias(c) for c in maxes],
                                F.min(order[0]).alias("_first"))
    wp = Window.partitionBy(kk).orderBy(ck)
    wpr = wp.rowsBetween(unb, -1)
    prev = tot.select(kk, ck,
                      *[F.sum(c).over(wpr).alias(f"_p_{c}") for c in sums],
                      *[F.max(c).over(wpr).alias(f"_p_{c}") for c in maxes],
                      *[F.sum(c).over(Window.partitionBy(kk)).alias(t) for c, t in totals.items()],
                      F.lead("_first").over(wp).alias("_p_next"))
    j = within.join(prev, on=[kk, ck], how="left")
    out = {}
    for c in sums:
        p = F.col(f"_p_{c}")
        out[c] = F.when(p.isNull(), F.col(c)).when(F.col(c).isNull(), p).otherwise(p + F.col(c))
    for c in maxes:
        out[c] = F.greatest(F.col(f"_p_{c}"), F.col(c))
    if next_col:
        out[next_col] = F.coalesce(F.col(next_col), F.col("_p_next"))
    helpers = [kk, ck, "_p_next", *[f"_p_{c}" for c in [*sums, *maxes]]]
    return j.withColumns(out).drop(*helpers)


def number_events(events: DataFrame, by: Sequence[str] = ("game_id",), order: str = "event_id",
                  tiebreak: Sequence[str] = (), out: str = "seq", total: str | None = "n_events",
                  chunk: int | None = DEFAULT_CHUNK) -> DataFrame:
    """1-based position of every event within its game, in ``order``; with
    ``total`` also the game's event count (from the same pass)."""
    d = events.withColumn(out, F.lit(1).cast("long"))
    # equal event ids (replays, id-less games) are numbered by their other values
    rest = [f.name for f in events.schema.fields if f.name not in (*by, order, *tiebreak)
            and f.dataType.typeName() not in ("array", "map", "struct")]
    return cumulative(d, by, [order, *tiebreak, *rest], sums=[out], chunk=chunk,
                      totals={out: total} if total else None)


def snapshot_history(credits: DataFrame, every: int = SNAPSHOT_EVERY, seq: str = "seq",
                     keys: Sequence[str] = PLAYER_KEYS, game: str = "game_id", shots: bool = True,
                     chunk: int | None = DEFAULT_CHUNK, total: str = "n_events") -> DataFrame:
    """Cumulative player statistics at every boundary of ``every`` events of a game (ST10).

    ``credits`` carry ``seq``, the event's position among the game's events,
    and ``n_events``, the game's event count (both from
    :func:`number_events`).  Snapshot ``k`` covers events ``1 .. k*every``
    (the last one the rest).  A player appears from the snapshot of their
    first credit on and is carried forward while silent.  Output: the
    columns of :func:`player_stats` plus ``snapshot_id``.

    Plan: credits are pre-aggregated per (player, snapshot) -> running totals
    per player (two-level when ``chunk``) -> each row is expanded over the
    silent snapshots up to the player's next active one (or the game's last).
    No player x snapshot grid join, no per-game sort.
    """
    snap = (F.floor((F.col(seq) - 1) / every) + 1).cast("long")
    c = credits.withColumn("snapshot_id", snap)
    counters = [*STAT_COUNTERS, "_shots"] if shots else STAT_COUNTERS
    aggs = [F.count("shot_x").alias(x) if x == "_shots" else F.sum(x).alias(x) for x in counters]
    aggs.append(latest_by("event_id", "quarter", "clock").alias("latest"))
    has_total = total in credits.columns
    if has_total:
        # the game's last snapshot travels with every credit: no per-game join
        aggs.append(F.max(F.ceil(F.col(total) / every)).alias("_last"))
    per_bucket = c.groupBy(*keys, "snapshot_id").agg(*aggs)
    # ``_last`` rides along as a (constant) running max so that both branches
    # of the two-level scan read the same aggregate and share its shuffle
    run = cumulative(per_bucket, keys, "snapshot_id", sums=counters,
                     maxes=["latest", "_last"] if has_total else ["latest"],
                     chunk=chunk, next_col="_next")
    if not has_total:
        # branch after the per-bucket shuffle, so both branches share it
        last = per_bucket.groupBy(game).agg(F.max("snapshot_id").alias("_last"))
        run = run.join(last, on=game, how="left")
    expand = F.explode(F.sequence(F.col("snapshot_id"), F.coalesce(F.col("_next") - 1, F.col("_last"))))
    hist = run.select(*keys, *counters, "latest", fg_pct().alias("fg_pct"), expand.alias("snapshot_id"))
    return with_shots(hist, c, keys) if shots else hist


def snapshot_shots(credits: DataFrame, every: int = SNAPSHOT_EVERY, seq: str = "seq",
                   keys: Sequence[str] = PLAYER_KEYS) -> DataFrame:
    """The history's shot charts in long form: one row per attempt with the
    first ``snapshot_id`` whose chart holds it.  As many rows as attempts,
    however many snapshots a game has."""
    return (credits.where(F.col("shot_x").isNotNull())
            .select(*keys, (F.floor((F.col(seq) - 1) / every) + 1).cast("long").alias("snapshot_id"), "event_id",
                    F.col("shot_x").alias("x"), F.col("shot_y").alias("y"), F.col("fgm").alias("r")))


def with_shots(hist: DataFrame, credits: DataFrame, keys: Sequence[str] = PLAYER_KEYS) -> DataFrame:
    """``hist`` with each row's chart so far, for payloads.  A player's attempts
    are collected once, by snapshot and event, and every row takes the first
    ``_shots`` of them - its running count of attempts - so no running total
    carries an array and no row looks through the whole list."""
    entry = F.when(F.col("shot_x").isNotNull(), F.struct(F.col("snapshot_id").alias("s"), F.col("event_id").alias("o"), F.col("shot_x").alias("x"),
                                                         F.col("shot_y").alias("y"), F.col("fgm").alias("r")))
    chart = F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.struct(e["x"].alias("x"), e["y"].alias("y"), e["r"].alias("r")))
    charts = credits.groupBy(F.struct(*keys).alias("_key")).agg(chart.alias("_all"))
    shots = F.slice("_all", F.lit(1), F.col("_shots").cast("int"))
    return (hist.withColumn("_key", F.struct(*keys)).join(charts, "_key", "left")
            .select(*[c for c in hist.columns if c not in ("snapshot_id", "_shots")], shots.alias("shots"), "snapshot_id"))


def by_moment(df: DataFrame, keys: Sequence[str] = ("game_id", "seconds_remaining")) -> DataFrame:
    """One exchange that clusters a game's moments: deduplication and the team's
    and the game's shares behind it need no other."""
    return df.repartition(*keys)


def dedupe_moments(df: DataFrame, keys: Sequence[str] = ("game_id", "player_name", "team_code",
                                                         "seconds_remaining"),
                   latest: str | None = "snapshot_id") -> DataFrame:
    """One row per (game, player, team, moment) (A5).

    The survivor is the latest snapshot, ties broken by the team and then the
    greatest scalar values, so the order is total.  ``row_number`` over the key: a partition holds
    the few snapshots that share one moment, never a whole game.
    ``keys`` without ``team_code`` reproduces the reference's key.
    """
    keys = list(keys)
    scalars = [f.name for f in df.schema.fields if f.name not in keys and f.name != latest
               and f.dataType.typeName() not in ("array", "map", "struct")]
    order = [F.col(latest).desc()] if latest and latest in df.columns else []
    # rows of one snapshot (equal names with the team left out, several
    # opponents, messages without an id) tie; the team, then the greatest values, decide
    order += [F.col(c).asc_nulls_last() if c == "team_code" else F.col(c).desc()
              for c in sorted(scalars, key=lambda c: c != "team_code")]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def share_of_total(df: DataFrame, value: str, by: Sequence[str], out: str,
                   scale: int | None = None, percent: bool = False,
                   exact_scale: int | None = None) -> DataFrame:
    """``value / sum(value) over by`` (0.0 when the total is not positive).

    ``scale`` rounds the ratio; ``percent`` multiplies it by 100.
    ``exact_scale`` sums a value that has at most that many decimal places
    as a DECIMAL, so the total is exact and independent of summation order
    (e.g. efficiency, defined with two places).  The window partition is one
    moment of one team or game -- tens of rows.
    """
    v = F.col(value)
    if exact_scale is not None:
        total = F.sum(v.cast(f"decimal(30,{exact_scale})")).over(Window.partitionBy(*by)).cast("double")
    else:
        total = F.sum(v).over(Window.partitionBy(*by))
    r = safe_ratio(v, total, scale)
    return df.withColumn(out, r * 100 if percent else r)
