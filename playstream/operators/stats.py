"""Per-player statistics (A1-A3, F8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstream.functions import fg_pct
from playstream.operators.rank import global_rank

PLAYER_KEYS = ("game_id", "player_name", "team_code")
PLAYER_ORDER = ("game_id", "team_code", "player_name")
STAT_COUNTERS = ["pts", "ast", "reb", "stl", "blk", "tov", "pf", "fga", "fgm"]


def latest_by(*cols: str) -> Column:
    """Aggregate: the lexicographically greatest ``struct(cols)`` (A3); nulls sort lowest."""
    return F.max(F.struct(*cols))


def shot_entries(x: str = "shot_x", y: str = "shot_y", r: str = "fgm", order: str = "event_id") -> Column:
    """Per-row shot entry ``{o, x, y, r}`` for rows with a position, else null."""
    return F.when(F.col(x).isNotNull(),
                  F.struct(F.col(order).alias("o"), F.col(x).alias("x"), F.col(y).alias("y"),
                           F.col(r).alias("r")))


def shots_in_order(entries: Column) -> Column:
    """Sort shot entries by event order and drop the order field."""
    return F.transform(F.array_sort(entries), lambda s: F.struct(s["x"].alias("x"), s["y"].alias("y"),
                                                                 s["r"].alias("r")))


def shot_chart(x: str = "shot_x", y: str = "shot_y", r: str = "fgm", order: str = "event_id") -> Column:
    """Aggregate: list of ``{x, y, r}`` for rows with a position, in event order (A2).

    Empty list when there is none.  Entries carry the event order so the
    list is deterministic, then it is dropped.
    """
    return shots_in_order(F.collect_list(shot_entries(x, y, r, order)))


COURT = 100.0   # fixed value: positions run from 0 to 100 along both sides
CELLS = 5       # cells along a side of a shot grid


def shot_cell(x: str = "shot_x", y: str = "shot_y", cells: int = CELLS) -> Column:
    """Number of the court cell of a position, row by row from 0; positions
    outside the court count to the cell at its edge; null without a position."""
    def along(c: str) -> Column:
        return F.least(F.greatest(F.floor(F.col(c) * cells / COURT), F.lit(0)), F.lit(cells - 1))
    return F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), along(y) * cells + along(x)).cast("int")


def shot_grid(x: str = "shot_x", y: str = "shot_y", r: str = "fgm", cells: int = CELLS) -> Column:
    """Aggregate: attempts and makes of every court cell (A2 in a fixed size).

    An array of ``cells * cells`` entries ``{made, tried}``.  Every entry is a
    sum, so partial results add up (:func:`add_grids`) and a stream's state of
    a player has the same size whatever the number of attempts."""
    cell, made = shot_cell(x, y, cells), F.coalesce(F.col(r), F.lit(0))
    return F.array(*[F.struct(F.coalesce(F.sum(F.when(cell == k, made)), F.lit(0)).cast("long").alias("made"), F.count_if(cell == k).alias("tried"))
                     for k in range(cells * cells)])


def add_grids(a: "str | Column", b: "str | Column") -> Column:
    """The grid of two sets of attempts together; a null grid counts as empty."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    both = F.zip_with(a, b, lambda p, q: F.struct((p["made"] + q["made"]).alias("made"), (p["tried"] + q["tried"]).alias("tried")))
    return F.coalesce(both, a, b)


def grid_cells(df: DataFrame, keys: Sequence[str] = PLAYER_KEYS, grid: str = "shot_grid", cells: int = CELLS) -> DataFrame:
    """A grid in long form: one row per cell with attempts, ``(keys, cell_x, cell_y, made, tried)``."""
    return (df.select(*keys, F.posexplode(grid).alias("k", "c")).where(F.col("c.tried") > 0)
            .select(*keys, (F.col("k") % cells).alias("cell_x"), F.floor(F.col("k") / cells).cast("int").alias("cell_y"), "c.made", "c.tried"))


def shot_rows(credits: DataFrame, keys: Sequence[str] = PLAYER_KEYS) -> DataFrame:
    """The shot chart in long format: one row per field-goal attempt
    (keys, event_id, x, y, r).  Nothing is collected, so it scales with any
    player's volume; :func:`shot_chart` builds the nested list for payloads."""
    return (credits.filter(F.col("shot_x").isNotNull())
                   .select(*keys, "event_id", F.col("shot_x").alias("x"), F.col("shot_y").alias("y"),
                           F.col("fgm").alias("r")))


def player_stats(credits: DataFrame, keys: Sequence[str] = PLAYER_KEYS, shots: bool = True,
                 grid: int | None = None) -> DataFrame:
    """Group credit rows by (game, player, team): nine sums, shot chart, latest
    event and field-goal percentage (A1).  Partial + final aggregation, so a
    hot game is pre-combined on the map side before the shuffle.

    The shot chart is a list per player (the payload's shape), as long as the
    player's attempts in the game; for feeds where one player can carry an
    unbounded share of the rows pass ``shots=False`` and use
    :func:`shot_rows`, or ``grid`` (cells along a side) for a chart of fixed
    size in the column ``shot_grid``."""
    aggs = [F.sum(c).alias(c) for c in STAT_COUNTERS]
    if shots:
        aggs.append(shot_chart().alias("shots"))
    if grid:
        aggs.append(shot_grid(cells=grid).alias("shot_grid"))
    aggs.append(latest_by("event_id", "quarter", "clock").alias("latest"))
    return credits.groupBy(*keys).agg(*aggs).withColumn("fg_pct", fg_pct())


def unpack_latest(df: DataFrame, latest: str = "latest") -> DataFrame:
    """Split the latest-event struct into three columns."""
    return df.withColumns({
        "latest_event_id": F.col(f"{latest}.event_id"),
        "latest_quarter": F.col(f"{latest}.quarter"),
        "latest_clock": F.col(f"{latest}.clock"),
    })


def ordered_stats(stats: DataFrame, out: str = "place") -> DataFrame:
    """Statistics sorted by (game, team), players by name, for batch views (O1),
    with each row's place in that order."""
    return global_rank(stats, PLAYER_ORDER, out)
