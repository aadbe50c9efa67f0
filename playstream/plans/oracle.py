"""DuckDB oracle SQL for the registered queries.

Written from the operator definitions (not generated from the engine): the
reference formulation with joins, row_number and brute-force replays, so a
mismatch points at the Spark plan.  Conventions: integer sums cast to
BIGINT, explicit NULLS FIRST/LAST, ``printf`` for rounding by the exact binary value, arrays
compared as JSON text.
"""

from __future__ import annotations

# The play-by-play fixture view over ``events`` (FIXTURES.md section 2).
PBP_RAW = """pbp_raw AS (
WITH a AS (SELECT event_id AS e, user_id AS u, event_type AS et, value AS v,
    CAST(floor(event_id/500) AS INT) AS g, CAST(event_id % 500 AS INT) AS pos FROM events),
b AS (SELECT *, CAST(floor(pos/120) AS INT)+1 AS q, pos % 120 AS k FROM a),
c AS (SELECT *, CASE WHEN q<=4 THEN 720-6*k ELSE 300-15*k END AS sec,
   CASE et WHEN 'click' THEN '2pt' WHEN 'view' THEN '3pt' WHEN 'purchase' THEN 'freethrow' WHEN 'signup' THEN 'rebound'
     ELSE CASE e % 5 WHEN 0 THEN 'turnover' WHEN 1 THEN 'foul' WHEN 2 THEN 'steal' WHEN 3 THEN 'block' ELSE 'violation' END END AS act FROM b),
d AS (SELECT *, CASE WHEN act IN ('2pt','3pt','freethrow') THEN CASE WHEN CAST(floor(v) AS INT) % 2 = 0 THEN 'Made' ELSE 'Missed' END END AS res FROM c)
SELECT lpad(CAST(22500349+g AS STRING),10,'0') AS game_id, pos+1 AS action_number, q AS period,
  'PT' || lpad(CAST(CAST(floor(sec/60) AS INT) AS STRING),2,'0') || 'M' || lpad(CAST(sec % 60 AS STRING),2,'0') || '.00S' AS clock_raw,
  'T' || lpad(CAST(2*g + u % 2 AS STRING),4,'0') AS team_code,
  CASE WHEN e % 50 = 49 THEN NULL WHEN e % 50 = 24 THEN '' ELSE 'P. Num' || lpad(CAST(u % 20 AS STRING),2,'0') END AS player_name,
  act AS action_type, res AS shot_result,
  CASE WHEN res='Made' AND act<>'freethrow' AND e % 3 = 0 THEN 'Layup (' || substr(act,1,1) || ' PTS) (P. Num' || lpad(CAST((u+2) % 20 AS STRING),2,'0') || ' 4 AST)'
       WHEN res='Made' THEN 'Jumper (2 PTS)' ELSE 'MISS' END AS description,
  CASE WHEN res IS NOT NULL THEN (e % 800)/8.0E0 END AS x, CASE WHEN res IS NOT NULL THEN CAST(floor(v) AS INT) % 100 + 0.5E0 END AS y
FROM d)"""

# The irregular view of the same actions (sources/fixture.py).
PBP_HARD = PBP_RAW.replace("pbp_raw AS (", "pbp_easy AS (", 1) + """,
pbp_num AS (SELECT *, (CAST(game_id AS INT) - 22500349) * 500 + action_number - 1 AS e FROM pbp_easy),
pbp_raw AS (SELECT game_id, action_number, period,
  regexp_replace(regexp_replace(clock_raw, 'PT0', 'PT'), 'M0', 'M') AS clock_raw,
  CASE WHEN e % 41 = 0 THEN NULL WHEN e % 43 = 0 THEN 'T3RD' ELSE team_code END AS team_code, player_name,
  CASE WHEN e % 37 = 0 THEN NULL ELSE action_type END AS action_type, shot_result, description,
  CASE WHEN x IS NOT NULL THEN (e % 10000) / 100.0E0 END AS x,
  CASE WHEN y IS NOT NULL THEN (e * 7 % 10000) / 100.0E0 END AS y FROM pbp_num)"""


def hard(ctes: list[str]) -> list[str]:
    """The same queries over the irregular view."""
    return [PBP_HARD if c is PBP_RAW else c for c in ctes]


# Normalised events (P4, F1-F4, L1).  The assist pattern is a fixed value of the feed.
EV = r"""ev AS (
SELECT game_id, CAST(action_number AS INTEGER) AS event_id, CAST(period AS INTEGER) AS quarter,
  team_code, player_name, coalesce(action_type, 'Unknown') AS event_type, shot_result,
  CASE WHEN contains(lower(coalesce(action_type, 'Unknown')), '3pt') THEN 3
       WHEN contains(lower(coalesce(action_type, 'Unknown')), '2pt') THEN 2
       WHEN contains(lower(coalesce(action_type, 'Unknown')), 'freethrow') THEN 1 ELSE 0 END AS shot_value,
  CASE WHEN shot_result = 'Made'
       THEN nullif(trim(regexp_extract(description, '\(([^)]+)\s+\d+\s+AST\)', 1)), '') END AS assist_player,
  CASE WHEN clock_raw IS NULL OR clock_raw = '' THEN '00:00'
       ELSE split_part(replace(replace(replace(clock_raw, 'PT', ''), 'M', ':'), 'S', ''), '.', 1) END AS clock,
  CAST(printf('%.1f', x) AS DOUBLE) AS x, CAST(printf('%.1f', y) AS DOUBLE) AS y
FROM pbp_raw WHERE player_name IS NOT NULL AND player_name <> '')"""

# Events numbered within their game (kept events only).
EVN = """evn AS (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY event_id) AS seq FROM ev)"""


def credits_sql(src: str = "ev", name: str = "cr", extra: str = "") -> str:
    """Actor rows UNION ALL assister rows."""
    fg = "shot_result IN ('Made','Missed') AND event_type <> 'freethrow'"
    e = f", {extra}" if extra else ""
    return f"""{name} AS (
SELECT game_id, team_code, player_name, event_id, quarter, clock,
  CASE WHEN {fg} THEN x END AS shot_x, CASE WHEN {fg} THEN y END AS shot_y,
  CASE WHEN shot_result = 'Made' THEN shot_value ELSE 0 END AS pts,
  CASE WHEN event_type = 'rebound' THEN 1 ELSE 0 END AS reb,
  CASE WHEN event_type = 'steal' THEN 1 ELSE 0 END AS stl,
  CASE WHEN event_type = 'block' THEN 1 ELSE 0 END AS blk,
  CASE WHEN event_type = 'turnover' THEN 1 ELSE 0 END AS tov,
  CASE WHEN event_type = 'foul' THEN 1 ELSE 0 END AS pf,
  CASE WHEN {fg} THEN 1 ELSE 0 END AS fga,
  CASE WHEN shot_result = 'Made' AND event_type <> 'freethrow' THEN 1 ELSE 0 END AS fgm,
  0 AS ast{e}
FROM {src} WHERE player_name IS NOT NULL
UNION ALL
SELECT game_id, team_code, assist_player, event_id, quarter, clock, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
  0, 0, 0, 0, 0, 0, 0, 0, 1{e}
FROM {src} WHERE player_name IS NOT NULL AND assist_player IS NOT NULL)"""


SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in
                 ["pts", "ast", "reb", "stl", "blk", "tov", "pf", "fga", "fgm"])
SHOTS = ("coalesce(list({'x': shot_x, 'y': shot_y, 'r': fgm} ORDER BY event_id) "
         "FILTER (WHERE shot_x IS NOT NULL), [])")
LATEST = "max({'event_id': event_id, 'quarter': quarter, 'clock': clock})"
FG_PCT = "CASE WHEN fga > 0 THEN round(fgm / fga * 100, 1) ELSE CAST(0.0 AS DOUBLE) END"

# Final player statistics (A1-A3, F8), latest unpacked.
ST = f"""st0 AS (
SELECT game_id, player_name, team_code, {SUMS}, {SHOTS} AS shots, {LATEST} AS latest
FROM cr GROUP BY game_id, player_name, team_code),
st AS (SELECT * EXCLUDE (latest), {FG_PCT} AS fg_pct, latest.event_id AS latest_event_id,
  latest.quarter AS latest_quarter, latest.clock AS latest_clock FROM st0)"""

# Snapshot history by brute-force replay (ST10): every player who has credits
# up to snapshot k, summed over all their credits up to k.
HIST = f"""crn AS (SELECT *, CAST((seq - 1) // 30 + 1 AS BIGINT) AS snap FROM crs),
lastg AS (SELECT game_id, max(snap) AS last_snap FROM crn GROUP BY game_id),
firstp AS (SELECT game_id, player_name, team_code, min(snap) AS first_snap FROM crn
           GROUP BY game_id, player_name, team_code),
grid AS (SELECT f.game_id, f.player_name, f.team_code,
           unnest(generate_series(f.first_snap, l.last_snap)) AS snapshot_id
         FROM firstp f JOIN lastg l ON f.game_id = l.game_id),
h0 AS (SELECT g.game_id, g.player_name, g.team_code, g.snapshot_id, {SUMS.replace('sum(', 'sum(c.')},
  coalesce(list({{'x': c.shot_x, 'y': c.shot_y, 'r': c.fgm}} ORDER BY c.event_id) FILTER (WHERE c.shot_x IS NOT NULL), []) AS shots,
  max({{'event_id': c.event_id, 'quarter': c.quarter, 'clock': c.clock}}) AS latest
  FROM grid g JOIN crn c ON c.game_id = g.game_id AND c.player_name = g.player_name
    AND c.team_code IS NOT DISTINCT FROM g.team_code AND c.snap <= g.snapshot_id
  GROUP BY g.game_id, g.player_name, g.team_code, g.snapshot_id),
hs AS (SELECT * EXCLUDE (latest), {FG_PCT} AS fg_pct, latest.event_id AS latest_event_id,
  latest.quarter AS latest_quarter, latest.clock AS latest_clock FROM h0)"""


def enrich_sql(src: str, by: list[str], name: str = "en") -> str:
    """J1-J4 as the reference writes them: team sums, opponent self-join,
    row_number clock, two left joins, metrics."""
    bys = ", ".join(by)
    on_a_b = " AND ".join(f"a.{k} = b.{k}" for k in by)
    on_s_o = " AND ".join(f"s.{k} = o.{k}" for k in by)
    on_s_c = " AND ".join(f"s.{k} = c.{k}" for k in by)
    extra = "".join(f", s.{k}" for k in by if k != "game_id")
    secs = ("(try_cast(split_part({c}, ':', 1) AS INTEGER) * 60 + "
            "try_cast(split_part({c}, ':', 2) AS INTEGER))")
    return f"""{name}_ts AS (SELECT {bys}, team_code, CAST(sum(pts) AS BIGINT) AS team_score FROM {src}
  GROUP BY {bys}, team_code),
{name}_opp AS (SELECT a.*, b.team_score AS opp_score FROM {name}_ts a LEFT JOIN {name}_ts b
  ON {on_a_b} AND a.team_code <> b.team_code),
{name}_clk AS (SELECT {bys}, game_quarter, game_clock FROM (
  SELECT {bys}, latest_quarter AS game_quarter, latest_clock AS game_clock,
    row_number() OVER (PARTITION BY {bys} ORDER BY latest_quarter DESC NULLS LAST,
      {secs.format(c='latest_clock')} ASC NULLS LAST, latest_clock ASC NULLS LAST) AS i
  FROM {src}) WHERE i = 1),
{name} AS (SELECT s.game_id, s.team_code, o.team_score, CAST(o.team_score - o.opp_score AS BIGINT) AS score_diff,
  CAST((4 - c.game_quarter) * 720 + {secs.format(c='c.game_clock')} AS INTEGER) AS seconds_remaining,
  c.game_quarter, c.game_clock, s.player_name, s.pts, s.ast, s.reb, s.stl, s.blk, s.tov, s.pf, s.fg_pct,
  round(s.pts + s.reb + s.ast + s.stl + s.blk - s.tov - s.pf + s.fg_pct / 5, 2) AS efficiency,
  s.shots{extra}
FROM {src} s LEFT JOIN {name}_opp o ON {on_s_o} AND s.team_code = o.team_code
LEFT JOIN {name}_clk c ON {on_s_c})"""


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


BASE = [PBP_RAW, EV]
STATS = [*BASE, credits_sql(), ST]
HISTORY = [*BASE, EVN, credits_sql("evn", "crs", "seq"), HIST]

SNAP_COLS = ("game_id, team_code, team_score, score_diff, seconds_remaining, game_quarter, game_clock, "
             "player_name, pts, ast, reb, stl, blk, tov, pf, fg_pct, efficiency")

# Deduplicated history: the latest snapshot of every (game, player, team, moment).
DEDUP = """dd AS (SELECT * EXCLUDE (i) FROM (SELECT *, row_number() OVER (
  PARTITION BY game_id, player_name, team_code, seconds_remaining ORDER BY snapshot_id DESC,
    score_diff DESC NULLS LAST) AS i FROM hen) WHERE i = 1)"""

# Training set: labels from the final difference and the game's best efficiency.
TRAIN = """fin AS (SELECT game_id, team_code, score_diff AS final_diff FROM (
  SELECT *, row_number() OVER (PARTITION BY game_id, team_code
    ORDER BY seconds_remaining ASC NULLS FIRST, snapshot_id DESC, player_name ASC NULLS FIRST) AS i FROM dd) WHERE i = 1),
tr0 AS (SELECT d.*, f.final_diff, CASE WHEN f.final_diff > 0 THEN 1 ELSE 0 END AS label_win,
  CAST(sum(CAST(d.efficiency AS DECIMAL(30,2))) OVER (PARTITION BY d.game_id, d.team_code, d.seconds_remaining)
    AS DOUBLE) AS tot_eff,
  max(d.efficiency) OVER (PARTITION BY d.game_id) AS max_game_eff
  FROM dd d LEFT JOIN fin f ON d.game_id IS NOT DISTINCT FROM f.game_id AND d.team_code IS NOT DISTINCT FROM f.team_code),
tr AS (SELECT * EXCLUDE (tot_eff),
  CASE WHEN tot_eff > 0 THEN efficiency / tot_eff ELSE CAST(0.0 AS DOUBLE) END AS efficiency_norm,
  CASE WHEN efficiency = max_game_eff THEN 1 ELSE 0 END AS label_mvp FROM tr0)"""


def scored_sql(src: str, fill: bool = False) -> list[str]:
    """Win% and MVP% of the rows of ``src`` by a forest and a logistic model of given parameters."""
    numbers = "team_score, score_diff, seconds_remaining, game_quarter, pts, ast, reb, stl, blk, tov, pf, fg_pct, efficiency".split(", ")
    filled = f"SELECT * REPLACE ({', '.join(f'coalesce({c}, 0) AS {c}' for c in numbers)}) FROM {src}" if fill else f"SELECT * FROM {src}"
    return [f"""sc0 AS (SELECT *, CAST(sum(CAST(efficiency AS DECIMAL(30,2))) OVER (PARTITION BY game_id, team_code, seconds_remaining) AS DOUBLE) AS tot_eff FROM ({filled}))""",
            """sc1 AS (SELECT *,
  (CASE WHEN score_diff > 0.5 THEN CASE WHEN score_diff > 9.5 THEN 0.9375E0 ELSE 0.625E0 END WHEN seconds_remaining > 1440.5 THEN 0.375E0 ELSE 0.125E0 END
   + CASE WHEN seconds_remaining > 600.5 THEN 0.4375E0 WHEN score_diff <= -3.5 THEN 0E0 WHEN score_diff <= 3.5 THEN 0.5E0 ELSE 1E0 END
   + CASE WHEN score_diff > -12.5 THEN 0.5625E0 ELSE 0.03125E0 END) / 3E0 AS win_prob,
  CASE WHEN tot_eff > 0 THEN efficiency / tot_eff ELSE 0E0 END AS efficiency_norm FROM sc0)""",
            """sc2 AS (SELECT *, 1E0 / (1E0 + exp(4.5E0 - 0.11E0 * pts - 0.07E0 * ast - 0.05E0 * reb - 0.21E0 * stl - 0.19E0 * blk
  + 0.13E0 * tov + 0.08E0 * pf - 0.004E0 * fg_pct - 6.5E0 * efficiency_norm)) AS mvp_prob FROM sc1)""",
            """sc AS (SELECT *, CAST(printf('%.2f', win_prob * 100) AS FLOAT) AS win_pct,
  CAST(printf('%.2f', CASE WHEN sum(mvp_prob) OVER w > 0 THEN mvp_prob / sum(mvp_prob) OVER w * 100 ELSE 0E0 END) AS FLOAT) AS mvp_pct
  FROM sc2 WINDOW w AS (PARTITION BY game_id, seconds_remaining))"""]
