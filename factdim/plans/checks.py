"""Independent SQL for the registered jobs, in the naive form, over the practice tables."""

from __future__ import annotations

from ..sources.practice import BROWSERS, HOSTS
from .jobs import CELLS

_HOST_LIST = "[" + ", ".join(f"'{h}'" for h in HOSTS) + "]"
_BROWSER_LIST = "[" + ", ".join(f"'{b}'" for b in BROWSERS) + "]"

# --- the adapted tables -----------------------------------------------------------------------

FILMS = """
films AS (
  SELECT 'Customer#' || o_custkey AS actor, CAST(o_custkey AS VARCHAR) AS actorid,
         o_orderpriority AS film, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(floor(o_totalprice) AS INTEGER) AS votes,
         CAST(floor(o_totalprice / 50000) + 1 AS INTEGER) AS rating,
         CAST(o_orderkey AS VARCHAR) AS filmid
  FROM orders)"""

PLAYERS = "players AS (SELECT 'Player#' || c_custkey AS player_name FROM customer)"

SEASONS = """
player_seasons AS (
  SELECT DISTINCT 'Player#' || o_custkey AS player_name,
         CAST(year(o_orderdate) AS INTEGER) AS season
  FROM orders)"""

_GAME_REST = """
         l_suppkey AS player_id, 'Player#' || l_suppkey AS player_name,
         CAST(year(l_shipdate) AS INTEGER) AS season,
         CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN NULL
              ELSE CAST(trunc(l_quantity) AS INTEGER) END AS pts"""

GAMES = f"""
games0 AS (
  SELECT l_orderkey AS game_id,
         CAST((l_suppkey + year(l_shipdate)) % 30 AS INTEGER) AS team_id,{_GAME_REST}
  FROM lineitem),
games AS (SELECT *, 'T' || team_id AS team_abbreviation FROM games0)"""

TWO_TEAM_GAMES = f"""
games0 AS (
  SELECT l_orderkey AS game_id,
         CAST((l_orderkey + (l_linenumber % 2)
               * (1 + CAST(floor(l_orderkey / 30) AS BIGINT) % 29)) % 30 AS INTEGER) AS team_id,
         {_GAME_REST}
  FROM lineitem),
games AS (SELECT *, 'T' || team_id AS team_abbreviation FROM games0)"""

SITE = f"""
site AS (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS device_id,
         {_HOST_LIST}[user_id % 3 + 1] AS host, ts AS event_time,
         CAST(ts AS DATE) AS day
  FROM events)"""

DEVICES = f"""
devices AS (
  SELECT DISTINCT device_id, {_BROWSER_LIST}[device_id % 4 + 1] AS browser_type FROM site)"""

DEVICE_DAYS = f"""{SITE},{DEVICES},
seen AS (
  SELECT DISTINCT CAST(s.user_id AS VARCHAR) AS user_id, d.browser_type, s.day
  FROM site s JOIN devices d ON s.device_id = d.device_id)"""

WEB = f"""
web AS (
  SELECT '10.0.0.' || (user_id % 5) AS ip, {_HOST_LIST}[user_id % 3 + 1] AS host,
         epoch_us(ts) // 1000 AS ts
  FROM events)"""

MATCH_TABLES = """
details AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS match_id, CAST(l_suppkey AS VARCHAR) AS player_gamertag,
         CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) AS player_total_kills
  FROM lineitem),
matches AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS match_id, CAST(o_custkey % 28 AS VARCHAR) AS mapid,
         o_orderpriority AS playlist_id, o_orderdate AS completion_date
  FROM orders),
earned AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS match_id, CAST(l_suppkey AS VARCHAR) AS player_gamertag,
         CAST(l_partkey AS VARCHAR) AS medal_id
  FROM lineitem),
medals AS (
  SELECT CAST(p_partkey AS VARCHAR) AS medal_id,
         CASE WHEN p_size = 7 THEN 'Killing Spree' ELSE p_name END AS name
  FROM part),
maps AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS mapid, n_name AS name
  FROM nation)"""

# --- actors -----------------------------------------------------------------------------------

_CLASS = """CASE WHEN avg(f.rating) >= 8 THEN 'star' WHEN avg(f.rating) >= 7 THEN 'good'
              WHEN avg(f.rating) >= 6 THEN 'average' ELSE 'bad' END"""

STATUS = f"""{FILMS},
yearly AS (
  SELECT actorid, year, {_CLASS} AS quality_class FROM films f GROUP BY actorid, year),
actor_years AS (
  SELECT d.actorid, y.year AS current_year
  FROM (SELECT actorid, min(year) AS debut FROM films GROUP BY actorid) d
  JOIN (SELECT unnest(generate_series((SELECT min(year) FROM films),
                                      (SELECT max(year) FROM films)))::INTEGER AS year) y
    ON y.year >= d.debut),
status AS (
  SELECT 'Customer#' || a.actorid AS actor, a.actorid,
         last_value(y.quality_class IGNORE NULLS) OVER (
           PARTITION BY a.actorid ORDER BY a.current_year) AS quality_class,
         y.actorid IS NOT NULL AS is_active, a.current_year
  FROM actor_years a LEFT JOIN yearly y
    ON a.actorid = y.actorid AND a.current_year = y.year)"""

_ACTORS = f"""
WITH {STATUS}
SELECT s.actor, s.actorid,
       string_agg(f.filmid || ':' || f.film || ':' || f.votes || ':' || f.rating, ';'
                  ORDER BY f.year, f.filmid) AS films,
       s.quality_class, s.is_active, s.current_year
FROM status s JOIN films f ON f.actorid = s.actorid AND f.year <= s.current_year
WHERE s.current_year >= {{first_year}}
GROUP BY ALL"""

# A run starts where the year before has no equal status, and ends before the next start.
_SCD = f"""
WITH {STATUS},
starts AS (
  SELECT n.* FROM status n
  WHERE NOT EXISTS (
    SELECT 1 FROM status b
    WHERE b.actorid = n.actorid AND b.current_year = n.current_year - 1
      AND b.quality_class = n.quality_class AND b.is_active = n.is_active)),
last_years AS (SELECT actorid, max(current_year) AS last_year FROM status GROUP BY actorid)
SELECT s.actorid, any_value(s.actor) AS actor, any_value(s.quality_class) AS quality_class,
       any_value(s.is_active) AS is_active, s.current_year AS start_year,
       coalesce(min(t.current_year) - 1, any_value(l.last_year)) AS end_year, any_value(l.last_year) AS current_year
FROM starts s JOIN last_years l ON l.actorid = s.actorid
LEFT JOIN starts t ON t.actorid = s.actorid AND t.current_year > s.current_year
GROUP BY s.actorid, s.current_year"""

# --- shared pieces ----------------------------------------------------------------------------

# A team beats those whose points lie below its own in the game's sorted list of team points.
_OUTCOMES = f"""{TWO_TEAM_GAMES},
points AS (
  SELECT game_id, team_id, 'T' || team_id AS team_abbreviation, coalesce(sum(pts), 0) AS own
  FROM games GROUP BY game_id, team_id),
boards AS (SELECT game_id, list_sort(list(own)) AS board FROM points GROUP BY game_id),
outcomes AS (
  SELECT p.team_abbreviation, p.game_id, len(b.board) - 1 AS opponents, list_position(b.board, p.own) - 1 AS win
  FROM points p JOIN boards b USING (game_id) WHERE len(b.board) > 1)"""

# A streak is told from the number of misses before its games.
_STREAKS = f"""
WITH {GAMES},
best AS (
  SELECT game_id, player_name, min_by(coalesce(pts, 0), coalesce(pts, -1)) AS pts
  FROM games GROUP BY game_id, player_name),
counted AS (
  SELECT *, count(*) FILTER (pts <= 10) OVER (
    PARTITION BY player_name ORDER BY game_id ROWS UNBOUNDED PRECEDING) AS misses
  FROM best),
runs AS (
  SELECT player_name, misses, count(*) AS games_in_row_over_10, min(game_id) AS streak_start_game,
         max(game_id) AS streak_end_game
  FROM counted WHERE pts > 10 GROUP BY player_name, misses),
longest AS (SELECT player_name, max(games_in_row_over_10) AS most FROM runs GROUP BY player_name)
SELECT r.player_name, r.games_in_row_over_10, r.streak_start_game, r.streak_end_game
FROM runs r JOIN longest l ON l.player_name = r.player_name AND l.most = r.games_in_row_over_10 {{where}}"""

# One GROUP BY for each set.
_SET_ROWS = """
SELECT {player} AS player_name, {team} AS team_abbreviation, {season} AS season,
       CAST(coalesce(sum(pts), 0) AS BIGINT) AS total_points, count(*) AS games_played,
       {player_label} AS player_label, {team_label} AS team_label, {season_label} AS season_label
FROM joined GROUP BY ALL"""

_PLAYER = {"player": "player_name", "player_label": "player_name"}
_TEAM = {"team": "team_abbreviation", "team_label": "team_abbreviation"}
_SEASON = {"season": "season", "season_label": "CAST(season AS VARCHAR)"}
_NOTHING = {
    "player": "NULL::VARCHAR", "team": "NULL::VARCHAR", "season": "NULL::INTEGER",
    "player_label": "'ALL_PLAYERS'", "team_label": "'ALL_TEAMS'", "season_label": "'ALL_SEASONS'",
}
_GROUPING_SETS = f"""
WITH {GAMES},{SEASONS},
joined AS (
  SELECT g.player_name, g.team_abbreviation, s.season, g.pts
  FROM games g, player_seasons s WHERE g.player_name = s.player_name {{on_season}})""" + " UNION ALL ".join(
    _SET_ROWS.format(**(_NOTHING | columns)) for columns in (_PLAYER | _TEAM, _PLAYER | _SEASON, _TEAM)
)

_DAYS_TEXT = "string_agg(CAST(day AS VARCHAR), ',' ORDER BY day)"

_DEVICE_LISTS = f"""
WITH {DEVICE_DAYS}
SELECT user_id, browser_type, {_DAYS_TEXT} AS activity_datelist, (SELECT max(day) FROM site) AS date
FROM seen GROUP BY user_id, browser_type"""


def _site_lists(keys: str) -> str:
    return f"""
WITH {SITE}, seen AS (SELECT DISTINCT {keys}, day FROM site)
SELECT {keys}, {_DAYS_TEXT} AS activity_datelist, (SELECT max(day) FROM site) AS date
FROM seen GROUP BY {keys}"""


def _month_grid(keys: str) -> str:
    same_key = " AND ".join(f"k.{k.strip()} = s.{k.strip()}" for k in keys.split(","))
    key_list = ", ".join(f"k.{k.strip()}" for k in keys.split(","))
    return f"""{SITE},
grid AS (
  SELECT k.*, d.day
  FROM (SELECT DISTINCT {keys} FROM site WHERE day >= (SELECT date_trunc('month', max(day)) FROM site)) k
  CROSS JOIN (SELECT CAST(unnest(generate_series((SELECT date_trunc('month', max(day)) FROM site), (SELECT max(day) FROM site),
                                                 INTERVAL 1 DAY)) AS DATE) AS day) d),
slots AS (
  SELECT {key_list}, k.day, count(s.user_id) AS hits, count(DISTINCT s.user_id) AS visitors
  FROM grid k LEFT JOIN site s ON {same_key} AND s.day = k.day
  GROUP BY {key_list}, k.day)"""


def _month_arrays(keys: str) -> str:
    return f"""
WITH {_month_grid(keys)}
SELECT {keys}, CAST(date_trunc('month', max(day)) AS DATE) AS month,
       string_agg(CAST(hits AS VARCHAR), ',' ORDER BY day) AS hit_array,
       string_agg(CAST(visitors AS VARCHAR), ',' ORDER BY day) AS unique_visitors
FROM slots GROUP BY {keys}"""


_SESSIONS = f"""{WEB},
gaps AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY ip, host ORDER BY ts) > 300000
                 THEN 1 ELSE 0 END AS opens
  FROM web),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY ip, host ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n
  FROM gaps),
closed AS (
  SELECT ip, host, epoch_ms(min(ts)) AS session_start, epoch_ms(max(ts) + 300000) AS session_end,
         count(*) AS event_count, md5(ip || '|' || host || '|' || min(ts)) AS session_id
  FROM numbered GROUP BY ip, host, n)"""

_LINE_SESSIONS = _SESSIONS.replace("FROM events)", "FROM events WHERE event_id % 40 NOT IN (1, 2, 3))")


def _growth(number: str, back: str) -> str:
    return f"""
WITH {SITE},
act AS (SELECT DISTINCT user_id, {number} AS p FROM site),
axis AS (SELECT unnest(generate_series((SELECT min(p) FROM act), (SELECT max(p) FROM act))) AS p),
grid AS (
  SELECT u.user_id, x.p, a.p IS NOT NULL AS active
  FROM (SELECT user_id, min(p) AS debut FROM act GROUP BY user_id) u
  JOIN axis x ON x.p >= u.debut
  LEFT JOIN act a ON a.user_id = u.user_id AND a.p = x.p),
states AS (
  SELECT p, active, lag(active) OVER (PARTITION BY user_id ORDER BY p) AS prev FROM grid)
SELECT {back} AS period,
       count(*) FILTER (active AND prev IS NULL) AS new,
       count(*) FILTER (active AND prev) AS retained,
       count(*) FILTER (active AND NOT prev) AS resurrected,
       count(*) FILTER (NOT active AND prev) AS churned,
       count(*) FILTER (NOT active AND NOT prev) AS stale,
       count(*) FILTER (active) AS active,
       count(*) FILTER (active AND (prev IS NULL OR NOT prev))
         - count(*) FILTER (NOT active AND prev) AS net_change
FROM states GROUP BY p"""


_GROWTH_DAILY = _growth("day - DATE '1970-01-01'", "DATE '1970-01-01' + CAST(p AS INTEGER)")
_GROWTH_WEEKLY = _growth(
    "date_trunc('week', day)::DATE - DATE '1969-12-29'", "DATE '1969-12-29' + CAST(p AS INTEGER)"
).replace("(SELECT max(p) FROM act))", "(SELECT max(p) FROM act), 7)")

_upper, _cases = 0, []
for _cell, _share in CELLS.items():
    _upper += _share
    _cases.append(f"WHEN b < {_upper} THEN '{_cell}'")

_CELLS = f"""
hashed AS (
  SELECT user_id, CAST('0x' || substr(md5('feed_layout|' || user_id), 1, 8) AS BIGINT) % 100 AS b
  FROM (SELECT DISTINCT user_id FROM events)),
cells AS (
  SELECT user_id, 'feed_layout' AS experiment, CASE {" ".join(_cases)} END AS cell FROM hashed)"""

_CENTS = "CAST(round(l_extendedprice * (1 - l_discount) * 100) AS BIGINT)"

CHECKS: dict[str, str] = {
    "dedup_games": f"""
WITH {GAMES}
SELECT * FROM games
QUALIFY row_number() OVER (
  PARTITION BY game_id, team_id, player_id
  ORDER BY player_name NULLS FIRST, team_abbreviation NULLS FIRST, season NULLS FIRST,
           pts NULLS FIRST) = 1""",
    "game_grouping_sets": _GROUPING_SETS.format(on_season="AND g.season = s.season"),
    "game_grouping_sets_career": _GROUPING_SETS.format(on_season=""),
    "top_player_for_team": f"""
WITH {GAMES}
SELECT player_name, team_abbreviation, CAST(sum(coalesce(pts, 0)) AS BIGINT) AS total_points
FROM games GROUP BY player_name, team_abbreviation
QUALIFY rank() OVER (ORDER BY total_points DESC) = 1""",
    "top_player_season": f"""
WITH {GAMES},{SEASONS}
SELECT g.player_name, s.season, CAST(sum(coalesce(g.pts, 0)) AS BIGINT) AS total_points
FROM games g JOIN player_seasons s ON g.player_name = s.player_name AND g.season = s.season
GROUP BY g.player_name, s.season QUALIFY rank() OVER (ORDER BY total_points DESC) = 1""",
    "team_wins": f"""
WITH {_OUTCOMES}
SELECT team_abbreviation, CAST(sum(win) AS BIGINT) AS total_wins FROM outcomes GROUP BY ALL""",
    "top_team_wins": f"""
WITH {_OUTCOMES},
totals AS (SELECT team_abbreviation, CAST(sum(win) AS BIGINT) AS total_wins FROM outcomes GROUP BY ALL)
SELECT * FROM totals WHERE total_wins = (SELECT max(total_wins) FROM totals)""",
    # 90 games by position: the difference of two running sums
    "max_wins_in_stretch": f"""
WITH {_OUTCOMES},
single AS (SELECT team_abbreviation, game_id, win FROM outcomes WHERE opponents > 0),
lists AS (SELECT team_abbreviation, list(win ORDER BY game_id) AS wins FROM single GROUP BY ALL),
stretches AS (
  SELECT team_abbreviation, list_sum(wins[greatest(i - 89, 1):i]) AS n
  FROM lists, unnest(range(1, len(wins) + 1)) AS r(i))
SELECT team_abbreviation, CAST(max(n) AS BIGINT) AS max_wins_in_90_games
FROM stretches GROUP BY team_abbreviation""",
    "longest_streak_all_players": _STREAKS.format(where=""),
    "longest_streak_one_player": _STREAKS.format(where="WHERE r.player_name = 'Player#7'"),
    # from the first active season, the last one before and the one at hand
    "player_state": f"""
WITH {PLAYERS},{SEASONS},
numbered AS (SELECT season, row_number() OVER (ORDER BY season) AS nr FROM (SELECT DISTINCT season FROM player_seasons)),
played AS (
  SELECT player_name, list(n.nr) AS seasons
  FROM player_seasons a JOIN numbered n USING (season)
  WHERE player_name IN (SELECT player_name FROM players) GROUP BY player_name),
seen AS (
  SELECT p.player_name, n.season, n.nr - list_max(list_filter(p.seasons, lambda x: x < n.nr)) AS since,
         list_contains(p.seasons, n.nr) AS active
  FROM played p JOIN numbered n ON n.nr >= list_min(p.seasons))
SELECT player_name, season,
       CASE WHEN since IS NULL THEN 'New'
            WHEN since = 1 AND active THEN 'Continued Playing'
            WHEN since = 1 THEN 'Retired'
            WHEN active THEN 'Returned from Retirement'
            ELSE 'Stayed Retired' END AS player_state
FROM seen""",
    "actors_increment": _ACTORS.format(first_year="(SELECT max(year) FROM films)"),
    "actors_backfill": _ACTORS.format(first_year=0),
    "actors_scd2_backfill": _SCD,
    "actors_scd2_increment": _SCD,
    "actors_scd2_rerun": _SCD,
    "actors_history_stored": _SCD,
    "segment_upsert": """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
       CAST(o_totalprice + CASE WHEN o_orderkey % 3 = 0 AND o_orderstatus IN ('F', 'P') THEN 1 ELSE 0 END AS DOUBLE) AS price
FROM orders""",
    "device_dates_increment": _DEVICE_LISTS,
    "device_dates_backfill": _DEVICE_LISTS,
    "device_dates_map": f"""
WITH lists AS ({_DEVICE_LISTS})
SELECT user_id, date,
       string_agg(browser_type || '=' || activity_datelist, ';' ORDER BY browser_type) AS activity
FROM lists GROUP BY user_id, date""",
    "host_dates_increment": _site_lists("host"),
    "user_host_dates_increment": _site_lists("user_id, host"),
    "host_dates_backfill": _site_lists("host"),
    "datelist_int": f"""
WITH {DEVICE_DAYS},
masks AS (
  SELECT user_id, browser_type,
         coalesce(bit_or(CAST(1 AS BIGINT) << CAST(greatest(31 - age, 0) AS INTEGER)) FILTER (age < 32), 0) AS datelist_int,
         CAST(count(DISTINCT age) FILTER (age < 32) AS INTEGER) AS days_active,
         coalesce(bool_or(age < 7), false) AS active_7d,
         coalesce(bool_or(age < 28), false) AS active_28d
  FROM (SELECT *, (SELECT max(day) FROM site) - day AS age FROM seen) GROUP BY user_id, browser_type)
SELECT user_id, browser_type, datelist_int, lpad(bin(datelist_int), 32, '0') AS datelist_bits,
       days_active, active_7d, active_28d
FROM masks""",
    "monthly_array_increment": _month_arrays("host"),
    "monthly_array_increment_by_user": _month_arrays("user_id, host"),
    "monthly_array_backfill": _month_arrays("host"),
    "monthly_array_upsert": _month_arrays("host"),
    "monthly_array_explode": f"""
WITH {_month_grid("host")} SELECT host, day AS date, hits, visitors FROM slots""",
    "monthly_array_totals": f"""
WITH {_month_grid("host")}
SELECT host, CAST(date_trunc('month', max(day)) AS DATE) AS month, CAST(sum(hits) AS BIGINT) AS hits,
       CAST(sum(visitors) AS BIGINT) AS visitors
FROM slots GROUP BY host""",
    "match_fact": f"""
WITH {MATCH_TABLES}
SELECT d.match_id, d.player_gamertag, CAST(d.player_total_kills AS INTEGER) AS kills,
       m.playlist_id, p.mapid, p.name AS map_name, n.name AS medal_name
FROM details d
LEFT JOIN matches m ON d.match_id = m.match_id
LEFT JOIN earned e ON d.match_id = e.match_id AND d.player_gamertag = e.player_gamertag
LEFT JOIN medals n ON e.medal_id = n.medal_id
LEFT JOIN maps p ON m.mapid = p.mapid""",
    "bucketed_match_join": f"""
WITH {MATCH_TABLES}
SELECT d.match_id, d.player_gamertag, d.player_total_kills, m.mapid, m.playlist_id,
       CAST(m.completion_date AS DATE) AS completion_date, e.medal_id
FROM details d JOIN matches m ON d.match_id = m.match_id
JOIN earned e ON d.match_id = e.match_id AND d.player_gamertag = e.player_gamertag""",
    "hot_match_join": f"""
WITH {MATCH_TABLES},
numbered AS (
  SELECT *, row_number() OVER (
           PARTITION BY CAST(match_id AS BIGINT) % 3 = 0 ORDER BY CAST(match_id AS BIGINT)) AS nth
  FROM matches),
one_final AS (
  SELECT CASE WHEN CAST(match_id AS BIGINT) % 3 = 0 THEN 'final' ELSE match_id END AS match_id,
         mapid, playlist_id, CAST(completion_date AS DATE) AS completion_date
  FROM numbered WHERE CAST(match_id AS BIGINT) % 3 <> 0 OR nth = 1)
SELECT m.match_id, CASE WHEN m.match_id = 'final' THEN d.player_gamertag || '-' || d.match_id
                        ELSE d.player_gamertag END AS player_gamertag,
       d.player_total_kills, m.mapid, m.playlist_id, m.completion_date, e.medal_id
FROM details d JOIN earned e ON d.match_id = e.match_id AND d.player_gamertag = e.player_gamertag
JOIN one_final m
  ON m.match_id = CASE WHEN CAST(d.match_id AS BIGINT) % 3 = 0 THEN 'final' ELSE d.match_id END""",
    "visitors_by_month": f"""
WITH {SITE}
SELECT host, CAST(date_trunc('month', day) AS DATE) AS month, count(DISTINCT user_id) AS visitors
FROM site WHERE user_id IS NOT NULL GROUP BY 1, 2""",
    "visitors_by_week": f"""
WITH {SITE}
SELECT CAST(date_trunc('week', day) AS DATE) AS week, count(DISTINCT user_id) AS visitors
FROM site WHERE user_id IS NOT NULL AND host IS NOT NULL GROUP BY 1""",
    "visitors_trailing": f"""
WITH {SITE},
span AS (SELECT min(day) AS first, max(day) AS last FROM site),
days AS (SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS date FROM span)
SELECT s.host, d.date, count(DISTINCT s.user_id) AS visitors
FROM days d JOIN site s ON s.day BETWEEN d.date - 6 AND d.date
WHERE s.user_id IS NOT NULL GROUP BY 1, 2""",
    "avg_kills_per_game": f"""
WITH {MATCH_TABLES}
SELECT player_gamertag, sum(CAST(player_total_kills AS INTEGER)) / count(DISTINCT match_id)
         AS avg_kills_per_game
FROM details GROUP BY player_gamertag""",
    "top_killers_preview": f"""
WITH {MATCH_TABLES}
SELECT player_gamertag, sum(CAST(player_total_kills AS INTEGER)) / count(DISTINCT match_id)
         AS avg_kills_per_game
FROM details GROUP BY player_gamertag
ORDER BY avg_kills_per_game DESC, player_gamertag LIMIT 5""",
    "most_played_playlist": f"""
WITH {MATCH_TABLES}
SELECT playlist_id, count(DISTINCT match_id) AS total_matches FROM matches GROUP BY playlist_id""",
    "most_played_map": f"""
WITH {MATCH_TABLES}
SELECT p.mapid, p.name AS map_name, count(DISTINCT m.match_id) AS total_plays
FROM matches m LEFT JOIN maps p ON m.mapid = p.mapid GROUP BY p.mapid, p.name""",
    "medal_maps": f"""
WITH {MATCH_TABLES}
SELECT p.mapid, p.name AS map_name, count(*) AS medal_count
FROM earned e JOIN medals n ON e.medal_id = n.medal_id AND n.name = 'Killing Spree'
LEFT JOIN matches m ON e.match_id = m.match_id
LEFT JOIN maps p ON m.mapid = p.mapid GROUP BY p.mapid, p.name""",
    "layout_experiment": f"""
WITH {MATCH_TABLES},
fact AS (
  SELECT m.playlist_id, p.mapid
  FROM details d
  LEFT JOIN matches m ON d.match_id = m.match_id
  LEFT JOIN earned e ON d.match_id = e.match_id AND d.player_gamertag = e.player_gamertag
  LEFT JOIN maps p ON m.mapid = p.mapid)
SELECT 'by_playlist' AS layout, count(*) AS rows, count(DISTINCT coalesce(playlist_id, '-')) AS partition_values FROM fact
UNION ALL SELECT 'by_map', count(*), count(DISTINCT coalesce(mapid, '-')) FROM fact
UNION ALL
SELECT 'by_both', count(*), count(DISTINCT coalesce(playlist_id, '-') || '|' || coalesce(mapid, '-')) FROM fact""",
    "sessions": f"WITH {_SESSIONS} SELECT * FROM closed",
    "sessions_stream": f"""
WITH {_SESSIONS}
SELECT * FROM closed
WHERE session_end <= (SELECT epoch_ms(max(ts)) FROM web) - INTERVAL 10 SECOND""",
    "sessions_upsert": f"""
WITH {_SESSIONS}
SELECT * FROM closed
WHERE session_end <= (SELECT epoch_ms(max(ts)) FROM web) - INTERVAL 10 SECOND""",
    "sessions_from_lines": f"WITH {_LINE_SESSIONS} SELECT * FROM closed",
    "sessions_from_messages": f"WITH {_LINE_SESSIONS} SELECT * FROM closed",
    # the watermark of a slice: the newest event of all slices before, less 10 seconds
    "intake_report": """
WITH bounds AS (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events),
sliced AS (
  SELECT event_id % 40 AS kind, epoch_us(ts) // 1000 AS ms,
         CAST(floor((CAST(ts AS DATE) - a) * 5 / (b - a + 1)) AS INTEGER) AS own
  FROM events, bounds),
arrived AS (
  SELECT ms, kind IN (1, 2, 3) AS bad, CASE WHEN kind = 4 AND own < 4 THEN own + 1 ELSE own END AS slice FROM sliced),
newest AS (SELECT slice, max(ms) FILTER (NOT bad) AS top FROM arrived GROUP BY slice),
marks AS (
  SELECT slice, max(top) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 10000 AS mark
  FROM newest),
judged AS (SELECT slice, bad, coalesce(ms + 300000 <= mark, false) AS late FROM arrived JOIN marks USING (slice))
SELECT CAST(slice AS BIGINT) AS batch_id, count(*) FILTER (NOT bad AND NOT late) AS accepted,
       count(*) FILTER (NOT bad AND late) AS late, count(*) FILTER (bad) AS rejected
FROM judged GROUP BY slice""",
    "session_stats": f"""
WITH {_SESSIONS}
SELECT coalesce(host, 'ALL') AS host, count(*) AS sessions,
       avg(event_count) AS avg_events_per_session
FROM closed GROUP BY GROUPING SETS ((host), ())""",
    "consecutive_drop_alert": """
WITH present AS (
  SELECT CAST(ts AS DATE) AS date, event_type, user_id, count(*) AS value FROM events GROUP BY ALL),
spine AS (
  SELECT event_type, user_id, CAST(unnest(generate_series(min(date), (SELECT max(date) FROM present),
                                                          INTERVAL 1 DAY)) AS DATE) AS date
  FROM present GROUP BY event_type, user_id),
daily AS (
  SELECT s.*, coalesce(p.value, 0) AS value
  FROM spine s LEFT JOIN present p USING (event_type, user_id, date)),
steps AS (
  SELECT a.*, b.value AS previous_value,
         a.value < b.value AND (b.value - a.value) >= CAST(0.2 AS DOUBLE) * b.value AS fell
  FROM daily a JOIN daily b
    ON b.event_type = a.event_type AND b.user_id = a.user_id AND b.date = a.date - 1)
SELECT s.event_type, s.user_id, s.date, s.value, s.previous_value
FROM steps s JOIN steps t ON t.event_type = s.event_type AND t.user_id = s.user_id AND t.date = s.date - 1
WHERE s.fell AND t.fell""",
    "missing_days": f"""
WITH {SITE},
bounds AS (SELECT user_id, min(day) AS lo, max(day) AS hi FROM site GROUP BY user_id),
spine AS (
  SELECT user_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS missing_date
  FROM bounds)
SELECT user_id, missing_date FROM spine
WHERE (user_id, missing_date) NOT IN (SELECT (user_id, day) FROM site)""",
    "volume_drop": """
WITH present AS (
  SELECT event_type, user_id, CAST(ts AS DATE) AS date, count(*) AS rows FROM events GROUP BY ALL),
daily AS (
  SELECT s.*, coalesce(p.rows, 0) AS rows
  FROM (SELECT event_type, user_id,
               CAST(unnest(generate_series(min(date), (SELECT max(date) FROM present), INTERVAL 1 DAY)) AS DATE) AS date
        FROM present GROUP BY event_type, user_id) s
  LEFT JOIN present p USING (event_type, user_id, date)),
rated AS (
  SELECT a.event_type, a.user_id, a.date, a.rows, avg(b.rows) AS trailing_mean
  FROM daily a JOIN daily b
    ON b.event_type = a.event_type AND b.user_id = a.user_id AND b.date BETWEEN a.date - 7 AND a.date - 1
  GROUP BY ALL)
SELECT * FROM rated WHERE rows < CAST(0.9 AS DOUBLE) * trailing_mean""",
    "schema_conformance": """
SELECT 'event_id' AS column, true AS present, 'bigint' AS expected_type, 'bigint' AS actual_type,
       count(*) FILTER (event_id IS NULL) / count(*) AS null_rate,
       CAST(0 AS DOUBLE) AS bad_cast_rate FROM events
UNION ALL
SELECT 'ts', true, 'date', 'timestamp_ntz', count(*) FILTER (ts IS NULL) / count(*),
       count(*) FILTER (ts IS NOT NULL AND TRY_CAST(ts AS DATE) IS NULL) / count(*) FROM events
UNION ALL
SELECT 'user_id', true, 'smallint', 'bigint', count(*) FILTER (user_id IS NULL) / count(*),
       count(*) FILTER (user_id IS NOT NULL AND TRY_CAST(user_id AS SMALLINT) IS NULL) / count(*)
FROM events
UNION ALL
SELECT 'event_type', true, 'int', 'string', count(*) FILTER (event_type IS NULL) / count(*),
       count(*) FILTER (event_type IS NOT NULL AND TRY_CAST(event_type AS INTEGER) IS NULL)
         / count(*) FROM events
UNION ALL SELECT 'session_id', false, 'string', NULL, NULL, NULL
UNION ALL SELECT 'value', true, NULL, 'double', NULL, NULL
UNION ALL SELECT 'props', true, NULL, 'string', NULL, NULL""",
    "freshness": """
WITH newest AS (
  SELECT 'events' AS table_name, max(ts) AS latest FROM events
  UNION ALL SELECT 'orders', max(o_orderdate) FROM orders
  UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem)
SELECT table_name, latest,
       CAST(floor((epoch_ms(TIMESTAMP '2024-02-01 06:00:00') - epoch_us(latest) // 1000) / 60000)
            AS BIGINT) AS lag_minutes
FROM newest""",
    "unit_profit": f"SELECT l_orderkey, l_linenumber, {_CENTS} AS profit_cents FROM lineitem",
    "aggregate_profit": f"""
SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS lines,
       CAST(sum({_CENTS}) AS BIGINT) AS profit_cents
FROM lineitem GROUP BY ALL""",
    "growth_daily": _GROWTH_DAILY,
    "growth_weekly": _GROWTH_WEEKLY,
    "daily_growth_rate": f"""
WITH daily AS ({_GROWTH_DAILY})
SELECT period, active, net_change,
       (active - lag(active) OVER (ORDER BY period)) / lag(active) OVER (ORDER BY period)
         AS growth_rate
FROM daily""",
    "engagement": f"""
WITH {SITE},
days AS (SELECT DISTINCT day FROM site),
dau AS (SELECT day, count(DISTINCT user_id) AS dau, count(*) AS n FROM site GROUP BY day),
mau AS (
  SELECT d.day, count(DISTINCT s.user_id) AS mau
  FROM days d JOIN site s ON s.day <= d.day AND s.day > d.day - 28 GROUP BY d.day)
SELECT d.day AS date, dau, mau, dau / mau AS dau_mau, n / dau AS events_per_user
FROM dau d JOIN mau m ON d.day = m.day""",
    "experiment_cells": f"WITH {_CELLS} SELECT user_id, experiment, cell FROM cells",
    "experiment_metrics": f"""
WITH {_CELLS},
per_user AS (
  SELECT user_id, count(*) FILTER (event_type = 'click') AS clicks,
         count(*) FILTER (event_type = 'error') AS errors, count(*) AS events
  FROM events GROUP BY user_id),
long AS (
  SELECT c.experiment, c.cell, u.metric, u.v
  FROM cells c JOIN (UNPIVOT per_user ON clicks, errors, events INTO NAME metric VALUE v) u
    ON c.user_id = u.user_id),
stats AS (
  SELECT experiment, cell, metric, count(*) AS users, sum(v) / count(*) AS mean,
         var_samp(v) AS variance
  FROM long GROUP BY ALL)
SELECT t.experiment, t.cell, t.metric, t.users, t.mean, round(t.variance, 6) AS variance,
       CASE WHEN t.cell <> 'A' THEN round((t.mean - c.mean) / c.mean, 6) END AS lift,
       CASE WHEN t.cell <> 'A' THEN
         round((t.mean - c.mean) / sqrt(t.variance / t.users + c.variance / c.users), 6) END
         AS welch_z
FROM stats t JOIN stats c ON c.metric = t.metric AND c.cell = 'A'""",
    "retention": f"""
WITH {SITE},
first AS (SELECT user_id, min(day) AS cohort FROM site GROUP BY user_id),
marks AS (
  SELECT f.user_id, f.cohort, max(CASE WHEN s.day - f.cohort = 7 THEN 1 ELSE 0 END) AS d7,
         max(CASE WHEN s.day - f.cohort BETWEEN 1 AND 7 THEN 1 ELSE 0 END) AS w1,
         max(CASE WHEN s.day - f.cohort BETWEEN 22 AND 28 THEN 1 ELSE 0 END) AS w4
  FROM first f JOIN site s ON s.user_id = f.user_id GROUP BY ALL)
SELECT cohort, count(*) AS users,
       CASE WHEN cohort + 7 <= (SELECT max(day) FROM site) THEN sum(d7) / count(*) END AS day_7_share,
       CASE WHEN cohort + 7 <= (SELECT max(day) FROM site) THEN sum(w1) / count(*) END AS week_1_share,
       CASE WHEN cohort + 28 <= (SELECT max(day) FROM site) THEN sum(w4) / count(*) END AS week_4_share
FROM marks GROUP BY cohort""",
}
