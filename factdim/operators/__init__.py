"""The operators: DataFrame in, DataFrame out."""

from .cumulative import (
    as_date_map,
    backfill_actor_status,
    backfill_actors,
    backfill_dates,
    cumulate_actors,
    cumulate_dates,
)
from .datelist import datelist_int
from .experiments import assign_cells, cell_metrics, cell_sizes
from .growth import daily_growth, growth_accounting, player_state, retention
from .matches import (
    avg_kills_per_game,
    bucketed_match_join,
    hot_match_join,
    match_fact,
    medal_maps,
    most_played_map,
    most_played_playlist,
    with_completion_day,
)
from .metrics import aggregate_profit, engagement, unit_profit
from .monthly import (
    daily_activity,
    monthly_array_backfill,
    monthly_array_explode,
    monthly_array_increment,
    monthly_array_totals,
)
from .ordered import rolling_sum, running_totals, slot_of
from .quality import (
    consecutive_drop_alert,
    freshness,
    missing_periods,
    schema_conformance,
    volume_drop,
)
from .relational import (
    assert_unique_key,
    checked_broadcast,
    dedup,
    duplicate_keys,
    ordered_desc,
    outside_domain,
    preview,
    split_null_keys,
    top_with_ties,
    with_exists_flag,
)
from .rollups import (
    grouping_sets_points,
    longest_streak,
    max_wins_in_stretch,
    team_game_outcomes,
    team_wins,
    top_player_for_team,
    top_player_season,
    top_team_wins,
)
from .scd import scd2_backfill, scd2_increment
from .sessions import session_stats, sessionize
from .visitors import count_visitors, trailing_visitors, visitor_bitmaps

__all__ = [name for name in dir() if not name.startswith("_")]
