"""Event-session and monthly-series analytics on Spark DataFrames."""

from hiatus.operators.identity import (
    ARTIST,
    TRACK,
    ambiguous_names,
    backfill_coverage,
    name_map,
    name_map_stats,
    recoverable_rows,
)
from hiatus.operators.profile import (
    dataset_profile,
    date_coverage,
    missing_profile,
    parsed_times,
    plays_per_month,
    plays_per_year,
    raw_quality,
    rows_missing,
    session_stats,
)
from hiatus.operators.ranking import (
    first_events,
    most_active_user,
    plays_per_user,
    top_sessions,
    top_songs,
    top_user,
    top_users,
)
from hiatus.operators.regression import fit_models, recursive_forecast, validation_errors
from hiatus.operators.series import (
    monthly_history,
    monthly_metrics,
    series_features,
    usable_rows,
)
from hiatus.operators.sessions import sessionize, summarize_events, summarize_sessionized
from hiatus.plans.forecast import forecast_history, forecast_top_user, forecast_users
from hiatus.plans.sessions import materialize, prepare, top_songs_in_top_sessions
from hiatus.schema import EVENT_COLUMNS, RAW_EVENTS, as_events
from hiatus.sources import load_events, read_export, read_tsv, stage_events, write_tsv

__all__ = [
    "ARTIST",
    "EVENT_COLUMNS",
    "RAW_EVENTS",
    "TRACK",
    "ambiguous_names",
    "as_events",
    "backfill_coverage",
    "dataset_profile",
    "date_coverage",
    "first_events",
    "fit_models",
    "forecast_history",
    "forecast_top_user",
    "forecast_users",
    "load_events",
    "materialize",
    "missing_profile",
    "monthly_history",
    "monthly_metrics",
    "most_active_user",
    "name_map",
    "name_map_stats",
    "parsed_times",
    "plays_per_month",
    "plays_per_user",
    "plays_per_year",
    "prepare",
    "raw_quality",
    "read_export",
    "read_tsv",
    "recoverable_rows",
    "recursive_forecast",
    "rows_missing",
    "series_features",
    "session_stats",
    "sessionize",
    "stage_events",
    "summarize_events",
    "summarize_sessionized",
    "top_sessions",
    "top_songs",
    "top_songs_in_top_sessions",
    "top_user",
    "top_users",
    "usable_rows",
    "validation_errors",
    "write_tsv",
]
