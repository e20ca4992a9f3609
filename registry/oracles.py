"""Independent SQL for every query, for DuckDB on the same tables."""

from __future__ import annotations

from registry.queries import DECIMALS, GIVEN_USER, MANY_SESSIONS, ORDER_GAP, PLAY_GAP

FEATURES = ("time_index", "month_sin", "month_cos", "lag_1", "lag_2", "lag_3")
TERMS = ("intercept", *FEATURES, "rolling_mean_3")

EVENT = "user_id, started_at, artist_id, artist_name, track_id, track_name, song_id"
SESSION = (
    "user_id, track_count, session_start, session_end, session_number, session_id, "
    "session_duration_seconds, session_duration_minutes"
)
HISTORY = "month_start, session_count, avg_session_duration_minutes, user_id"


def num(expression: str, name: str) -> str:
    return f"coalesce(nullif(round({expression}, {DECIMALS}), 0), 0.0) AS {name}"


def nullable_num(expression: str, name: str) -> str:
    rounded = f"round({expression}, {DECIMALS})"
    return f"CASE WHEN {rounded} = 0 THEN 0.0 ELSE {rounded} END AS {name}"


IDS = """
ids AS (
  SELECT event_id, ts, user_id, event_type, number,
    CASE WHEN event_id % 31 = 0 THEN NULL
         WHEN event_type = 'error' THEN 'error-' || (event_id % 2)
         ELSE 'id-' || event_type END AS artist_id,
    CASE WHEN event_id % 9 = 0 THEN NULL
         WHEN number::INTEGER % 10 = 0 THEN event_type || '-' || number || '-' || (event_id % 2)
         ELSE event_type || '-' || number END AS track_id
  FROM (SELECT *, json_extract_string(props, '$.k') AS number FROM events)
)"""

PLAYS = (
    IDS
    + """,
plays AS (
  SELECT user_id, ts AS started_at, artist_id, event_type AS artist_name, track_id,
    number AS track_name, coalesce(track_id, number) AS song_id, event_id
  FROM ids
)"""
)

RAW = (
    IDS
    + """,
raw_plays AS (
  SELECT user_id::VARCHAR AS user_id,
    CASE WHEN event_id % 103 = 0 THEN 'bad'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS started_at_raw,
    artist_id,
    CASE WHEN event_id % 97 <> 0 THEN event_type END AS artist_name,
    track_id,
    CASE WHEN event_id % 101 <> 0 THEN number END AS track_name
  FROM ids
)"""
)

NORMALIZED = (
    RAW
    + """,
normalized AS (
  SELECT * FROM (
    SELECT user_id, try_strptime(started_at_raw, '%Y-%m-%dT%H:%M:%SZ') AS started_at,
      artist_id, artist_name, track_id, track_name, coalesce(track_id, track_name) AS song_id
    FROM raw_plays)
  WHERE started_at IS NOT NULL AND track_name IS NOT NULL
)"""
)

ORDERS = """
nation_orders AS (
  SELECT c_nationkey AS user_id, o_orderdate AS started_at, c_mktsegment AS artist_name,
    o_orderpriority AS track_name, o_orderkey AS event_id
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""


def sessionized(source: str, gap_minutes: float) -> str:
    """Row-level sessions of ``source``, by windows over all of a user's events."""
    return f""",
stepped AS (
  SELECT *, lag(started_at) OVER (PARTITION BY user_id ORDER BY started_at, event_id)
    AS previous_started_at
  FROM {source}
),
flagged AS (
  SELECT *, CASE WHEN previous_started_at IS NULL
      OR epoch_us(started_at) - epoch_us(previous_started_at) > {round(gap_minutes * 60_000_000)}
    THEN 1 ELSE 0 END AS is_new_session
  FROM stepped
),
numbered AS (
  SELECT *, (sum(is_new_session) OVER (PARTITION BY user_id ORDER BY started_at, event_id
      ROWS UNBOUNDED PRECEDING))::BIGINT AS session_number
  FROM flagged
),
sessionized AS (
  SELECT *, epoch_us(started_at) // 1000000 - epoch_us(previous_started_at) // 1000000
      AS gap_seconds,
    user_id::VARCHAR || '-' || printf('%08d', session_number) AS session_id
  FROM numbered
),
sessions AS (
  SELECT user_id, track_count, session_start, session_end, session_number, session_id,
    seconds AS session_duration_seconds, {num("seconds / 60.0", "session_duration_minutes")}
  FROM (
    SELECT user_id, session_number, session_id, count(*) AS track_count,
      min(started_at) AS session_start, max(started_at) AS session_end,
      epoch_us(max(started_at)) // 1000000 - epoch_us(min(started_at)) // 1000000 AS seconds
    FROM sessionized GROUP BY user_id, session_number, session_id)
)"""


PLAY_SESSIONS = PLAYS + sessionized("plays", PLAY_GAP)
ORDER_SESSIONS = ORDERS + sessionized("nation_orders", ORDER_GAP)
SESSIONIZED = (
    f"{EVENT}, event_id, gap_seconds, is_new_session, previous_started_at, "
    "session_number, session_id"
)

SESSION_ORDER = "track_count DESC, session_start, user_id, session_id"
SONG_ORDER = "play_count DESC, session_count DESC, artist_name NULLS FIRST, track_name NULLS FIRST"


def top_sessions(count: int) -> str:
    return f"SELECT {SESSION} FROM sessions ORDER BY {SESSION_ORDER} LIMIT {count}"


def top_songs(session_count: int) -> str:
    return f"""
    SELECT artist_name, track_name, count(*) AS play_count,
      count(DISTINCT session_id) AS session_count, count(DISTINCT track_id) AS distinct_track_ids
    FROM sessionized WHERE session_id IN (
      SELECT session_id FROM sessions ORDER BY {SESSION_ORDER} LIMIT {session_count})
    GROUP BY artist_name, track_name ORDER BY {SONG_ORDER} LIMIT 10"""


def top_users(count: int) -> str:
    return f"""
    SELECT user_id, count(*) AS session_count, min(session_start) AS first_session_start,
      max(session_end) AS last_session_end
    FROM sessions GROUP BY user_id ORDER BY session_count DESC, user_id LIMIT {count}"""


ACTIVE_USER = (
    "SELECT user_id, count(*) AS play_count FROM plays GROUP BY user_id "
    "ORDER BY play_count DESC, user_id LIMIT 1"
)

FIRST_EVENTS = f""",
sample AS (
  SELECT * FROM plays WHERE user_id = (SELECT user_id FROM ({ACTIVE_USER}))
  ORDER BY started_at, event_id LIMIT 40
)"""


def coverage(source: str) -> str:
    return f"""
    SELECT count(*) AS normalized_rows, min(started_at) AS min_started_at,
      max(started_at) AS max_started_at, count(DISTINCT year(started_at)) AS distinct_years,
      count(DISTINCT date_trunc('month', started_at)) AS distinct_months
    FROM {source}"""


def missing_rows(column: str) -> str:
    return f"""
    SELECT user_id, started_at, artist_id, artist_name, track_id, track_name
    FROM normalized WHERE {column} IS NULL"""


def name_map(names: str, column: str, distinct: str, example: str) -> str:
    return f""",
name_map AS (
  SELECT {names}, count(DISTINCT {column}) AS {distinct}, min({column}) AS {example}
  FROM normalized WHERE {column} IS NOT NULL GROUP BY {names}
)"""


TRACK_NAMES = "artist_name, track_name"
TRACK_MAP = NORMALIZED + name_map(
    TRACK_NAMES, "track_id", "distinct_track_ids_for_name_pair", "example_track_id"
)
ARTIST_MAP = NORMALIZED + name_map(
    "artist_name", "artist_id", "distinct_artist_ids_for_name", "example_artist_id"
)


def map_stats(distinct: str, unique: str, ambiguous: str) -> str:
    return f"""
    SELECT count(*) FILTER ({distinct} = 1) AS {unique},
      count(*) FILTER ({distinct} > 1) AS {ambiguous} FROM name_map"""


def recoverable(names: str, column: str, distinct: str, example: str) -> str:
    return f"""
    SELECT {EVENT}, {example}
    FROM normalized JOIN (SELECT * FROM name_map WHERE {distinct} = 1) USING ({names})
    WHERE {column} IS NULL"""


def backfill(kind: str, names: str, distinct: str) -> str:
    found = recoverable(names, f"{kind}_id", distinct, f"example_{kind}_id")
    missing = f"null_{kind}_id_rows"
    filled = f"exact_backfillable_null_{kind}_rows"
    return f"""
    SELECT {missing}, {filled},
      round(100.0 * {filled} / nullif({missing}, 0), 4)
        AS exact_backfillable_rate_pct_of_null_{kind}_rows
    FROM (SELECT (SELECT count(*) FROM normalized WHERE {kind}_id IS NULL) AS {missing},
                 (SELECT count(*) FROM ({found})) AS {filled})"""


MONTHLY = (
    ORDER_SESSIONS
    + """,
monthly AS (
  SELECT user_id, date_trunc('month', session_start)::TIMESTAMP AS month_start,
    count(*) AS session_count, avg(session_duration_seconds / 60.0) AS average_minutes
  FROM sessions GROUP BY ALL
),
bounds AS (
  SELECT user_id, min(month_start) AS low, max(month_start) AS high, sum(session_count)::BIGINT AS total
  FROM monthly GROUP BY user_id
),
calendar AS (
  SELECT user_id, unnest(generate_series(low, high, INTERVAL 1 MONTH)) AS month_start,
    high AS last_available_month, total
  FROM bounds
),
filled AS (
  SELECT c.user_id, c.month_start, c.last_available_month, c.total,
    coalesce(m.session_count, 0)::DOUBLE AS session_count,
    coalesce(m.average_minutes, 0.0) AS average_minutes
  FROM calendar c LEFT JOIN monthly m USING (user_id, month_start)
)"""
)


def history(metric: str = "session_count") -> str:
    value = "session_count" if metric == "session_count" else "average_minutes"
    return (
        MONTHLY
        + f""",
history AS (
  SELECT month_start, session_count, average_minutes, user_id, {value} AS selected_metric,
    '{metric}' AS metric_name, total, last_available_month
  FROM filled
)"""
    )


def features(metric: str = "session_count") -> str:
    return (
        history(metric)
        + """,
features AS (
  SELECT *,
    (row_number() OVER by_month - 1)::DOUBLE AS time_index,
    month(month_start)::DOUBLE AS month_number,
    sin(2.0 * pi() * month(month_start) / 12.0) AS month_sin,
    cos(2.0 * pi() * month(month_start) / 12.0) AS month_cos,
    lag(selected_metric, 1) OVER by_month AS lag_1,
    lag(selected_metric, 2) OVER by_month AS lag_2,
    lag(selected_metric, 3) OVER by_month AS lag_3,
    avg(selected_metric) OVER (PARTITION BY user_id ORDER BY month_start
      ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS rolling_mean_3
  FROM history
  WINDOW by_month AS (PARTITION BY user_id ORDER BY month_start)
),
usable AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY month_start DESC) AS from_end,
    count(*) OVER (PARTITION BY user_id) AS model_rows
  FROM features WHERE lag_3 IS NOT NULL
)"""
    )


def shown_history() -> str:
    return (
        f"month_start, {num('session_count', 'session_count')}, "
        f"{num('average_minutes', 'avg_session_duration_minutes')}, user_id, "
        f"{num('selected_metric', 'selected_metric')}, metric_name"
    )


def shown_features() -> str:
    columns = ("time_index", "month_number", "month_sin", "month_cos")
    lags = ("lag_1", "lag_2", "lag_3", "rolling_mean_3")
    return ", ".join(
        [shown_history(), *(num(c, c) for c in columns), *(nullable_num(c, c) for c in lags)]
    )


def fit(name: str, rows: str) -> str:
    """Least squares in plain SQL: orthogonalise the columns one after another.

    The rolling mean is left out of the system (it is the mean of the lags) and
    brought back by the step to the minimum-norm solution. An all-zero column
    gets coefficient 0; otherwise the columns must be linearly independent,
    which takes at least seven months per user.
    """
    count = 1 + len(FEATURES)
    start = ", ".join(
        ["1.0::DOUBLE AS x0", *(f"{c} AS x{i}" for i, c in enumerate(FEATURES, 1))]
    )
    parts = [
        f"{name}_0 AS (SELECT user_id, month_start, {start}, selected_metric AS y FROM {rows})"
    ]
    for k in range(count):
        by_user = "OVER (PARTITION BY user_id)"
        slope = "coalesce(sum(x{k} * {v}) {w} / nullif(sum(x{k} * x{k}) {w}, 0), 0)"
        later = [f"x{j}" for j in range(k + 1, count)] + ["y"]
        slopes = ", ".join(
            f"{slope.format(k=k, v=v, w=by_user)} AS s{k}_{v}" for v in later
        )
        parts.append(f"{name}_s{k} AS (SELECT *, {slopes} FROM {name}_{k})")
        kept = ", ".join(f"{v} - s{k}_{v} * x{k} AS {v}" for v in later)
        parts.append(
            f"{name}_{k + 1} AS (SELECT * REPLACE ({kept}) FROM {name}_s{k})"
        )
    known = [f"s{k}_{v}" for k in range(count) for v in [f"x{j}" for j in range(k + 1, count)] + ["y"]]
    one = ", ".join(f"any_value({c}) AS {c}" for c in known)
    parts.append(f"{name}_r AS (SELECT user_id, {one} FROM {name}_{count} GROUP BY user_id)")
    previous = f"{name}_r"
    for k in reversed(range(count)):
        rest = "".join(f" - s{k}_x{j} * b{j}" for j in range(k + 1, count))
        parts.append(f"{name}_b{k} AS (SELECT *, s{k}_y{rest} AS b{k} FROM {previous})")
        previous = f"{name}_b{k}"
    shift = "(b4 + b5 + b6) / 4.0"
    parts.append(
        f"{name} AS (SELECT user_id, b0 AS c0, b1 AS c1, b2 AS c2, b3 AS c3, "
        f"b4 - {shift} / 3.0 AS c4, b5 - {shift} / 3.0 AS c5, b6 - {shift} / 3.0 AS c6, "
        f"{shift} AS c7 FROM {previous})"
    )
    return ",\n" + ",\n".join(parts)


def full_fit(metric: str = "session_count") -> str:
    return features(metric) + fit("model", "usable")


def holdout_fit(metric: str = "session_count") -> str:
    return features(metric) + fit(
        "model", "(SELECT * FROM usable WHERE model_rows > 12 AND from_end > 6)"
    )


PREDICTED = (
    "c0 + c1 * time_index + c2 * month_sin + c3 * month_cos "
    "+ c4 * lag_1 + c5 * lag_2 + c6 * lag_3 + c7 * rolling_mean_3"
)

VALIDATION = (
    holdout_fit()
    + f""",
validation AS (
  SELECT user_id, metric_name, month_start, selected_metric, {PREDICTED} AS predicted
  FROM usable JOIN model USING (user_id) WHERE from_end <= 6
)"""
)


def forecast(only_top: bool = False) -> str:
    steps = ["""
origin AS (
  SELECT user_id, metric_name, month_start AS origin_month, time_index AS origin_index, total,
    selected_metric AS v0, lag_1 AS v1, lag_2 AS v2, model.* EXCLUDE (user_id)
  FROM usable JOIN model USING (user_id) WHERE from_end = 1
),
step_0 AS (SELECT *, 0 AS step, origin_month AS month_start, v0 AS predicted FROM origin)"""]
    for k in (1, 2, 3):
        month = f"month(origin_month + INTERVAL {k} MONTH)"
        value = (
            f"greatest(0.0, c0 + c1 * (origin_index + {k}) "
            f"+ c2 * sin(2.0 * pi() * {month} / 12.0) + c3 * cos(2.0 * pi() * {month} / 12.0) "
            "+ c4 * v0 + c5 * v1 + c6 * v2 + c7 * (v0 + v1 + v2) / 3.0)"
        )
        steps.append(
            f"step_{k} AS (SELECT * REPLACE ({k} AS step, {value} AS predicted, "
            f"{value} AS v0, v0 AS v1, v1 AS v2, "
            f"origin_month + INTERVAL {k} MONTH AS month_start) FROM step_{k - 1})"
        )
    pick = ""
    if only_top:
        pick = "WHERE user_id = (SELECT user_id FROM bounds ORDER BY total DESC, user_id LIMIT 1)"
    stacked = " UNION ALL ".join(f"SELECT * FROM step_{k}" for k in (1, 2, 3))
    steps.append(f"forecast AS (SELECT * FROM ({stacked}) {pick})")
    return ",\n".join(["", *steps])


SHOWN_FORECAST = (
    f"SELECT month_start, {num('predicted', 'predicted_value')}, "
    "round_even(predicted, 0)::INTEGER AS predicted_value_rounded, "
    "step::INTEGER AS forecast_step, user_id, metric_name FROM forecast"
)


def sql(tables: str, select: str) -> str:
    return f"WITH {tables.strip()}\n{select.strip()}"


ORACLES: dict[str, str] = {
    "events_normalized": sql(NORMALIZED, f"SELECT {EVENT} FROM normalized"),
    "parsed_times": sql(
        RAW,
        "SELECT started_at_raw, try_strptime(started_at_raw, '%Y-%m-%dT%H:%M:%SZ') AS started_at "
        "FROM raw_plays",
    ),
    "parquet_stage_roundtrip": sql(PLAYS, f"SELECT {EVENT}, event_id FROM plays"),
    "tsv_roundtrip": sql(NORMALIZED, f"SELECT {EVENT} FROM normalized"),
    "tsv_export_sessions": sql(PLAY_SESSIONS, f"SELECT {SESSION} FROM sessions"),
    "tsv_export_texts": sql(
        PLAYS,
        "SELECT event_id, CASE event_id % 7 WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN '\\N' "
        "ELSE '  \"a\"' || chr(9) || artist_name || ' ' END AS artist_name, started_at FROM plays",
    ),
    "parquet_folder_load": sql(PLAYS, f"SELECT {EVENT}, event_id FROM plays"),
    "prepared_sessions": sql(
        NORMALIZED
        + ", timed AS (SELECT *, row_number() OVER () AS event_id FROM normalized)"
        + sessionized("timed", PLAY_GAP),
        f"SELECT {SESSION} FROM sessions",
    ),
    "session_stream": sql(
        PLAY_SESSIONS,
        "SELECT user_id, track_count, session_start, session_end, session_duration_seconds, session_duration_minutes "
        f"FROM sessions WHERE session_end + INTERVAL {PLAY_GAP} MINUTE <= "
        "(SELECT date_trunc('milliseconds', max(started_at)) - INTERVAL 1 HOUR FROM plays)",
    ),
    "prepared_rows": sql(
        NORMALIZED
        + ", timed AS (SELECT *, row_number() OVER () AS event_id FROM normalized)"
        + sessionized("timed", PLAY_GAP),
        "SELECT user_id, sum(track_count)::BIGINT AS plays, max(session_number)::BIGINT AS sessions FROM sessions GROUP BY user_id",
    ),
    "session_summary_unnumbered": sql(PLAY_SESSIONS, f"SELECT {SESSION} FROM sessions"),
    "top_songs_session_join_many": sql(PLAY_SESSIONS, top_songs(MANY_SESSIONS)),
    "top_songs_pruned_join_many": sql(PLAY_SESSIONS, top_songs(MANY_SESSIONS)),
    "top_songs_from_rows": sql(PLAY_SESSIONS, top_songs(50)),
    "top_sessions_from_rows": sql(PLAY_SESSIONS, top_sessions(50)),
    "top_users_from_rows": sql(PLAY_SESSIONS, top_users(10)),
    "first_events_of_given_user": sql(
        PLAYS,
        f"SELECT {EVENT}, event_id FROM plays WHERE user_id = {GIVEN_USER} ORDER BY started_at, event_id LIMIT 40",
    ),
    "forecast_given_users": sql(full_fit() + forecast(), SHOWN_FORECAST + " WHERE user_id < 5"),
    "sessionized_events": sql(PLAY_SESSIONS, f"SELECT {SESSIONIZED} FROM sessionized"),
    "sessionized_events_hot": sql(PLAY_SESSIONS, f"SELECT {SESSIONIZED} FROM sessionized"),
    "session_summary_rows": sql(PLAY_SESSIONS, f"SELECT {SESSION} FROM sessions"),
    "session_summary_window": sql(PLAY_SESSIONS, f"SELECT {SESSION} FROM sessions"),
    "session_boundary_inclusive": sql(ORDER_SESSIONS, f"SELECT {SESSION} FROM sessions"),
    "session_summary_zero_gap": sql(ORDERS + sessionized("nation_orders", 0), f"SELECT {SESSION} FROM sessions"),
    "session_summary_second_gap": sql(PLAYS + sessionized("plays", 1 / 60), f"SELECT {SESSION} FROM sessions"),
    "session_stats": sql(
        PLAY_SESSIONS,
        f"SELECT count(*) AS total_sessions, {num('avg(track_count)', 'avg_tracks_per_session')}, "
        "max(track_count) AS max_tracks_in_one_session FROM sessions",
    ),
    "top_sessions": sql(PLAY_SESSIONS, top_sessions(50)),
    "longest_sessions_preview": sql(PLAY_SESSIONS, top_sessions(20)),
    "top_sessions_ranked": sql(
        PLAY_SESSIONS,
        f"SELECT *, row_number() OVER (ORDER BY {SESSION_ORDER}) AS rank "
        f"FROM ({top_sessions(50)})",
    ),
    "top_songs_interval_join": sql(PLAY_SESSIONS, top_songs(50)),
    "top_songs_session_join": sql(PLAY_SESSIONS, top_songs(50)),
    "top_songs_pruned_join": sql(PLAY_SESSIONS, top_songs(50)),
    "top_songs_many_sessions": sql(PLAY_SESSIONS, top_songs(MANY_SESSIONS)),
    "top_songs_ranked": sql(
        PLAY_SESSIONS,
        f"SELECT *, row_number() OVER (ORDER BY {SONG_ORDER}) AS rank FROM ({top_songs(50)})",
    ),
    "top_users": sql(PLAY_SESSIONS, top_users(10)),
    "top_user": sql(PLAY_SESSIONS, top_users(1)),
    "plays_per_user": sql(
        PLAYS, "SELECT user_id, count(*) AS play_count FROM plays GROUP BY user_id"
    ),
    "most_active_user": sql(PLAYS, ACTIVE_USER),
    "first_events_of_user": sql(PLAYS + FIRST_EVENTS, f"SELECT {EVENT}, event_id FROM sample"),
    "first_events_sessionized": sql(
        PLAYS + FIRST_EVENTS + sessionized("sample", PLAY_GAP),
        f"SELECT {SESSIONIZED} FROM sessionized",
    ),
    "dataset_profile": sql(
        NORMALIZED,
        "SELECT count(*) AS total_rows, count(DISTINCT user_id) AS distinct_users, "
        "min(started_at) AS min_started_at, max(started_at) AS max_started_at FROM normalized",
    ),
    "raw_quality": sql(
        RAW,
        """
        SELECT count(*) AS raw_rows,
          count(*) FILTER (try_strptime(started_at_raw, '%Y-%m-%dT%H:%M:%SZ') IS NULL)
            AS invalid_timestamp_rows,
          count(*) FILTER (track_name IS NULL) AS null_track_name_rows_raw,
          count(*) FILTER (artist_name IS NULL) AS null_artist_name_rows_raw
        FROM raw_plays""",
    ),
    "date_coverage": sql(NORMALIZED, coverage("normalized")),
    "order_date_coverage": sql(ORDERS, coverage("nation_orders")),
    "plays_per_year": sql(
        ORDERS,
        "SELECT year(started_at)::INTEGER AS year, count(*) AS play_count "
        "FROM nation_orders GROUP BY ALL",
    ),
    "plays_per_month": sql(
        ORDERS,
        "SELECT date_trunc('month', started_at)::TIMESTAMP AS month_start, "
        "count(*) AS play_count FROM nation_orders GROUP BY ALL",
    ),
    "missing_profile": sql(
        NORMALIZED,
        "SELECT count(*) AS total_rows, "
        + ", ".join(
            f"count(*) FILTER ({c} IS NULL) AS null_{c}_rows, "
            f"count(DISTINCT {c}) AS distinct_{c}s"
            for c in ("artist_id", "track_id", "artist_name", "track_name")
        )
        + " FROM normalized",
    ),
    "missing_track_rows": sql(NORMALIZED, missing_rows("track_id")),
    "missing_artist_rows": sql(NORMALIZED, missing_rows("artist_id")),
    "track_map": sql(TRACK_MAP, "SELECT * FROM name_map"),
    "track_map_stats": sql(
        TRACK_MAP,
        map_stats(
            "distinct_track_ids_for_name_pair", "unique_name_pairs", "ambiguous_name_pairs"
        ),
    ),
    "ambiguous_tracks": sql(
        TRACK_MAP,
        """
        SELECT * FROM name_map WHERE distinct_track_ids_for_name_pair > 1
        ORDER BY distinct_track_ids_for_name_pair DESC, artist_name NULLS FIRST,
          track_name NULLS FIRST LIMIT 20""",
    ),
    "recoverable_track_rows": sql(
        TRACK_MAP,
        recoverable(
            TRACK_NAMES, "track_id", "distinct_track_ids_for_name_pair", "example_track_id"
        ),
    ),
    "track_backfill": sql(
        TRACK_MAP, backfill("track", TRACK_NAMES, "distinct_track_ids_for_name_pair")
    ),
    "artist_map": sql(ARTIST_MAP, "SELECT * FROM name_map"),
    "artist_map_stats": sql(
        ARTIST_MAP,
        map_stats("distinct_artist_ids_for_name", "unique_artist_names", "ambiguous_artist_names"),
    ),
    "ambiguous_artists": sql(
        ARTIST_MAP,
        """
        SELECT * FROM name_map WHERE distinct_artist_ids_for_name > 1
        ORDER BY distinct_artist_ids_for_name DESC, artist_name NULLS FIRST LIMIT 20""",
    ),
    "recoverable_artist_rows": sql(
        ARTIST_MAP,
        recoverable(
            "artist_name", "artist_id", "distinct_artist_ids_for_name", "example_artist_id"
        ),
    ),
    "artist_backfill": sql(
        ARTIST_MAP, backfill("artist", "artist_name", "distinct_artist_ids_for_name")
    ),
    "monthly_metrics": sql(
        MONTHLY,
        f"SELECT user_id, month_start, session_count, "
        f"{num('average_minutes', 'avg_session_duration_minutes')} FROM monthly",
    ),
    "monthly_history": sql(
        history(),
        f"SELECT {shown_history()}, total AS user_session_count, last_available_month "
        "FROM history",
    ),
    "monthly_history_duration": sql(
        history("avg_session_duration_minutes"), f"SELECT {shown_history()} FROM history"
    ),
    "monthly_history_top_user": sql(
        history(),
        f"SELECT {shown_history()}, total AS top_user_session_count, last_available_month "
        "FROM history WHERE user_id = "
        "(SELECT user_id FROM bounds ORDER BY total DESC, user_id LIMIT 1)",
    ),
    "series_features": sql(features(), f"SELECT {shown_features()} FROM features"),
    "usable_rows": sql(features(), f"SELECT {shown_features()} FROM usable"),
    "holdout_split": sql(
        features(), f"SELECT {shown_features()}, from_end <= 6 AS is_holdout FROM usable"
    ),
    "history_head": sql(
        history(),
        f"SELECT {shown_history()} FROM history QUALIFY "
        "row_number() OVER (PARTITION BY user_id ORDER BY history.month_start) <= 12",
    ),
    "history_tail": sql(
        history(),
        f"SELECT {shown_history()} FROM history QUALIFY "
        "row_number() OVER (PARTITION BY user_id ORDER BY history.month_start DESC) <= 12",
    ),
    "model_coefficients": sql(
        full_fit(),
        " UNION ALL ".join(
            f"SELECT user_id, 'session_count' AS metric_name, '{term}' AS feature_name, "
            f"{num(f'c{i}', 'coefficient')} FROM model"
            for i, term in enumerate(TERMS)
        ),
    ),
    "validation_table": sql(
        VALIDATION,
        f"SELECT user_id, metric_name, month_start, {num('selected_metric', 'selected_metric')}, "
        f"{num('predicted', 'predicted_value')}, "
        f"{num('abs(selected_metric - predicted)', 'absolute_error')} FROM validation",
    ),
    "validation_mae": sql(
        VALIDATION,
        f"""
        SELECT user_id, metric_name,
          {nullable_num("avg(abs(v.selected_metric - v.predicted))", "validation_mae")},
          CASE WHEN model_rows > 12 THEN model_rows - 6 ELSE model_rows END
            AS validation_train_rows,
          model_rows
        FROM (SELECT DISTINCT user_id, metric_name, model_rows FROM usable)
        LEFT JOIN (SELECT user_id, selected_metric, predicted FROM validation) v USING (user_id)
        GROUP BY user_id, metric_name, model_rows""",
    ),
    "forecast_all": sql(full_fit() + forecast(), SHOWN_FORECAST),
    "forecast_all_duration": sql(
        full_fit("avg_session_duration_minutes") + forecast(), SHOWN_FORECAST
    ),
    "forecast_without_refit": sql(holdout_fit() + forecast(), SHOWN_FORECAST),
    "forecast_top": sql(full_fit() + forecast(only_top=True), SHOWN_FORECAST),
    "history_and_forecast": sql(
        full_fit() + forecast(),
        f"""
        SELECT user_id, metric_name, month_start, {num("selected_metric", "value")},
          FALSE AS is_forecast FROM history
        UNION ALL
        SELECT user_id, metric_name, month_start, {num("predicted", "value")},
          TRUE AS is_forecast FROM forecast""",
    ),
}
