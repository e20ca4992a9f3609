"""Monthly series per user and the feature frame built on them.

Every operator handles all users at once. A user has one row per calendar
month, so the per-user windows are small whatever the number of events.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hiatus.functions import next_month, utc_clock
from hiatus.schema import FEATURES, SERIES_METRICS

HOLDOUT_MONTHS = 6


def check_metric(metric: str) -> str:
    if metric not in SERIES_METRICS:
        raise ValueError(f"Unsupported metric {metric!r}; expected one of {SERIES_METRICS}")
    return metric


def monthly_metrics(sessions: DataFrame) -> DataFrame:
    """Sessions and their average minutes per user and month of session start."""
    month = F.trunc(utc_clock(F.col("session_start")).cast("date"), "month")
    return sessions.groupBy("user_id", month.alias("month_start")).agg(
        F.count(F.lit(1)).alias("session_count"),
        F.avg("session_duration_minutes").alias("avg_session_duration_minutes"),
    )


def monthly_history(sessions: DataFrame, metric: str = "session_count") -> DataFrame:
    """Gap-free monthly series of every user, from first to last month."""
    check_metric(metric)
    return fill_months(monthly_metrics(sessions), metric)


def top_user_history(sessions: DataFrame, metric: str = "session_count") -> DataFrame:
    """The monthly series of the user with the most sessions.

    A user's sessions are the sum over their months, so the user is picked from
    the monthly rows and the sessions are read once.
    """
    check_metric(metric)
    months = F.collect_list(
        F.struct("month_start", "session_count", "avg_session_duration_minutes")
    )
    picked = (
        monthly_metrics(sessions)
        .groupBy("user_id")
        .agg(F.sum("session_count").alias("total"), months.alias("months"))
        .orderBy(F.desc("total"), F.asc("user_id"))
        .limit(1)
    )
    return fill_months(picked.select("user_id", F.inline("months")), metric)


def fill_months(monthly: DataFrame, metric: str = "session_count") -> DataFrame:
    """Adds the months without a session, with 0 for both metrics.

    Each month row produces itself and the empty months up to the next one, so
    filling needs no calendar table and no join.
    """
    last_covered = F.coalesce(next_month(F.col("following_month"), -1), F.col("month_start"))
    months = F.sequence("month_start", last_covered, F.expr("interval 1 month"))
    following = F.lead("month_start").over(_by_month())
    filled = monthly.withColumn("following_month", following).select(
        "user_id",
        F.posexplode(months).alias("offset", "month_start"),
        F.col("session_count").cast("double").alias("count_value"),
        F.col("avg_session_duration_minutes").alias("average_value"),
    )
    observed = F.col("offset") == 0
    history = filled.select(
        "month_start",
        F.when(observed, F.col("count_value")).otherwise(0.0).alias("session_count"),
        F.when(observed, F.col("average_value"))
        .otherwise(0.0)
        .alias("avg_session_duration_minutes"),
        "user_id",
    )
    return history.withColumns(
        {"selected_metric": F.col(metric).cast("double"), "metric_name": F.lit(metric)}
    )


def with_series_totals(history: DataFrame, total: str = "user_session_count") -> DataFrame:
    """Adds each user's number of sessions and last month to every row."""
    whole = Window.partitionBy("user_id")
    return history.withColumns(
        {
            total: F.sum("session_count").over(whole).cast("long"),
            "last_available_month": F.max("month_start").over(whole),
        }
    )


def series_features(history: DataFrame, target: str = "selected_metric") -> DataFrame:
    """Trend, yearly season, three lags, and the mean of the three previous values."""
    in_order = _by_month()
    angle = F.lit(2.0 * math.pi) * F.month("month_start") / F.lit(12.0)
    return history.withColumns(
        {
            "time_index": (F.row_number().over(in_order) - 1).cast("double"),
            "month_number": F.month("month_start").cast("double"),
            "month_sin": F.sin(angle),
            "month_cos": F.cos(angle),
            **{f"lag_{k}": F.lag(target, k).over(in_order) for k in (1, 2, 3)},
            "rolling_mean_3": F.avg(target).over(in_order.rowsBetween(-3, -1)),
        }
    )


def usable_rows(features: DataFrame, target: str = "selected_metric") -> DataFrame:
    """Feature rows with nothing missing; the first three months of a series go."""
    return features.dropna(subset=[*FEATURES, target])


def holdout_split(usable: DataFrame, holdout: int = HOLDOUT_MONTHS) -> DataFrame:
    """Marks each user's last ``holdout`` rows as ``is_holdout``."""
    return usable.withColumn("is_holdout", _from_end() <= holdout)


def series_head(rows: DataFrame, count: int) -> DataFrame:
    """First ``count`` months of every user."""
    return _numbered(rows, F.row_number().over(_by_month()), count)


def series_tail(rows: DataFrame, count: int) -> DataFrame:
    """Last ``count`` months of every user."""
    return _numbered(rows, _from_end(), count)


def _numbered(rows: DataFrame, place, count: int) -> DataFrame:
    return rows.withColumn("_place", place).filter(F.col("_place") <= count).drop("_place")


def _by_month():
    return Window.partitionBy("user_id").orderBy("month_start")


def _from_end():
    return F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("month_start")))
