"""Monthly forecast: history, features, model, validation and forecast tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiatus.operators import regression, series


@dataclass(frozen=True)
class ForecastTables:
    """Lazy result tables, each keyed by ``user_id`` and ``metric_name``."""

    history: DataFrame
    models: DataFrame
    coefficients: DataFrame
    validation: DataFrame
    errors: DataFrame
    forecast: DataFrame


def forecast_history(history: DataFrame, periods: int = 3, refit: bool = True) -> ForecastTables:
    """Forecast from a monthly history, whatever produced it."""
    models = regression.fit_models(series.series_features(history))
    return ForecastTables(
        history=history,
        models=models,
        coefficients=regression.model_coefficients(models),
        validation=regression.validation_table(models),
        errors=regression.validation_errors(models),
        forecast=regression.recursive_forecast(models, periods, refit),
    )


def forecast_users(
    sessions: DataFrame,
    metric: str = "session_count",
    periods: int = 3,
    users: DataFrame | None = None,
    refit: bool = True,
) -> ForecastTables:
    """Forecast for every user, or for those listed in ``users``."""
    series.check_metric(metric)
    chosen = sessions
    if users is not None:
        chosen = sessions.join(users.select("user_id"), "user_id", "left_semi")
    history = series.with_series_totals(series.monthly_history(chosen, metric))
    return forecast_history(history, periods, refit)


def forecast_top_user(
    sessions: DataFrame, metric: str = "session_count", periods: int = 3
) -> ForecastTables:
    """Forecast for the user with the most sessions; empty when there are none."""
    history = series.with_series_totals(
        series.top_user_history(sessions, metric), "top_user_session_count"
    )
    return forecast_history(history, periods)


def history_and_forecast(tables: ForecastTables) -> DataFrame:
    """Observed and predicted months on one axis."""
    observed = tables.history.select(
        "user_id",
        "metric_name",
        "month_start",
        F.col("selected_metric").alias("value"),
        F.lit(False).alias("is_forecast"),
    )
    predicted = tables.forecast.select(
        "user_id",
        "metric_name",
        "month_start",
        F.col("predicted_value").alias("value"),
        F.lit(True).alias("is_forecast"),
    )
    return observed.unionByName(predicted)
