from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hiatus.operators import regression, series
from hiatus.operators.sessions import summarize_events
from hiatus.plans.forecast import (
    forecast_history,
    forecast_top_user,
    forecast_users,
    history_and_forecast,
)

# Monthly session counts of one listener, February 2005 to May
# 2009, and the published model results for them.
SESSIONS_PER_MONTH = [
    17, 44, 63, 33, 89, 51, 76, 65, 116, 112, 121, 123, 97, 108, 90, 122, 129, 127, 134,
    101, 101, 101, 102, 105, 92, 97, 67, 38, 74, 177, 182, 181, 205, 194, 182, 202, 167,
    173, 153, 143, 195, 237, 192, 143, 229, 231, 227, 219, 197, 192, 153, 128,
]
COEFFICIENTS = {
    "intercept": 30.799183225370953,
    "time_index": 1.3336725531802451,
    "month_sin": -14.706776590237862,
    "month_cos": 5.844643094282122,
    "lag_1": 0.5170765307955797,
    "lag_2": -0.13838530659598958,
    "lag_3": 0.014651720482828146,
    "rolling_mean_3": 0.13111431489412229,
}
FORECAST = [162.80384424345232, 191.88239407630155, 212.29095647115363]
HOLDOUT_ERROR = 19.85104237460891
FORECAST_WITHOUT_REFIT = [175.82, 207.68, 224.13]


def month(index, first=date(2005, 2, 1)):
    count = first.year * 12 + first.month - 1 + index
    return date(count // 12, count % 12 + 1, 1)


def history_of(spark, **users):
    rows = [
        (month(i), user, float(v), "session_count")
        for user, values in users.items()
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(
        rows, "month_start date, user_id string, selected_metric double, metric_name string"
    )


@pytest.fixture(scope="module")
def golden(spark):
    return forecast_history(history_of(spark, u=SESSIONS_PER_MONTH))


def test_golden_coefficients(golden):
    rows = golden.coefficients.collect()
    assert [r.feature_name for r in rows] == list(COEFFICIENTS)
    assert {r.feature_name: r.coefficient for r in rows} == pytest.approx(COEFFICIENTS, abs=1e-9)


def test_golden_forecast(golden):
    rows = golden.forecast.orderBy("forecast_step").collect()
    assert [r.predicted_value for r in rows] == pytest.approx(FORECAST, abs=1e-9)
    assert [r.predicted_value_rounded for r in rows] == [163, 192, 212]
    assert [r.month_start for r in rows] == [date(2009, 6, 1), date(2009, 7, 1), date(2009, 8, 1)]
    assert [r.forecast_step for r in rows] == [1, 2, 3]
    assert golden.forecast.columns == [
        "month_start", "predicted_value", "predicted_value_rounded", "forecast_step",
        "user_id", "metric_name",
    ]


def test_golden_validation(golden):
    [errors] = golden.errors.collect()
    assert errors.validation_mae == pytest.approx(HOLDOUT_ERROR, abs=1e-9)
    assert (errors.validation_train_rows, errors.model_rows) == (43, 49)
    table = golden.validation.collect()
    assert len(table) == 6
    mean = sum(r.absolute_error for r in table) / 6
    assert mean == pytest.approx(HOLDOUT_ERROR, abs=1e-9)


def test_forecast_without_refit(spark):
    tables = forecast_history(history_of(spark, u=SESSIONS_PER_MONTH), refit=False)
    values = [r.predicted_value for r in tables.forecast.orderBy("forecast_step").collect()]
    assert values == pytest.approx(FORECAST_WITHOUT_REFIT, abs=5e-3)


def test_users_do_not_influence_each_other(spark):
    others = [(i * 37) % 11 for i in range(30)]
    history = history_of(spark, a=others, u=SESSIONS_PER_MONTH, z=others[:10])
    rows = forecast_history(history).forecast.filter("user_id = 'u'").orderBy("forecast_step")
    assert [r.predicted_value for r in rows.collect()] == pytest.approx(FORECAST, abs=1e-9)


def test_series_of_three_months_has_no_model(spark):
    tables = forecast_history(history_of(spark, u=[1, 2, 3]))
    assert tables.models.count() == 0
    assert tables.forecast.count() == 0


def test_validation_starts_at_sixteen_months(spark):
    values = [(i * 7) % 5 + 1 for i in range(16)]
    errors = {
        r.user_id: r
        for r in forecast_history(history_of(spark, short=values[:15], long=values)).errors.collect()
    }
    assert errors["short"].validation_mae is None
    assert (errors["short"].model_rows, errors["short"].validation_train_rows) == (12, 12)
    assert errors["long"].validation_mae is not None
    assert (errors["long"].model_rows, errors["long"].validation_train_rows) == (13, 7)


def test_falling_series_is_clamped_and_feeds_back(spark):
    values = [300 - 12 * i for i in range(25)]
    rows = forecast_history(history_of(spark, u=values), periods=4).forecast.collect()
    assert min(r.predicted_value for r in rows) == 0.0
    assert all(r.predicted_value >= 0 for r in rows)
    assert len(rows) == 4


def test_halves_round_to_even(spark):
    from hiatus.functions import rounded_half_even

    frame = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (3.4,)], "x double")
    assert [r[0] for r in frame.select(rounded_half_even(F.col("x"))).collect()] == [0, 2, 2, 3]


def test_periods_must_be_positive(golden):
    with pytest.raises(ValueError):
        regression.recursive_forecast(golden.models, 0)


def sessions_at(events, *starts, user="u"):
    return summarize_events(events(*[(user, s) for s in starts]))


def test_missing_month_is_filled_with_zero(events):
    sessions = sessions_at(
        events, "2024-01-05 10:00:00", "2024-01-05 10:10:00", "2024-03-02 09:00:00"
    )
    for metric, expected in (
        ("session_count", [1.0, 0.0, 1.0]),
        ("avg_session_duration_minutes", [10.0, 0.0, 0.0]),
    ):
        rows = series.monthly_history(sessions, metric).orderBy("month_start").collect()
        assert [r.month_start for r in rows] == [month(i, date(2024, 1, 1)) for i in range(3)]
        assert [r.selected_metric for r in rows] == expected
        assert {r.metric_name for r in rows} == {metric}


def test_long_pause_fills_every_month(events):
    sessions = sessions_at(events, "2019-12-31 23:59:59", "2022-02-01 00:00:00")
    rows = series.monthly_history(sessions).orderBy("month_start").collect()
    assert [r.month_start for r in rows] == [month(i, date(2019, 12, 1)) for i in range(27)]
    assert sum(r.session_count for r in rows) == 2


def test_unknown_metric(events):
    sessions = sessions_at(events, "2024-01-05 10:00:00")
    for build in (series.monthly_history, series.top_user_history, forecast_users, forecast_top_user):
        with pytest.raises(ValueError):
            build(sessions, "plays")


def test_features_of_a_short_series(spark):
    rows = (
        series.series_features(history_of(spark, u=[4, 6, 8, 10, 12]))
        .orderBy("month_start")
        .collect()
    )
    assert [r.time_index for r in rows] == [0, 1, 2, 3, 4]
    assert [r.lag_1 for r in rows] == [None, 4, 6, 8, 10]
    assert [r.rolling_mean_3 for r in rows] == [None, 4, 5, 6, 8]
    assert rows[0].month_sin == pytest.approx(0.8660254037844386)
    usable = series.usable_rows(series.series_features(history_of(spark, u=[4, 6, 8, 10, 12])))
    assert [r.lag_3 for r in usable.orderBy("month_start").collect()] == [4, 6]


def busy_and_quiet(events):
    start = datetime(2020, 1, 15, 12)
    rows = [("busy", str(start + timedelta(days=11 * i + i % 7))) for i in range(80)]
    rows += [("quiet", str(start + timedelta(days=31 * i))) for i in range(25)]
    return summarize_events(events(*rows))


def test_top_user_tables_equal_those_among_all_users(events):
    sessions = busy_and_quiet(events)
    top = forecast_top_user(sessions)
    everyone = forecast_users(sessions)
    assert {r.user_id for r in top.history.collect()} == {"busy"}
    assert top.history.first().top_user_session_count == 80

    def values(frame):
        rows = frame.filter("user_id = 'busy'").orderBy("forecast_step").collect()
        return [r.predicted_value for r in rows]

    assert values(top.forecast) == pytest.approx(values(everyone.forecast), abs=1e-9)
    assert forecast_top_user(sessions.limit(0)).forecast.count() == 0


def test_chosen_users_and_combined_axis(events, spark):
    sessions = busy_and_quiet(events)
    chosen = spark.createDataFrame([("quiet",)], "user_id string")
    tables = forecast_users(sessions, users=chosen, periods=2)
    combined = history_and_forecast(tables).orderBy("month_start").collect()
    assert {r.user_id for r in combined} == {"quiet"}
    assert [r.is_forecast for r in combined][-3:] == [False, True, True]
    assert combined[-2].month_start == month(1, combined[-3].month_start)


def test_monthly_counts_add_up_to_the_sessions(events):
    sessions = busy_and_quiet(events)
    totals = {
        r.user_id: r.user_session_count
        for r in series.with_series_totals(series.monthly_history(sessions)).collect()
    }
    assert totals == {"busy": 80, "quiet": 25}


def test_head_tail_and_holdout(spark):
    history = history_of(spark, u=range(10), v=range(3))
    assert series.series_head(history, 4).count() == 7
    tail = series.series_tail(history, 2).orderBy("user_id", "month_start").collect()
    assert [r.selected_metric for r in tail] == [8, 9, 1, 2]
    split = series.holdout_split(history, 2)
    assert split.filter("is_holdout").count() == 4
