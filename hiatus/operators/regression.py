"""Linear autoregressive model per user: fit, validate, predict, roll forward.

A user's months are packed into one array (a few hundred entries at most), so
each user is one row and users are the unit of parallelism. Only the
least-squares solve runs in Python, on Arrow batches of many users; packing,
prediction, errors and the recursive forecast are column expressions.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiatus.functions import next_month, rounded_half_even
from hiatus.operators.series import HOLDOUT_MONTHS, usable_rows
from hiatus.schema import FEATURES

# Validation needs more than this many usable rows besides the held-out ones.
VALIDATION_MARGIN = 6

TERMS = ("intercept", *FEATURES)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _least_squares(design: pd.Series, target: pd.Series) -> pd.Series:
    """Minimum-norm least-squares coefficients for each row's flattened design matrix."""

    def solve(x, y):
        if y is None or len(y) == 0:
            return None
        return np.linalg.lstsq(np.reshape(x, (len(y), -1)), np.asarray(y), rcond=None)[0]

    return pd.Series([solve(x, y) for x, y in zip(design, target)], dtype=object)


def fit_models(
    features: DataFrame,
    target: str = "selected_metric",
    holdout: int = HOLDOUT_MONTHS,
    margin: int = VALIDATION_MARGIN,
) -> DataFrame:
    """One row per user with usable months: the packed months and two coefficient vectors.

    ``coefficients`` uses every usable month. ``holdout_coefficients`` leaves out
    the last ``holdout`` and is null unless ``holdout + margin`` months are
    exceeded. The rolling mean is the mean of the three lags, so the system is
    rank-deficient and the minimum-norm solution is the one reported.
    """
    month = F.struct(
        "month_start",
        F.array(F.lit(1.0), *FEATURES).alias("inputs"),
        F.col(target).alias("actual"),
    )
    packed = (
        usable_rows(features, target)
        .groupBy("user_id", "metric_name")
        .agg(F.array_sort(F.collect_list(month)).alias("months"))
        .withColumn("model_rows", F.size("months").cast("long"))
    )
    validated = F.col("model_rows") > holdout + margin
    training = F.when(
        validated,
        F.slice("months", F.lit(1), (F.col("model_rows") - holdout).cast("int")),
    )
    return packed.withColumns(
        {
            "is_validated": validated,
            "validation_train_rows": F.when(validated, F.col("model_rows") - holdout).otherwise(
                F.col("model_rows")
            ),
            "coefficients": _solve(F.col("months")),
            "holdout_coefficients": _solve(training),
        }
    )


def model_coefficients(models: DataFrame) -> DataFrame:
    """Long table of coefficients, intercept first.

    The constant list of terms is exploded, not the solution: a condition on the
    exploded array would be pushed below it and solve every system again.
    """
    return models.select(
        "user_id",
        "metric_name",
        "coefficients",
        F.posexplode(F.array(*map(F.lit, TERMS))).alias("position", "feature_name"),
    ).select(
        "user_id",
        "metric_name",
        "feature_name",
        F.col("coefficients")[F.col("position")].alias("coefficient"),
    )


def validation_table(models: DataFrame, holdout: int = HOLDOUT_MONTHS) -> DataFrame:
    """Held-out months with one-step predictions from true lags, not clamped."""
    held_out = models.filter("is_validated").select(
        "user_id",
        "metric_name",
        "holdout_coefficients",
        F.explode(F.slice("months", -holdout, holdout)).alias("month"),
    )
    predicted = _dot(F.col("month.inputs"), F.col("holdout_coefficients"))
    return held_out.select(
        "user_id",
        "metric_name",
        F.col("month.month_start").alias("month_start"),
        F.col("month.actual").alias("selected_metric"),
        predicted.alias("predicted_value"),
    ).withColumn("absolute_error", F.abs(F.col("selected_metric") - F.col("predicted_value")))


def validation_errors(models: DataFrame, holdout: int = HOLDOUT_MONTHS) -> DataFrame:
    """Mean absolute error per user; null where the series is too short to validate."""
    held_out = F.slice("months", -holdout, holdout)
    coefficients = F.col("holdout_coefficients")
    errors = F.transform(
        held_out, lambda m: F.abs(m["actual"] - _dot(m["inputs"], coefficients))
    )
    total = F.aggregate(errors, F.lit(0.0), lambda acc, e: acc + e)
    return models.select(
        "user_id",
        "metric_name",
        F.when(F.col("is_validated"), total / F.lit(float(holdout))).alias("validation_mae"),
        "validation_train_rows",
        "model_rows",
    )


def recursive_forecast(models: DataFrame, periods: int = 3, refit: bool = True) -> DataFrame:
    """The next ``periods`` months; each value is clamped at 0 and feeds the next step.

    ``refit=False`` uses the coefficients fitted without the held-out months.
    """
    if periods < 1:
        raise ValueError(f"periods must be at least 1: {periods}")
    fitted = models if refit else models.filter("is_validated")
    ready = fitted.select(
        "user_id",
        "metric_name",
        F.col("coefficients" if refit else "holdout_coefficients").alias("beta"),
        F.element_at("months", -1).alias("last"),
    )
    last_inputs = F.col("last.inputs")
    start = F.struct(
        F.col("last.actual").alias("newest"),
        _term(last_inputs, "lag_1").alias("second"),
        _term(last_inputs, "lag_2").alias("third"),
        F.array().cast("array<double>").alias("path"),
    )

    def advance(state: Column, step: Column) -> Column:
        month = next_month(F.col("last.month_start"), step)
        angle = F.lit(2.0 * math.pi) * F.month(month) / F.lit(12.0)
        lags = [state["newest"], state["second"], state["third"]]
        inputs = F.array(
            F.lit(1.0),
            _term(last_inputs, "time_index") + step,
            F.sin(angle),
            F.cos(angle),
            *lags,
            (lags[0] + lags[1] + lags[2]) / F.lit(3.0),
        )
        value = F.greatest(F.lit(0.0), _dot(inputs, F.col("beta")))
        return F.struct(
            value.alias("newest"),
            lags[0].alias("second"),
            lags[1].alias("third"),
            F.concat(state["path"], F.array(value)).alias("path"),
        )

    steps = F.sequence(F.lit(1), F.lit(periods))
    path = F.aggregate(steps, start, advance, lambda state: state["path"])
    return ready.select(
        "user_id",
        "metric_name",
        F.col("last.month_start").alias("last_month"),
        F.posexplode(path).alias("position", "predicted_value"),
    ).select(
        next_month(F.col("last_month"), F.col("position") + 1).alias("month_start"),
        "predicted_value",
        rounded_half_even(F.col("predicted_value")).alias("predicted_value_rounded"),
        (F.col("position") + 1).alias("forecast_step"),
        "user_id",
        "metric_name",
    )


def _solve(months: Column) -> Column:
    return _least_squares(
        F.flatten(F.transform(months, lambda m: m["inputs"])),
        F.transform(months, lambda m: m["actual"]),
    )


def _dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)


def _term(inputs: Column, name: str) -> Column:
    return F.element_at(inputs, TERMS.index(name) + 1)
