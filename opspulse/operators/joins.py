"""Joins of series with covariates, ranges and each other; all are equi joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import floor_hour


def join_staffing(df: DataFrame, staffing: DataFrame, on: list[str] = ["id", "ds"]) -> DataFrame:  # noqa: B006
    return df.join(staffing, on)


join_weather = join_staffing


def join_labels(df: DataFrame, labels: DataFrame, label: str = "oncall_busy", on: list[str] = ["ds"]) -> DataFrame:  # noqa: B006
    """Hours without a label are 0."""
    return df.join(labels, on, "left").withColumn(label, F.coalesce(F.col(label).cast("double"), F.lit(0.0)))


def with_ranges(df: DataFrame, ranges: DataFrame) -> DataFrame:
    return df.join(ranges.select("id", "ds", "metric", "yhat", "yhat_lower", "yhat_upper"), ["id", "ds", "metric"], "left")


def compare_forecasts(df: DataFrame, models: list[str], value: str = "predictions") -> DataFrame:
    """(id, ds, target_name, one column for each model): a union with a model column, pivoted once; complete rows only."""
    wide = df.groupBy("id", "ds", "target_name").pivot("model", models).agg(F.max(value))
    return wide.na.drop(subset=models)


def align(frames: list[DataFrame], on: list[str] = ["id", "ds"], how: str = "full") -> DataFrame:  # noqa: B006
    return reduce(lambda a, b: a.join(b, on, how), frames)


def join_observations(df: DataFrame, obs: DataFrame, ts: str = "ds", valid: str = "valid", on: str = "exact") -> DataFrame:
    """Left join with observations stamped on the hour ('exact'), or with the latest of each hour ('hour')."""
    if on == "hour":
        row = F.max_by(F.struct(*[F.col(f"`{c}`") for c in obs.columns]), valid)
        obs = obs.groupBy(floor_hour(valid).alias(ts)).agg(row.alias("r")).select(ts, "r.*")
    else:
        obs = obs.withColumn(ts, F.col(valid))
    return df.join(obs, ts, "left")


def future_covariates(staffing: DataFrame, weather: DataFrame, on: list[str] = ["id", "ds"]) -> DataFrame:  # noqa: B006
    return staffing.join(weather, on)


def with_actuals(forecast: DataFrame, actual: DataFrame, how: str = "inner", on: list[str] = ["id", "ds"]) -> DataFrame:  # noqa: B006
    return forecast.join(actual, on, how)


def daily_vs_forecast(daily: DataFrame, forecast: DataFrame, n: int = 7, id: str = "id", day: str = "date") -> DataFrame:
    """The last n days of each site with their forecast and the weekday's name."""
    from .filters import last_n

    return last_n(daily, n, [id], day).join(forecast, [id, day], "left").withColumn("weekday_name", F.date_format(day, "EEEE"))
