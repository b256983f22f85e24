"""Flags, colours, alerts, snapshots, comparisons and what-if."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import pct_diff
from .aggregates import daily_peaks, midnight_totals
from .filters import latest_ts, local_day, on_latest_date
from .joins import align, compare_forecasts, with_ranges

# Colours.
RED, GOLD, GREEN, BLACK = "#FF0000", "#FFD700", "#008000", "#000000"


def yes_no(cond: Column) -> Column:
    """Null conditions are 'no': unknown bounds are not anomalous."""
    return F.when(F.coalesce(cond, F.lit(False)), "yes").otherwise("no")


def flag_anomalies(df: DataFrame, ranges: DataFrame | None = None, value: str = "value", name: str = "anomaly") -> DataFrame:
    """df with ranges joined (unless it has them) and a yes/no flag for values outside [lower, upper]."""
    rows = df if ranges is None else with_ranges(df, ranges)
    return rows.withColumn(name, yes_no((F.col(value) < F.col("yhat_lower")) | (F.col(value) > F.col("yhat_upper"))))


def colour(value: str, ladder: str = "history") -> Column:
    """history: red / gold / green, black when equal or unknown; forecast: and now: green when equal or unknown."""
    v, hi, mid = F.col(value), F.col("yhat_upper"), F.col("yhat")
    if ladder == "history":
        return F.when(v > hi, RED).when(v > mid, GOLD).when(v < mid, GREEN).otherwise(BLACK)
    return F.when(v > hi, RED).when(v > mid, GOLD).otherwise(GREEN)


def latest_long(long: DataFrame) -> DataFrame:
    """All metrics of each site's newest hour."""
    return long.join(latest_ts(long).withColumnRenamed("max_ds", "ds"), ["id", "ds"])


def kpi_status(long: DataFrame, ranges: DataFrame) -> DataFrame:
    """(id, ds, metric, value, yhat, yhat_lower, yhat_upper, critical) for the newest hour; metrics without a range are left out."""
    rows = latest_long(long).join(ranges.select("id", "ds", "metric", "yhat", "yhat_lower", "yhat_upper"), ["id", "ds", "metric"])
    return rows.withColumn("critical", F.coalesce(F.col("value") > F.col("yhat_upper"), F.lit(False)))


def latest_alerts(long: DataFrame, ranges: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """(id, ds, metric, value, yhat_upper rounded) where the newest value is strictly above its bound."""
    rows = long if metrics is None else long.where(F.col("metric").isin(metrics))
    return kpi_status(rows, ranges).where("critical").select("id", "ds", "metric", "value", F.round("yhat_upper", 1).alias("yhat_upper"))


def today_vs_range(long: DataFrame, ranges: DataFrame, metric: str, today: Column, tz: str = "UTC") -> DataFrame:
    rows = with_ranges(local_day(long.where(F.col("metric") == metric), "ds", tz, today, src=tz), ranges)
    return rows.withColumn("above", F.coalesce(F.col("value") > F.col("yhat_upper"), F.lit(False)))


def snapshot(long: DataFrame, ranges: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Newest value, range and description of every metric. dictionary: (metric, description), a fixed few rows."""
    return with_ranges(latest_long(long), ranges).join(F.broadcast(dictionary), "metric", "left")


def day_profile(long: DataFrame, ranges: DataFrame, metric: str, forecast: DataFrame | None = None) -> DataFrame:
    """(id, hour, expected, actual, is_now[, forecast]) for each site's latest day."""
    own = long.where(F.col("metric") == metric)
    today = on_latest_date(own).join(latest_ts(own), "id")
    actual = today.select("id", F.hour("ds").alias("hour"), F.col("value").alias("actual"), (F.col("ds") == F.col("max_ds")).alias("is_now"))
    day = ranges.where(F.col("metric") == metric).join(latest_ts(own), "id").where(F.to_date("ds") == F.to_date("max_ds"))
    expected = day.select("id", F.hour("ds").alias("hour"), F.col("yhat").alias("expected"))
    parts = [expected, actual]
    if forecast is not None:
        ahead = forecast.join(latest_ts(own), "id").where((F.to_date("ds") == F.to_date("max_ds")) & (F.col("ds") > F.col("max_ds")))
        parts.append(ahead.select("id", F.hour("ds").alias("hour"), F.col("predictions").alias("forecast")))
    return align(parts, ["id", "hour"], "full").withColumn("is_now", F.coalesce("is_now", F.lit(False)))


def morning_report(wide: DataFrame, cumulative: list[str], peaks: list[str]) -> DataFrame:
    """(id, totals at midnight, yesterday's peaks) for each site."""
    totals = midnight_totals(wide, cumulative)
    tops = daily_peaks(wide, peaks).withColumnsRenamed({p: f"peak_{p}" for p in peaks})
    yesterday = F.date_sub(F.to_date(F.col("ds")), 1)
    return totals.join(tops.withColumnRenamed("id", "_id"), (F.col("id") == F.col("_id")) & (F.col("date") == yesterday)).drop("_id", "date")


def forecast_anomaly_table(forecast: DataFrame, history: DataFrame, ranges: DataFrame, today: Column) -> DataFrame:
    """Long combined table: forecast and history beside each other with flags, colours, ranges and the day offset.

    forecast: (id, ds, metric, predictions, q20, q80); history: (id, ds, metric, value).
    """
    f = flag_anomalies(forecast, ranges, "predictions").withColumn("colour", colour("predictions", "forecast"))
    h = flag_anomalies(history, ranges, "value", "hist_anomaly").withColumn("hist_colour", colour("value", "history"))
    bounds = ["yhat", "yhat_lower", "yhat_upper"]
    both = align([f.drop(*bounds), h.drop(*bounds)], ["id", "ds", "metric"], "full")
    return with_ranges(both, ranges).withColumn("day_offset", F.datediff(F.to_date("ds"), today))


def variant_effects(forecasts: DataFrame, base: str, variants: list[str]) -> tuple[DataFrame, DataFrame]:
    """Hourly % difference of each variant to the base, and its mean for each target."""
    wide = compare_forecasts(forecasts, [base, *variants])
    hourly = wide.select("id", "ds", "target_name", *[pct_diff(v, base).alias(f"pct_{v}") for v in variants])
    return hourly, hourly.groupBy("target_name").agg(*[F.avg(f"pct_{v}").alias(f"pct_{v}") for v in variants])


def scenarios(future: DataFrame, hours: dict[str, int], column: str = "oncall_busy") -> DataFrame:
    """Each future row once for each scenario: column is 1.0 in its first hours, then 0.0."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("id").orderBy("ds"))
    table = F.explode(F.map_from_arrays(F.array(*map(F.lit, hours)), F.array(*map(F.lit, hours.values())))).alias("scenario", "_h")
    rows = future.withColumn("_n", rank).select("*", table)
    return rows.withColumn(column, (F.col("_n") <= F.col("_h")).cast("double")).drop("_n", "_h")


def what_if(scored: DataFrame, baseline: str, intervention: str, value: str = "predictions") -> DataFrame:
    """(id, ds, target_name, baseline, intervention, reduction) from rows scored for each scenario."""
    wide = scored.groupBy("id", "ds", "target_name").pivot("scenario", [baseline, intervention]).agg(F.max(value))
    return wide.withColumn("reduction", F.col(f"`{baseline}`") - F.col(f"`{intervention}`"))
