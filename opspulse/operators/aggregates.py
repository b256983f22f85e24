"""Roll-ups and profiles; partial and final hash aggregation throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .filters import last_n, same_weekday_as_latest


def daily_total(df: DataFrame, value: str, id: str = "id", ts: str = "ds", drop_partial: bool = True) -> DataFrame:
    """(id, date, total); a site's last day is partial and goes."""
    days = df.groupBy(id, F.to_date(ts).alias("date")).agg(F.sum(value).alias("total"))
    if not drop_partial:
        return days
    top = F.max("date").over(Window.partitionBy(id))
    return days.withColumn("_top", top).where(F.col("date") < F.col("_top")).drop("_top")


def hour_profile(df: DataFrame, value: str, id: str = "id", ts: str = "ds", same_weekday: bool = False, last: int | None = None) -> DataFrame:
    """(id, hour, mean), over all rows, the latest row's weekday, or the last n rows."""
    rows = last_n(df, last, [id], ts) if last else df
    rows = same_weekday_as_latest(rows, id, ts) if same_weekday else rows
    return rows.groupBy(id, F.hour(ts).alias("hour")).agg(F.avg(value).alias("mean"))


def hour_bands(df: DataFrame, value: str, k: float = 2.0, id: str = "id", ts: str = "ds") -> DataFrame:
    """(id, hour, mean, sd, zone2 = mean + k sd)."""
    out = df.groupBy(id, F.hour(ts).alias("hour")).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
    return out.withColumn("zone2", F.col("mean") + k * F.col("sd"))


def zone(value: Column, mean: Column, high: Column) -> Column:
    return F.when(value >= high, "red").when(value >= mean, "yellow").otherwise("green")


def daily_peaks(df: DataFrame, metrics: list[str], id: str = "id", ts: str = "ds") -> DataFrame:
    return df.groupBy(id, F.to_date(ts).alias("date")).agg(*[F.max(m).alias(m) for m in metrics])


def peak_rows(long: DataFrame, by: list[str], ts: str = "ds", value: str = "value") -> DataFrame:
    """The row of each group's highest value, the first on a tie."""
    w = Window.partitionBy(*by).orderBy(F.col(value).desc_nulls_last(), F.col(ts))
    return long.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def midnight_totals(df: DataFrame, cols: list[str], id: str = "id", ts: str = "ds") -> DataFrame:
    """Cumulative columns at 00:00 of each site's latest day: yesterday's totals."""
    from .filters import latest_ts

    tops = latest_ts(df, id, ts)
    at = F.date_trunc("day", F.col("max_ds")).cast("timestamp_ntz")
    return df.join(tops, id).where(F.col(ts) == at).select(id, ts, *cols)


def mean_effects(effects: DataFrame, cols: list[str]) -> DataFrame:
    return effects.groupBy("target_name").agg(*[F.avg(c).alias(c) for c in cols])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n"))


def distinct_count(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count_distinct(col).alias("n"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def exceedance(long: DataFrame, since: str | None = None) -> DataFrame:
    """(id, metric, hours, days, days_per_row): how often the value passed its upper bound. long has ranges joined."""
    rows = long if since is None else long.where(F.col("ds") >= F.lit(since).cast("timestamp_ntz"))
    over = F.coalesce(F.col("value") > F.col("yhat_upper"), F.lit(False))
    out = rows.groupBy("id", "metric").agg(
        F.count_if(over).alias("hours"), F.count_distinct(F.when(over, F.to_date("ds"))).alias("days"), F.count("*").alias("_rows")
    )
    return out.select("id", "metric", "hours", "days", (F.col("days") / F.col("_rows")).alias("days_per_row"))
