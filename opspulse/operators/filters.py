"""Filters and row selection by time, always per site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_ts(df: DataFrame, id: str = "id", ts: str = "ds") -> DataFrame:
    """(id, max_ds): partial aggregation, one row a site."""
    return df.groupBy(id).agg(F.max(ts).alias("max_ds"))


def latest(df: DataFrame, id: str = "id", ts: str = "ds") -> DataFrame:
    """The newest row of each site."""
    row = F.max_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), ts)
    return df.groupBy(F.col(id).alias("_id")).agg(row.alias("r")).select("r.*")


def future_rows(df: DataFrame, known: DataFrame, id: str = "id", ts: str = "ds") -> DataFrame:
    """Rows after the last known hour of their site."""
    return df.join(latest_ts(known, id, ts), id).where(F.col(ts) > F.col("max_ds")).drop("max_ds")


def on_latest_date(df: DataFrame, id: str = "id", ts: str = "ds") -> DataFrame:
    return df.join(latest_ts(df, id, ts), id).where(F.to_date(ts) == F.to_date("max_ds")).drop("max_ds")


def same_weekday_as_latest(df: DataFrame, id: str = "id", ts: str = "ds") -> DataFrame:
    return df.join(latest_ts(df, id, ts), id).where(F.weekday(ts) == F.weekday("max_ds")).drop("max_ds")


def around(df: DataFrame, ts: str, now: Column, before: str, after: str) -> DataFrame:
    """Within [now - before, now + after]; before and after are interval texts such as '12 hours'."""
    return df.where(F.col(ts).between(now - F.expr(f"interval {before}"), now + F.expr(f"interval {after}")))


def yesterday(df: DataFrame, ts: str, now: Column) -> DataFrame:
    today = F.date_trunc("day", now).cast("timestamp_ntz")
    return df.where((F.col(ts) >= today - F.expr("interval 1 day")) & (F.col(ts) < today))


def local_day(df: DataFrame, ts: str, tz: str, today: Column, src: str = "UTC") -> DataFrame:
    """Rows whose date in the zone is today."""
    return df.where(F.to_date(F.convert_timezone(F.lit(src), F.lit(tz), F.col(ts))) == today)


def at_hour(df: DataFrame, ts: str, hour: int) -> DataFrame:
    return df.where(F.hour(ts) == hour)


def asof(df: DataFrame, ts: str, cutoff: Column, closed: str = "right") -> DataFrame:
    """History up to the cutoff: <= for closed='right', < for 'left'."""
    return df.where(F.col(ts) <= cutoff if closed == "right" else F.col(ts) < cutoff)


def horizon(df: DataFrame, ts: str, cutoff: Column, steps: int, closed: str = "right") -> DataFrame:
    """The steps hours after the history of the same convention."""
    end = cutoff + F.make_dt_interval(hours=F.lit(steps))
    return df.where((F.col(ts) > cutoff) & (F.col(ts) <= end) if closed == "right" else (F.col(ts) >= cutoff) & (F.col(ts) < end))


def for_target(df: DataFrame, id: str, target: str) -> DataFrame:
    return df.where((F.col("id") == id) & (F.col("target_name") == target))


def refresh_window(df: DataFrame, col: str, days: int = 7) -> DataFrame:
    """One row (latest, since, until): what to fetch anew around the newest stamp."""
    top = df.agg(F.max(col).alias("latest"))
    step = F.make_dt_interval(days=F.lit(days))
    return top.select("latest", (F.col("latest") - step).alias("since"), (F.col("latest") + step).alias("until"))


def _ranked(df: DataFrame, by: list[str], order: Column, n: int) -> DataFrame:
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(order)))
    return ranked.where(F.col("_n") <= n).drop("_n")


def last_n(df: DataFrame, n: int, by: list[str] = ["id"], ts: str = "ds") -> DataFrame:  # noqa: B006
    return _ranked(df, by, F.col(ts).desc(), n)


def first_n(df: DataFrame, n: int, by: list[str] = ["id"], ts: str = "ds") -> DataFrame:  # noqa: B006
    return _ranked(df, by, F.col(ts).asc(), n)
