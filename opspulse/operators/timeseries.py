"""Regular hourly axes, fills, gaps, lags. Windows are always partitioned by series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import floor_hour
from .upsert import dedupe

HOUR = "interval 1 hour"


def ffill(df: DataFrame, cols: list[str], by: list[str] = ["id"], order: str = "ds") -> DataFrame:  # noqa: B006
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def bfill(df: DataFrame, cols: list[str], by: list[str] = ["id"], order: str = "ds") -> DataFrame:  # noqa: B006
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(0, Window.unboundedFollowing)
    return df.withColumns({c: F.first(c, ignorenulls=True).over(w) for c in cols})


def axis(df: DataFrame, id: str = "id", ts: str = "ds", step: str = HOUR) -> DataFrame:
    """Every step from a site's first to its last stamp."""
    ends = df.groupBy(id).agg(F.min(ts).alias("_a"), F.max(ts).alias("_b"))
    return ends.select(id, F.explode(F.sequence("_a", "_b", F.expr(step))).alias(ts))


def extend(df: DataFrame, h: int, id: str = "id", ts: str = "ds", unit: str = "hour") -> DataFrame:
    """The h steps after a site's last stamp."""
    last = df.groupBy(id).agg(F.max(ts).alias("_b"))
    one = F.expr(f"interval 1 {unit}")
    return last.select(id, F.explode(F.sequence(F.col("_b") + one, F.col("_b") + F.expr(f"interval {h} {unit}"), one)).alias(ts))


def regularize(df: DataFrame, targets: list[str], id: str = "id", ts: str = "ds", seq: list[str] = []) -> DataFrame:  # noqa: B006
    """Snap to the hour, keep the last row of an hour, complete the axis, fill targets forward, then backward."""
    snapped = df.withColumn("_raw", F.col(ts)).withColumn(ts, floor_hour(ts))
    one = dedupe(snapped, [id, ts], ["_raw", *seq]).drop("_raw")
    full = axis(one, id, ts).join(one, [id, ts], "left")
    return bfill(ffill(full, targets, [id], ts), targets, [id], ts)


def find_gaps(df: DataFrame, id: str = "id", ts: str = "ds", step_seconds: int = 3600, limit: int | None = 10) -> DataFrame:
    """(id, previous, ds, seconds) where two rows of a site are not one step apart; the first ``limit`` as a report."""
    before = F.lag(ts).over(Window.partitionBy(id).orderBy(ts))
    out = df.select(id, before.alias("previous"), ts).withColumn("seconds", F.timestamp_diff("SECOND", F.col("previous"), F.col(ts)))
    out = out.where(F.col("seconds") != step_seconds)
    return out if limit is None else out.orderBy(id, ts).limit(limit)


def assert_regular(df: DataFrame, id: str = "id", ts: str = "ds") -> DataFrame:
    """df, or an error that names the first gaps."""
    gaps = find_gaps(df, id, ts).collect()  # at most 10 rows
    if gaps:
        raise ValueError("not hourly: " + "; ".join(f"{r[0]} {r['previous']} -> {r[ts]}" for r in gaps))
    return df


def daily_from_cumulative(df: DataFrame, col: str, id: str = "id", ts: str = "ds", hour: int = 23, strict: bool = False) -> DataFrame:
    """(id, date, value): the next row's cumulative at the last hour; strict wants the next row one hour later."""
    w = Window.partitionBy(id).orderBy(ts)
    nxt = F.lead(col).over(w)
    if strict:
        nxt = F.when(F.lead(ts).over(w) == F.col(ts) + F.expr(HOUR), nxt)
    out = df.select(id, ts, nxt.alias("value")).where(F.hour(ts) == hour)
    return out.select(id, F.to_date(ts).alias("date"), "value")


def lag_features(df: DataFrame, id: str, ts: str, value: str, lags: int = 48, steps: int = 24) -> DataFrame:
    """(id, ds, lags array oldest first, y1..): the last ``lags`` values and the next ``steps``; incomplete rows go."""
    w = Window.partitionBy(id).orderBy(ts)
    past = F.collect_list(value).over(w.rowsBetween(1 - lags, 0))
    ahead = F.collect_list(value).over(w.rowsBetween(1, steps))
    out = df.select(id, ts, past.alias("lags"), ahead.alias("ahead"))
    return out.where((F.size("lags") == lags) & (F.size("ahead") == steps))


def islands(df: DataFrame, by: list[str], ts: str, max_gap: str = "1 hour", min_len: int = 1) -> DataFrame:
    """(by, island, start, end, n): runs whose stamps are at most max_gap apart, of at least min_len rows."""
    w = Window.partitionBy(*by).orderBy(ts)
    new = F.when(F.lag(ts).over(w).isNull() | (F.col(ts) > F.lag(ts).over(w) + F.expr(f"interval {max_gap}")), 1).otherwise(0)
    numbered = df.select(*by, ts, new.alias("_new")).withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = numbered.groupBy(*by, "island").agg(F.min(ts).alias("start"), F.max(ts).alias("end"), F.count("*").alias("n"))
    return out.where(F.col("n") >= min_len)
