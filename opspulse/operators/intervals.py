"""Shifts: intervals to hours, staffing grids, activity outside shifts, on-call labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import ceil_hour, floor_hour, round_hour_even
from .timeseries import islands


def expand_intervals(df: DataFrame, start: str, end: str, edge: str = "ceil", ts: str = "ds") -> DataFrame:
    """One row for each hour of [start, end) after rounding both ends; empty intervals give no rows."""
    to = {"ceil": ceil_hour, "even": round_hour_even, "floor": floor_hour}[edge]
    hour = F.expr("interval 1 hour")
    a, b = to(start), to(end)
    hours = F.when(a < b, F.sequence(a, b - hour, hour))  # sequence would run backwards otherwise
    return df.withColumn(ts, F.explode(hours))


def staffing_steps(df: DataFrame, start: str, end: str, by: list[str], edge: str = "ceil", name: str = "staff") -> DataFrame:
    """by + (start, end, name): the longest spans of a constant number of open intervals, none where it is 0.

    A sweep over the edges: +1 where an interval opens, -1 where it closes, added up by key and hour
    before any shuffle, then a running sum. Rows grow with the edges, not with the hours in between.
    """
    to = {"ceil": ceil_hour, "even": round_hour_even, "floor": floor_hour}[edge]
    keys = [F.col(c) for c in by]
    spans = df.select(*keys, to(start).alias("_a"), to(end).alias("_b")).where(F.col("_a") < F.col("_b"))
    edges = spans.select(*keys, F.explode(F.array(F.struct(F.col("_a").alias("at"), F.lit(1).alias("d")), F.struct(F.col("_b").alias("at"), F.lit(-1).alias("d")))).alias("e"))
    moved = edges.groupBy(*keys, F.col("e.at").alias("start")).agg(F.sum("e.d").alias("_d")).where("_d <> 0")
    w = Window.partitionBy(*keys).orderBy("start")
    steps = moved.select(*keys, "start", F.lead("start").over(w).alias("end"), F.sum("_d").over(w).alias(name))
    return steps.where(F.col(name) > 0)


def staffing_counts(df: DataFrame, start: str, end: str, by: list[str], edge: str = "ceil", ts: str = "ds", name: str = "staff") -> DataFrame:
    """by + (ts, name): how many intervals are open in each hour; hours are made last, from the steps, without a shuffle."""
    steps = staffing_steps(df, start, end, by, edge, name)
    hour = F.expr("interval 1 hour")
    return steps.select(*[F.col(c) for c in by], F.explode(F.sequence("start", F.col("end") - hour, hour)).alias(ts), name)


def staffing_by_person(shifts: DataFrame, people: list[str], seq: str = "scheduled_shift_id", fill: str = "NotWorking") -> DataFrame:
    """Hour x person with the first shift type of the hour. shifts: ds, person, shift_type, seq; unmapped types never count."""
    known = shifts.where(F.col("shift_type").isNotNull())
    wide = known.groupBy("ds").pivot("person", people).agg(F.min_by("shift_type", seq))
    return wide.na.fill(fill, subset=people)


def staffing_by_code(shifts: DataFrame, codes: list[str], seq: str = "scheduled_shift_id") -> DataFrame:
    """Hour x code with the person written last, for every hour of the grid. shifts: ds, code, person, seq."""
    grid = shifts.agg(F.min("ds").alias("a"), F.max("ds").alias("b")).select(
        F.explode(F.sequence(floor_hour("a"), floor_hour("b"), F.expr("interval 1 hour"))).alias("ds")
    )
    wide = shifts.groupBy("ds").pivot("code", codes).agg(F.max_by("person", seq))
    return grid.join(wide, "ds", "left")


def in_shift(activity: DataFrame, shifts: DataFrame, by: str = "user_id", ts: str = "ts", how: str = "left_semi") -> DataFrame:
    """Activity inside (left_semi) or outside (left_anti) the half-open shifts of the same person.

    The interval join is an equi join on (person, day): a shift is listed under each day it touches.
    """
    days = F.explode(F.sequence(F.to_date("shift_start"), F.to_date("shift_end"), F.expr("interval 1 day")))
    by_day = shifts.where(F.col("shift_start") < F.col("shift_end")).select(F.col(by).alias("_by"), "shift_start", "shift_end", days.alias("_day"))
    hit = (F.col(by) == F.col("_by")) & (F.to_date(ts) == F.col("_day")) & (F.col(ts) >= F.col("shift_start")) & (F.col(ts) < F.col("shift_end"))
    return activity.join(by_day, hit, how)


def activity_oncall(activity: DataFrame, oncall: DataFrame, regular: DataFrame) -> DataFrame:
    """Activity within an on-call shift and outside the person's regular shifts."""
    return in_shift(in_shift(activity, oncall), regular, how="left_anti")


def oncall_busy(activity: DataFrame, oncall: DataFrame, regular: DataFrame, max_gap: str = "2 hours", min_len: int = 2) -> DataFrame:
    """(ds, oncall_busy): hours inside busy blocks; the gap and the least length are our parameters."""
    blocks = islands(activity_oncall(activity, oncall, regular), ["user_id"], "ts", max_gap, min_len)
    hours = F.explode(F.sequence(floor_hour("start"), floor_hour("end"), F.expr("interval 1 hour")))
    return blocks.select(hours.alias("ds")).distinct().select("ds", F.lit(1.0).alias("oncall_busy"))
