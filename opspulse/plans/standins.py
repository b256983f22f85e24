"""Inputs of the registered queries, derived from the events and orders tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.time import floor_hour
from ..operators.filters import latest_ts
from ..operators.forecast import seasonal_ranges
from ..operators.reshape import to_long

TYPES = ["click", "error", "purchase", "signup", "view"]
NOW = "2024-01-15 10:00:00"


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, ds, one count for each event type, n): three sites, hours without events are absent."""
    e = events(spark, sf_dir).select(
        F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string")).alias("id"), floor_hour("ts").alias("ds"), "event_type"
    )
    counts = [F.count_if(F.col("event_type") == t).alias(t) for t in TYPES]
    return e.groupBy("id", "ds").agg(*counts, F.count("*").alias("n"))


def long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_long(hourly(spark, sf_dir), TYPES)


def ranges(spark: SparkSession, sf_dir: str, newest: bool = False) -> DataFrame:
    """Ranges of all hours, or of each site's newest hour alone."""
    at = latest_ts(hourly(spark, sf_dir)).withColumnRenamed("max_ds", "ds") if newest else None
    return seasonal_ranges(long(spark, sf_dir), horizon=24, keep=None, season="hour_of_day", at=at)


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw report lines: text, hour ending, the date only on a day's first line."""
    h = hourly(spark, sf_dir)
    line = F.row_number().over(Window.partitionBy("id").orderBy("ds"))
    first = F.row_number().over(Window.partitionBy("id", F.to_date("ds")).orderBy("ds")) == 1
    return h.select(
        F.col("id").alias("file"), line.alias("line_no"),
        F.when(first, F.date_format("ds", "MM/dd/yy")).otherwise(" ").alias("dateflg"),
        (F.hour("ds") + 1).cast("string").alias("timeflg"),
        *[F.concat(F.col(t).cast("string"), F.lit(".9")).alias(t) for t in TYPES],
    )


def shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One shift for each person and day: first to last event, the first event's type as the code."""
    e = events(spark, sf_dir)
    return e.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.min("ts").alias("shift_start"), F.max("ts").alias("shift_end"), F.min_by("event_type", "ts").alias("code"), F.min("event_id").alias("scheduled_shift_id")
    )


def daily(spark: SparkSession, sf_dir: str, by: Column | None = None) -> DataFrame:
    """Orders of each day, for each value of ``by`` or for all."""
    return orders(spark, sf_dir).groupBy((F.lit("all") if by is None else by).alias("id"), F.to_date("o_orderdate").alias("date")).agg(F.count("*").alias("value"))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).where("event_type = 'view'")
    return e.groupBy(floor_hour("ts").alias("ds")).agg(F.round(F.avg("value"), 6).alias("temperature"))


def labels01(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).where("event_type = 'error'")
    return e.groupBy(floor_hour("ts").alias("ds")).agg(F.count("*").alias("c")).where("c > 3").select("ds", F.lit(1).alias("oncall_busy"))


COUNTS = ", ".join(f"count(*) FILTER (event_type = '{t}') AS {t}" for t in TYPES)
CTE = {
    "hourly": f"hourly AS (SELECT 's' || CAST(user_id % 3 AS VARCHAR) AS id, date_trunc('hour', ts) AS ds, {COUNTS}, count(*) AS n FROM events GROUP BY 1, 2)",
    "long": "long AS (" + " UNION ALL ".join(f"SELECT id, ds, '{t}' AS metric, CAST({t} AS DOUBLE) AS value FROM hourly" for t in TYPES) + ")",
    "tops": "tops AS (SELECT id, max(ds) AS max_ds FROM hourly GROUP BY id)",
    "stats": "stats AS (SELECT id, metric, hour(ds) AS slot, avg(value) AS yhat, stddev_samp(value) AS sd FROM long GROUP BY 1, 2, 3)",
    "ax": "ax AS (SELECT id, ds FROM hourly UNION ALL SELECT id, unnest(generate_series(max_ds + INTERVAL 1 HOUR, max_ds + INTERVAL 24 HOUR, INTERVAL 1 HOUR)) AS ds FROM tops)",
    "ranges": "ranges AS (SELECT ax.id, ax.ds, metric, yhat, yhat - 1.959964 * sd AS yhat_lower, yhat + 1.959964 * sd AS yhat_upper FROM ax JOIN stats ON ax.id = stats.id AND hour(ax.ds) = slot)",
    "shifts": "shifts AS (SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS shift_start, max(ts) AS shift_end, arg_min(event_type, ts) AS code, min(event_id) AS scheduled_shift_id FROM events GROUP BY 1, 2)",
    "daily": "daily AS (SELECT 'all' AS id, CAST(o_orderdate AS DATE) AS date, count(*) AS value FROM orders GROUP BY 2)",
    "weather": "weather AS (SELECT date_trunc('hour', ts) AS ds, round(avg(value), 6) AS temperature FROM events WHERE event_type = 'view' GROUP BY 1)",
    "labels01": "labels01 AS (SELECT date_trunc('hour', ts) AS ds, 1 AS oncall_busy FROM events WHERE event_type = 'error' GROUP BY 1 HAVING count(*) > 3)",
}
NEEDS = {"long": ["hourly"], "tops": ["hourly"], "stats": ["long"], "ax": ["tops"], "ranges": ["ax", "stats"]}


def sql(body: str, *names: str) -> str:
    """The body with the named inputs and all that they need."""
    order: list[str] = []

    def add(name):
        for n in NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    own = body.strip()
    more = own[5:] if own.upper().startswith("WITH ") else None
    head = ",\n".join(CTE[n] for n in order)
    return f"WITH {head},\n{more}" if more else f"WITH {head}\n{own}"
