"""Structured Streaming: ingest, late corrections, windows, alerts, sessions."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.cleaning import fill_down, hour_ending, to_int
from ..operators.anomaly import latest_alerts
from ..operators.upsert import dedupe, touched_partitions, upsert
from ..schema import METRICS, REPORT_RAW


def report_stream(spark: SparkSession, path: str, schema: T.StructType = REPORT_RAW, pattern: str = "*.csv") -> DataFrame:
    """New report files, each once; the checkpoint of the query resumes after a restart."""
    return spark.readStream.schema(schema).option("header", True).option("pathGlobFilter", pattern).csv(path).withColumn(
        "file", F.col("_metadata.file_path")
    )


def clean_report(df: DataFrame, metrics: list[str] = METRICS, id: str = "site") -> DataFrame:
    """Report lines -> (id, ds, metrics int, _order): the same code for a batch and for each batch of a stream."""
    rows = df if "line_no" in df.columns else df.withColumn("line_no", F.monotonically_increasing_id())
    rows = fill_down(rows, "dateflg", "line_no", "file").withColumn("ds", hour_ending("dateflg", "timeflg"))
    return to_int(rows, metrics).select(F.lit(id).alias("id"), "ds", *metrics, F.col("line_no").alias("_order"))


def newest_version(spark: SparkSession, path: str, schema: T.StructType, below: int | None = None) -> DataFrame:
    """The table that versioned_upsert keeps: of each part, the rows of its highest version (below ``below``)."""
    full = T.StructType([*[f for f in schema if f.name not in ("v", "part")], T.StructField("v", T.IntegerType()), T.StructField("part", T.IntegerType())])
    rows = spark.read.schema(full).option("basePath", path).parquet(f"{path}/v=*")
    if below is not None:
        rows = rows.where(F.col("v") < below)
    top = rows.groupBy("part").agg(F.max("v").alias("v"))  # reads no column of the files
    return rows.join(top, ["v", "part"], "left_semi")


def versioned_upsert(path: str, keys: list[str], clean: Callable[[DataFrame], DataFrame], part: Column | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: version n holds the parts that batch n touches, made from these parts' last lower versions.

    part: an int made of the keys, such as the day of ds; without it a version is the whole history. A replay
    reads versions below n alone and writes version n again. newest_version reads the table; the
    column names ``v`` and ``part`` are its own.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        new = dedupe(clean(batch), keys, ["_order"]).drop("_order")
        new = new.withColumn("part", F.coalesce(part, F.lit(-1)).cast("int") if part is not None else F.lit(0)).persist()
        hist = new.limit(0)
        if epoch:
            hist = newest_version(batch.sparkSession, path, new.schema, epoch).drop("v")
            hist = touched_partitions(hist, new, "part") if part is not None else hist
        out = upsert(hist, new, keys).hint("rebalance", "part")
        out.write.mode("overwrite").partitionBy("part").parquet(f"{path}/v={epoch}")
        new.unpersist()

    return write


def start_ingest(stream: DataFrame, path: str, checkpoint: str, keys: list[str] = ["id", "ds"], clean: Callable = clean_report, part: Column | None = None) -> StreamingQuery:  # noqa: B006
    """Clean and upsert each batch; late or corrected hours replace old ones, with no bound on lateness."""
    out = stream.writeStream.foreachBatch(versioned_upsert(path, keys, clean, part)).option("checkpointLocation", checkpoint)
    return out.trigger(availableNow=True).start()


def inflow_stream(events: DataFrame, ts: str = "ts", window: str = "1 hour", lateness: str = "2 hours", by: list[str] = []) -> DataFrame:  # noqa: B006
    """(window start, by, n) from raw events; watermarks need a TIMESTAMP, so wall-clock stamps are cast."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    out = timed.groupBy(F.window(ts, window).alias("w"), *by).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("ds"), *by, "n")


def start_inflow(
    events: DataFrame, sink: str, checkpoint: str, ts: str = "ts", window: str = "1 hour", lateness: str = "2 hours",
    by: list[str] = [], event: str | None = None,  # noqa: B006
) -> StreamingQuery:
    """Running counts of each window, in update mode: a batch writes the windows it changed, under its own number.

    The watermark ends the state of old windows, so neither state nor output of a batch grows with the stream;
    rows are not counted once the watermark has passed their window (Spark may apply it a batch later). With ``event``, an event that
    arrives again within the watermark counts once. Read the sink with ``inflow_table``.
    """
    if event:
        events = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness).dropDuplicatesWithinWatermark([event])
        timed = events.groupBy(F.window(ts, window).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("ds"), *by, "n")
    else:
        timed = inflow_stream(events, ts, window, lateness, by)

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={epoch}")  # a replayed batch replaces itself

    return timed.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def inflow_table(spark: SparkSession, sink: str, by: list[str] = []) -> DataFrame:  # noqa: B006
    """(ds, by, n): each window as the last batch that changed it left it."""
    rows = spark.read.parquet(sink)
    return rows.groupBy("ds", *by).agg(F.max_by("n", "batch").alias("n"))


def start_alerts(stream: DataFrame, ranges: DataFrame, sink: str, checkpoint: str, metrics: list[str] | None = None) -> StreamingQuery:
    """Alerts for the newest hour of each arriving batch of long rows (id, ds, metric, value)."""

    def write(batch: DataFrame, epoch: int) -> None:
        latest_alerts(batch, ranges, metrics).write.mode("overwrite").parquet(f"{sink}/batch={epoch}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def alert_changes(stream: DataFrame, ranges: DataFrame) -> DataFrame:
    """(id, metric, ds, change, value): alerts as they open and close, from long rows (id, ds, metric, value).

    Each site and metric has its own state: the newest hour seen and whether an alert is open. Hours are taken in order;
    an hour that is not newer than the newest seen is late and changes nothing, so a stale hour raises no alert, and an
    alert that stays open is not raised again. An hour without a range is not above it. ranges: (id, ds, metric, yhat_upper).
    """
    rows = stream.join(ranges.select("id", "ds", "metric", "yhat_upper"), ["id", "ds", "metric"], "left")

    def change(key: tuple, parts, state):
        g = pd.concat(list(parts)).drop_duplicates("ds", keep="last").sort_values("ds")
        newest, on = state.get if state.exists else (None, False)
        if newest is not None:
            g = g[g["ds"] > newest]
        if len(g):
            hot = (g["value"] > g["yhat_upper"]).to_numpy()
            was = [on, *hot[:-1]]
            state.update((g["ds"].iloc[-1].to_pydatetime(), bool(hot[-1])))
            g = g.assign(id=key[0], metric=key[1], change=["opened" if h else "closed" for h in hot])
            g = g[hot != was]
        else:
            g = g.assign(change="")
        yield g[["id", "metric", "ds", "change", "value"]]

    kind = stream.schema["id"].dataType.simpleString()
    out = f"id {kind}, metric string, ds timestamp_ntz, change string, value double"
    return rows.groupBy("id", "metric").applyInPandasWithState(change, out, "newest timestamp_ntz, on boolean", "append", "NoTimeout")


def busy_blocks_stream(activity: DataFrame, gap: str = "2 hours", lateness: str = "1 hour", ts: str = "ts") -> DataFrame:
    """(user_id, start, end, n): sessions of activity."""
    timed = activity.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    out = timed.groupBy("user_id", F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def oncall_activity_stream(
    activity: DataFrame, oncall: DataFrame, regular: DataFrame, longest: str = "24 hours", lateness: str = "2 hours",
) -> DataFrame:
    """(user_id, ts): activity within an on-call shift and outside the person's regular shifts, all three as streams.

    activity: (user_id, ts); shifts: (user_id, shift_start, shift_end), half-open. Two joins by person and day with bounds in
    time (a shift is listed under each day it touches, so that activity is compared with that day's shifts and not with all of a person's): inside (left semi), then outside (left outer, kept where nothing matched, once the watermark rules a match
    out). ``longest`` is the greatest length of a shift, later hours of a longer one do not count; it and ``lateness``
    bound what the joins keep. Rows later than the watermark are dropped.
    """

    def bounded(shifts: DataFrame, name: str) -> DataFrame:
        own = shifts.select(F.col("user_id").alias("_by"), F.col("shift_start").cast("timestamp").alias("_a"), F.col("shift_end").cast("timestamp").alias("_z"))
        timed = own.withWatermark("_a", lateness).where(F.col("_a") < F.col("_z"))
        last = F.least(F.col("_z"), F.col("_a") + F.expr(f"interval {longest}"))
        return timed.withColumn("_on", F.explode(F.sequence(F.to_date("_a"), F.to_date(last), F.expr("interval 1 day")))).alias(name)

    def held(name: str) -> Column:
        a, z = F.col(f"{name}._a"), F.col(f"{name}._z")
        return (F.col("user_id") == F.col(f"{name}._by")) & (F.col("_day") == F.col(f"{name}._on")) & (F.col("ts") >= a) & (F.col("ts") < a + F.expr(f"interval {longest}")) & (F.col("ts") < z)

    timed = activity.select("user_id", F.col("ts").cast("timestamp").alias("ts")).withWatermark("ts", lateness).withColumn("_day", F.to_date("ts"))
    inside = timed.join(bounded(oncall, "o"), held("o"), "left_semi")
    return inside.join(bounded(regular, "r"), held("r"), "left").where(F.col("r._by").isNull()).select("user_id", "ts")


def oncall_blocks_stream(
    activity: DataFrame, oncall: DataFrame, regular: DataFrame, gap: str = "2 hours", longest: str = "24 hours", lateness: str = "2 hours",
) -> DataFrame:
    """(user_id, start, end, n): sessions of the activity that oncall_activity_stream finds, each once, when it is closed."""
    found = oncall_activity_stream(activity, oncall, regular, longest, lateness)
    out = found.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
