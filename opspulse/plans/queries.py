"""One query for each operator of the inventory, with the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import cleaning as cl
from ..functions import time as tm
from ..functions import weather as wx
from ..operators import aggregates as ag
from ..operators import anomaly as an
from ..operators import filters as fl
from ..operators import intervals as iv
from ..operators import joins as jn
from ..operators import reshape as rs
from ..operators import timeseries as ts
from ..operators import upsert as up
from ..sources import sinks as sk
from . import standins as si
from .standins import NOW, TYPES, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
T = ", ".join(TYPES)


def query(text: str | None, *inputs: str):
    def add(f):
        QUERIES[f.__name__] = f
        if text is not None:
            ORACLE_SQL[f.__name__] = sql(text, *inputs) if inputs else text.strip()
        return f

    return add


def r6(*cols: str):
    return [F.round(c, 6).alias(c) for c in cols]


# --- sources, cleaning, projection


@query(f"SELECT id, ds + INTERVAL 1 HOUR AS ds, {', '.join(f'CAST({t} AS INTEGER) AS {t}' for t in TYPES)} FROM hourly", "hourly")
def clean_report(spark, d):
    rows = cl.fill_down(si.report(spark, d), "dateflg", "line_no", "file")
    rows = rows.withColumn("ds", cl.hour_ending("dateflg", "timeflg"))
    return cl.to_int(rows, TYPES).select(F.col("file").alias("id"), "ds", *TYPES)


@query("SELECT event_id, date_trunc('second', ts) AS a, CASE WHEN event_id % 3 = 2 THEN NULL ELSE date_trunc('minute', ts) END AS b FROM events")
def parse_mixed(spark, d):
    e = si.events(spark, d)
    text = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm")).when(F.col("event_id") % 3 == 1, F.date_format("ts", "M/d/yy H:mm")).otherwise("junk")
    e = e.withColumns({"t": text, "a": F.date_format("ts", "yyyy-MM-dd HH:mm:ss")})
    return cl.parse_ts(e, ["a"], "raise").select("event_id", "a", cl.parse_mixed_ts("t", ["yyyy-MM-dd HH:mm", "M/d/yy H:mm"]).alias("b"))


@query("SELECT event_id, date_trunc('hour', ts) AS ds FROM events WHERE event_id % 7 <> 0")
def drop_header_lines(spark, d):
    """Repeated header lines fall out by coercion and a null key."""
    e = si.events(spark, d).select("event_id", F.when(F.col("event_id") % 7 == 0, "ts").otherwise(F.date_format("ts", "yyyy-MM-dd HH:00:00")).alias("ds"))
    return cl.drop_null_keys(cl.parse_ts(e, ["ds"]), ["ds"])


@query(
    """SELECT CAST(start AS TIMESTAMP) + to_seconds(3600 * (i - 1)) AS ds, v[i] AS v, list_reverse(v)[i] AS w FROM
    (SELECT date_trunc('day', ts) AS start, list(value ORDER BY event_id) AS v FROM events GROUP BY 1) x, LATERAL (SELECT unnest(range(1, len(v) + 1)) AS i)"""
)
def weather_arrays(spark, d):
    e = si.events(spark, d).groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("start")).agg(F.array_sort(F.collect_list(F.struct("event_id", "value"))).alias("x"))
    rows = e.select("start", F.lit(3600).alias("step_seconds"), F.col("x.value").alias("v"), F.reverse("x.value").alias("w"))
    return wx.weather_from_arrays(rows, ["v", "w"])


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN 0.0001 WHEN event_id % 5 = 2 THEN NULL ELSE value END AS p01i FROM events")
def metar_markers(spark, d):
    k = F.col("event_id") % 5
    e = si.events(spark, d).withColumn("p01i", F.when(k == 0, "M").when(k == 1, "T").when(k == 2, "?").otherwise(F.col("value").cast("string")))
    return wx.clean_metar(e, ["p01i"]).select("event_id", "p01i")


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(trunc(value) AS INTEGER) END AS v, CAST(CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END AS INTEGER) AS n_bad FROM events")
def tolerant_int(spark, d):
    e = si.events(spark, d).withColumn("v", F.when(F.col("event_id") % 4 == 0, "x").otherwise(F.col("value").cast("string")))
    return cl.to_int(e, ["v"], "tolerant").select("event_id", "v", F.size("bad").alias("n_bad"))


@query("SELECT id, ds, coalesce(a, 0) + coalesce(b, 0) + purchase AS zero, a + b AS prop FROM (SELECT *, nullif(click, 0) AS a, nullif(error, 1) AS b FROM hourly)", "hourly")
def rollups(spark, d):
    h = si.hourly(spark, d).withColumns({"a": F.nullif(F.col("click"), F.lit(0)), "b": F.nullif(F.col("error"), F.lit(1))})
    return cl.add_rollups(h, {"zero": (["a", "b", "purchase"], "zero"), "prop": (["a", "b"], "propagate")}).select("id", "ds", "zero", "prop")


@query("SELECT 'site' AS site, event_id, CASE event_type WHEN 'click' THEN 'flow' WHEN 'view' THEN 'pod' WHEN 'error' THEN 'oncall' END AS kind FROM events")
def code_map(spark, d):
    dim = spark.createDataFrame([("click", "flow"), ("view", "pod"), ("error", "oncall")], "event_type string, kind string")
    return cl.with_id(cl.map_codes(si.events(spark, d), "event_type", dim), "site", "site").select("site", "event_id", "kind")


@query("SELECT event_id, event_type || CAST(user_id AS VARCHAR) AS name, value * 2 AS twice, CASE WHEN event_id % 2 = 0 THEN 'NoMD' ELSE event_type END AS md FROM events")
def project_fill(spark, d):
    e = si.events(spark, d).withColumns({"u": F.col("user_id").cast("string"), "md": F.when(F.col("event_id") % 2 == 1, F.col("event_type"))})
    return e.na.fill({"md": "NoMD"}).select("event_id", cl.full_name("event_type", "u").alias("name"), (F.col("value") * 2).alias("twice"), "md")


@query(f"SELECT id, ds, {T} FROM hourly WHERE ds >= TIMESTAMP '{NOW}'", "hourly")
def common_columns(spark, d):
    h = si.hourly(spark, d)
    a, _ = cl.common_select(h.drop("n").where(F.col("ds") >= si.now()), h)
    return cl.select_like(a, "yhat", drop=True)


@query("SELECT * FROM (SELECT 'ts' AS column_name, count(*) FILTER (ts IS NULL) AS nulls FROM events UNION ALL SELECT 'v', count(*) FILTER (value < 5) FROM events UNION ALL SELECT 'user_id', count(*) FILTER (user_id IS NULL) FROM events)")
def null_audit(spark, d):
    return cl.null_audit(si.events(spark, d).select("ts", F.when(F.col("value") >= 5, F.col("value")).alias("v"), "user_id"))


# --- scalar functions


@query(
    """SELECT event_id, date_trunc('hour', ts) AS lo, CASE WHEN date_trunc('hour', ts) < ts THEN date_trunc('hour', ts) + INTERVAL 1 HOUR ELSE ts END AS hi,
    TIMESTAMP '1970-01-01' + to_hours(CAST(CASE WHEN x - floor(x) = 0.5 THEN 2 * round(x / 2) ELSE round(x) END AS BIGINT)) AS even
    FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN ts ELSE date_trunc('hour', ts) + INTERVAL 30 MINUTE END AS ts2 FROM events) e,
    LATERAL (SELECT floor(epoch(ts2)) / 3600.0 AS x)"""
)
def hour_rounding(spark, d):
    e = si.events(spark, d)
    half = F.when(F.col("event_id") % 2 == 0, F.col("ts")).otherwise(tm.floor_hour("ts") + F.expr("interval 30 minutes"))
    return e.select("event_id", tm.floor_hour("ts").alias("lo"), tm.ceil_hour("ts").alias("hi"), tm.round_hour_even(half).alias("even"))


@query(
    f"""SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(ts AS DATE) AS date, CAST(isodow(ts) - 1 AS INTEGER) AS weekday, dayname(ts) AS weekday_name,
    CAST(date_diff('day', DATE '2024-01-15', CAST(ts AS DATE)) AS INTEGER) AS day_offset, strftime(ts, '%Y-%m-%d-%H') AS stamp,
    CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Montreal' AS TIMESTAMP) AS local, date_diff('second', TIMESTAMP '{NOW}', date_trunc('second', ts)) / 3600.0 AS hours,
    contains(lower(event_type), 'ic') AS has_ic, replace(event_type, 'e', 'E') AS swapped FROM events"""
)
def calendar_columns(spark, d):
    e = tm.with_calendar(si.events(spark, d), "ts")
    return e.select(
        "event_id", "hour", "date", "weekday", "weekday_name", tm.day_offset("ts", "2024-01-15").alias("day_offset"), tm.hour_stamp("ts").alias("stamp"),
        tm.to_zone("ts", "UTC", "America/Montreal").alias("local"), tm.hours_between(si.now(), F.date_trunc("second", "ts").cast("timestamp_ntz")).alias("hours"),
        F.contains(F.lower("event_type"), F.lit("ic")).alias("has_ic"), F.replace("event_type", F.lit("e"), F.lit("E")).alias("swapped"),
    )


@query("SELECT id, ds, round(CASE WHEN error = 0 THEN NULL ELSE (click - error) / CAST(error AS DOUBLE) * 100 END, 6) AS pct, round(n / 7.0::DOUBLE, 1) AS r FROM hourly", "hourly")
def percent_and_round(spark, d):
    return si.hourly(spark, d).select("id", "ds", F.round(tm.pct_diff("click", "error"), 6).alias("pct"), tm.round1(F.col("n") / 7.0).alias("r"))


_COND = "CASE event_id % 6 WHEN 0 THEN 'Snow' WHEN 1 THEN 'Light rain' WHEN 2 THEN 'rain and snow' WHEN 3 THEN 'Fog patches' WHEN 4 THEN 'A mix' ELSE 'Clear' END"


@query(
    f"""SELECT event_id, round(t * 9 / 5 + 32, 6) AS tmpf, round(t * 9 / 5 + 28, 6) AS dwpf, round_even(value / 1.852, 0) AS sknt,
    CAST(CASE WHEN event_id % 100 >= 60 THEN 0.01 ELSE 0.0 END AS DOUBLE) AS p01i,
    CAST(CASE WHEN c LIKE '%snow%' THEN 1.0 WHEN c LIKE '%rain%' THEN 2.0 WHEN c LIKE '%fog%' OR c LIKE '%mist%' THEN 0.5 ELSE 6.0 END AS DOUBLE) AS vsby,
    CASE WHEN c LIKE '%snow%' AND c LIKE '%rain%' OR c LIKE '%mix%' THEN '-RASN' WHEN c LIKE '%snow%' THEN '-SN' WHEN c LIKE '%rain%' THEN '-RA' WHEN c LIKE '%fog%' OR c LIKE '%mist%' THEN 'BR' ELSE '' END AS wxcodes
    FROM (SELECT *, value - 20 AS t, lower({_COND}) AS c FROM events)"""
)
def forecast_as_observation(spark, d):
    e = si.events(spark, d).select(
        "event_id", F.col("ts").alias("period"), F.expr(_COND).alias("condition"), (F.col("value") - 20).alias("temperature"),
        (F.col("event_id") % 100).cast("double").alias("precip_probability"), F.col("value").alias("wind_speed"), F.lit(90.0).alias("wind_direction"),
    )
    out = wx.forecast_to_obs(e.withColumn("period", F.struct("event_id", "period")))
    return out.select(F.col("valid.event_id").alias("event_id"), *r6("tmpf", "dwpf"), "sknt", "p01i", F.col("vsby").cast("double").alias("vsby"), "wxcodes")


# --- filters and row selection


@query(f"SELECT h.id, h.ds, n FROM hourly h JOIN (SELECT id, max(ds) AS m FROM hourly WHERE ds < TIMESTAMP '{NOW}' GROUP BY id) k ON h.id = k.id AND h.ds > m", "hourly")
def future_rows(spark, d):
    h = si.hourly(spark, d).select("id", "ds", "n")
    return fl.future_rows(h, fl.asof(h, "ds", si.now(), "left"))


@query("SELECT h.id, ds, n FROM hourly h JOIN tops USING (id) WHERE CAST(ds AS DATE) = CAST(max_ds AS DATE)", "tops")
def on_latest_date(spark, d):
    return fl.on_latest_date(si.hourly(spark, d).select("id", "ds", "n"))


@query("SELECT h.id, ds, n FROM hourly h JOIN tops USING (id) WHERE isodow(ds) = isodow(max_ds)", "tops")
def same_weekday(spark, d):
    return fl.same_weekday_as_latest(si.hourly(spark, d).select("id", "ds", "n"))


@query(
    f"""SELECT 'around' AS part, event_id FROM events WHERE ts BETWEEN TIMESTAMP '{NOW}' - INTERVAL 12 HOUR AND TIMESTAMP '{NOW}' + INTERVAL 12 HOUR
    UNION ALL SELECT 'yesterday', event_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-14'
    UNION ALL SELECT 'today', event_id FROM events WHERE CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Montreal' AS DATE) = DATE '2024-01-15'
    UNION ALL SELECT 'hour', event_id FROM events WHERE hour(ts) = 23
    UNION ALL SELECT 'horizon', event_id FROM events WHERE ts > TIMESTAMP '{NOW}' AND ts <= TIMESTAMP '{NOW}' + INTERVAL 24 HOUR"""
)
def time_filters(spark, d):
    e = si.events(spark, d)
    parts = {
        "around": fl.around(e, "ts", si.now(), "12 hours", "12 hours"), "yesterday": fl.yesterday(e, "ts", si.now()),
        "today": fl.local_day(e, "ts", "America/Montreal", F.to_date(F.lit("2024-01-15"))), "hour": fl.at_hour(e, "ts", 23),
        "horizon": fl.horizon(e, "ts", si.now(), 24),
    }
    out = [p.select(F.lit(n).alias("part"), "event_id") for n, p in parts.items()]
    return out[0].union(out[1]).union(out[2]).union(out[3]).union(out[4])


@query("SELECT id, metric AS target_name, ds, value FROM long WHERE id = 's1' AND metric = 'error'", "long")
def for_target(spark, d):
    return fl.for_target(si.long(spark, d).withColumnRenamed("metric", "target_name"), "s1", "error").select("id", "target_name", "ds", "value")


@query("SELECT max(ds) AS latest, max(ds) - INTERVAL 7 DAY AS since, max(ds) + INTERVAL 7 DAY AS until FROM hourly", "hourly")
def refresh_window(spark, d):
    return fl.refresh_window(si.hourly(spark, d), "ds")


@query(f"SELECT h.id, ds, {T}, n FROM hourly h JOIN tops ON h.id = tops.id AND ds = max_ds", "tops")
def latest_rows(spark, d):
    return fl.latest(si.hourly(spark, d))


@query("SELECT id, ds, n FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ds DESC) AS a FROM hourly) WHERE a <= 24", "hourly")
def last_rows(spark, d):
    return fl.last_n(si.hourly(spark, d).select("id", "ds", "n"), 24)


@query(f"SELECT id, ds, n FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ds) AS a FROM hourly WHERE ds > TIMESTAMP '{NOW}') WHERE a <= 8", "hourly")
def first_rows(spark, d):
    return fl.first_n(si.hourly(spark, d).where(F.col("ds") > si.now()).select("id", "ds", "n"), 8)


# --- joins


@query("SELECT h.id, h.ds, n, temperature FROM hourly h JOIN weather w ON h.ds = w.ds", "hourly", "weather")
def join_weather(spark, d):
    return jn.join_weather(si.hourly(spark, d).select("id", "ds", "n"), si.weather(spark, d), ["ds"])


_GRID = "grid AS (SELECT user_id, unnest(generate_series(a, b - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS ds, code, scheduled_shift_id FROM (SELECT *, CASE WHEN date_trunc('hour', shift_start) < shift_start THEN date_trunc('hour', shift_start) + INTERVAL 1 HOUR ELSE shift_start END AS a, CASE WHEN date_trunc('hour', shift_end) < shift_end THEN date_trunc('hour', shift_end) + INTERVAL 1 HOUR ELSE shift_end END AS b FROM shifts) WHERE a < b)"


@query(f"WITH {_GRID} SELECT user_id, ds, code FROM grid", "shifts")
def expand_shifts(spark, d):
    return iv.expand_intervals(si.shifts(spark, d), "shift_start", "shift_end").select("user_id", "ds", "code")


@query(f"WITH {_GRID}, s AS (SELECT ds, count(*) AS staff FROM grid GROUP BY 1) SELECT h.id, h.ds, n, staff FROM hourly h JOIN s ON h.ds = s.ds", "hourly", "shifts")
def join_staffing(spark, d):
    staff = iv.expand_intervals(si.shifts(spark, d), "shift_start", "shift_end").groupBy("ds").agg(F.count("*").alias("staff"))
    return jn.join_staffing(si.hourly(spark, d).select("id", "ds", "n"), staff, ["ds"])


@query(f"WITH {_GRID} SELECT code, ds, count(*) AS staff FROM grid GROUP BY ALL", "shifts")
def staffing_counts(spark, d):
    return iv.staffing_counts(si.shifts(spark, d), "shift_start", "shift_end", ["code"])


@query(f"WITH {_GRID}, c AS (SELECT code, ds, count(*) AS staff FROM grid GROUP BY ALL), k AS (SELECT *, ds - INTERVAL 1 HOUR * row_number() OVER (PARTITION BY code, staff ORDER BY ds) AS run FROM c) SELECT code, min(ds) AS start, max(ds) + INTERVAL 1 HOUR AS \"end\", staff FROM k GROUP BY code, staff, run", "shifts")
def staffing_steps(spark, d):
    return iv.staffing_steps(si.shifts(spark, d), "shift_start", "shift_end", ["code"])


@query("SELECT h.id, h.ds, n, CAST(coalesce(oncall_busy, 0) AS DOUBLE) AS oncall_busy FROM hourly h LEFT JOIN labels01 l ON h.ds = l.ds", "hourly", "labels01")
def join_labels(spark, d):
    return jn.join_labels(si.hourly(spark, d).select("id", "ds", "n"), si.labels01(spark, d))


@query("SELECT l.id, l.ds, l.metric, value, round(yhat, 6) AS yhat, round(yhat_lower, 6) AS yhat_lower, round(yhat_upper, 6) AS yhat_upper FROM long l LEFT JOIN ranges r ON l.id = r.id AND l.ds = r.ds AND l.metric = r.metric", "ranges")
def with_ranges(spark, d):
    return jn.with_ranges(si.long(spark, d), si.ranges(spark, d)).select("id", "ds", "metric", "value", *r6("yhat", "yhat_lower", "yhat_upper"))


_MODELS = "m AS (SELECT id, ds, metric AS target_name, value AS basic, CASE WHEN value > 1 THEN value + 1 END AS holidays, value * 2 AS staffing FROM long)"


def _models(spark, d):
    x = si.long(spark, d).withColumnRenamed("metric", "target_name")
    made = {"basic": F.col("value"), "holidays": F.when(F.col("value") > 1, F.col("value") + 1), "staffing": F.col("value") * 2}
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), v.alias("predictions")) for n, v in made.items()])).alias("m")
    return x.select("id", "ds", "target_name", each).select("id", "ds", "target_name", "m.*")


@query(f"WITH {_MODELS} SELECT id, ds, target_name, basic, holidays, staffing FROM m WHERE holidays IS NOT NULL", "long")
def compare_forecasts(spark, d):
    return jn.compare_forecasts(_models(spark, d), ["basic", "holidays", "staffing"])


@query(f"WITH {_MODELS} SELECT target_name, round(avg((holidays - basic) / nullif(basic, 0) * 100), 6) AS pct_holidays, round(avg((staffing - basic) / nullif(basic, 0) * 100), 6) AS pct_staffing FROM m WHERE holidays IS NOT NULL GROUP BY 1", "long")
def variant_effects(spark, d):
    _, mean = an.variant_effects(_models(spark, d), "basic", ["holidays", "staffing"])
    return mean.select("target_name", *r6("pct_holidays", "pct_staffing"))


@query("SELECT coalesce(a.ds, b.ds) AS ds, temperature, oncall_busy FROM weather a FULL JOIN labels01 b ON a.ds = b.ds", "weather", "labels01")
def align_tables(spark, d):
    return jn.align([si.weather(spark, d), si.labels01(spark, d)], ["ds"])


@query("SELECT h.id, h.ds, o.event_id FROM hourly h LEFT JOIN (SELECT date_trunc('hour', ts) AS ds, arg_max(event_id, ts) AS event_id FROM events WHERE event_type = 'view' GROUP BY 1) o ON h.ds = o.ds", "hourly")
def join_observations(spark, d):
    obs = si.events(spark, d).where("event_type = 'view'").select("event_id", F.col("ts").alias("valid"))
    return jn.join_observations(si.hourly(spark, d), obs, on="hour").select("id", "ds", "event_id")


@query(f"WITH {_GRID}, s AS (SELECT ds, count(*) AS staff FROM grid GROUP BY 1) SELECT s.ds, staff, temperature FROM s JOIN weather w ON s.ds = w.ds", "shifts", "weather")
def future_covariates(spark, d):
    staff = iv.expand_intervals(si.shifts(spark, d), "shift_start", "shift_end").groupBy("ds").agg(F.count("*").alias("staff"))
    return jn.future_covariates(staff, si.weather(spark, d), ["ds"])


@query("SELECT r.id, r.ds, r.metric, round(yhat, 6) AS yhat, value FROM ranges r LEFT JOIN long l ON l.id = r.id AND l.ds = r.ds AND l.metric = r.metric", "ranges")
def with_actuals(spark, d):
    return jn.with_actuals(si.ranges(spark, d), si.long(spark, d), "left", ["id", "ds", "metric"]).select("id", "ds", "metric", *r6("yhat"), "value")


@query("SELECT id, date, value, value * 2 AS yhat, dayname(date) AS weekday_name FROM (SELECT *, row_number() OVER (ORDER BY date DESC) AS a FROM daily) WHERE a <= 7", "daily")
def daily_vs_forecast(spark, d):
    day = si.daily(spark, d)
    return jn.daily_vs_forecast(day, day.select("id", "date", (F.col("value") * 2).alias("yhat")))


# --- aggregates


@query("SELECT id, CAST(ds AS DATE) AS date, CAST(sum(n) AS BIGINT) AS total FROM hourly JOIN tops USING (id) WHERE CAST(ds AS DATE) < CAST(max_ds AS DATE) GROUP BY 1, 2", "tops")
def daily_total(spark, d):
    return ag.daily_total(si.hourly(spark, d), "n")


@query("SELECT id, CAST(hour(ds) AS INTEGER) AS hour, round(avg(n), 6) AS mean FROM hourly GROUP BY 1, 2", "hourly")
def hour_profile(spark, d):
    return ag.hour_profile(si.hourly(spark, d), "n").select("id", "hour", *r6("mean"))


@query("SELECT h.id, CAST(hour(ds) AS INTEGER) AS hour, round(avg(n), 6) AS mean FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ds DESC) AS a FROM hourly) h JOIN tops USING (id) WHERE a <= 400 AND isodow(ds) = isodow(max_ds) GROUP BY 1, 2", "tops")
def weekday_profile(spark, d):
    return ag.hour_profile(si.hourly(spark, d), "n", same_weekday=True, last=400).select("id", "hour", *r6("mean"))


@query("SELECT id, CAST(hour(ds) AS INTEGER) AS hour, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS sd, round(avg(n) + 2 * stddev_samp(n), 6) AS zone2 FROM hourly GROUP BY 1, 2", "hourly")
def hour_bands(spark, d):
    return ag.hour_bands(si.hourly(spark, d), "n").select("id", "hour", *r6("mean", "sd", "zone2"))


@query(f"SELECT id, CAST(ds AS DATE) AS date, {', '.join(f'max({t}) AS {t}' for t in TYPES)} FROM hourly GROUP BY 1, 2", "hourly")
def daily_peaks(spark, d):
    return ag.daily_peaks(si.hourly(spark, d), TYPES)


@query("SELECT id, ds, metric, value FROM (SELECT *, row_number() OVER (PARTITION BY id, metric ORDER BY value DESC, ds) AS a FROM long) WHERE a = 1", "long")
def peak_rows(spark, d):
    return ag.peak_rows(si.long(spark, d), ["id", "metric"])


_CUM = "cum AS (SELECT id, ds, CAST(sum(n) OVER (PARTITION BY id, CAST(ds AS DATE) ORDER BY ds) AS BIGINT) AS cum_n, n FROM hourly)"


def _cumulative(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("id", F.to_date("ds")).orderBy("ds")
    return si.hourly(spark, d).select("id", "ds", F.sum("n").over(w).alias("cum_n"), "n")


@query(f"WITH {_CUM} SELECT c.id, ds, cum_n FROM cum c JOIN tops USING (id) WHERE ds = date_trunc('day', max_ds)", "tops")
def midnight_totals(spark, d):
    return ag.midnight_totals(_cumulative(spark, d), ["cum_n"])


@query(f"WITH {_CUM} SELECT c.id, c.ds, cum_n, p.peak_n FROM cum c JOIN tops USING (id) JOIN (SELECT id, CAST(ds AS DATE) AS date, max(n) AS peak_n FROM hourly GROUP BY 1, 2) p ON p.id = c.id AND p.date = CAST(c.ds AS DATE) - 1 WHERE c.ds = date_trunc('day', max_ds)", "tops")
def morning_report(spark, d):
    return an.morning_report(_cumulative(spark, d), ["cum_n"], ["n"])


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def value_counts(spark, d):
    return ag.value_counts(si.events(spark, d), "event_type")


@query("SELECT count(DISTINCT user_id) AS n FROM events")
def distinct_count(spark, d):
    return ag.distinct_count(si.events(spark, d), "user_id")


@query("SELECT DISTINCT event_type FROM events")
def distinct_values(spark, d):
    return ag.distinct_values(si.events(spark, d), "event_type")


@query(
    f"""SELECT l.id, l.metric, count(*) FILTER (value > yhat_upper) AS hours, count(DISTINCT CASE WHEN value > yhat_upper THEN CAST(l.ds AS DATE) END) AS days,
    round(count(DISTINCT CASE WHEN value > yhat_upper THEN CAST(l.ds AS DATE) END) / CAST(count(*) AS DOUBLE), 6) AS days_per_row
    FROM long l JOIN ranges r ON l.id = r.id AND l.ds = r.ds AND l.metric = r.metric WHERE l.ds >= TIMESTAMP '2024-01-05' GROUP BY 1, 2""", "ranges",
)
def exceedance(spark, d):
    out = ag.exceedance(jn.with_ranges(si.long(spark, d), si.ranges(spark, d)), "2024-01-05")
    return out.select("id", "metric", "hours", "days", *r6("days_per_row"))


# --- windows, axes, sets


_AX = "full_ax AS (SELECT id, unnest(generate_series(min(ds), max(ds), INTERVAL 1 HOUR)) AS ds FROM hourly GROUP BY id), j AS (SELECT a.id, a.ds, h.error FROM full_ax a LEFT JOIN hourly h ON a.id = h.id AND a.ds = h.ds)"


@query(f"WITH {_AX} SELECT id, ds, last_value(error IGNORE NULLS) OVER (PARTITION BY id ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS error FROM j", "hourly")
def regularize(spark, d):
    e = si.hourly(spark, d).select("id", (F.col("ds") + F.expr("interval 10 minutes")).alias("ds"), "error")
    return ts.regularize(e, ["error"])


@query("SELECT id, ds, first_value(x IGNORE NULLS) OVER (PARTITION BY id ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS x FROM (SELECT id, ds, nullif(click, 0) AS x FROM hourly)", "hourly")
def backfill(spark, d):
    return ts.bfill(si.hourly(spark, d).select("id", "ds", F.nullif(F.col("click"), F.lit(0)).alias("x")), ["x"])


@query("SELECT * FROM (SELECT id, lag(ds) OVER (PARTITION BY id ORDER BY ds) AS previous, ds, date_diff('second', lag(ds) OVER (PARTITION BY id ORDER BY ds), ds) AS seconds FROM hourly) WHERE seconds <> 3600", "hourly")
def find_gaps(spark, d):
    return ts.find_gaps(si.hourly(spark, d), limit=None)


@query("SELECT id, unnest(generate_series(max_ds + INTERVAL 1 HOUR, max_ds + INTERVAL 48 HOUR, INTERVAL 1 HOUR)) AS ds FROM tops", "tops")
def extend_axis(spark, d):
    return ts.extend(si.hourly(spark, d), 48)


@query(f"WITH {_CUM} SELECT id, CAST(ds AS DATE) AS date, v AS value FROM (SELECT id, ds, lead(cum_n) OVER (PARTITION BY id ORDER BY ds) AS v FROM cum) WHERE hour(ds) = 23", "hourly")
def daily_from_cumulative(spark, d):
    return ts.daily_from_cumulative(_cumulative(spark, d), "cum_n")


@query("SELECT id, ds, CAST(n_lags AS INTEGER) AS n_lags, CAST(s AS BIGINT) AS s, y1, y3 FROM (SELECT id, ds, count(*) OVER p AS n_lags, sum(n) OVER p AS s, lead(n, 1) OVER o AS y1, lead(n, 3) OVER o AS y3 FROM hourly WINDOW p AS (PARTITION BY id ORDER BY ds ROWS BETWEEN 47 PRECEDING AND CURRENT ROW), o AS (PARTITION BY id ORDER BY ds)) WHERE n_lags = 48 AND y3 IS NOT NULL", "hourly")
def lag_features(spark, d):
    x = ts.lag_features(si.hourly(spark, d), "id", "ds", "n", 48, 3)
    return x.select("id", "ds", F.size("lags").alias("n_lags"), F.aggregate("lags", F.lit(0).cast("bigint"), lambda a, v: a + v).alias("s"), F.col("ahead")[0].alias("y1"), F.col("ahead")[2].alias("y3"))


@query("WITH f AS (SELECT *, CASE WHEN lag(ds) OVER w IS NULL OR ds > lag(ds) OVER w + INTERVAL 1 HOUR THEN 1 ELSE 0 END AS new FROM hourly WINDOW w AS (PARTITION BY id ORDER BY ds)), g AS (SELECT *, CAST(sum(new) OVER (PARTITION BY id ORDER BY ds) AS BIGINT) AS island FROM f) SELECT id, island, min(ds) AS start, max(ds) AS \"end\", count(*) AS n FROM g GROUP BY 1, 2 HAVING count(*) >= 2", "hourly")
def islands(spark, d):
    return ts.islands(si.hourly(spark, d), ["id"], "ds", "1 hour", 2)


@query(
    f"SELECT id, ds, n + CASE WHEN ds >= TIMESTAMP '{NOW}' THEN 100 ELSE 0 END AS n FROM hourly WHERE ds < TIMESTAMP '2024-01-18' OR ds >= TIMESTAMP '2024-01-18'", "hourly",
)
def upsert(spark, d):
    h = si.hourly(spark, d).select("id", "ds", "n")
    old, new = h.where(F.col("ds") < F.lit("2024-01-18").cast("timestamp_ntz")), h.where(F.col("ds") >= si.now()).withColumn("n", F.col("n") + 100)
    return up.upsert(old, new, ["id", "ds"])


@query("SELECT user_id, arg_max(event_id, ts) AS event_id FROM events GROUP BY 1")
def keep_last(spark, d):
    return up.dedupe(si.events(spark, d).select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id")


@query("SELECT DISTINCT user_id, event_type, CAST(NULL AS DOUBLE) AS extra FROM events WHERE user_id % 2 = 0 UNION SELECT user_id, event_type, 1.0 FROM events WHERE user_id % 2 = 1")
def union_distinct(spark, d):
    e = si.events(spark, d).select("user_id", "event_type")
    return up.distinct_rows(up.union_all(e.where("user_id % 2 = 0"), e.where("user_id % 2 = 1").withColumn("extra", F.lit(1.0))))


# --- reshape, staffing


@query("SELECT id, ds, metric, value FROM long", "long")
def wide_to_long(spark, d):
    return si.long(spark, d)


@query(
    "SELECT id, ds, " + ", ".join(f"round(max(yhat) FILTER (metric = '{t}'), 6) AS {t}_yhat, round(max(yhat_upper) FILTER (metric = '{t}'), 6) AS {t}_yhat_upper" for t in TYPES) + " FROM ranges GROUP BY 1, 2", "ranges",
)
def long_to_wide(spark, d):
    wide = sk.to_wide(si.ranges(spark, d), TYPES, values=("yhat", "yhat_upper"))
    return wide.select("id", "ds", *r6(*[f"{t}_{v}" for t in TYPES for v in ("yhat", "yhat_upper")]))


@query("SELECT id, max_ds + to_hours(i) AS ds, CAST(i AS INTEGER) AS step, n * (i + 1.0) AS yhat, n * (i + 1.0) - 1 AS q20, n * (i + 1.0) + 1 AS q80 FROM tops JOIN hourly h USING (id), (SELECT unnest(range(0, 4)) AS i) WHERE h.ds = max_ds".replace("n * (i + 1.0)", "CAST(n * (i + 1) AS DOUBLE)"), "tops")
def steps_to_rows(spark, d):
    h = si.hourly(spark, d).select("id", "ds", *[c for i in range(4) for c in (
        (F.col("n") * (i + 1)).cast("double").alias(f"step{i}"), ((F.col("n") * (i + 1)).cast("double") - 1).alias(f"step{i} 20.0%"), ((F.col("n") * (i + 1)).cast("double") + 1).alias(f"step{i} 80.0%"))])
    return rs.steps_to_rows(h, 4)


_EVEN = "CAST(CASE WHEN x - floor(x) = 0.5 THEN 2 * round(x / 2) ELSE round(x) END AS BIGINT)"
_GRID_EVEN = f"""ge AS (SELECT user_id, code, scheduled_shift_id, TIMESTAMP '1970-01-01' + to_hours(unnest(range(a, b))) AS ds FROM (SELECT *, (SELECT {_EVEN} FROM (SELECT floor(epoch(shift_start)) / 3600.0 AS x)) AS a, (SELECT {_EVEN} FROM (SELECT floor(epoch(shift_end)) / 3600.0 AS x)) AS b FROM shifts) WHERE a < b)"""


@query(
    f"WITH {_GRID_EVEN} SELECT ds, " + ", ".join(f"coalesce(arg_min(code, scheduled_shift_id) FILTER (user_id = {u} AND code <> 'error'), 'NotWorking') AS p{u}" for u in range(1, 5)) + " FROM ge WHERE code <> 'error' GROUP BY 1", "shifts",
)
def staffing_by_person(spark, d):
    s = iv.expand_intervals(si.shifts(spark, d), "shift_start", "shift_end", "even")
    s = s.select("ds", F.concat(F.lit("p"), F.col("user_id").cast("string")).alias("person"), F.when(F.col("code") != "error", F.col("code")).alias("shift_type"), "scheduled_shift_id")
    return iv.staffing_by_person(s, [f"p{u}" for u in range(1, 5)])


@query(
    f"WITH {_GRID}, g AS (SELECT unnest(generate_series(min(ds), max(ds), INTERVAL 1 HOUR)) AS ds FROM grid) SELECT g.ds, " + ", ".join(f"max(p) FILTER (code = '{t}') AS {t}" for t in TYPES) + " FROM g LEFT JOIN (SELECT ds, code, CAST(arg_max(user_id, scheduled_shift_id) AS VARCHAR) AS p FROM grid GROUP BY 1, 2) x ON g.ds = x.ds GROUP BY 1", "shifts",
)
def staffing_by_code(spark, d):
    s = iv.expand_intervals(si.shifts(spark, d), "shift_start", "shift_end")
    return iv.staffing_by_code(s.select("ds", "code", F.col("user_id").cast("string").alias("person"), "scheduled_shift_id"), TYPES)


def _oncall(spark, d):
    s = si.shifts(spark, d)
    cut = s.withColumn("mid", F.date_trunc("day", "shift_start").cast("timestamp_ntz") + F.expr("interval 12 hours"))
    regular = cut.where("user_id % 2 = 0").select("user_id", F.col("shift_start"), F.least("mid", "shift_end").alias("shift_end"))
    return si.events(spark, d).select("event_id", "user_id", "ts"), s.select("user_id", "shift_start", "shift_end"), regular


_ACT = """act AS (SELECT event_id, e.user_id, ts FROM events e WHERE EXISTS (SELECT 1 FROM shifts s WHERE s.user_id = e.user_id AND ts >= shift_start AND ts < shift_end)
AND NOT EXISTS (SELECT 1 FROM shifts s WHERE s.user_id = e.user_id AND s.user_id % 2 = 0 AND ts >= shift_start AND ts < least(date_trunc('day', shift_start) + INTERVAL 12 HOUR, shift_end)))"""


@query(f"WITH {_ACT} SELECT event_id, user_id, ts FROM act", "shifts")
def activity_oncall(spark, d):
    return iv.activity_oncall(*_oncall(spark, d))


@query(
    f"""WITH {_ACT}, f AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL 2 HOUR THEN 1 ELSE 0 END AS new FROM act WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM f), b AS (SELECT user_id, k, min(ts) AS a, max(ts) AS z FROM g GROUP BY 1, 2 HAVING count(*) >= 2)
    SELECT DISTINCT unnest(generate_series(date_trunc('hour', a), date_trunc('hour', z), INTERVAL 1 HOUR)) AS ds, CAST(1 AS DOUBLE) AS oncall_busy FROM b""", "shifts",
)
def oncall_busy(spark, d):
    return iv.oncall_busy(*_oncall(spark, d))


# --- calendar


_HOL = "(VALUES (DATE '2024-01-01', 'qc', 'New Year''s Day'), (DATE '2024-01-08', 'il', 'A'), (DATE '2024-01-08', 'il', 'B'), (DATE '2024-01-01', 'il', 'C')) AS hol(date, calendar, name)"


def holidays(spark):
    rows = [("2024-01-01", "qc", "New Year's Day"), ("2024-01-08", "il", "A"), ("2024-01-08", "il", "B"), ("2024-01-01", "il", "C")]
    return spark.createDataFrame(rows, "d string, calendar string, name string").select(F.to_date("d").alias("date"), "calendar", "name")


@query(
    f"""SELECT h.id, h.ds, CASE WHEN q IS NULL THEN 'no' ELSE 'yes' END AS is_qc_holiday, CASE WHEN i IS NULL THEN 'no' ELSE 'yes' END AS is_il_holiday, coalesce(q, 'no') AS qc_holiday_name, coalesce(i, 'no') AS il_holiday_name
    FROM hourly h LEFT JOIN (SELECT date, min(name) FILTER (calendar = 'qc') AS q, min(name) FILTER (calendar = 'il') AS i FROM {_HOL} GROUP BY 1) x ON CAST(ds AS DATE) = x.date""", "hourly",
)
def holiday_flags(spark, d):
    return cal.add_holidays(si.hourly(spark, d).select("id", "ds"), "ds", holidays(spark), names=True)


@query("SELECT CAST(min(year(o_orderdate)) AS INTEGER) AS first_year, CAST(max(year(o_orderdate)) AS INTEGER) AS last_year FROM orders")
def year_range(spark, d):
    return cal.year_range(si.orders(spark, d), "o_orderdate")


@query("SELECT count(*) AS n, CAST(sum(CASE WHEN month(o_orderdate) = 12 AND day(o_orderdate) = 25 THEN 1 ELSE 0 END) AS BIGINT) AS christmas FROM orders WHERE (month(o_orderdate) = 12 AND day(o_orderdate) = 25) OR (month(o_orderdate) = 6 AND day(o_orderdate) = 24) OR (month(o_orderdate) = 9 AND day(o_orderdate) <= 7 AND isodow(o_orderdate) = 1)")
def orders_on_holidays(spark, d):
    names = ["Christmas Day", "Saint-Jean-Baptiste Day", "Labour Day"]
    dim = cal.holiday_dim(spark, (1990, 2005)).where(F.col("name").isin(names))
    o = cal.add_holidays(si.orders(spark, d), "o_orderdate", dim, ("qc",), names=True).where("is_qc_holiday = 'yes'")
    return o.agg(F.count("*").alias("n"), F.count_if(F.col("qc_holiday_name") == "Christmas Day").alias("christmas"))


# Pesach by the closed formula of Gauss, which counts Julian days of March; here it serves as the check.
_PESACH = """y AS (SELECT CAST(unnest(range(1991, 2000)) AS BIGINT) AS g),
a AS (SELECT g, (12 * (g + 3760) + 17) % 19 AS a, (g + 3760) % 4 AS b FROM y),
q AS (SELECT *, 32.0440932161 + 1.5542417966 * a + 0.25 * b - 0.003177794022 * (g + 3760) AS q FROM a),
m AS (SELECT *, CAST(floor(q) AS BIGINT) AS m, (CAST(floor(q) AS BIGINT) + 3 * (g + 3760) + 5 * b + 5) % 7 AS c FROM q),
p AS (SELECT g, make_date(g, 3, 1) + CAST(12 + m + CASE WHEN c IN (2, 4, 6) THEN 1 WHEN c = 1 AND a > 6 AND q - m >= 0.63287037 THEN 2 WHEN c = 0 AND a > 11 AND q - m >= 0.89772376 THEN 1 ELSE 0 END AS INTEGER) AS p FROM m),
il AS (
  SELECT p + unnest([0, 6, 50, 163, 164, 172, 177, 184]) AS date, unnest(['Pesach', 'Seventh day of Pesach', 'Shavuot', 'Rosh Hashanah', 'Rosh Hashanah (second day)', 'Yom Kippur', 'Sukkot', 'Simchat Torah']) AS name FROM p
  UNION ALL SELECT p + 20 - CASE dayofweek(p + 20) WHEN 5 THEN 1 WHEN 6 THEN 2 ELSE 0 END, 'Independence Day' FROM p
)"""


@query(f"WITH {_PESACH} SELECT o_orderdate AS date, name, count(*) AS n FROM (SELECT CAST(o_orderdate AS DATE) AS o_orderdate FROM orders) JOIN il ON o_orderdate = date GROUP BY ALL")
def orders_on_hebrew_holidays(spark, d):
    days = si.orders(spark, d).groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count("*").alias("n"))
    return days.join(F.broadcast(cal.hebrew_dim(spark, (1991, 1999))), "date").select("date", "name", "n")


# --- ranges, flags, alerts


@query("SELECT id, ds, metric, round(yhat, 6) AS yhat, round(yhat_lower, 6) AS yhat_lower, round(yhat_upper, 6) AS yhat_upper FROM ranges", "ranges")
def seasonal_ranges(spark, d):
    return si.ranges(spark, d).select("id", "ds", "metric", *r6("yhat", "yhat_lower", "yhat_upper"))


@query(
    """WITH s2 AS (SELECT id, metric, (isodow(ds) - 1) * 24 + hour(ds) AS slot, avg(value) AS yhat, stddev_samp(value) AS sd FROM long GROUP BY 1, 2, 3),
    a2 AS (SELECT id, ds FROM hourly UNION ALL SELECT id, unnest(generate_series(max_ds + INTERVAL 1 HOUR, max_ds + INTERVAL 48 HOUR, INTERVAL 1 HOUR)) AS ds FROM tops),
    k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ds DESC) AS a FROM a2)
    SELECT k.id, k.ds, metric, round(yhat, 6) AS yhat, round(yhat + 1.959964 * sd, 6) AS yhat_upper FROM k JOIN s2 ON k.id = s2.id AND (isodow(ds) - 1) * 24 + hour(ds) = slot WHERE a <= 336""", "long", "tops",
)
def weekly_ranges(spark, d):
    from ..operators.forecast import seasonal_ranges as ranges

    return ranges(si.long(spark, d)).select("id", "ds", "metric", *r6("yhat", "yhat_upper"))


_FLAG = "CASE WHEN value < yhat_lower OR value > yhat_upper THEN 'yes' ELSE 'no' END"


@query(
    f"""SELECT l.id, l.ds, l.metric, value, {_FLAG} AS anomaly,
    CASE WHEN value > yhat_upper THEN '#FF0000' WHEN value > yhat THEN '#FFD700' WHEN value < yhat THEN '#008000' ELSE '#000000' END AS hist_colour,
    CASE WHEN value > yhat_upper THEN '#FF0000' WHEN value > yhat THEN '#FFD700' ELSE '#008000' END AS fc_colour
    FROM long l LEFT JOIN ranges r ON l.id = r.id AND l.ds = r.ds AND l.metric = r.metric AND r.metric <> 'view'""", "ranges",
)
def flag_anomalies(spark, d):
    out = an.flag_anomalies(si.long(spark, d), si.ranges(spark, d).where("metric <> 'view'"))
    return out.select("id", "ds", "metric", "value", "anomaly", an.colour("value").alias("hist_colour"), an.colour("value", "forecast").alias("fc_colour"))


_FA = f"""fc AS (SELECT id, ds, metric, value * 1.5 AS predictions, value AS q20, value * 2 AS q80 FROM long WHERE ds > TIMESTAMP '{NOW}' AND ds <= TIMESTAMP '{NOW}' + INTERVAL 24 HOUR),
hs AS (SELECT id, ds, metric, value FROM long WHERE ds > TIMESTAMP '{NOW}' - INTERVAL 24 HOUR AND ds <= TIMESTAMP '{NOW}')"""


@query(
    f"""WITH {_FA} SELECT x.id, x.ds, x.metric, predictions, value, CASE WHEN predictions IS NULL THEN NULL WHEN predictions < yhat_lower OR predictions > yhat_upper THEN 'yes' ELSE 'no' END AS anomaly,
    CASE WHEN value IS NULL THEN NULL ELSE {_FLAG} END AS hist_anomaly, round(yhat, 6) AS yhat, CAST(date_diff('day', DATE '2024-01-15', CAST(x.ds AS DATE)) AS INTEGER) AS day_offset
    FROM (SELECT coalesce(fc.id, hs.id) AS id, coalesce(fc.ds, hs.ds) AS ds, coalesce(fc.metric, hs.metric) AS metric, predictions, value FROM fc FULL JOIN hs ON fc.id = hs.id AND fc.ds = hs.ds AND fc.metric = hs.metric) x
    LEFT JOIN ranges r ON x.id = r.id AND x.ds = r.ds AND x.metric = r.metric""", "ranges",
)
def forecast_anomaly_table(spark, d):
    x = si.long(spark, d)
    fc = fl.horizon(x, "ds", si.now(), 24).select("id", "ds", "metric", (F.col("value") * 1.5).alias("predictions"), F.col("value").alias("q20"), (F.col("value") * 2).alias("q80"))
    hs = fl.horizon(x, "ds", si.now() - F.expr("interval 24 hours"), 24)
    out = an.forecast_anomaly_table(fc, hs, si.ranges(spark, d), F.to_date(F.lit("2024-01-15")))
    return out.select("id", "ds", "metric", "predictions", "value", "anomaly", "hist_anomaly", *r6("yhat"), "day_offset")


_STATUS = "status AS (SELECT l.id, l.ds, l.metric, value, yhat, yhat_lower, yhat_upper, value > yhat_upper AS critical FROM long l JOIN tops t ON l.id = t.id AND l.ds = t.max_ds JOIN ranges r ON l.id = r.id AND l.ds = r.ds AND l.metric = r.metric)"


@query(f"WITH {_STATUS} SELECT id, ds, metric, value, round(yhat, 6) AS yhat, round(yhat_lower, 6) AS yhat_lower, round(yhat_upper, 6) AS yhat_upper, critical FROM status", "ranges")
def kpi_status(spark, d):
    return an.kpi_status(si.long(spark, d), si.ranges(spark, d, newest=True)).select("id", "ds", "metric", "value", *r6("yhat", "yhat_lower", "yhat_upper"), "critical")


_LOOSE = "loose AS (SELECT id, ds, metric, value, yhat / 4 AS yhat_upper FROM status)"


def _loose(spark, d, newest=False):
    """Ranges with a low upper bound, so that alerts exist."""
    return si.ranges(spark, d, newest).withColumn("yhat_upper", F.col("yhat") / 4)


@query(f"WITH {_STATUS}, {_LOOSE} SELECT id, ds, metric, value, round(yhat_upper, 1) AS yhat_upper FROM loose WHERE value > yhat_upper AND metric <> 'view'", "ranges")
def latest_alerts(spark, d):
    return an.latest_alerts(si.long(spark, d), _loose(spark, d, True), TYPES[:4])


@query(f"WITH {_STATUS}, {_LOOSE} SELECT id, metric, ds, CASE WHEN value > yhat_upper THEN '{{\"type\":\"AdaptiveCard\",\"body\":[{{\"type\":\"TextBlock\",\"text\":\"' || metric || ' is ' || CAST(value AS VARCHAR) || ', expected at most ' || CAST(round(yhat_upper, 1) AS VARCHAR) || '\"}}]}}' ELSE '{{}}' END AS payload FROM loose", "ranges")
def alert_payload(spark, d):
    return sk.alert_payload(an.kpi_status(si.long(spark, d), _loose(spark, d, True)))


@query(f"WITH {_STATUS}, {_LOOSE} SELECT id, ds, string_agg(metric || '=' || CAST(value AS VARCHAR), ',' ORDER BY metric) AS facts FROM loose WHERE value > yhat_upper GROUP BY 1, 2", "ranges")
def alert_facts(spark, d):
    facts = sk.alert_facts(an.latest_alerts(si.long(spark, d), _loose(spark, d, True)))
    return facts.select("id", "ds", F.array_join(F.transform("facts", lambda x: F.concat(x["name"], F.lit("="), x["value"])), ",").alias("facts"))


@query("SELECT l.id, l.ds, l.metric, value, round(yhat_upper, 6) AS yhat_upper, coalesce(value > yhat_upper, false) AS above FROM long l LEFT JOIN ranges r ON l.id = r.id AND l.ds = r.ds AND l.metric = r.metric WHERE l.metric = 'error' AND CAST(l.ds AS DATE) = DATE '2024-01-15'", "ranges")
def today_vs_range(spark, d):
    out = an.today_vs_range(si.long(spark, d), si.ranges(spark, d), "error", F.to_date(F.lit("2024-01-15")))
    return out.select("id", "ds", "metric", "value", *r6("yhat_upper"), "above")


@query(f"WITH {_STATUS} SELECT id, ds, metric, value, round(yhat, 6) AS yhat, CASE metric WHEN 'click' THEN 'Clicks' WHEN 'error' THEN 'Errors' END AS description FROM status", "ranges")
def snapshot(spark, d):
    dic = spark.createDataFrame([("click", "Clicks"), ("error", "Errors")], "metric string, description string")
    return an.snapshot(si.long(spark, d), si.ranges(spark, d), dic).select("id", "ds", "metric", "value", *r6("yhat"), "description")


@query(
    """SELECT coalesce(e.id, a.id) AS id, coalesce(e.hour, a.hour) AS hour, round(expected, 6) AS expected, actual, coalesce(is_now, false) AS is_now FROM
    (SELECT r.id, CAST(hour(ds) AS INTEGER) AS hour, yhat AS expected FROM ranges r JOIN tops USING (id) WHERE metric = 'error' AND CAST(ds AS DATE) = CAST(max_ds AS DATE)) e
    FULL JOIN (SELECT l.id, CAST(hour(ds) AS INTEGER) AS hour, value AS actual, ds = max_ds AS is_now FROM long l JOIN tops USING (id) WHERE metric = 'error' AND CAST(ds AS DATE) = CAST(max_ds AS DATE)) a
    ON e.id = a.id AND e.hour = a.hour""", "ranges",
)
def day_profile(spark, d):
    return an.day_profile(si.long(spark, d), si.ranges(spark, d), "error").select("id", "hour", *r6("expected"), "actual", "is_now")


@query(
    f"""WITH f AS (SELECT id, ds, n, row_number() OVER (PARTITION BY id ORDER BY ds) AS k FROM hourly WHERE ds > TIMESTAMP '{NOW}')
    SELECT id, ds, 'n' AS target_name, n * 1.0::DOUBLE AS none, n * 1.0::DOUBLE - CASE WHEN k <= 8 THEN 2 ELSE 0 END AS busy, CAST(CASE WHEN k <= 8 THEN 2 ELSE 0 END AS DOUBLE) AS reduction FROM f WHERE k <= 24""", "hourly",
)
def what_if(spark, d):
    fut = fl.first_n(si.hourly(spark, d).where(F.col("ds") > si.now()).select("id", "ds", "n"), 24)
    rows = an.scenarios(fut, {"none": 0, "busy": 8})
    scored = rows.select("id", "ds", F.lit("n").alias("target_name"), "scenario", (F.col("n").cast("double") - 2 * F.col("oncall_busy")).alias("predictions"))
    return an.what_if(scored, "none", "busy")
