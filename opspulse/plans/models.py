"""Queries of forecasts, back-tests and streams; SQL where it can express them."""

from __future__ import annotations

import functools
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anomaly as an
from ..operators import backtest as bt
from ..operators import filters as fl
from ..operators import forecast as fc
from ..operators import gram as gm
from ..operators import lagsums as ls
from ..operators import timeseries as ts
from ..operators.reshape import to_long
from ..streaming import stream as st
from . import standins as si
from .queries import _ACT, _LOOSE, _STATUS, _loose, _oncall, holidays, query, r6
from .standins import NOW, TYPES


def regular(spark: SparkSession, d: str) -> DataFrame:
    """The counts of each site on a full hourly axis."""
    h = si.hourly(spark, d).select("id", "ds", *TYPES)
    return to_long(ts.regularize(h, TYPES), TYPES)


_FILLED = ", ".join(f"last_value({t} IGNORE NULLS) OVER w AS {t}" for t in TYPES)
_LONG = " UNION ALL ".join(f"SELECT id, ds, '{t}' AS metric, CAST({t} AS DOUBLE) AS value FROM fj" for t in TYPES)
_REG = f"""fa AS (SELECT id, unnest(generate_series(min(ds), max(ds), INTERVAL 1 HOUR)) AS ds FROM hourly GROUP BY id),
fj AS (SELECT a.id, a.ds, {_FILLED} FROM fa a LEFT JOIN hourly h ON a.id = h.id AND a.ds = h.ds
  WINDOW w AS (PARTITION BY a.id ORDER BY a.ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
reg AS ({_LONG}),
cut AS (SELECT id, unnest(generate_series(b - INTERVAL 24 HOUR, a + INTERVAL 240 HOUR, INTERVAL '-1 hours')) AS cutoff FROM (SELECT id, min(ds) AS a, max(ds) AS b FROM fa GROUP BY id)),
bt AS (SELECT c.id, g.metric, cutoff, g.ds, CAST(date_diff('hour', cutoff, g.ds) AS INTEGER) AS horizon, g.value AS y,
  (SELECT avg(p.value) FROM reg p WHERE p.id = g.id AND p.metric = g.metric AND p.ds <= cutoff AND hour(p.ds) = hour(g.ds)) AS yhat
  FROM cut c JOIN reg g ON c.id = g.id AND g.ds > cutoff AND g.ds <= cutoff + INTERVAL 24 HOUR)"""


def _backtest(spark, d):
    """Each hour after ten days of history is a cutoff."""
    x = regular(spark, d)
    return bt.backtest_seasonal(x, bt.make_cutoffs(x, 240, 1, 24))


@query(f"WITH {_REG} SELECT id, cutoff FROM cut", "hourly")
def make_cutoffs(spark, d):
    return bt.make_cutoffs(regular(spark, d), 240, 1, 24)


@query(f"WITH {_REG} SELECT id, metric, cutoff, ds, horizon, y, round(yhat, 6) AS yhat FROM bt", "hourly")
def backtest(spark, d):
    return _backtest(spark, d).select("id", "metric", "cutoff", "ds", "horizon", "y", *r6("yhat"))


_SCORE = "count(*) AS n, round(avg((y - yhat) ** 2), 6) AS mse, round(sqrt(avg((y - yhat) ** 2)), 6) AS rmse, round(avg(abs(y - yhat)), 6) AS mae, round(avg(abs(y - yhat) / greatest(abs(y), 2.220446049250313e-16)) / 1e12, 3) AS mape"


def _rounded(scores: DataFrame, *by: str) -> DataFrame:
    return scores.select(*by, "n", *r6("mse", "rmse", "mae"), F.round(F.col("mape") / 1e12, 3).alias("mape"))


@query(f"WITH {_REG} SELECT id, metric, {_SCORE} FROM bt GROUP BY 1, 2", "hourly")
def backtest_score(spark, d):
    return _rounded(bt.score(_backtest(spark, d)), "id", "metric")


@query(f"WITH {_REG} SELECT horizon, {_SCORE} FROM bt GROUP BY 1", "hourly")
def score_by_horizon(spark, d):
    return _rounded(bt.score(_backtest(spark, d), ["horizon"]), "horizon")


@query(f"WITH {_REG}, p AS (SELECT id, metric, cutoff, avg((y - yhat) ** 2) AS m FROM bt GROUP BY 1, 2, 3) SELECT metric, dayname(cutoff) AS weekday_name, count(*) AS cutoffs, round(avg(m), 6) AS mse, round(avg(sqrt(m)), 6) AS rmse FROM p GROUP BY 1, 2", "hourly")
def score_by_weekday(spark, d):
    x = _backtest(spark, d)
    per = bt.score(x, ["id", "metric", "cutoff"])
    out = per.groupBy("metric", F.date_format("cutoff", "EEEE").alias("weekday_name")).agg(F.count("*").alias("cutoffs"), F.avg("mse").alias("mse"), F.avg("rmse").alias("rmse"))
    return out.select("metric", "weekday_name", "cutoffs", *r6("mse", "rmse"))


@query(f"WITH {_REG}, p AS (SELECT id, metric, cutoff, avg((y - yhat) ** 2) AS m, avg(abs(y - yhat) / greatest(abs(y), 2.220446049250313e-16)) AS a FROM bt GROUP BY 1, 2, 3) SELECT id, metric, dayname(cutoff) AS weekday_name, count(*) AS cutoffs, round(avg(m), 6) AS mse, round(avg(sqrt(m)), 6) AS rmse, round(avg(a) / 1e12, 3) AS mape FROM p GROUP BY 1, 2, 3", "hourly")
def score_by_cutoff(spark, d):
    out = bt.score_by_cutoff(_backtest(spark, d), weekday=True)
    return out.select("id", "metric", "weekday_name", "cutoffs", *r6("mse", "rmse"), F.round(F.col("mape") / 1e12, 3).alias("mape"))


_WEEKLY = """, two AS (SELECT id, metric, 'daily' AS model, y, yhat FROM bt UNION ALL
SELECT c.id, g.metric, 'weekly', g.value, (SELECT avg(p.value) FROM reg p WHERE p.id = g.id AND p.metric = g.metric AND p.ds <= cutoff AND hour(p.ds) = hour(g.ds) AND dayofweek(p.ds) = dayofweek(g.ds))
  FROM cut c JOIN reg g ON c.id = g.id AND g.ds > cutoff AND g.ds <= cutoff + INTERVAL 24 HOUR),
sc AS (SELECT id, metric, model, sqrt(avg((y - yhat) ** 2)) AS rmse FROM two GROUP BY 1, 2, 3)"""


@query(f"WITH {_REG}{_WEEKLY} SELECT id, metric, arg_min(model, rmse) AS model, round(min(rmse), 6) AS rmse FROM sc GROUP BY 1, 2", "hourly")
def compare_models(spark, d):
    x = regular(spark, d)
    return bt.compare_models(x, bt.make_cutoffs(x, 240, 1, 24), {"daily": 24, "weekly": 168})[1].select("id", "metric", "model", *r6("rmse"))


@query(None)
def compare_candidates(spark, d):
    """Slot means, autoregression and regressions with and without covariates over the same cutoffs: the best for each series."""
    past, _ = _covariates(spark, d)
    x = past.select("id", F.col("target_name").alias("metric"), "ds", "value")
    cuts = bt.make_cutoffs(x, 240, 48, 24)
    cols = ["id", "metric", "model", "y", "yhat"]
    parts = [fc.ablation(past, cuts, {"calendar": [], "covariates": VARIANTS["all"]}).select(cols)]
    parts += [bt.backtest_seasonal(x, cuts, season=n).withColumn("model", F.lit(name)).select(cols) for name, n in (("daily", 24), ("weekly", 168))]
    parts += [fc.ar_backtest(x, cuts).withColumn("model", F.lit("autoregression")).select(cols)]
    return bt.best_model(bt.score(functools.reduce(DataFrame.unionByName, parts), ["id", "metric", "model"]))


@query(None)
def trend_season_ranges(spark, d):
    days = fc.holiday_days(spark, (1994, 2003))
    return fc.trend_season_ranges(si.daily(spark, d, F.col("o_orderpriority")), holidays=days)


@query(None)
def ar_forecast(spark, d):
    return fc.ar_forecast(regular(spark, d))


@query(f"WITH {_REG} SELECT a.id, a.metric, CAST(lag AS INTEGER) AS lag, sum(a.value * b.value) AS products FROM reg a CROSS JOIN (SELECT unnest(range(72)) AS lag) JOIN reg b ON a.id = b.id AND a.metric = b.metric AND b.ds = a.ds - to_hours(lag) GROUP BY ALL", "hourly")
def lag_sums(spark, d):
    """Products of each series with itself at 0 to 71 hours' distance, added up over blocks: what an autoregression is solved from."""
    x = regular(spark, d)
    blocks = ls.hour_blocks(x, 72).withColumn("shift", F.lit(0.0))  # counts as they are, so that sums are whole numbers
    each = ls.lag_totals(blocks, 72).select("id", "metric", F.posexplode("sums").alias("pos", "s")).where("pos > 0")
    return each.groupBy("id", "metric", (F.col("pos") - 1).alias("lag")).agg(F.sum("s").alias("products"))


_ONE_LAG = """few AS (SELECT id, unnest(generate_series(b - INTERVAL 24 HOUR, a + INTERVAL 480 HOUR, INTERVAL '-7 hours')) AS cutoff FROM (SELECT id, min(ds) AS a, max(ds) AS b FROM fa GROUP BY id)),
pr AS (SELECT p.id, p.metric, h, p.ds, q.ds AS goal, p.value AS x, q.value AS y FROM reg p CROSS JOIN (SELECT unnest([1, 2, 3]) AS h) JOIN reg q ON p.id = q.id AND p.metric = q.metric AND q.ds = p.ds + to_hours(h)),
fit AS (SELECT c.id, metric, cutoff, h, avg(y) AS my, avg(x) AS mx, CASE WHEN var_pop(x) > 1e-12 THEN covar_pop(x, y) / var_pop(x) ELSE 0 END AS slope
  FROM few c JOIN pr ON pr.id = c.id AND pr.ds > cutoff - INTERVAL 336 HOUR AND goal <= cutoff GROUP BY ALL)"""


@query(f"WITH {_REG}, {_ONE_LAG} SELECT f.id, f.metric, cutoff, ds + to_hours(f.h) AS ds, CAST(f.h AS INTEGER) AS horizon, y, round(my + slope * (x - mx), 3) AS yhat FROM fit f JOIN pr ON pr.id = f.id AND pr.metric = f.metric AND pr.h = f.h AND pr.ds = cutoff", "hourly")
def ar_one_lag(spark, d):
    """The autoregression on one lag as of every seventh hour, from two weeks before it."""
    x = regular(spark, d)
    out = fc.ar_backtest(x, bt.make_cutoffs(x, 480, 7, 24), lags=1, steps=3, history=336)
    return out.withColumn("yhat", F.round("yhat", 3))


@query(None)
def ar_backtest_hourly(spark, d):
    """Scores by horizon of the autoregression on 48 lags, refitted at a cutoff every hour, at most the last 720 of each site."""
    x = regular(spark, d)
    cuts = fl.last_n(bt.make_cutoffs(x, 240, 1, 24), 720, ["id"], "cutoff")
    return bt.score(fc.ar_backtest(x, cuts), ["metric", "horizon"])


@query(None)
def chained_forecast(spark, d):
    return fc.chained_forecast(regular(spark, d), "error", "view")


def _covariates(spark, d):
    """History before NOW and the 24 hours after, with holiday, staffing and weather columns."""
    from ..functions.calendar import add_holidays
    from ..operators.intervals import expand_intervals

    staff = expand_intervals(si.shifts(spark, d), "shift_start", "shift_end").groupBy("ds").agg(F.count("*").cast("double").alias("staff"))
    x = si.hourly(spark, d).join(staff, "ds").join(si.weather(spark, d), "ds")
    x = x.join(si.labels01(spark, d), "ds", "left").withColumn("oncall_busy", F.coalesce(F.col("oncall_busy"), F.lit(0)).cast("double"))
    x = add_holidays(x, "ds", holidays(spark)).withColumn("holiday", (F.col("is_qc_holiday") == "yes").cast("double"))
    cols = ["staff", "temperature", "holiday", "oncall_busy"]
    hist = x.where(F.col("ds") <= si.now())
    past = to_long(hist, TYPES, ["id", "ds", *cols]).withColumnRenamed("metric", "target_name")
    return past, fl.horizon(x, "ds", si.now(), 24).select("id", "ds", *cols)


VARIANTS = {"basic": [], "holidays": ["holiday"], "staffing": ["staff"], "weather": ["temperature"], "all": ["holiday", "staff", "temperature"]}


@query(None)
def covariate_forecast(spark, d):
    past, future = _covariates(spark, d)
    return fc.run_variants(past, future, VARIANTS)


@query(None)
def ablation(spark, d):
    """Scores of each covariate set over daily cutoffs."""
    past, _ = _covariates(spark, d)
    cuts = bt.make_cutoffs(past.select("id", "ds"), 240, 24, 24)
    return bt.score(fc.ablation(past, cuts, VARIANTS), ["metric", "model"])


_DAYS = "(date_part('epoch', CAST(date AS TIMESTAMP)) / 86400)"
_TREND = {"one": "1", "trend": f"({_DAYS} - start)", "sin": f"sin(2 * pi() * {_DAYS} / 7)", "cos": f"cos(2 * pi() * {_DAYS} / 7)"}
_TREND_SUMS = ", ".join(f"round(sum({x} * {y}), 4) AS {a}_{b}" for i, (a, x) in enumerate(_TREND.items()) for b, y in [*list(_TREND.items())[i:], ("value", "value")])


@query(f"WITH s AS (SELECT id, date, value, min({_DAYS}) OVER (PARTITION BY id) AS start FROM (SELECT o_orderpriority AS id, CAST(o_orderdate AS DATE) AS date, count(*) AS value FROM orders GROUP BY 1, 2)) SELECT id, count(*) AS n, {_TREND_SUMS} FROM s GROUP BY id")
def trend_gram(spark, d):
    """The sums from which a trend with a weekly wave is solved, for each series."""
    rows = si.daily(spark, d, F.col("o_orderpriority")).withColumn("t", F.unix_date("date").cast("double"))
    rows = rows.join(rows.groupBy("id").agg(F.min("t").alias("start")), "id")
    wave = gm.fourier(F.col("t"), 7.0, 1)
    columns = {"one": F.lit(1.0), "trend": F.col("t") - F.col("start"), "sin": wave[0], "cos": wave[1]}
    out, names, at = gm.gram(rows, ["id"], columns, F.col("value")), list(columns), 0
    shown = []
    for i, a in enumerate(names):
        for b in names[i:]:
            shown.append(F.round(F.get("g", F.lit(at)), 4).alias(f"{a}_{b}"))
            at += 1
        shown.append(F.round(F.get("b", F.lit(i)), 4).alias(f"{a}_value"))
    return out.select("id", "n", *shown)


_CELL = ["s", "s_past", "s_y", "s_past_past", "s_past_y", "s_y_y"]
_CELL_SQL = "count(*) AS s, sum(past) AS s_past, sum(y) AS s_y, sum(past * past) AS s_past_past, sum(past * y) AS s_past_y, sum(y * y) AS s_y_y"
_WEEKS = """wk AS (SELECT g.id, g.metric, g.ds, g.value AS y, p.value AS past FROM reg g JOIN reg p ON p.id = g.id AND p.metric = g.metric AND p.ds = g.ds - INTERVAL 7 DAY),
few AS (SELECT id, unnest(generate_series(b - INTERVAL 24 HOUR, a + INTERVAL 480 HOUR, INTERVAL '-7 hours')) AS cutoff FROM (SELECT id, min(ds) AS a, max(ds) AS b FROM fa GROUP BY id))"""


def _with_past(spark, d):
    x = regular(spark, d).withColumnRenamed("value", "y")
    earlier = x.select("id", "metric", (F.col("ds") + F.expr("interval 7 days")).alias("ds"), F.col("y").alias("past"))
    return x, x.join(earlier, ["id", "metric", "ds"], "left")


@query(f"WITH {_REG}, {_WEEKS} SELECT id, metric, hour(ds) AS hour, CAST(isodow(ds) - 1 AS INTEGER) AS day, {_CELL_SQL} FROM wk GROUP BY ALL", "hourly")
def season_cells(spark, d):
    """Products of last week's value and this one's for each weekday's hour: the state of a seasonal regression."""
    out = gm.cells(_with_past(spark, d)[1], ["id", "metric"], ["past", "y"])
    return out.select("id", "metric", "hour", "day", F.col("s").cast("long").alias("s"), *_CELL[1:])


@query(f"WITH {_REG}, {_WEEKS} SELECT w.id, metric, cutoff, {_CELL_SQL} FROM few c JOIN wk w ON w.id = c.id AND w.ds <= cutoff AND w.ds > cutoff - INTERVAL 336 HOUR GROUP BY ALL", "hourly")
def cells_as_of(spark, d):
    """The state of the two weeks before each cutoff, as the difference of two running sums."""
    x, both = _with_past(spark, d)
    running = gm.running_cells(both, ["id", "metric"], ["past", "y"])
    out = gm.cells_as_of(running, bt.make_cutoffs(x, 480, 7, 24), ["id", "metric"], ["past", "y"], 336)
    return out.groupBy("id", "metric", "cutoff").agg(F.sum("s").cast("long").alias("s"), *[F.sum(c).alias(c) for c in _CELL[1:]])


@query(None)
def ablation_hourly(spark, d):
    """Scores of each covariate set over a cutoff every hour, at most the last 720 of each site."""
    past, _ = _covariates(spark, d)
    cuts = fl.last_n(bt.make_cutoffs(past.select("id", "ds"), 240, 1, 24), 720, ["id"], "cutoff")
    return bt.score(fc.ablation(past, cuts, VARIANTS), ["metric", "model", "horizon"])


@query(None)
def forecast_effects(spark, d):
    past, future = _covariates(spark, d)
    out = fc.run_variants(past, future, VARIANTS)
    return an.variant_effects(out, "basic", ["holidays", "staffing", "weather", "all"])[1]


@query(None)
def forecast_need(spark, d):
    past, future = _covariates(spark, d)
    need = past.where("target_name = 'error'").select("id", "ds", F.lit("oncall_busy").alias("target_name"), F.col("oncall_busy").alias("value"), "staff", "temperature")
    step = iter(range(1000))
    out = _scratch(spark)

    def keep(df):
        path = f"{out}/{next(step)}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return fc.oncall_need(need, future, ["staff", "temperature"], keep)


@query(None)
def multiplicative_forecast(spark, d):
    past, future = _covariates(spark, d)
    return fc.covariate_forecast(past, future, {"past_only": ["staff", "temperature"]}, multiplicative=True, future_fill=0.0)


@query(None)
def oncall_what_if(spark, d):
    """Four and eight hours on call against none: one fitted model, scenarios are rows that it scores."""
    past, future = _covariates(spark, d)
    hours = {"tbs_no_oncall": 0, "tbs_with_oncall": 8, "tbs_with_4h": 4}
    out = fc.CovariateModel(past, {"oncall": ["oncall_busy"]}).score(an.scenarios(future, hours), keep=["scenario"])
    return functools.reduce(
        DataFrame.unionByName,
        [an.what_if(out, "tbs_no_oncall", name).withColumn("against_none", F.lit(hours[name])).withColumnRenamed(name, "with_oncall") for name in ("tbs_with_oncall", "tbs_with_4h")],
    )


_SWEEP = """j AS (SELECT y.id, x.metric AS regressor, y.value AS v, lag(y.value) OVER w AS v1, lag(x.value) OVER w AS x1
  FROM long y JOIN long x ON y.id = x.id AND y.ds = x.ds WHERE y.metric = 'error' WINDOW w AS (PARTITION BY y.id, x.metric ORDER BY y.ds)),
c AS (SELECT id, regressor, count(*) AS n, var_pop(v) AS var, corr(v, v1) AS a, corr(v, x1) AS b, corr(v1, x1) AS ab FROM j WHERE v1 IS NOT NULL GROUP BY 1, 2)"""


@query(f"WITH {_SWEEP} SELECT id, regressor, n, round(sqrt(var * (1 - CASE WHEN 1 - ab * ab < 1e-9 THEN a * a ELSE (a * a + b * b - 2 * a * b * ab) / (1 - ab * ab) END)), 4) AS rmse FROM c", "long")
def regressor_sweep(spark, d):
    return fc.regressor_sweep(si.long(spark, d), "error", TYPES).withColumn("rmse", F.round("rmse", 4))


def _daily_series(spark, d):
    return si.daily(spark, d, F.col("o_orderpriority")).select("id", F.col("date").cast("timestamp_ntz").alias("ds"), "value")


@query(None)
def grid_search(spark, d):
    grid = [{"daily": 0, "weekly": w, "yearly": y} for w in (0, 3) for y in (0, 5, 10)]
    return fc.grid_search(_daily_series(spark, d), grid)


@query(None)
def holiday_sets(spark, d):
    from ..functions.calendar import hebrew_dim, holiday_dim

    both = holiday_dim(spark, (1994, 2003), custom=hebrew_dim(spark, (1994, 2003)))
    sets = {"none": [], "qc": ["qc"], "il": ["il"], "both": ["qc", "il"]}
    return fc.holiday_sets(_daily_series(spark, d), both, sets, {"weekly": 3, "yearly": 10})


@query(f"WITH {_REG} SELECT id, metric, ds + INTERVAL 1 DAY AS ds, value AS predictions FROM (SELECT *, row_number() OVER (PARTITION BY id, metric ORDER BY ds DESC) AS k FROM reg) WHERE k <= 24", "hourly")
def user_model(spark, d):
    def last_day(key, g):
        import pandas as pd

        tail = g.tail(24)
        return pd.DataFrame({"id": key[0], "metric": key[1], "ds": tail["ds"] + pd.Timedelta(days=1), "predictions": tail["value"]})

    return fc.forecast_with(regular(spark, d), last_day, "id string, metric string, ds timestamp_ntz, predictions double")


# --- streams, each run over what is there


def _scratch(spark: SparkSession) -> str:
    """A new folder that all executors share where the session names one."""
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='opspulse-')}"
    return f"{base}/stream-{uuid.uuid4().hex}"


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    return spark.readStream.schema(si.events(spark, d).schema).option("pathGlobFilter", "events.parquet").parquet(d)


@query("SELECT date_trunc('hour', ts) AS ds, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_inflow(spark, d):
    """Hourly inflow by Structured Streaming over the events, in update mode; the batch result must be the same."""
    out = _scratch(spark)
    st.start_inflow(_event_stream(spark, d), f"{out}/hours", f"{out}/checkpoint", by=["event_type"], event="event_id").awaitTermination()
    return st.inflow_table(spark, f"{out}/hours", ["event_type"]).withColumn("ds", F.col("ds").cast("timestamp_ntz"))


@query(f"SELECT user_id, max(ts) AS ds, count(*) AS events FROM events WHERE ts < TIMESTAMP '{NOW}' GROUP BY 1")
def stream_upsert(spark, d):
    """foreachBatch upsert keyed by user: the newest row wins."""
    out = _scratch(spark)
    rows = _event_stream(spark, d).where(F.col("ts") < si.now())

    def newest(batch):
        return batch.groupBy("user_id").agg(F.max("ts").alias("ds"), F.count("*").alias("events")).withColumn("_order", F.col("ds"))

    q = st.start_ingest(rows, out, f"{out}/checkpoint", ["user_id"], newest, F.pmod(F.hash("user_id"), F.lit(16)))
    q.awaitTermination()
    return st.newest_version(spark, out, newest(rows).drop("_order").schema).drop("v", "part")


@query(f"WITH {_STATUS}, {_LOOSE} SELECT id, ds, metric, value, round(yhat_upper, 1) AS yhat_upper FROM loose WHERE value > yhat_upper", "ranges")
def stream_alerts(spark, d):
    """Alerts on arrival: one batch of hourly rows against static ranges."""
    out = _scratch(spark)
    si.long(spark, d).write.parquet(f"{out}/rows")
    rows = spark.readStream.schema("id string, ds timestamp_ntz, metric string, value double").parquet(f"{out}/rows")
    q = st.start_alerts(rows, _loose(spark, d), f"{out}/alerts", f"{out}/checkpoint")
    q.awaitTermination()
    found = spark.read.schema("id string, ds timestamp_ntz, metric string, value double, yhat_upper double").parquet(f"{out}/alerts/batch=*")
    return found


_CHANGES = """h AS (SELECT l.id, l.ds, l.metric, l.value, yhat_upper, coalesce(l.value > yhat_upper, false) AS hot FROM long l LEFT JOIN loose_ranges r ON l.id = r.id AND l.ds = r.ds AND l.metric = r.metric),
c AS (SELECT *, lag(hot, 1, false) OVER (PARTITION BY id, metric ORDER BY ds) AS was FROM h)
SELECT id, metric, ds, CASE WHEN hot THEN 'opened' ELSE 'closed' END AS change, value FROM c WHERE hot <> was"""


@query("WITH loose_ranges AS (SELECT id, ds, metric, yhat + 0.5 * sd AS yhat_upper FROM (SELECT ax.id, ax.ds, metric, yhat, sd FROM ax JOIN stats ON ax.id = stats.id AND hour(ax.ds) = slot)), " + _CHANGES, "long", "ranges")
def stream_alert_changes(spark, d):
    """Alerts opened and closed, once each, with state by site and metric."""
    out = _scratch(spark)
    si.long(spark, d).write.parquet(f"{out}/rows")
    limits = si.ranges(spark, d).select("id", "ds", "metric", (F.col("yhat") + 0.5 * (F.col("yhat_upper") - F.col("yhat")) / 1.959964).alias("yhat_upper"))
    limits.write.parquet(f"{out}/ranges")
    rows = spark.readStream.schema("id string, ds timestamp_ntz, metric string, value double").parquet(f"{out}/rows")
    changes = st.alert_changes(rows, spark.read.parquet(f"{out}/ranges"))
    q = changes.writeStream.format("parquet").outputMode("append").option("path", f"{out}/changes").option("checkpointLocation", f"{out}/checkpoint")
    q.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(changes.schema).parquet(f"{out}/changes")


_BLOCKS = """WITH a AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
b AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM a)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 2 HOUR AS "end", count(*) AS n FROM b GROUP BY user_id, k"""


@query(_BLOCKS)
def stream_busy_blocks(spark, d):
    """Sessions of activity; a last row without a user moves the watermark, so that open sessions are emitted too."""
    out = _scratch(spark)
    own = _event_stream(spark, d).select("user_id", "ts")
    last = si.events(spark, d).agg((F.max("ts") + F.expr("interval 30 days")).alias("ts")).select(F.lit(None).cast(own.schema["user_id"].dataType).alias("user_id"), "ts")
    last.write.parquet(f"{out}/last")
    rows = own.unionByName(spark.readStream.schema(last.schema).parquet(f"{out}/last"))
    q = st.busy_blocks_stream(rows).writeStream.format("parquet").outputMode("append")
    q = q.option("checkpointLocation", f"{out}/checkpoint").option("path", f"{out}/blocks").trigger(availableNow=True).start()
    q.awaitTermination()
    found = spark.read.schema("user_id long, start timestamp, end timestamp, n long").parquet(f"{out}/blocks").where("user_id is not null")
    return found.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


_ONCALL_BLOCKS = f"""WITH {_ACT}, f AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM act WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
g AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM f)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 2 HOUR AS "end", count(*) AS n FROM g GROUP BY user_id, k"""


@query(_ONCALL_BLOCKS, "shifts")
def stream_oncall_blocks(spark, d):
    """Blocks of on-call activity outside regular shifts: streams of activity and of both schedules, joined within bounds in time."""
    out = _scratch(spark)
    activity, oncall, regular_shifts = _oncall(spark, d)
    # moves the watermarks, so that all is emitted; its user is not null, since rows without a user are dropped before the watermark
    after = activity.agg((F.max("ts") + F.expr("interval 30 days")).alias("at"))
    kind = activity.schema["user_id"].dataType

    def stream(rows: DataFrame, name: str) -> DataFrame:
        last = after.select(F.lit(-1).cast(kind).alias("user_id"), *[F.col("at").alias(c) for c in rows.columns[1:]])
        rows.unionByName(last).write.parquet(f"{out}/{name}")
        return spark.readStream.schema(rows.schema).parquet(f"{out}/{name}")

    parts = [stream(activity.select("user_id", "ts"), "activity"), stream(oncall, "oncall"), stream(regular_shifts, "regular")]
    q = st.oncall_blocks_stream(*parts).writeStream.format("parquet").outputMode("append")
    q = q.option("checkpointLocation", f"{out}/checkpoint").option("path", f"{out}/blocks").trigger(availableNow=True).start()
    q.awaitTermination()
    found = spark.read.schema("user_id long, start timestamp, end timestamp, n long").parquet(f"{out}/blocks")
    return found.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


@query("SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS ds, count(*) AS n FROM events GROUP BY 1")
def stream_inflow_daily(spark, d):
    """Daily inflow by Structured Streaming, in append mode: each day is emitted once, when the watermark has passed it."""
    out = _scratch(spark)
    own = _event_stream(spark, d).select("ts")
    last = si.events(spark, d).agg((F.max("ts") + F.expr("interval 30 days")).alias("ts"))
    last.write.parquet(f"{out}/last")
    rows = own.unionByName(spark.readStream.schema(last.schema).parquet(f"{out}/last"))
    q = st.inflow_stream(rows, window="1 day").writeStream.format("parquet").outputMode("append")
    q = q.option("checkpointLocation", f"{out}/checkpoint").option("path", f"{out}/days").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema("ds timestamp, n long").parquet(f"{out}/days").select(F.col("ds").cast("timestamp_ntz").alias("ds"), "n")
