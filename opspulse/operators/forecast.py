"""Expected ranges and forecasts, every series in parallel.

Seasonal ranges are aggregates and joins alone. Trend, holiday and covariate regressions are
solved from sums that Spark adds up (``gram``); their coefficients are a table, and scoring is a
join. Autoregressions are solved from lag sums (``lagsums``), on a whole series or as of any cutoff.
Only a user's own model (``forecast_with``) gets a series in one task, ``HISTORY`` of its newest rows by default.
"""

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import gram as gm
from . import lagsums as ls
from .filters import last_n
from .timeseries import extend

Z95 = 1.959964
HISTORY = 24 * 365 * 3  # newest rows of a series that a user's model reads


def slot(ts: Column | str, season: str) -> Column:
    """Season slot of a stamp: hour_of_day, hour_of_week (Monday first) or day_of_week."""
    if season == "hour_of_day":
        return F.hour(ts)
    return F.weekday(ts) * 24 + F.hour(ts) if season == "hour_of_week" else F.weekday(ts)


def seasonal_ranges(long: DataFrame, horizon: int = 48, keep: int | None = 336, z: float = Z95, season: str = "hour_of_week", at: DataFrame | None = None) -> DataFrame:
    """(id, ds, metric, yhat, yhat_lower, yhat_upper): mean +/- z sd of the slot, over history and ``horizon`` hours more.

    at: (id, ds), the only hours wanted; the axis is then not built.
    """
    keys = ["id", "metric"]
    stats = long.withColumn("slot", slot("ds", season)).groupBy(*keys, "slot").agg(F.avg("value").alias("yhat"), F.stddev_samp("value").alias("sd"))
    if at is not None:
        ahead = at.select("id", "ds")
    else:
        history = long.select("id", "ds").distinct()
        ahead = history.unionByName(extend(history, horizon)) if horizon else history
        if keep is not None:
            ahead = last_n(ahead, keep, ["id"], "ds")
    half = z * F.col("sd")
    rows = ahead.withColumn("slot", slot("ds", season)).join(stats, ["id", "slot"])
    return rows.select("id", "ds", "metric", "yhat", (F.col("yhat") - half).alias("yhat_lower"), (F.col("yhat") + half).alias("yhat_upper"))


def _trend_columns(t: Column, start: Column, seasons: dict[str, tuple[float, int]]) -> dict[str, Column]:
    """Intercept, trend since the series' start, and Fourier terms by name; t in days."""
    out = {"one": F.lit(1.0), "trend": t - start}
    for name, (period, order) in seasons.items():
        out |= {f"{name}{i}": c for i, c in enumerate(gm.fourier(t, period, order))}
    return out


def trend_season_ranges(
    daily: DataFrame, horizon: int = 30, history: int | None = 1095, keep: int | None = 44, z: float = Z95,
    seasons: tuple[tuple[float, int], ...] = ((7.0, 3), (365.25, 10)), holidays: DataFrame | None = None,
) -> DataFrame:
    """(id, date, yhat, yhat_lower, yhat_upper): linear trend, Fourier seasons and a holiday step on the last ``history`` days (None: all).

    daily: (id, date, value). holidays: a ``date`` column, a few rows a year. The fit is one aggregate of
    products; bands come from the same sums, and scoring is a join.
    """
    rows = daily.select("id", "date", F.col("value").cast("double"))
    rows = rows if history is None else last_n(rows, history, ["id"], "date")
    columns = _trend_columns(F.unix_date("date").cast("double"), F.col("start"), {f"p{i}_": s for i, s in enumerate(seasons)}) | {"holiday": F.col("hol")}
    start = rows.groupBy("id").agg(F.unix_date(F.min("date")).cast("double").alias("start"))

    def with_columns(df: DataFrame) -> DataFrame:
        days = None if holidays is None else holidays.select("date", F.lit(1.0).alias("hol")).distinct()
        df = df.withColumn("hol", F.lit(0.0)) if days is None else df.join(days, "date", "left").na.fill(0.0, ["hol"])
        return df.join(start, "id")

    fit = gm.solve(gm.gram(with_columns(rows), ["id"], columns, F.col("value")), ["id"], list(columns), {"all": list(columns)})
    ahead = extend(daily.select("id", F.col("date").cast("timestamp_ntz").alias("ds")), horizon, unit="day").select("id", F.to_date("ds").alias("date"))
    axis = rows.select("id", "date").unionByName(ahead)
    axis = axis if keep is None else last_n(axis, keep, ["id"], "date")
    half = z * F.sqrt(F.greatest(F.col("sse") - F.col("n") * F.col("mean") * F.col("mean"), F.lit(0.0)) / (F.col("n") - 1))
    scored = with_columns(axis).join(fit, "id").withColumn("yhat", gm.dot("coef", list(columns.values())))
    return scored.select("id", "date", "yhat", (F.col("yhat") - half).alias("yhat_lower"), (F.col("yhat") + half).alias("yhat_upper"))


def ar_fit(long: DataFrame, lags: int = 48, steps: int = 24, quantiles: tuple[float, ...] = (0.2, 0.5, 0.8)) -> DataFrame:
    """Coefficients (id, metric, step, intercept, coef oldest lag first, offsets: residual quantiles), one row a step.

    From lag sums over all hours of a series (``lagsums``).
    """
    whole = ls.series_ends(long).select("id", "metric", F.col("a").alias("start"), F.col("b").alias("cut"))
    models = ls.lag_models(long, whole, lags, steps).select("id", "metric", "step", "intercept", "coef")
    return models.join(ls.lag_bands(long, models, lags, steps, quantiles), ["id", "metric", "step"])


def ar_score(long: DataFrame, model: DataFrame, lags: int = 48) -> DataFrame:
    """(id, ds, metric, step, predictions, bands) after each series' last stamp, from a coefficient table."""
    tail = last_n(long.select("id", "metric", "ds", "value"), lags, ["id", "metric"], "ds")
    ordered = F.array_sort(F.collect_list(F.struct("ds", "value")))  # ``lags`` rows
    last = tail.groupBy("id", "metric").agg(ordered.alias("x"), F.max("ds").alias("last")).where(F.size("x") == lags)
    dot = F.aggregate(F.zip_with("coef", "x", lambda c, x: c * x["value"]), F.lit(0.0), lambda a, v: a + v)
    scored = last.join(model, ["id", "metric"]).withColumn("predictions", F.col("intercept") + dot)
    return scored.select(
        "id", (F.col("last") + F.make_dt_interval(hours=F.col("step"))).alias("ds"), "metric", "step", "predictions",
        F.transform("offsets", lambda o: F.col("predictions") + o).alias("bands"),
    )


def ar_forecast(long: DataFrame, lags: int = 48, steps: int = 24, quantiles: tuple[float, ...] = (0.2, 0.5, 0.8)) -> DataFrame:
    return ar_score(long, ar_fit(long, lags, steps, quantiles), lags)


def chained_forecast(long: DataFrame, first: str, then: str, lags: int = 48, steps: int = 24) -> DataFrame:
    """Two stages: ``first`` is forecast from its own lags, and its forecast is a future regressor of ``then``.

    (id, ds, target_name, model, predictions, q20, q50, q80) of ``then``; long is hourly and regular.
    """
    own = long.where(F.col("metric") == first)
    lead = own.select("id", "ds", F.col("value").alias("lead"))
    past = long.where(F.col("metric") == then).join(lead, ["id", "ds"]).withColumnRenamed("metric", "target_name")
    future = ar_forecast(own, lags, steps).select("id", "ds", F.col("predictions").alias("lead"))
    return covariate_forecast(past, future, {"chained": ["lead"]})


def _weekly(rows: DataFrame, history: DataFrame, by: list[str]) -> DataFrame:
    """rows + week: the value a week before, or the mean of the weekday's hour, or the mean; history has by, ds and y."""
    earlier = history.select(*by, (F.col("ds") + F.expr("interval 7 days")).alias("ds"), F.col("y").alias("_week"))
    slots = history.groupBy(*by, slot("ds", "hour_of_week").alias("_slot")).agg(F.avg("y").alias("_mean"))
    whole = history.groupBy(*by).agg(F.avg("y").alias("_all"))
    out = rows.join(earlier, [*by, "ds"], "left").withColumn("_slot", slot("ds", "hour_of_week"))
    out = out.join(slots, [*by, "_slot"], "left").join(whole, by, "left")
    return out.withColumn("week", F.coalesce("_week", "_mean", "_all")).drop("_week", "_slot", "_mean", "_all")


def _numbers(names: list[str]) -> list[Column]:
    return [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names]


class CovariateModel:
    """Seasonal regressions on last week's value and covariates, for each series; fitted once, scored any number of times.

    history: (id, target_name, ds, value, covariates...). coefficients: (id, target_name, model, n, hours,
    days, coef, bands), a row for each series and variant. Both the fit and the scores are joins and sums.
    """

    BY = ["id", "target_name"]

    def __init__(self, history: DataFrame, variants: dict[str, list[str]], multiplicative: bool = False, quantiles: tuple[float, ...] = (0.2, 0.5, 0.8)):
        self.names = sorted({c for cols in variants.values() for c in cols})
        self.x, self.multiplicative = ["week", *self.names], multiplicative
        y = F.col("value").cast("double")
        y = F.when(y.isNotNull(), F.log1p(F.greatest(y, F.lit(0.0)))) if multiplicative else y
        self.history = history.select(*self.BY, "ds", y.alias("y"), *_numbers(self.names))
        rows = _weekly(self.history, self.history, self.BY)
        fit = gm.solve_cells(gm.cells(rows, self.BY, [*self.x, "y"]), self.BY, [*self.x, "y"], {m: ["week", *cols] for m, cols in variants.items()})
        self.fitted = fit
        rest = rows.where(F.col("y").isNotNull()).join(fit, self.BY).withColumn("rest", F.col("y") - gm.seasonal_score(self.x))
        bands = rest.groupBy(*self.BY, "model").agg(F.percentile_approx("rest", list(quantiles), 10_000).alias("bands"))
        self.coefficients = fit.join(bands, [*self.BY, "model"])

    def score(self, future: DataFrame, keep: list[str] = [], clip: tuple[float, float] | None = None) -> DataFrame:  # noqa: B006
        """(id, ds, target_name, model, keep..., predictions, q20, q50, q80) for the rows of future: (id, ds, keep..., covariates...)."""
        rows = future.select("id", "ds", *keep, *_numbers(self.names)).join(self.history.select(*self.BY).distinct(), "id")
        rows = _weekly(rows, self.history, self.BY).join(self.coefficients, self.BY).withColumn("p", gm.seasonal_score(self.x))

        def shown(c: Column) -> Column:
            c = F.expm1(c) if self.multiplicative else c
            return F.least(F.greatest(c, F.lit(clip[0])), F.lit(clip[1])) if clip else c

        bands = [shown(F.col("p") + F.get("bands", F.lit(i))).alias(n) for i, n in enumerate(("q20", "q50", "q80"))]
        return rows.select("id", "ds", "target_name", "model", *keep, shown(F.col("p")).alias("predictions"), *bands)


def covariate_forecast(
    history: DataFrame, future: DataFrame, variants: dict[str, list[str]], targets: list[str] | None = None,
    multiplicative: bool = False, clip: tuple[float, float] | None = None, future_fill: float | None = None,
) -> DataFrame:
    """(id, ds, target_name, model, predictions, q20, q50, q80) for the future rows, of every variant.

    history: (id, ds, target_name, value, covariates...); future: (id, ds, covariates...), the same columns.
    A variant is a list of covariate columns (numbers or 0/1; null is 0). future_fill replaces future covariates.
    multiplicative fits on log1p. Bands are residual quantiles by a sketch, within a ten-thousandth of the rank.
    """
    past = history.where(F.col("target_name").isin(targets)) if targets else history
    model = CovariateModel(past, variants, multiplicative)
    ahead = future if future_fill is None else future.withColumns({c: F.lit(future_fill) for c in model.names})
    return model.score(ahead, clip=clip)


run_variants = covariate_forecast


def ar_backtest(long: DataFrame, cutoffs: DataFrame, lags: int = 48, steps: int = 24, history: int = 24 * 90) -> DataFrame:
    """(id, metric, cutoff, ds, horizon, y, yhat) of the autoregression fitted on the ``history`` hours up to each cutoff.

    A cutoff's state is the difference of two running lag sums, so any number of cutoffs
    reads a row once. yhat is null where the hours before the cutoff are too few.
    """
    ends = ls.series_ends(long)
    cuts = cutoffs.select("id", ls.hour_number("cutoff").alias("cut")).join(ends, "id").where("cut between a and b")
    cuts = cuts.select("id", "metric", F.greatest("a", F.col("cut") - history + 1).alias("start"), "cut")
    fit = ls.lag_models(long, cuts, lags, steps).select("id", "metric", "cut", F.col("step").alias("horizon"), "yhat")
    ahead = cuts.select("id", "metric", "cut", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("horizon"))
    ahead = ahead.withColumns({"cutoff": ls.hour_stamp(F.col("cut")), "ds": ls.hour_stamp(F.col("cut") + F.col("horizon"))})
    goal = ahead.join(long.select("id", "metric", "ds", F.col("value").cast("double").alias("y")), ["id", "metric", "ds"])
    return goal.join(fit, ["id", "metric", "cut", "horizon"], "left").select("id", "metric", "cutoff", "ds", "horizon", "y", "yhat")


def ablation(rows: DataFrame, cutoffs: DataFrame, variants: dict[str, list[str]], steps: int = 24, history: int = 24 * 91) -> DataFrame:
    """(id, metric, model, cutoff, ds, horizon, y, yhat): rolling-origin scores' input for each variant.

    rows: (id, ds, target_name, value, covariates...), hourly, with actual covariates; hours may be absent. cutoffs:
    (id, cutoff); history in hours, whole weeks. The models are those of ``covariate_forecast`` fitted on the history up
    to the cutoff, but that last week's values are also read from before the history. Their sums are
    differences of running sums, so that any number of cutoffs reads a row once.
    """
    by, names = ["id", "target_name"], sorted({c for cols in variants.values() for c in cols})
    own = rows.select(*by, "ds", F.col("value").cast("double").alias("y"), *_numbers(names))
    ends = own.groupBy(*by).agg(F.min("ds").alias("a"), F.max("ds").alias("b"))
    axis = ends.select(*by, F.explode(F.sequence("a", "b", F.expr("interval 1 hour"))).alias("ds"))
    earlier = own.select(*by, (F.col("ds") + F.expr("interval 7 days")).alias("ds"), F.col("y").alias("week"))
    own = axis.join(own, [*by, "ds"], "left").join(earlier, [*by, "ds"], "left")
    own = own.withColumns({"blank": F.col("week").isNull().cast("double"), "past": F.coalesce("week", F.lit(0.0))})
    x = ["week", *names]
    running = gm.running_cells(own, by, ["blank", "past", *names, "y"])
    asof = gm.cells_as_of(running, cutoffs, by, ["blank", "past", *names, "y"], history).where("s > 0")
    asof = gm.filled(asof, [*by, "cutoff", "hour", "day"], "week", "past", "blank", [*x, "y"])
    fit = gm.solve_cells(asof, [*by, "cutoff"], [*x, "y"], {m: ["week", *cols] for m, cols in variants.items()})
    ahead = cutoffs.select("id", "cutoff", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("horizon"))
    ahead = ahead.withColumn("ds", F.col("cutoff") + F.make_dt_interval(hours=F.col("horizon")))
    goal = ahead.join(own.where(F.col("y").isNotNull()), ["id", "ds"]).withColumns({"hour": F.hour("ds"), "day": F.weekday("ds")})
    slots = asof.select(*by, "cutoff", "hour", "day", (F.col("s_y") / F.col("s")).alias("slot_mean"))
    goal = goal.join(slots, [*by, "cutoff", "hour", "day"], "left").join(fit, [*by, "cutoff"])
    goal = goal.withColumn("week", F.coalesce("week", "slot_mean", "mean"))
    return goal.select("id", F.col("target_name").alias("metric"), "model", "cutoff", "ds", "horizon", "y", gm.seasonal_score(x).alias("yhat"))


def oncall_need(history: DataFrame, future: DataFrame, covariates: list[str], keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(id, ds, target_name, predicted_oncall_prob): a logistic model of the label on daily and weekly terms and the covariates.

    history: (id, ds, target_name, value 0 or 1, covariates...); keep writes a table of a row a series and reads it back.
    """
    by = ["id", "target_name"]
    hours = F.timestamp_diff("HOUR", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ds")) / 24.0
    terms = gm.fourier(hours, 1.0, 2) + gm.fourier(hours, 7.0, 1)
    columns = {"one": F.lit(1.0)} | {f"t{i}": c for i, c in enumerate(terms)} | {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in covariates}
    coef = gm.logistic(history, by, columns, F.col("value"), keep)
    scored = future.join(coef, "id").withColumn("_z", gm.dot("coef", list(columns.values())))
    return scored.select("id", "ds", "target_name", (1 / (1 + F.exp(-F.col("_z")))).alias("predicted_oncall_prob"))


def regressor_sweep(long: DataFrame, target: str, candidates: list[str], lag: int = 1) -> DataFrame:
    """(id, regressor, n, rmse): one lagged regressor at a time besides the target's own lag, all from one table of sums."""
    y = long.where(F.col("metric") == target).select("id", "ds", "value")
    x = long.where(F.col("metric").isin(candidates)).select("id", "ds", F.col("metric").alias("regressor"), F.col("value").alias("x"))
    by = ["id", "regressor"]
    w = Window.partitionBy(*by).orderBy("ds")
    rows = y.join(x, ["id", "ds"]).select(*by, "value", F.lag("value", lag).over(w).alias("own"), F.lag("x", lag).over(w).alias("other"))
    columns = {"one": F.lit(1.0), "own": F.col("own"), "other": F.col("other")}
    fit = gm.solve(gm.gram(rows, by, columns, F.col("value")), by, list(columns), {"all": list(columns)})
    return fit.select(*by, "n", F.sqrt(F.col("sse") / F.col("n")).alias("rmse"))


GRID = (("daily", 1.0), ("weekly", 7.0), ("yearly", 365.25))


def grid_columns(grid: list[dict]) -> tuple[dict[str, Column], dict[str, list[str]], list[str]]:
    """The columns that a grid needs (over ds, start and a 0/1 column a calendar), those of each entry by its JSON, and the calendars."""
    import json

    t = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ds")) / 86400.0
    columns: dict[str, Column] = {"one": F.lit(1.0), "trend": t - F.col("start")}
    for name, period in GRID:
        most = max([0, *(p.get(name, 0) for p in grid)])
        terms = gm.fourier(t, period, most)
        columns |= {f"{name}_{f}{k + 1}": terms[j * most + k] for j, f in enumerate(("sin", "cos")) for k in range(most)}
    calendars = sorted({c for p in grid for c in p.get("holidays", [])})
    columns |= {f"holiday_{c}": F.col(f"`{c}`") for c in calendars}
    models = {}
    for p in grid:
        own = ["one", "trend"] + [f"{n}_{f}{k}" for n, _ in GRID for f in ("sin", "cos") for k in range(1, p.get(n, 0) + 1)]
        models[json.dumps(p, sort_keys=True)] = own + [f"holiday_{c}" for c in p.get("holidays", [])]
    return columns, models, calendars


def grid_rows(series: DataFrame, calendars: list[str], holidays: DataFrame | None = None) -> DataFrame:
    """(id, ds, value, start, a 0/1 column for each calendar): what grid_columns reads."""
    rows = series.select("id", "ds", F.col("value").cast("double"))
    start = rows.groupBy("id").agg((F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.min("ds")) / 86400.0).alias("start"))
    if holidays is not None and calendars:
        days = holidays.groupBy(F.col("date").alias("_d")).pivot("calendar", calendars).agg(F.first(F.lit(1.0)))
        rows = rows.join(days, F.to_date("ds") == F.col("_d"), "left").na.fill(0.0, calendars).drop("_d")
    return rows.join(start, "id")


def grid_search(series: DataFrame, grid: list[dict], holidays: DataFrame | None = None) -> DataFrame:
    """(id, params, n, rmse): in-sample error of trend + Fourier fits over a parameter grid.

    series: (id, ds, value). A grid entry has daily, weekly, yearly (Fourier orders) and may have holidays (calendar names).
    holidays: (date, calendar). One aggregate over the rows serves all entries; each is solved from its part of the sums.
    """
    columns, models, calendars = grid_columns(grid)
    sums = gm.gram(grid_rows(series, calendars, holidays), ["id"], columns, F.col("value"))
    return gm.solve(sums, ["id"], list(columns), models).select("id", F.col("model").alias("params"), "n", F.sqrt(F.col("sse") / F.col("n")).alias("rmse"))


def holiday_sets(series: DataFrame, holidays: DataFrame, sets: dict[str, list[str]], base: dict) -> DataFrame:
    """grid_search over sets of holiday calendars; params names the set's calendars."""
    return grid_search(series, [base | {"holidays": cols} for cols in sets.values()], holidays)


def forecast_with(long: DataFrame, fn: Callable[[tuple, pd.DataFrame], pd.DataFrame], schema: str, history: int = HISTORY) -> DataFrame:
    """Any user model, one (id, metric) series a task: fn(key, its newest ``history`` rows sorted by ds) -> rows of schema."""

    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        return fn(key, g.sort_values("ds"))

    return last_n(long, history, ["id", "metric"], "ds").groupBy("id", "metric").applyInPandas(run, schema)


def holiday_days(spark, years: tuple[int, int]) -> DataFrame:
    """(date) of the holidays by rule within the years."""
    from ..functions.calendar import holiday_dim

    return holiday_dim(spark, years).select("date")
