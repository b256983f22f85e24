"""Rolling-origin back-tests in one job, and their scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPS = 2.220446049250313e-16


def make_cutoffs(df: DataFrame, initial: int, period: int, horizon: int, id: str = "id", ts: str = "ds", unit: str = "hour") -> DataFrame:
    """(id, cutoff): every ``period`` backwards from max - horizon, while ``initial`` of history is left."""
    span = lambda n: F.expr(f"interval {n} {unit}")
    ends = df.groupBy(id).agg(F.min(ts).alias("a"), F.max(ts).alias("b"))
    first, last = F.col("a") + span(initial), F.col("b") - span(horizon)
    back = F.when(first <= last, F.sequence(last, first, F.expr(f"-1 * interval {period} {unit}")))
    return ends.select(id, F.explode(back).alias("cutoff"))


def backtest_seasonal(long: DataFrame, cutoffs: DataFrame, steps: int = 24, season: int = 24, closed: str = "right", z: float = 1.959964) -> DataFrame:
    """(id, metric, cutoff, ds, horizon, y, yhat, yhat_lower, yhat_upper) of the slot mean as of each cutoff.

    long is hourly and regular. Running sums for each slot of the season hold the statistics as of every
    hour, so a cutoff's forecast is an equi join to the last usable hour of the slot: ds - ceil(h/season)*season.
    """
    w = Window.partitionBy("id", "metric", "slot").orderBy("ds").rowsBetween(Window.unboundedPreceding, 0)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    hours = F.timestamp_diff("HOUR", epoch, F.col("ds"))
    run = long.withColumn("slot", F.pmod(hours, F.lit(season)))
    stats = run.select(
        "id", "metric", F.col("ds").alias("seen"), F.avg("value").over(w).alias("yhat"), F.stddev_samp("value").over(w).alias("sd")
    )
    lag = 0 if closed == "right" else 1
    h = F.explode(F.sequence(F.lit(1), F.lit(steps)))
    ahead = cutoffs.select("id", "cutoff", h.alias("h")).select(
        "id", "cutoff",
        (F.col("cutoff") + F.make_dt_interval(hours=F.col("h") - lag)).alias("ds"),
        (F.col("h") - lag).cast("int").alias("horizon"),
        F.make_dt_interval(hours=F.ceil(F.col("h") / season).cast("int") * season).alias("_back"),
    )
    goal = ahead.join(long.select("id", "metric", "ds", F.col("value").alias("y")), ["id", "ds"])
    goal = goal.withColumn("seen", F.col("ds") - F.col("_back")).drop("_back")
    half = z * F.col("sd")
    return goal.join(stats, ["id", "metric", "seen"]).select(
        "id", "metric", "cutoff", "ds", "horizon", "y", "yhat", (F.col("yhat") - half).alias("yhat_lower"), (F.col("yhat") + half).alias("yhat_upper")
    )


def _scores(y: str = "y", yhat: str = "yhat") -> list[Column]:
    e = F.col(y) - F.col(yhat)
    return [
        F.count("*").alias("n"), F.avg(e * e).alias("mse"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        F.avg(F.abs(e) / F.greatest(F.abs(F.col(y)), F.lit(EPS))).alias("mape"),
    ]


def score(bt: DataFrame, by: list[str] = ["id", "metric"]) -> DataFrame:  # noqa: B006
    """n, mse, rmse, mae, mape under their true names; rows without both values do not count."""
    return bt.na.drop(subset=["y", "yhat"]).groupBy(*by).agg(*_scores())


def score_by_cutoff(bt: DataFrame, by: list[str] = ["id", "metric"], weekday: bool = False) -> DataFrame:  # noqa: B006
    """Mean over cutoffs of each cutoff's errors (not pooled), by weekday name of the cutoff if wanted."""
    per = score(bt, [*by, "cutoff"])
    keys = [F.col(c) for c in by] + ([F.date_format("cutoff", "EEEE").alias("weekday_name")] if weekday else [])
    return per.groupBy(*keys).agg(F.count("*").alias("cutoffs"), F.avg("mse").alias("mse"), F.avg("rmse").alias("rmse"), F.avg("mape").alias("mape"))


def compare_models(long: DataFrame, cutoffs: DataFrame, seasons: dict[str, int], steps: int = 24) -> tuple[DataFrame, DataFrame]:
    """Scores of each candidate season over the same cutoffs, and the best model of each series."""
    out = None
    for name, season in seasons.items():
        one = backtest_seasonal(long, cutoffs, steps, season).withColumn("model", F.lit(name))
        out = one if out is None else out.unionByName(one)
    scores = score(out, ["id", "metric", "model"])
    return scores, best_model(scores)


def best_model(scores: DataFrame) -> DataFrame:
    """(id, metric, model, rmse): the candidate of least rmse for each series, ties to the first name."""
    return scores.groupBy("id", "metric").agg(F.min_by("model", F.struct("rmse", "model")).alias("model"), F.min("rmse").alias("rmse"))
