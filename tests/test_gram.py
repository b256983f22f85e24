"""Regressions from sums against plain numpy, and alerts with state over several batches."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from opspulse.operators import forecast, gram
from opspulse.streaming import stream

START = dt.datetime(2024, 1, 1)


def at(h):
    return START + dt.timedelta(hours=h)


def lstsq(x, y, ridge):
    s = np.where(np.abs(x).max(axis=0) > 0, np.abs(x).max(axis=0), 1.0)
    a = x / s
    return np.linalg.lstsq(np.vstack([a, np.sqrt(ridge) * np.eye(a.shape[1])]), np.r_[y, np.zeros(a.shape[1])], rcond=None)[0] / s


def test_gram_solves_every_model_of_a_grid(spark):
    r = np.random.default_rng(1)
    rows = [(k, float(t), float(r.normal()), float(2 * t + r.normal()) if t % 7 else None) for k in "ab" for t in range(90)]
    df = spark.createDataFrame(rows, "id string, t double, u double, y double").repartition(5)
    columns = {"one": F.lit(1.0), "t": F.col("t"), "u": F.col("u")}
    models = {"all": ["one", "t", "u"], "trend": ["one", "t"]}
    got = {(x.id, x.model): x for x in gram.solve(gram.gram(df, ["id"], columns, F.col("y")), ["id"], list(columns), models).collect()}
    assert len(got) == 4
    for (k, model), x in got.items():
        own = np.array([v[1:] for v in rows if v[0] == k and v[3] is not None], float)
        full = np.column_stack([np.ones(len(own)), own[:, 0], own[:, 1]])[:, : len(models[model])]
        w = lstsq(full, own[:, 2], 1e-6)
        rest = own[:, 2] - full @ w
        assert x.coef == pytest.approx([*w, 0.0][:3], abs=1e-6) and x.n == len(own)
        assert x.sse == pytest.approx(rest @ rest, rel=1e-6) and x.mean == pytest.approx(rest.mean(), abs=1e-6)


def frame(n, seed=2):
    r = np.random.default_rng(seed)
    return pd.DataFrame({"id": "a", "target_name": "t", "ds": [at(h) for h in range(n)], "value": [float(5 + h % 24 + 3 * (h // 24 % 7 == 5) + r.normal()) if h % 31 else None for h in range(n)], "x": r.normal(size=n)})


def design(g, past, columns):
    """Plain design: hour, weekday, the value a week before (else the slot's mean in past), covariates."""
    y = past.set_index("ds")["value"]
    slot = y.groupby([y.index.weekday, y.index.hour]).mean()
    week = y.reindex(g["ds"] - pd.Timedelta(days=7)).to_numpy()
    mean = np.array([slot.get((d.weekday(), d.hour), y.mean()) for d in g["ds"]])
    week = np.where(np.isnan(week), mean, week)
    return np.column_stack([np.ones(len(g)), np.eye(24)[g["ds"].dt.hour][:, 1:], np.eye(7)[g["ds"].dt.weekday][:, 1:], week, *[g[c] for c in columns]])


@pytest.mark.parametrize("multiplicative", [False, True])
def test_covariate_models_equal_plain_regressions(spark, multiplicative):
    g = frame(700)
    past, future = g[:676], g[676:]
    df = spark.createDataFrame(past).withColumn("ds", F.col("ds").cast("timestamp_ntz")).withColumn("value", F.nanvl("value", F.lit(None)))
    ahead = spark.createDataFrame(future[["id", "ds", "x"]]).withColumn("ds", F.col("ds").cast("timestamp_ntz"))
    got = forecast.covariate_forecast(df, ahead, {"plain": [], "with": ["x"]}, multiplicative=multiplicative).toPandas()
    own = past.assign(value=np.log1p(past["value"].clip(lower=0))) if multiplicative else past
    ok = own["value"].notna()
    for model, cols in (("plain", []), ("with", ["x"])):
        w = lstsq(design(own, own, cols)[ok], own["value"][ok], 1e-3)
        want = design(future, own, cols) @ w
        rest = own["value"][ok] - design(own, own, cols)[ok] @ w
        back = np.expm1 if multiplicative else (lambda v: v)
        one = got[got.model == model].sort_values("ds")
        assert one.predictions.to_numpy() == pytest.approx(back(want), rel=1e-4)
        assert one.q80.to_numpy() == pytest.approx(back(want + np.quantile(rest, 0.8)), abs=0.05)


def test_back_test_states_equal_refits(spark):
    """Hours are absent and null; a window of two weeks; each cutoff's model is that of a plain refit."""
    g = frame(800, 3)
    g = g[(np.arange(800) % 53 != 7)]
    df = spark.createDataFrame(g).withColumn("ds", F.col("ds").cast("timestamp_ntz")).withColumn("value", F.nanvl("value", F.lit(None)))
    cuts = [at(h) for h in (420, 555, 700)]
    out = forecast.ablation(df, spark.createDataFrame([("a", c) for c in cuts], "id string, cutoff timestamp_ntz"), {"with": ["x"]}, 24, 336).toPandas()
    assert len(out) == sum(g["ds"].between(c + dt.timedelta(hours=1), c + dt.timedelta(hours=24)).where(g["value"].notna(), False).sum() for c in cuts)
    y = g.set_index("ds")["value"]
    for c in cuts:
        own = g[(g["ds"] <= c) & (g["ds"] > c - dt.timedelta(hours=336)) & g["value"].notna()]
        one = out[out.cutoff == c].sort_values("ds")
        goal = g[g["ds"].isin(one.ds)]
        full = []
        for part in (own, goal):
            x = design(part, own, ["x"])
            week = y.reindex(part["ds"] - pd.Timedelta(days=7)).to_numpy()  # also from before the window
            x[:, 30] = np.where(np.isnan(week), x[:, 30], week)
            full.append(x)
        w = lstsq(full[0], own["value"].to_numpy(), 1e-3)
        assert one.yhat.to_numpy() == pytest.approx(full[1] @ w, abs=2e-3)


def test_need_is_a_probability_of_a_plain_newton_fit(spark, tmp_path):
    r = np.random.default_rng(5)
    g = frame(600, 6)
    g["value"] = (r.random(600) < 1 / (1 + np.exp(-(-1 + 2 * g["x"])))).astype(float)
    df = spark.createDataFrame(g).withColumn("ds", F.col("ds").cast("timestamp_ntz"))
    step = iter(range(100))

    def keep(x):
        path = f"{tmp_path}/{next(step)}"
        x.write.parquet(path)
        return spark.read.schema(x.schema).parquet(path)

    got = forecast.oncall_need(df, df.select("id", "ds", "x"), ["x"], keep).orderBy("ds").toPandas()
    t = ((g["ds"] - pd.Timestamp("1970-01-01")) / pd.Timedelta(days=1)).to_numpy()
    wave = lambda p, n: [f(2 * np.pi * k * t / p) for f in (np.sin, np.cos) for k in range(1, n + 1)]
    x, y, w = np.column_stack([np.ones(600), *wave(1, 2), *wave(7, 1), g["x"]]), g["value"].to_numpy(), np.zeros(8)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(8), x.T @ (y - p) - 1e-4 * w)
    p = got["predicted_oncall_prob"].to_numpy()
    assert p == pytest.approx(1 / (1 + np.exp(-x @ w)), abs=1e-6)
    line = np.clip(x @ np.linalg.lstsq(x, y, rcond=None)[0], 1e-3, 1 - 1e-3)
    loss = lambda q: -(y * np.log(q) + (1 - y) * np.log(1 - q)).mean()
    assert loss(p) <= loss(line)


def test_alerts_open_and_close_once_over_batches_with_a_late_one(spark, tmp_path):
    values = {("s1", h): v for h, v in enumerate([1, 9, 9, 9, 1, 1, 9, 1])} | {("s2", h): v for h, v in enumerate([9, 9, 1, 1, 1, 9, 9, 9])}
    kind = "id string, ds timestamp_ntz, metric string, value double"
    ranges = spark.createDataFrame([(s, at(h), "m", 5.0) for s in ("s1", "s2") for h in range(8)], "id string, ds timestamp_ntz, metric string, yhat_upper double")
    batches = [[0, 1, 2], [3, 4, 5], [2], [6, 7]]  # the third is late, with a value that must not count
    changes = stream.alert_changes(spark.readStream.schema(kind).parquet(f"{tmp_path}/in"), ranges) if (tmp_path / "in").mkdir() is None else None
    for i, hours in enumerate(batches):
        rows = [(s, at(h), "m", 99.0 if i == 2 else float(values[s, h])) for s in ("s1", "s2") for h in hours]
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        q = changes.writeStream.format("parquet").outputMode("append").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/check")
        q.trigger(availableNow=True).start().awaitTermination()
    got = {(r.id, r.ds, r.change) for r in spark.read.schema(changes.schema).parquet(f"{tmp_path}/out").collect()}
    want = set()
    for s in ("s1", "s2"):
        on = False
        for h in range(8):
            if (values[s, h] > 5) != on:
                on = not on
                want.add((s, at(h), "opened" if on else "closed"))
    assert got == want
