"""Autoregressions from lag sums against plain least squares on the same hours."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from opspulse.operators import forecast, lagsums

KIND = "id string, metric string, ds timestamp_ntz, value double"


def at(h):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=int(h))


def frame(spark, values, metric="m"):
    return spark.createDataFrame([("a", metric, at(h), None if np.isnan(v) else float(v)) for h, v in enumerate(values)], KIND)


def plain(y, lags, h):
    """Intercept and weights, oldest lag first, of the value h hours on; None if fewer than two windows."""
    n = len(y) - lags - h + 1
    if n < 2:
        return None
    x = np.column_stack([np.ones(n), np.lib.stride_tricks.sliding_window_view(y, lags)[:n]])
    return np.linalg.lstsq(x, y[lags + h - 1 :], rcond=None)[0]


def test_any_span_across_blocks_equals_plain_least_squares(spark, monkeypatch):
    monkeypatch.setattr(lagsums, "BLOCK", 50)  # many blocks, shorter than the lags reach
    r = np.random.default_rng(3)
    v = 1000 + 5 * np.sin(np.arange(400) / 4) + r.normal(size=400)
    v[[0, 1, 77, 149, 150, 151]] = np.nan
    y = pd.Series(v).ffill().bfill().to_numpy()
    lags, steps = 5, 40
    for history, cuts in ((90, (44, 60, 200, 359)), (10_000, (8, 200)), (120, (119, 300))):
        stamps = spark.createDataFrame([("a", at(c)) for c in cuts], "id string, cutoff timestamp_ntz")
        got = {(x.cutoff, x.horizon): x for x in forecast.ar_backtest(frame(spark, v), stamps, lags, steps, history).collect()}
        assert len(got) == steps * len(cuts)
        for c in cuts:
            past = y[max(0, c - history + 1) : c + 1]
            for h in range(1, steps + 1):
                w, x = plain(past, lags, h), got[at(c), h]
                assert x.ds == at(c + h) and (x.y is None) == np.isnan(v[c + h])
                if w is None:
                    assert x.yhat is None
                elif len(past) - lags - h > 2 * lags:  # enough windows for a stable comparison
                    assert x.yhat == pytest.approx(w[0] + y[c - lags + 1 : c + 1] @ w[1:], abs=1e-3)


def test_bands_are_quantiles_of_all_residuals(spark):
    r = np.random.default_rng(5)
    y = r.normal(size=1500).cumsum()
    got = {x.step: x for x in forecast.ar_fit(frame(spark, y), 4, 3).collect()}
    for h in (1, 2, 3):
        w = plain(y, 4, h)
        n = len(y) - 4 - h + 1
        rest = y[3 + h :] - w[0] - np.lib.stride_tricks.sliding_window_view(y, 4)[:n] @ w[1:]
        assert [got[h].intercept, *got[h].coef] == pytest.approx(w, abs=1e-5)
        assert got[h].offsets == pytest.approx(np.quantile(rest, [0.2, 0.5, 0.8]), abs=0.02)


def test_short_constant_and_empty_series(spark):
    df = frame(spark, np.full(60, 7.0), "same").unionByName(frame(spark, np.full(60, np.nan), "none")).unionByName(frame(spark, np.arange(6.0), "short"))
    got = {(x.metric, x.step): x for x in forecast.ar_fit(df, 4, 3).collect()}
    assert {k for k in got} == {("same", 1), ("same", 2), ("same", 3), ("short", 1)}
    assert got["same", 2].intercept == pytest.approx(7) and got["same", 2].coef == pytest.approx([0] * 4)
    assert forecast.ar_fit(df.where("false"), 4, 3).count() == 0
    assert forecast.ar_backtest(df.where("false"), df.select("id", F.col("ds").alias("cutoff"))).count() == 0


def test_absent_and_repeated_hours(spark):
    y = np.random.default_rng(2).normal(size=200).cumsum()
    full = frame(spark, y)
    gone = [0.0 if i in (50, 51, 120) else 1.0 for i in range(200)]
    filled = pd.Series(np.where(np.array(gone) > 0, y, np.nan)).ffill().to_numpy()
    rows = full.where(~F.col("ds").isin([at(50), at(51), at(120)]))
    rows = rows.unionByName(rows.where(F.col("ds") == F.lit(at(9))).withColumn("value", F.col("value") - 1))
    got = {x.step: x for x in forecast.ar_fit(rows, 3, 2).collect()}
    for h in (1, 2):
        assert [got[h].intercept, *got[h].coef] == pytest.approx(plain(filled, 3, h), abs=1e-5)
