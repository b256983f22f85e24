"""Operators on literal rows, properties, and reference values against numpy."""

import datetime as dt

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hst
from pyspark.sql import functions as F

from opspulse.operators import aggregates, anomaly, backtest, filters, forecast, intervals, joins, reshape, timeseries, upsert

QUICK = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def at(h, day=1):
    return dt.datetime(2024, 1, day) + dt.timedelta(hours=h)


def series(spark, values, id="a"):
    return spark.createDataFrame([(id, at(h), None if v is None else float(v)) for h, v in values], "id string, ds timestamp_ntz, v double")


@QUICK
@given(hst.dictionaries(hst.integers(0, 40), hst.integers(0, 9), min_size=1), hst.dictionaries(hst.integers(0, 40), hst.integers(0, 9), min_size=1))
def test_upsert_is_idempotent_and_last_wins(spark, old, new):
    a, b = series(spark, old.items()), series(spark, new.items())
    once = upsert.upsert(a, b, ["id", "ds"])
    twice = upsert.upsert(once, b, ["id", "ds"])
    want = {at(h): float(v) for h, v in (old | new).items()}
    assert {r.ds: r.v for r in once.collect()} == {r.ds: r.v for r in twice.collect()} == want
    first = {r.ds: r.v for r in upsert.upsert(a, b, ["id", "ds"], keep="first").collect()}
    assert first == {at(h): float(v) for h, v in (new | old).items()}


@QUICK
@given(hst.dictionaries(hst.integers(0, 60), hst.one_of(hst.none(), hst.integers(0, 9)), min_size=1))
def test_regularize(spark, values):
    got = timeseries.regularize(series(spark, values.items()), ["v"]).orderBy("ds").collect()
    assert [r.ds for r in got] == [at(h) for h in range(min(values), max(values) + 1)]
    if any(v is not None for v in values.values()):
        assert all(r.v is not None for r in got)
    assert timeseries.find_gaps(timeseries.regularize(series(spark, values.items()), ["v"])).count() == 0


def test_snap_keeps_the_last_of_an_hour(spark):
    rows = [("a", dt.datetime(2024, 1, 1, 10, 15), 1.0), ("a", dt.datetime(2024, 1, 1, 10, 40), 2.0), ("a", dt.datetime(2024, 1, 1, 12), 3.0)]
    got = timeseries.regularize(spark.createDataFrame(rows, "id string, ds timestamp_ntz, v double"), ["v"]).orderBy("ds").collect()
    assert [r.v for r in got] == [2.0, 2.0, 3.0]
    with pytest.raises(ValueError, match="not hourly"):
        timeseries.assert_regular(series(spark, [(0, 1), (2, 1)]))


@QUICK
@given(hst.lists(hst.tuples(hst.integers(0, 50), hst.integers(0, 12)), min_size=1, max_size=6))
def test_expansion_has_the_rounded_length(spark, shifts):
    rows = [(i, at(0) + dt.timedelta(minutes=30 * a), at(0) + dt.timedelta(minutes=30 * (a + n))) for i, (a, n) in enumerate(shifts)]
    df = spark.createDataFrame(rows + [(99, None, at(3))], "k int, s timestamp_ntz, e timestamp_ntz")
    got = {r.k: r.n for r in intervals.expand_intervals(df, "s", "e").groupBy("k").agg(F.count("*").alias("n")).collect()}
    want = {i: -(-(a + n) // 2) - -(-a // 2) for i, (a, n) in enumerate(shifts)}
    assert got == {k: n for k, n in want.items() if n}


def test_staffing_grids(spark):
    rows = [(1, at(8), "ann", "X1", "pod"), (2, at(8), "ann", "Z1", "night"), (3, at(8), "bob", "X1", None), (4, at(10), "bob", "X1", "pod")]
    df = spark.createDataFrame(rows, "scheduled_shift_id int, ds timestamp_ntz, person string, code string, shift_type string")
    got = {r.ds: (r.ann, r.bob) for r in intervals.staffing_by_person(df, ["ann", "bob"]).collect()}
    assert got == {at(8): ("pod", "NotWorking"), at(10): ("NotWorking", "pod")}
    got = {r.ds: (r.X1, r.Z1) for r in intervals.staffing_by_code(df, ["X1", "Z1"]).collect()}
    assert got == {at(8): ("bob", "ann"), at(9): (None, None), at(10): ("bob", None)}


def test_islands_and_oncall(spark):
    act = spark.createDataFrame([(1, at(h)) for h in (0, 1, 2, 9, 20)] + [(2, at(1))], "user_id int, ts timestamp_ntz")
    got = {(r.user_id, r.start, r.n) for r in timeseries.islands(act, ["user_id"], "ts", "2 hours", 2).collect()}
    assert got == {(1, at(0), 3)}
    s = "user_id int, shift_start timestamp_ntz, shift_end timestamp_ntz"
    oncall, regular = spark.createDataFrame([(1, at(0), at(21))], s), spark.createDataFrame([(1, at(2), at(9))], s)
    assert {r.ts for r in intervals.activity_oncall(act, oncall, regular).collect()} == {at(0), at(1), at(9), at(20)}
    assert {r.ds for r in intervals.oncall_busy(act, oncall, regular).collect()} == {at(0), at(1)}


def test_flags_colours_and_null_bounds(spark):
    rows = [(1, 5.0, 3.0, 1.0, 4.0), (2, 3.5, 3.0, 1.0, 4.0), (3, 3.0, 3.0, 1.0, 4.0), (4, 2.0, 3.0, 1.0, 4.0), (5, 0.0, 3.0, 1.0, 4.0), (6, 2.0, None, None, None), (7, 4.0, 3.0, 1.0, 4.0)]
    df = spark.createDataFrame(rows, "k int, value double, yhat double, yhat_lower double, yhat_upper double")
    out = anomaly.flag_anomalies(df).withColumns({"h": anomaly.colour("value"), "f": anomaly.colour("value", "forecast")}).orderBy("k").collect()
    assert [r.anomaly for r in out] == ["yes", "no", "no", "no", "yes", "no", "no"]  # the bound itself is no anomaly
    names = {anomaly.RED: "r", anomaly.GOLD: "y", anomaly.GREEN: "g", anomaly.BLACK: "b"}
    assert "".join(names[r.h] for r in out) == "rybggby" and "".join(names[r.f] for r in out) == "ryggggy"


def test_long_wide_round_trip(spark):
    wide = spark.createDataFrame([("a", at(0), 1.0, 2.0), ("a", at(1), None, 3.0)], "id string, ds timestamp_ntz, x double, y double")
    from opspulse.sources.sinks import to_wide

    assert to_wide(reshape.to_long(wide, ["x", "y"]), ["x", "y"]).orderBy("ds").collect() == wide.orderBy("ds").collect()


def test_daily_total_and_selection(spark):
    df = series(spark, [(h, 1) for h in range(50)])
    assert [(r.date.day, r.total) for r in aggregates.daily_total(df, "v").orderBy("date").collect()] == [(1, 24.0), (2, 24.0)]
    assert filters.latest(df).first().ds == at(49) and filters.last_n(df, 3).count() == 3
    assert [r.ds for r in filters.horizon(df, "ds", F.lit(at(5)), 2, "left").orderBy("ds").collect()] == [at(5), at(6)]
    tie = spark.createDataFrame([("a", at(1), 5.0), ("a", at(0), 5.0)], "id string, ds timestamp_ntz, value double")
    assert aggregates.peak_rows(tie, ["id"]).first().ds == at(0)


def test_backtest_equals_brute_force(spark):
    r = np.random.default_rng(0)
    v = r.integers(0, 9, 24 * 12).astype(float)
    df = series(spark, enumerate(v)).select("id", "ds", F.lit("m").alias("metric"), F.col("v").alias("value"))
    cuts = backtest.make_cutoffs(df, 100, 31, 30)
    for closed in ("right", "left"):
        got = backtest.backtest_seasonal(df, cuts, 30, 24, closed).collect()
        assert len(got) == 30 * cuts.count()
        for x in got:
            c, t = (int((y - at(0)).total_seconds() // 3600) for y in (x.cutoff, x.ds))
            seen = [v[i] for i in range(len(v)) if i % 24 == t % 24 and (i <= c if closed == "right" else i < c)]
            assert x.yhat == pytest.approx(np.mean(seen)) and x.y == v[t]
    s = backtest.score(backtest.backtest_seasonal(df, cuts, 30)).first()
    assert s.rmse == pytest.approx(s.mse**0.5)


def test_ar_matches_numpy(spark):
    r = np.random.default_rng(1)
    v = np.sin(np.arange(400) / 4) + 0.1 * r.normal(size=400)
    df = series(spark, enumerate(v)).select("id", "ds", F.lit("m").alias("metric"), F.col("v").alias("value"))
    got = {x.step: x for x in forecast.ar_forecast(df, lags=6, steps=2).collect()}
    for h in (1, 2):
        n = 400 - 6 - h + 1
        x = np.column_stack([np.ones(n), *[v[i : i + n] for i in range(6)]])
        w = np.linalg.lstsq(x, v[5 + h : 5 + h + n], rcond=None)[0]
        assert got[h].predictions == pytest.approx(np.r_[1, v[-6:]] @ w, abs=1e-4) and got[h].bands == sorted(got[h].bands)
        assert got[h].ds == at(399 + h)


def test_trend_season_matches_numpy(spark):
    t = np.arange(200)
    y = 5 + 0.3 * t + 4 * np.sin(2 * np.pi * (t + 19723) / 7)
    rows = [("a", dt.date(2024, 1, 1) + dt.timedelta(days=int(i)), float(x)) for i, x in zip(t, y, strict=True)]
    df = spark.createDataFrame(rows, "id string, date date, value double")
    got = forecast.trend_season_ranges(df, horizon=7, keep=7, seasons=((7.0, 3),)).orderBy("date").toPandas()
    t2 = np.arange(200, 207)
    assert got.yhat.to_numpy() == pytest.approx(5 + 0.3 * t2 + 4 * np.sin(2 * np.pi * (t2 + 19723) / 7), abs=0.05)


def test_compare_and_what_if(spark):
    rows = [("a", at(0), "t", "m1", 0.0), ("a", at(0), "t", "m2", 1.0), ("a", at(1), "t", "m1", 2.0), ("a", at(1), "t", "m2", 3.0), ("a", at(2), "t", "m1", 2.0)]
    df = spark.createDataFrame(rows, "id string, ds timestamp_ntz, target_name string, model string, predictions double")
    assert joins.compare_forecasts(df, ["m1", "m2"]).count() == 2
    _, mean = anomaly.variant_effects(df, "m1", ["m2"])
    assert mean.first().pct_m2 == 50.0  # the zero base is null and does not count
    fut = spark.createDataFrame([("a", at(h)) for h in range(3)], "id string, ds timestamp_ntz")
    got = {(r.scenario, r.ds.hour): r.oncall_busy for r in anomaly.scenarios(fut, {"off": 0, "on": 2}).collect()}
    assert got == {("off", 0): 0, ("off", 1): 0, ("off", 2): 0, ("on", 0): 1, ("on", 1): 1, ("on", 2): 0}


@pytest.mark.parametrize("n", [1, 16])
def test_same_answer_for_any_partitioning(spark, n):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", n)
    try:
        df = series(spark, [(h % 30, h) for h in range(60)]).repartition(n)
        got = upsert.dedupe(df, ["id", "ds"], ["v"]).orderBy("ds").collect()
        assert [r.v for r in got] == [float(h + 30) for h in range(30)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_ablation_is_the_forecast_at_each_cutoff(spark):
    r = np.random.default_rng(4)
    rows = [("a", at(h), "t", float(h % 24 + r.normal()), float(h % 5 == 0)) for h in range(400)]
    df = spark.createDataFrame(rows, "id string, ds timestamp_ntz, target_name string, value double, x double")
    cuts = spark.createDataFrame([("a", at(300)), ("a", at(350))], "id string, cutoff timestamp_ntz")
    variants = {"plain": [], "with": ["x"]}
    got = {(x.model, x.ds): (x.y, x.yhat, x.horizon) for x in forecast.ablation(df, cuts, variants, 24).where(F.col("cutoff") == F.lit(at(300))).collect()}
    past, future = filters.asof(df, "ds", F.lit(at(300))), filters.horizon(df, "ds", F.lit(at(300)), 24).select("id", "ds", "x")
    want = forecast.covariate_forecast(past, future, variants).collect()
    assert len(got) == len(want) == 48
    for x in want:
        y, yhat, h = got[x.model, x.ds]
        assert yhat == pytest.approx(x.predictions) and at(300 + h) == x.ds and y == rows[300 + h][3]


def _hours(n, value, metric="a", first=0):
    return [("s", metric, at(h), float(value(h))) for h in range(first, first + n)]


def test_ar_backtest_equals_the_forecast_from_the_history(spark):
    df = spark.createDataFrame(_hours(400, lambda h: h % 24 + h % 7), "id string, metric string, ds timestamp_ntz, value double")
    cuts = spark.createDataFrame([("s", at(350))], "id string, cutoff timestamp_ntz")
    got = {x.ds: (x.horizon, x.y, round(x.yhat, 6)) for x in forecast.ar_backtest(df, cuts).collect()}
    own = forecast.ar_forecast(df.where(F.col("ds") <= F.lit(at(350)))).collect()
    true = {x.ds: x.value for x in df.collect()}
    assert got == {x.ds: (x.step, true[x.ds], round(x.predictions, 6)) for x in own} and len(got) == 24


def test_chained_forecast_uses_the_first_stage(spark):
    rows = _hours(400, lambda h: h % 24) + _hours(400, lambda h: 3 * (h % 24) + 1, "b")
    df = spark.createDataFrame(rows, "id string, metric string, ds timestamp_ntz, value double")
    got = forecast.chained_forecast(df, "a", "b").collect()
    assert len(got) == 24 and all(x.target_name == "b" and abs(x.predictions - (3 * x.ds.hour + 1)) < 0.1 for x in got)


def test_ranges_at_given_hours_are_those_of_all_hours(spark):
    df = spark.createDataFrame(_hours(200, lambda h: h % 24 + h % 5), "id string, metric string, ds timestamp_ntz, value double")
    at_last = filters.latest_ts(df).withColumnRenamed("max_ds", "ds")
    some = forecast.seasonal_ranges(df, at=at_last).collect()
    assert some == [x for x in forecast.seasonal_ranges(df).collect() if x.ds == at(199)] and len(some) == 1


def test_upsert_writes_only_touched_parts_and_replays(spark, tmp_path):
    from opspulse.streaming import stream

    path, kinds = f"file://{tmp_path}/t", "id string, ds timestamp_ntz, v1 int, _order int"
    write = stream.versioned_upsert(path, ["id", "ds"], lambda b: b, F.unix_date(F.to_date("ds")))
    write(spark.createDataFrame([("s", at(h), h, 0) for h in range(72)] + [("s", None, 7, 0)], kinds), 0)
    late = spark.createDataFrame([("s", at(30), 99, 0), ("s", at(30), 100, 1), ("s", at(200), 5, 0)], kinds)
    want = {at(h): h for h in range(72)} | {None: 7, at(30): 100, at(200): 5}
    for _ in range(2):
        write(late, 1)
        rows = stream.newest_version(spark, path, late.drop("_order").schema)
        assert {x.ds: x.v1 for x in rows.collect()} == want and rows.count() == len(want)
    assert spark.read.parquet(f"{path}/v=1").select("part").distinct().count() == 2
    write(late.limit(0), 2)
    assert {x.ds: x.v1 for x in stream.newest_version(spark, path, late.drop("_order").schema).collect()} == want


def test_staffing_sweep_equals_expansion(spark):
    import random

    r = random.Random(5)
    t0 = dt.datetime(2024, 1, 1)
    at = lambda: t0 + dt.timedelta(minutes=r.randrange(6000))
    rows = [(r.choice(["a", "b", None]), at(), at()) for _ in range(300)] + [("a", None, t0), ("b", t0, None), ("b", t0, t0)]
    df = spark.createDataFrame(rows, "code string, s timestamp_ntz, e timestamp_ntz")
    plain = intervals.expand_intervals(df, "s", "e").groupBy("code", "ds").count()
    want = sorted(map(tuple, plain.collect()), key=str)
    assert want and sorted(map(tuple, intervals.staffing_counts(df, "s", "e", ["code"]).collect()), key=str) == want
    last = {}
    for x in intervals.staffing_steps(df, "s", "e", ["code"]).orderBy("code", "start").collect():
        assert x.end > x.start and last.get(x.code, (None, None)) != (x.start, x.staff)  # spans are as long as can be
        last[x.code] = (x.end, x.staff)
    assert intervals.staffing_counts(df.limit(0), "s", "e", ["code"]).count() == 0


def test_running_inflow_in_batches(spark, tmp_path):
    """Six batches of a day each: repeated events count once, late ones not at all, and state stays bounded."""
    from opspulse.streaming import stream

    kind = "event_id long, ts timestamp_ntz"
    want = {}
    for day in range(1, 7):
        rows = [(day * 1000 + i, at(i % 24, day) + dt.timedelta(minutes=i % 50)) for i in range(240)]
        for _, ts in rows:
            hour = ts.replace(minute=0)
            want[hour] = want.get(hour, 0) + 1
        again = [x for x in rows if x[1] >= at(23, day)]
        late = [(day * 1000 + 500, at(3, day - 2))] if day > 3 else []  # the watermark that drops rows lags by a batch
        spark.createDataFrame(rows + again + late, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = stream.start_inflow(source, str(tmp_path / "out"), str(tmp_path / "check"), event="event_id")
    q.awaitTermination()
    got = {r.ds: r.n for r in stream.inflow_table(spark, str(tmp_path / "out")).select(F.col("ds").cast("timestamp_ntz").alias("ds"), "n").collect()}
    assert got == want
    state = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in q.recentProgress]
    assert len(state) >= 6 and max(state) < 2 * 264  # a day's events and windows, not the six days'
