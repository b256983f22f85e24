"""Cleaning, time functions and sources on literal rows."""

import datetime as dt

import pytest

from opspulse import schema
from opspulse.functions import calendar, cleaning, time, weather
from opspulse.sources import sinks, tables
from opspulse.streaming import stream


def at(*a):
    return dt.datetime(2024, 1, *a)


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def test_hour_ending_and_blank_dates(spark):
    rows = [("f", 2, " ", "24"), ("f", 1, "01/31/24", "1"), ("f", 3, None, "2"), ("f", 4, "2/1/24", "3.9")]
    df = frame(spark, rows, "file string, line_no int, dateflg string, timeflg string")
    out = cleaning.fill_down(df, "dateflg", "line_no", "file").withColumn("ds", cleaning.hour_ending("dateflg", "timeflg"))
    got = [r.ds for r in out.orderBy("line_no").collect()]
    assert got == [dt.datetime(2024, 1, 31, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 1, 31, 2), dt.datetime(2024, 2, 1, 3)]


def test_to_int_truncates_and_quarantines(spark):
    df = frame(spark, [("3.9", "x"), ("-3.9", None), (None, "7")], "a string, b string")
    assert [r.a for r in cleaning.to_int(df, ["a"]).collect()] == [3, -3, None]
    got = [(r.a, r.b, r.bad) for r in cleaning.to_int(df, ["a", "b"], "tolerant").collect()]
    assert got == [(3, None, ["b"]), (-3, None, []), (None, 7, [])]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cleaning.to_int(df, ["b"]).collect()


def test_rollup_nulls(spark):
    df = frame(spark, [(1, None), (None, None)], "a int, b int")
    got = cleaning.add_rollups(df, {"z": (["a", "b"], "zero"), "p": (["a", "b"], "propagate")}).collect()
    assert [(r.z, r.p) for r in got] == [(1, None), (0, None)]


def test_rounding_of_hours(spark):
    rows = [(at(1, 0, 30),), (at(1, 1, 30),), (at(1, 23, 45),), (at(1, 5),), (None,)]
    df = frame(spark, rows, "t timestamp_ntz").select(time.round_hour_even("t").alias("e"), time.ceil_hour("t").alias("c"), time.floor_hour("t").alias("f"))
    got = df.collect()
    assert [r.e for r in got] == [at(1, 0), at(1, 2), at(2, 0), at(1, 5), None]
    assert [r.c for r in got] == [at(1, 1), at(1, 2), at(2, 0), at(1, 5), None]
    assert [r.f for r in got] == [at(1, 0), at(1, 1), at(1, 23), at(1, 5), None]


def test_monday_is_zero_and_zero_base(spark):
    df = frame(spark, [(at(1), 2.0, 0.0), (at(7), 3.0, 2.0)], "t timestamp_ntz, a double, b double")
    got = time.with_calendar(df, "t").withColumn("d", time.pct_diff("a", "b")).collect()
    assert [(r.weekday, r.weekday_name, r.d) for r in got] == [(0, "Monday", None), (6, "Sunday", 50.0)]


def test_codes(spark):
    df = frame(spark, [("X1",), ("??",), (None,)], "shift_short_name string")
    got = {r.shift_short_name: r.shift_type for r in cleaning.map_codes(df, "shift_short_name", schema.shift_types(spark)).collect()}
    assert got == {"X1": "pod", "??": None, None: None}
    assert len(schema.SHIFT_TYPES) == 41 and len(schema.METRICS) == 45


def test_holidays(spark):
    dim = calendar.holiday_dim(spark, (2023, 2024)).collect()
    days = {(r.date, r.name) for r in dim}
    for day, name in [((2024, 3, 29), "Good Friday"), ((2024, 4, 1), "Easter Monday"), ((2024, 5, 20), "National Patriots' Day"), ((2024, 9, 2), "Labour Day"), ((2024, 10, 14), "Thanksgiving"), ((2023, 1, 2), "New Year's Day (observed)")]:
        assert (dt.date(*day), name) in days
    df = frame(spark, [(1, dt.datetime(2024, 7, 1, 5)), (2, None)], "k int, ds timestamp_ntz")
    got = {r.k: r.is_qc_holiday for r in calendar.add_holidays(df, "ds", calendar.holiday_dim(spark, (2024, 2024)), ("qc",)).collect()}
    assert got == {1: "yes", 2: "no"}
    shifted = calendar.add_holidays(df.where("k = 1"), "ds", calendar.holiday_dim(spark, (2024, 2024)), ("qc",), src="UTC", tz="America/Vancouver", style="bool")
    assert shifted.first().is_qc_holiday is False
    with pytest.raises(Exception, match="no valid stamp"):
        calendar.year_range(df.where("k = 2"), "ds").collect()


# Published dates of 15 Nisan and of 1 Tishri.
PESACH = ["1990-04-10", "1999-04-01", "2000-04-20", "2005-04-24", "2016-04-23", "2018-03-31", "2019-04-20", "2020-04-09", "2021-03-28", "2022-04-16", "2023-04-06", "2024-04-23", "2025-04-13", "2026-04-02", "2030-04-18"]
NEW_YEAR = ["1990-09-20", "1995-09-25", "2000-09-30", "2005-10-04", "2010-09-09", "2013-09-05", "2015-09-14", "2020-09-19", "2021-09-07", "2022-09-26", "2023-09-16", "2024-10-03", "2025-09-23", "2026-09-12", "2030-09-28"]


def test_hebrew_calendar(spark):
    rows = calendar.hebrew_dim(spark, (1990, 2030)).collect()
    days = {}
    for r in rows:
        days.setdefault(r.name, {})[r.date.year] = r.date
    assert len(rows) == 9 * 41 and all(len(x) == 41 for x in days.values())
    for name, dates in (("Pesach", PESACH), ("Rosh Hashanah", NEW_YEAR)):
        assert [str(days[name][int(d[:4])]) for d in dates] == dates
    for y in range(1990, 2030):
        assert days["Rosh Hashanah"][y].weekday() not in (6, 2, 4) and days["Pesach"][y].weekday() not in (0, 2, 4)
        assert (days["Rosh Hashanah"][y + 1] - days["Rosh Hashanah"][y]).days in (353, 354, 355, 383, 384, 385)
    independence = ["1998-04-30", "2004-04-27", "2021-04-15", "2022-05-05", "2023-04-26", "2024-05-14"]
    assert [str(days["Independence Day"][int(d[:4])]) for d in independence] == independence


def test_weather(spark):
    rows = [(i, c, 10.0, p, 18.52, 90.0) for i, (c, p) in enumerate([("Snow", 60.0), ("Rain and snow", 59.0), ("mist", 0.0), ("Clear", 0.0)])]
    df = frame(spark, rows, "period int, condition string, temperature double, precip_probability double, wind_speed double, wind_direction double")
    got = weather.forecast_to_obs(df).orderBy("valid").collect()
    assert [r.wxcodes for r in got] == ["-SN", "-RASN", "BR", ""] and [r.vsby for r in got] == [1.0, 1.0, 0.5, 6.0]
    assert [r.p01i for r in got] == [0.01, 0.0, 0.0, 0.0] and got[0].sknt == 10.0 and got[0].tmpf == 50.0 and len(got[0]) == 30
    old = weather.forecast_to_obs(df, compat=True).orderBy("valid").collect()
    assert old[1].wxcodes == "-SN" and old[0].sknt == 19.0
    metar = weather.clean_metar(frame(spark, [("M",), ("T",), ("0.5",)], "p string"), ["p"])
    assert [r.p for r in metar.collect()] == [None, 0.0001, 0.5]


def test_sources_and_stream_match_batch(spark, tmp_path):
    """Reports of two days, the second correcting an hour of the first: a stream gives what a batch gives."""
    head = "﻿" + ",".join(["dateflg", "timeflg", *schema.METRICS])
    line = lambda d, h, v: ",".join([d, str(h), *[str(v)] * 45])
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text("\n".join([head, line("01/31/24", 24, 1), line("", 23, "2.0")]) + "\n\n")
    (tmp_path / "in/b.csv").write_text("\n".join([head, line("01/31/24", 23, 9), line("", 22, 4)]) + "\n")
    (tmp_path / "in/skip.txt").write_text("not a report")
    raw = tables.read_report(spark, f"file://{tmp_path}/in/a.csv")
    assert raw.count() == 2 and [r.timeflg for r in raw.orderBy("line_no").collect()] == ["24", "23"]
    q = stream.start_ingest(stream.report_stream(spark, f"file://{tmp_path}/in"), f"file://{tmp_path}/out", f"file://{tmp_path}/cp")
    q.awaitTermination()
    done = max(int(p.name[2:]) for p in (tmp_path / "out").glob("v=*"))
    got = {r.ds: r.QTRACK1 for r in spark.read.parquet(f"file://{tmp_path}/out/v={done}").collect()}
    assert set(got) == {dt.datetime(2024, 1, 31, 22), dt.datetime(2024, 1, 31, 23), dt.datetime(2024, 2, 1)} and got[dt.datetime(2024, 2, 1)] == 1
    again = stream.start_ingest(stream.report_stream(spark, f"file://{tmp_path}/in"), f"file://{tmp_path}/out", f"file://{tmp_path}/cp")
    again.awaitTermination()
    assert max(int(p.name[2:]) for p in (tmp_path / "out").glob("v=*")) == done  # each file once


def test_other_sources_and_sinks(spark, tmp_path):
    (tmp_path / "t.csv").write_text("ds,v\n2024-01-01 00:00:00,1\nds,v\n2024-01-02 00:00:00,2\n")
    from pyspark.sql import types as T

    ddl = T.StructType([T.StructField("ds", T.TimestampNTZType()), T.StructField("v", T.StringType())])
    got = tables.read_table(spark, f"file://{tmp_path}/t.csv", ddl, ["ds"], "null", ["ds"])
    assert [r.v for r in got.orderBy("ds").collect()] == ["1", "2"]
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|CAST_INVALID_INPUT"):
        tables.read_table(spark, f"file://{tmp_path}/t.csv", ddl, ["ds"], "raise").collect()
    assert tables.read_many(spark, f"file://{tmp_path}", T.StructType([T.StructField("ds", T.StringType()), T.StructField("v", T.StringType())])).count() == 3
    (tmp_path / "s.json").write_text('{"scheduled_shift_id": 1, "shift_short_name": "X1", "shift_start": "2024-01-01T08:00:00", "shift_end": "bad"}\n')
    s = tables.read_shifts(spark, f"file://{tmp_path}/s.json").first()
    assert s.shift_start == at(1, 8) and s.shift_end is None
    df = frame(spark, [("a", 1), ("b", 2)], "k string, v int")
    sinks.write_table(df, f"file://{tmp_path}/o", ["k"])
    sinks.write_table(frame(spark, [("a", 5)], "k string, v int"), f"file://{tmp_path}/o", ["k"])
    assert {(r.k, r.v) for r in spark.read.parquet(f"file://{tmp_path}/o").collect()} == {("a", 5), ("b", 2)}
