"""On-call activity joins by person and day: shifts over midnight match on both days, and a person's other days are not compared."""

import datetime as dt
import re

from opspulse.streaming import stream


def at(h):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


def test_activity_meets_the_shifts_of_its_day_alone(spark):
    shift = "user_id long, shift_start timestamp_ntz, shift_end timestamp_ntz"
    acts = spark.createDataFrame([(1, at(h)) for h in (21, 23, 25, 26, 30, 47, 70)] + [(2, at(24)), (None, at(24))], "user_id long, ts timestamp_ntz")
    oncall = spark.createDataFrame([(1, at(22), at(30)), (1, at(46), at(99)), (2, at(24), at(24)), (2, at(20), None), (None, at(0), at(99))], shift)
    regular = spark.createDataFrame([(1, at(23.5), at(25.5)), (1, at(26), at(26))], shift)
    found = stream.oncall_activity_stream(acts, oncall, regular)
    got = sorted((r.user_id, r.ts) for r in found.collect())
    assert got == [(1, at(23)), (1, at(26)), (1, at(47))]  # the hour 70 is 24 hours after a start, beyond the longest shift
    joins = re.findall(r"^.*Join.*$", found._jdf.queryExecution().sparkPlan().toString(), re.M)
    assert len(joins) == 2 and all("_day" in j and "_on" in j for j in joins)
