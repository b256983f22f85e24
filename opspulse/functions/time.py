"""Hours, days, zones and formats of wall-clock stamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_hour(c: Column | str) -> Column:
    return F.date_trunc("hour", _col(c)).cast("timestamp_ntz")


def ceil_hour(c: Column | str) -> Column:
    low = floor_hour(c)
    return F.when(low < _col(c), low + F.expr("interval 1 hour")).otherwise(low)


def round_hour_even(c: Column | str) -> Column:
    """Nearest hour; the half goes to the even hour since the epoch."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    hours = F.bround(F.timestamp_diff("SECOND", epoch, _col(c)) / F.lit(3600.0)).cast("int")
    return epoch + F.make_dt_interval(hours=hours)


def with_calendar(df: DataFrame, ts: str) -> DataFrame:
    """hour, date, Monday-based weekday number and weekday name."""
    return df.withColumns(
        {"hour": F.hour(ts), "date": F.to_date(ts), "weekday": F.weekday(ts), "weekday_name": F.date_format(ts, "EEEE")}
    )


def day_offset(c: Column | str, today: Column | str) -> Column:
    return F.datediff(F.to_date(_col(c)), F.to_date(F.lit(today)) if isinstance(today, str) else today)


def to_zone(c: Column | str, src: str, dst: str) -> Column:
    return F.convert_timezone(F.lit(src), F.lit(dst), _col(c))


def hour_stamp(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd-HH")


def round1(c: Column | str) -> Column:
    return F.round(_col(c), 1)


def pct_diff(a: Column | str, b: Column | str) -> Column:
    """100 * (a - b) / b; null where b is 0."""
    return F.try_divide(_col(a) - _col(b), _col(b)) * 100


def hours_between(a: Column | str, b: Column | str) -> Column:
    return F.timestamp_diff("SECOND", _col(a), _col(b)) / F.lit(3600.0)
