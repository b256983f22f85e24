"""Holiday dimension and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def easter(year: Column) -> Column:
    """Gregorian Easter Sunday, by the anonymous computus."""
    q = lambda a, b: F.floor(a / b).cast("int")
    a, b, c = year % 19, q(year, 100), year % 100
    h = (19 * a + b - q(b, 4) - q(b - q(b + 8, 25) + 1, 3) + 15) % 30
    k = (32 + 2 * (b % 4) + 2 * q(c, 4) - h - c % 4) % 7
    m = q(a + 11 * h + 22 * k, 451)
    return F.make_date(year, q(h + k - 7 * m + 114, 31), (h + k - 7 * m + 114) % 31 + 1)


def _monday_before(year: Column, month: int, day: int) -> Column:
    """The last Monday before the given day."""
    last = F.date_sub(F.make_date(year, F.lit(month), F.lit(day)), 1)
    return F.date_sub(last, F.weekday(last))


def _nth_monday(year: Column, month: int, n: int) -> Column:
    first = F.make_date(year, F.lit(month), F.lit(1))
    return F.date_add(first, (7 - F.weekday(first)) % 7 + 7 * (n - 1))


def _days_before(year: Column) -> Column:
    """Days from the epoch of the Hebrew calendar to the mean new moon of a year's Tishri, put off where it may not begin."""
    y = year.cast("bigint")
    months = F.floor((235 * y - 234) / 19)
    days = 29 * months + F.floor((12084 + 13753 * months) / 25920)
    return days + F.when((3 * (days + 1)) % 7 < 3, 1).otherwise(0)


def hebrew_new_year(days: Column, at: int) -> Column:
    """Gregorian date of 1 Tishri: the mean moon, and delays that keep years of a lawful length. days: ``_days_before`` of the years from at - 1 on."""
    before, own, after = (F.get(days, F.lit(k)) for k in (at - 1, at, at + 1))
    late = F.when(after - own == 356, 2).when(own - before == 382, 1).otherwise(0)
    return F.date_from_unix_date((own + late - 2092590).cast("int"))  # the epoch is 2,092,590 days before 1970-01-01


def hebrew_dim(spark: SparkSession, years: tuple[int, int], calendar: str = "il") -> DataFrame:
    """(date, calendar, name): Israel's public holidays within the Gregorian years, by rule.

    Tishri's feasts count from the new year; those of spring lie a fixed number of days before the next one.
    Independence Day moves off Friday to Monday as the law of the year has it (Mondays since 2004).
    """
    h = F.col("id").cast("int")
    moons = spark.range(years[0] + 3760, years[1] + 3762).select(F.transform(F.sequence(h - 1, h + 2), _days_before).alias("moons"))
    starts = moons.select(hebrew_new_year(F.col("moons"), 1).alias("start"), F.date_sub(hebrew_new_year(F.col("moons"), 2), 163).alias("pesach"))
    start, pesach = F.col("start"), F.col("pesach")
    fifth = F.date_add(pesach, 20)
    day = F.weekday(fifth)
    independence = F.date_add(fifth, F.when(day == 4, -1).when(day == 5, -2).when((day == 0) & (F.year(fifth) >= 2004), 1).otherwise(0))
    rules = [
        ("Rosh Hashanah", start), ("Rosh Hashanah (second day)", F.date_add(start, 1)), ("Yom Kippur", F.date_add(start, 9)),
        ("Sukkot", F.date_add(start, 14)), ("Simchat Torah", F.date_add(start, 21)), ("Pesach", pesach),
        ("Seventh day of Pesach", F.date_add(pesach, 6)), ("Independence Day", independence), ("Shavuot", F.date_add(pesach, 50)),
    ]
    each = F.explode(F.array(*[F.struct(d.alias("date"), F.lit(calendar).alias("calendar"), F.lit(n).alias("name")) for n, d in rules]))
    days = starts.select(each.alias("x")).select("x.*")
    return days.where(F.year("date").between(*years))


def holiday_dim(spark: SparkSession, years: tuple[int, int], custom: DataFrame | None = None) -> DataFrame:
    """(date, calendar, name): Quebec by rule, with observed days; other calendars (``hebrew_dim``, say) come as a table."""
    y = F.col("y")
    fixed = lambda m, d: F.make_date(y, F.lit(m), F.lit(d))
    rules = [
        ("New Year's Day", fixed(1, 1), True), ("Good Friday", F.date_sub(easter(y), 2), False),
        ("Easter Monday", F.date_add(easter(y), 1), False), ("National Patriots' Day", _monday_before(y, 5, 25), False),
        ("Saint-Jean-Baptiste Day", fixed(6, 24), True), ("Canada Day", fixed(7, 1), True),
        ("Labour Day", _nth_monday(y, 9, 1), False), ("Thanksgiving", _nth_monday(y, 10, 2), False),
        ("Christmas Day", fixed(12, 25), True),
    ]
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), d.alias("date"), F.lit(o).alias("moves")) for n, d, o in rules]))
    days = spark.range(years[0], years[1] + 1).select(F.col("id").cast("int").alias("y")).select(each.alias("h")).select("h.*")
    weekend = F.col("moves") & (F.weekday("date") >= 5)
    observed = days.where(weekend).select(
        F.date_add("date", 7 - F.weekday("date")).alias("date"), F.concat("name", F.lit(" (observed)")).alias("name")
    )
    out = days.select("date", "name").unionByName(observed).select("date", F.lit("qc").alias("calendar"), "name")
    return out if custom is None else out.unionByName(custom.select("date", "calendar", "name"))


def add_holidays(
    df: DataFrame, ts: str, dim: DataFrame, calendars: tuple[str, ...] = ("qc", "il"), src: str | None = None,
    tz: str | None = None, names: bool = False, style: str = "yesno",
) -> DataFrame:
    """is_<calendar>_holiday by local date, and <calendar>_holiday_name. A null stamp is no holiday.

    Two names on one date and calendar do not multiply rows. The dimension has a few rows a year.
    """
    local = F.convert_timezone(F.lit(src or "UTC"), F.lit(tz), F.col(ts)) if tz else F.col(ts)
    firsts = [F.min(F.when(F.col("calendar") == c, F.col("name"))).alias(f"_{c}") for c in calendars]
    days = dim.groupBy(F.col("date").alias("_date")).agg(*firsts)
    out = df.withColumn("_local", F.to_date(local)).join(F.broadcast(days), F.col("_local") == F.col("_date"), "left")
    flag = lambda c: F.when(F.col(f"_{c}").isNotNull(), "yes").otherwise("no") if style == "yesno" else F.col(f"_{c}").isNotNull()
    out = out.withColumns({f"is_{c}_holiday": flag(c) for c in calendars})
    if names:
        none = "no" if style == "yesno" else ""
        out = out.withColumns({f"{c}_holiday_name": F.coalesce(F.col(f"_{c}"), F.lit(none)) for c in calendars})
    return out.drop("_local", "_date", *[f"_{c}" for c in calendars])


def year_range(df: DataFrame, ts: str) -> DataFrame:
    """One row (first_year, last_year); raises if no stamp is valid."""
    years = df.agg(F.min(F.year(ts)).alias("first_year"), F.max(F.year(ts)).alias("last_year"))
    bad = F.raise_error(F.lit("no valid stamp to take years from")).cast("int")
    return years.select(F.coalesce("first_year", bad).alias("first_year"), "last_year")
