"""Weather inputs: model arrays, station observations, and forecasts in observation form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRACE = 0.0001


def weather_from_arrays(df: DataFrame, variables: list[str], src: str = "UTC", tz: str | None = None) -> DataFrame:
    """Rows (start, step_seconds, one array for each variable) -> one row for each step, left-closed, in the site's zone."""
    rows = df.select("start", "step_seconds", F.posexplode(F.arrays_zip(*variables)).alias("pos", "v"))
    at = F.col("start") + F.make_dt_interval(secs=F.col("pos") * F.col("step_seconds"))
    return rows.select((F.convert_timezone(F.lit(src), F.lit(tz), at) if tz else at).alias("ds"), "v.*")


def clean_metar(df: DataFrame, cols: list[str], trace: float | None = TRACE) -> DataFrame:
    """'M' is missing, 'T' is a trace; the rest are numbers or null."""
    number = lambda c: F.when(F.col(c) == "M", None).when(F.col(c) == "T", F.lit(trace)).otherwise(F.col(c).try_cast("double"))
    return df.withColumns({c: number(c) for c in cols})


def _humidity(tmpf: Column, dwpf: Column) -> Column:
    magnus = lambda f: F.exp(17.625 * ((f - 32) * 5 / 9) / (243.04 + (f - 32) * 5 / 9))
    return F.least(F.greatest(100 * magnus(dwpf) / magnus(tmpf), F.lit(20.0)), F.lit(100.0)).cast("int")


def forecast_to_obs(df: DataFrame, compat: bool = False, station: str = "CYUL") -> DataFrame:
    """Hourly forecast rows as observation rows. compat keeps a double wind conversion and no mixed code."""
    cond = F.lower("condition")
    has = lambda *words: F.greatest(*[F.contains(cond, F.lit(w)) for w in (*words, words[0])])
    snow, rain, fog, mix = has("snow"), has("rain"), has("fog", "mist"), has("mix")
    tmpf = F.col("temperature") * 9 / 5 + 32
    wind = F.col("wind_speed") / 1.852 * (1.94384 if compat else 1.0)
    codes = F.when(snow & rain, "-RASN").when(mix, "-RASN") if not compat else F.when(F.lit(False), "")
    return df.select(
        F.lit(station).alias("station"), F.col("period").alias("valid"), tmpf.alias("tmpf"), (tmpf - 4).alias("dwpf"),
        _humidity(tmpf, tmpf - 4).alias("relh"), F.col("wind_direction").alias("drct"), F.bround(wind, 0).alias("sknt"),
        F.when(F.col("precip_probability") >= 60, 0.01).otherwise(0.0).alias("p01i"),
        F.lit(1012.0 * 0.02953).alias("alti"), F.lit(1012.0).alias("mslp"),
        F.when(snow, 1.0).when(rain, 2.0).when(fog, 0.5).otherwise(6.0).alias("vsby"), F.lit(0.0).alias("gust"),
        F.lit("BKN").alias("skyc1"), *[F.lit("").alias(f"skyc{i}") for i in (2, 3, 4)],
        F.lit(2500.0).alias("skyl1"), *[F.lit(None).cast("double").alias(f"skyl{i}") for i in (2, 3, 4)],
        codes.when(snow, "-SN").when(rain, "-RA").when(mix, "-RASN").when(fog, "BR").otherwise("").alias("wxcodes"),
        *[F.lit(0.0).alias(f"ice_accretion_{i}hr") for i in (1, 3, 6)],
        F.lit(None).cast("double").alias("peak_wind_gust"), F.lit(None).cast("double").alias("peak_wind_drct"),
        F.lit(None).cast("timestamp_ntz").alias("peak_wind_time"), tmpf.alias("feel"), F.lit("").alias("metar"),
        F.lit(None).cast("double").alias("snowdepth"),
    )
