"""Cleaning and projection of report rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import ROLLUPS


def parse_mixed_ts(col: str, formats: Iterable[str]) -> Column:
    """First of the formats that parses, as wall clock; null if none does."""
    return F.coalesce(*[F.try_to_timestamp(F.col(col), F.lit(f)) for f in formats]).cast("timestamp_ntz")


def parse_ts(df: DataFrame, cols: Iterable[str], on_error: str = "null") -> DataFrame:
    """Text to wall-clock timestamps; on_error 'raise' or 'null'."""
    to = F.to_timestamp if on_error == "raise" else F.try_to_timestamp
    return df.withColumns({c: to(F.col(c)).cast("timestamp_ntz") for c in cols})


def fill_down(df: DataFrame, col: str, order: str, by: str) -> DataFrame:
    """Blank or null takes the value of the row above, in the order of the file's lines."""
    above = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(col, F.last(F.nullif(F.trim(col), F.lit("")), ignorenulls=True).over(above))


def to_int(df: DataFrame, cols: Iterable[str], mode: str = "strict") -> DataFrame:
    """Text to int by way of double (truncates). mode 'tolerant' gives null and lists the bad columns in ``bad``."""
    if mode == "strict":
        return df.withColumns({c: F.col(c).cast("double").cast("int") for c in cols})
    number = {c: F.col(c).try_cast("double").cast("int") for c in cols}
    bad = F.array_compact(F.array(*[F.when(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull(), F.lit(c)) for c in cols]))
    return df.withColumn("bad", bad).withColumns(number)


def to_double(col: str) -> Column:
    return F.col(col).try_cast("double")


def hour_ending(date_col: str, hour_col: str, fmt: str = "M/d/yy") -> Column:
    """Stamp of the end of hour 1..24: hour 24 is midnight of the next day."""
    start = F.to_timestamp(F.col(date_col), fmt).cast("timestamp_ntz")
    return start + F.make_dt_interval(hours=F.col(hour_col).cast("double").cast("int"))


def add_rollups(df: DataFrame, spec: dict = ROLLUPS) -> DataFrame:
    """Sums over columns: {name: (columns, 'zero' | 'propagate')}."""

    def total(cols, nulls):
        parts = [F.coalesce(F.col(c), F.lit(0)) if nulls == "zero" else F.col(c) for c in cols]
        return sum(parts[1:], parts[0])

    return df.withColumns({name: total(*how) for name, how in spec.items()})


def with_id(df: DataFrame, value: str, name: str = "id") -> DataFrame:
    return df.withColumn(name, F.lit(value))


def map_codes(df: DataFrame, col: str, dim: DataFrame) -> DataFrame:
    """Left join on a code dimension of fixed size; unknown codes give null."""
    code = dim.columns[0]
    return df.join(F.broadcast(dim.withColumnRenamed(code, col)) if code != col else F.broadcast(dim), col, "left")


def full_name(first: str, last: str) -> Column:
    return F.concat(F.col(first), F.col(last))


def common_select(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with the columns that they share, in the order of the first."""
    cols = [c for c in a.columns if c in set(b.columns)]
    return a.select(cols), b.select(cols)


def select_like(df: DataFrame, part: str, drop: bool = False, keep: Iterable[str] = ()) -> DataFrame:
    """Columns whose name contains part (or all others), besides keep."""
    return df.select([c for c in df.columns if c in set(keep) or (part in c) != drop])


def targets(df: DataFrame, exclude: Iterable[str] = ("id", "ds")) -> list[str]:
    return [c for c in df.columns if c not in set(exclude)]


def blank(col: str) -> Column:
    return F.coalesce(F.trim(col) == "", F.lit(True))


def drop_null_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.na.drop(subset=cols)


def null_audit(df: DataFrame) -> DataFrame:
    """(column_name, nulls), in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "nulls")
