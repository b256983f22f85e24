"""Union, dedupe and keyed upsert with a total order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe(df: DataFrame, keys: list[str], order: list[str], keep: str = "last") -> DataFrame:
    """One row for each key: the last (or first) by the order columns."""
    by = [F.col(c).desc_nulls_last() if keep == "last" else F.col(c).asc_nulls_first() for c in order]
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*by)))
    return ranked.where("_n = 1").drop("_n")


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """By name; columns that one side lacks are null."""
    return a.unionByName(b, allowMissingColumns=True)


def upsert(hist: DataFrame, new: DataFrame, keys: list[str], keep: str = "last", seq: list[str] = []) -> DataFrame:  # noqa: B006
    """History with the new rows; on equal keys the new row wins ('last') or the old one stays ('first')."""
    both = union_all(hist.withColumn("_src", F.lit(0)), new.withColumn("_src", F.lit(1)))
    return dedupe(both, keys, ["_src", *seq], keep).drop("_src")


def touched_partitions(hist: DataFrame, new: DataFrame, date_col: str) -> DataFrame:
    """Rows of history in the dates that new touches: all that an upsert has to rewrite."""
    return hist.join(new.select(date_col).distinct(), date_col, "left_semi")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
