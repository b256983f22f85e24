"""Sinks: replaced tables, dashboards, alert payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Replace the table; with ``by`` only the partitions that df touches. Never read and overwrite one path in one job."""
    out = df.write.mode("overwrite").option("header", True)
    if by:
        out = out.partitionBy(*by).option("partitionOverwriteMode", "dynamic")
    out.format(fmt).save(path)


def to_wide(df: DataFrame, names: list[str], metric: str = "metric", keys: tuple[str, ...] = ("id", "ds"), values: tuple[str, ...] = ("value",)) -> DataFrame:
    """Long to wide with the given names: <name> for one value column, <name>_<value> for several."""
    aggs = [F.min(v).alias(v) for v in values]
    wide = df.groupBy(*keys).pivot(metric, names).agg(*aggs)
    return wide


def alert_payload(status: DataFrame) -> DataFrame:
    """(id, metric, ds, payload): a card for each critical metric, an empty object for the others."""
    text = F.format_string("%s is %s, expected at most %s", F.col("metric"), F.col("value").cast("string"), F.round("yhat_upper", 1).cast("string"))
    card = F.to_json(F.struct(
        F.lit("AdaptiveCard").alias("type"),
        F.array(F.struct(F.lit("TextBlock").alias("type"), text.alias("text"))).alias("body"),
    ))
    return status.select("id", "metric", "ds", F.when(F.col("critical"), card).otherwise("{}").alias("payload"))


def alert_facts(alerts: DataFrame) -> DataFrame:
    """(id, ds, facts): a sorted list of {name, value as text} for the alerts of an hour; at most one for each metric."""
    fact = F.struct(F.col("metric").alias("name"), F.col("value").cast("string").alias("value"))
    return alerts.groupBy("id", "ds").agg(F.array_sort(F.collect_list(fact)).alias("facts"))
