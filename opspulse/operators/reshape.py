"""Wide to long and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_long(df: DataFrame, metrics: list[str], keys: list[str] = ["id", "ds"]) -> DataFrame:  # noqa: B006
    """(keys, metric, value double)."""
    return df.select(*keys, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(keys, metrics, "metric", "value")


def steps_to_rows(df: DataFrame, steps: int, quantiles: tuple[str, ...] = ("20.0%", "80.0%"), which: str = "last", id: str = "id", ts: str = "ds") -> DataFrame:
    """One row step0.. with quantile columns -> a row for each step; from each site's last (or first) row."""
    row = (F.max_by if which == "last" else F.min_by)(F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.col(ts))
    own = df.groupBy(F.col(id).alias("_id")).agg(row.alias("r")).select("r.*")
    names = [F.array(*[F.col(f"`step{i}`") for i in range(steps)]).alias("yhat")]
    names += [F.array(*[F.col(f"`step{i} {q}`") for i in range(steps)]).alias(f"q{q.split('.')[0]}") for q in quantiles]
    out = own.select(id, ts, F.posexplode(F.arrays_zip(*names)).alias("pos", "v"))
    return out.select(id, (F.col(ts) + F.make_dt_interval(hours=F.col("pos"))).alias(ts), F.col("pos").alias("step"), "v.*")
