"""Autoregressions from lag sums: running sums of products of a series with itself, lag by lag.

A series is stored as rows of ``BLOCK`` hours, each with the hours before it that its lags reach, so no task
sees a whole series and a hot series spreads over its blocks. A block gives the sum of the values and of the
products at each lag; running sums over blocks give the state as of any hour. The Gram matrix of a span is the
Toeplitz matrix of the difference of two states, less the windows that stick out at its two ends; these few values
are in the states. Only the solve of lags x lags systems is Python's.

An hour without a row or value counts as the one before it, leading ones as the first value; of two rows of an hour
the greater value counts; a series without values, or of fewer than lags + step + 1 hours, has no model of that step.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 24 * 28  # hours in a row of the block table
BY = ["id", "metric"]


def hour_number(ts: Column | str) -> Column:
    """Hours since 1970."""
    return F.timestamp_diff("HOUR", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts) if isinstance(ts, str) else ts)


def hour_stamp(n: Column) -> Column:
    return F.timestamp_add("HOUR", n, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def _block(n: Column) -> Column:
    return F.floor(n / BLOCK)


def series_ends(long: DataFrame) -> DataFrame:
    """(id, metric, a, b, shift, lead): first and last hour, mean and first value of each series that has a value."""
    n, v = hour_number("ds"), F.col("value").cast("double")
    ends = long.groupBy(*BY).agg(F.min(n).alias("a"), F.max(n).alias("b"), F.avg(v).alias("shift"), F.min_by(v, F.when(v.isNotNull(), n)).alias("lead"))
    return ends.where(F.col("shift").isNotNull())


def hour_blocks(long: DataFrame, span: int) -> DataFrame:
    """(id, metric, shift, block, last, own, x): the values of a block's ``own`` hours up to ``last``, after up to ``span`` hours before them."""
    ends = series_ends(long)
    given = long.groupBy(*BY, hour_number("ds").alias("n")).agg(F.max(F.col("value").cast("double")).alias("v"))
    hours = ends.select(*BY, F.explode(F.sequence("a", "b")).alias("n"))
    rows = hours.join(given, [*BY, "n"], "left").withColumn("block", _block(F.col("n")))
    seen = rows.groupBy(*BY, "block").agg(F.max_by("v", F.when(F.col("v").isNotNull(), F.col("n"))).alias("last"))
    before = Window.partitionBy(*BY).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # over blocks, not hours
    carry = seen.select(*BY, "block", F.last("last", ignorenulls=True).over(before).alias("carry"))
    up_to = Window.partitionBy(*BY, "block").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    known = F.coalesce(F.last("v", ignorenulls=True).over(up_to), "carry", "lead")
    full = rows.join(carry, [*BY, "block"]).join(ends.select(*BY, "shift", "lead"), BY).select(*BY, "shift", "n", known.alias("v"))
    copies = full.withColumn("block", F.explode(F.sequence(_block(F.col("n")), _block(F.col("n") + span))))
    mine = _block(F.col("n")) == F.col("block")
    out = copies.groupBy(*BY, "block").agg(
        F.first("shift").alias("shift"), F.max("n").alias("last"), F.count(F.when(mine, 1)).alias("own"),
        F.array_sort(F.collect_list(F.struct("n", "v"))).alias("x"),  # BLOCK + span at most
    )
    return out.where("own > 0").select(*BY, "shift", "block", "last", "own", F.col("x.v").alias("x"))


def _products(x: np.ndarray, own: int, width: int) -> np.ndarray:
    """For each of the last ``own`` values: itself, then its product with the value d hours before, for d < width."""
    padded = np.concatenate([np.zeros(width - 1), x])  # hours before the series count as 0
    back = np.lib.stride_tricks.sliding_window_view(padded, width)[len(x) - own :, ::-1]
    now = x[len(x) - own :]
    return np.column_stack([now, back * now[:, None]])


def _kinds(df: DataFrame) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in BY)


def lag_totals(blocks: DataFrame, width: int) -> DataFrame:
    """(id, metric, block, sums): each block's sum of values, and of products at lags 0 to width - 1, of values less the series' mean."""

    def work(batches):
        for g in batches:
            sums = [_products(np.asarray(r.x) - r.shift, r.own, width).sum(axis=0) for r in g.itertuples(index=False)]
            yield g[[*BY, "block"]].assign(sums=[s.tolist() for s in sums])

    return blocks.mapInPandas(work, f"{_kinds(blocks)}, block long, sums array<double>")


def lag_states(long: DataFrame, stamps: DataFrame, width: int) -> DataFrame:
    """(id, metric, n, shift, sums, near): the sums up to each wanted hour n, and the last 2 * (width - 1) values.

    stamps: (id, metric, n), hours of the series. A row is read once, whatever the number of stamps.
    """
    blocks = hour_blocks(long, 2 * width)
    each = lag_totals(blocks, width).select(*BY, "block", F.posexplode("sums").alias("d", "s"))
    before = Window.partitionBy(*BY, "d").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    prior = each.withColumn("s", F.coalesce(F.sum("s").over(before), F.lit(0.0)))
    prior = prior.groupBy(*BY, "block").agg(F.array_sort(F.collect_list(F.struct("d", "s"))).alias("p")).select(*BY, "block", F.col("p.s").alias("prior"))
    wanted = stamps.withColumn("block", _block(F.col("n"))).groupBy(*BY, "block").agg(F.collect_set("n").alias("wanted"))  # BLOCK at most

    def work(batches):
        for g in batches:
            out = []
            for r in g.itertuples(index=False):
                x = np.asarray(r.x) - r.shift
                sums = np.asarray(r.prior) + np.cumsum(_products(x, r.own, width), axis=0)
                for n in sorted(r.wanted):
                    end = len(x) - (r.last - n)
                    out.append((r.id, r.metric, n, r.shift, sums[end - len(x) - 1].tolist(), x[max(0, end - 2 * (width - 1)) : end].tolist()))
            yield pd.DataFrame(out, columns=[*BY, "n", "shift", "sums", "near"])

    rows = blocks.join(prior, [*BY, "block"]).join(wanted, [*BY, "block"])
    return rows.mapInPandas(work, f"{_kinds(blocks)}, n long, shift double, sums array<double>, near array<double>")


def _between(near: np.ndarray, at: int, first: int, last: int) -> np.ndarray:
    """The values of the hours first to last from those that end at hour ``at``; 0 where there are none."""
    hours = np.arange(first, last + 1) - (at - len(near) + 1)
    ok = (hours >= 0) & (hours < len(near))
    return np.where(ok, near[np.clip(hours, 0, len(near) - 1)], 0.0)


def span_models(start: int, cut: int, early, late, lags: int, steps: int, ridge: float = 1e-8):
    """(step, intercept, weights oldest first, prediction) of each step that the hours start to cut can fit.

    early and late: (hour, sums, near) of the states near the start and at the cut, of centred values.
    """
    width = lags + steps
    windows = lambda v: np.lib.stride_tricks.sliding_window_view(v, width)
    at, sums, near = early
    inner = _products(near, max(0, min(at - start + 1, len(near))), width).sum(axis=0)
    total = np.asarray(late[1]) - (sums - inner)
    k = np.arange(width)
    full = total[1:][np.abs(k[:, None] - k)]
    head = _between(near, at, start - (width - 1), min(start + width - 2, cut))
    head = np.concatenate([head, np.zeros(2 * (width - 1) - len(head))])
    over, outside = windows(head), windows(np.concatenate([head[: width - 1], np.zeros(width - 1)]))
    tail = _between(late[2], late[0], cut - width + 2, cut)
    after = windows(np.concatenate([tail, np.zeros(width - 1)]))
    full = full - (over.T @ over - outside.T @ outside)
    ones = total[0] - (over.sum(axis=0) - outside.sum(axis=0))
    now = tail[width - 1 - lags :]
    for h in range(1, steps + 1):
        n = cut - start + 1 - lags - h + 1
        if n < 2:
            return
        rest, goal = after[steps - h :], lags - 1 + h
        s = ones - rest.sum(axis=0)
        g = full - rest.T @ rest - np.outer(s, s) / n
        scale = np.trace(g[:lags, :lags]) / lags / n
        w = np.linalg.solve(g[:lags, :lags] / scale + ridge * n * np.eye(lags), g[:lags, goal] / scale) if scale > 1e-12 else np.zeros(lags)
        c = (s[goal] - s[:lags] @ w) / n
        yield h, c, w, c + now @ w


def lag_models(long: DataFrame, cuts: DataFrame, lags: int, steps: int) -> DataFrame:
    """(id, metric, cut, step, intercept, coef oldest lag first, yhat): a direct model of each step, fitted on the hours start to cut.

    cuts: (id, metric, start, cut) as hour numbers within the series.
    """
    width = lags + steps
    cuts = cuts.join(series_ends(long).select(*BY, "b"), BY)
    cuts = cuts.select(*BY, "start", "cut", F.least(F.col("start") + width - 2, "b").alias("early"))
    stamps = cuts.select(*BY, F.explode(F.array("cut", "early")).alias("n")).distinct()
    states = lag_states(long, stamps, width)
    one = states.select(*BY, F.col("n").alias("early"), F.col("sums").alias("sums0"), F.col("near").alias("near0"))
    two = states.select(*BY, F.col("n").alias("cut"), "shift", "sums", "near")
    both = cuts.join(one, [*BY, "early"]).join(two, [*BY, "cut"])

    def fit(batches):
        for g in batches:
            out = []
            for r in g.itertuples(index=False):
                early, late = (r.early, np.asarray(r.sums0), np.asarray(r.near0)), (r.cut, np.asarray(r.sums), np.asarray(r.near))
                for h, c, w, p in span_models(r.start, r.cut, early, late, lags, steps):
                    out.append((r.id, r.metric, r.cut, h, c + r.shift * (1 - w.sum()), w.tolist(), p + r.shift))
            yield pd.DataFrame(out, columns=[*BY, "cut", "step", "intercept", "coef", "yhat"])

    return both.mapInPandas(fit, f"{_kinds(long)}, cut long, step int, intercept double, coef array<double>, yhat double")


def lag_bands(long: DataFrame, models: DataFrame, lags: int, steps: int, quantiles: tuple[float, ...], accuracy: int = 10_000) -> DataFrame:
    """(id, metric, step, offsets): quantiles of each model's residuals over the whole series, by a sketch within 1 / accuracy of the rank."""
    blocks = hour_blocks(long, lags + steps)
    each = models.groupBy(*BY).agg(F.array_sort(F.collect_list(F.struct("step", "intercept", "coef"))).alias("m"))  # ``steps`` entries
    rows = blocks.join(each.select(*BY, F.col("m.step").alias("step"), F.col("m.intercept").alias("intercept"), F.col("m.coef").alias("coef")), BY)

    def work(batches):
        for g in batches:
            out = []
            for r in g.itertuples(index=False):
                x = np.asarray(r.x)
                if len(x) < lags:
                    continue
                p = np.lib.stride_tricks.sliding_window_view(x, lags) @ np.stack(r.coef).T + np.asarray(r.intercept)
                for i, h in enumerate(r.step):
                    first = max(len(x) - r.own, lags - 1 + h)  # the window before lies in x
                    if first < len(x):
                        out.append((r.id, r.metric, h, (x[first:] - p[first - h - lags + 1 : len(x) - h - lags + 1, i]).tolist()))
            yield pd.DataFrame(out, columns=[*BY, "step", "rest"])

    rest = rows.mapInPandas(work, f"{_kinds(blocks)}, step int, rest array<double>").select(*BY, "step", F.explode("rest").alias("rest"))
    return rest.groupBy(*BY, "step").agg(F.percentile_approx("rest", list(quantiles), accuracy).alias("offsets"))
