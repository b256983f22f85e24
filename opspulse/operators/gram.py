"""Least squares from sums that Spark adds up: no task sees a series' rows.

A Gram table holds, for each series, the sums of products of all design columns (and of the
value). It is made by one aggregate with partial sums, so a series may have any number of
rows; only the p x p solve of a series runs in Python, on a row of p * p numbers. Every model
over a subset of the columns is solved from the same sums, so a grid of models costs one scan.

Seasonal designs (hour of day, weekday) are kept as *cells*: the sums of each (hour, weekday)
of a series, from which the products with the indicator columns follow. Running sums of a cell
give its state as of any hour; the state of a window is the difference of two of them, found by
equi join, so a back-test with any number of cutoffs reads each row once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEASON = 1 + 23 + 6  # intercept, hours but the first, weekdays but the first


def ridge_solve(g: np.ndarray, b: np.ndarray, largest: np.ndarray, ridge: float) -> np.ndarray:
    """Coefficients from a Gram matrix, with a slight ridge on columns scaled by their largest absolute value."""
    s = np.where(largest > 0, largest, 1.0)
    return np.linalg.solve(g / np.outer(s, s) + ridge * np.eye(len(s)), b / s) / s


# --- designs given as expressions


def gram(rows: DataFrame, by: list[str], columns: dict[str, Column], value: Column) -> DataFrame:
    """(by, n, g, b, yy, y, largest): sums of products over rows without nulls in the columns or the value.

    The first column is the constant 1. g is the upper triangle of the Gram matrix, row by row; b its products with
    the value; largest the columns' absolute maxima. Products are generated from an array and summed by place, with
    partial sums, since a plan of p * p separate sums would be too large to compile.
    """
    p = len(columns)
    v = rows.select(*by, F.array(*[c.cast("double") for c in columns.values()], value.cast("double")).alias("_v"))
    v = v.where(~F.exists("_v", lambda c: c.isNull()))
    one = v.select(*by, "_v", F.posexplode("_v").alias("_i", "_a"))
    two = one.select(*by, "_i", "_a", F.posexplode(F.slice("_v", F.col("_i") + 1, p + 1)).alias("_k", "_b"))
    sums = two.groupBy(*by, "_i", (F.col("_i") + F.col("_k")).alias("_j")).agg(F.sum(F.col("_a") * F.col("_b")).alias("_s"), F.max(F.abs("_a")).alias("_m"))
    whole = sums.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_i", "_j", "_s", "_m"))).alias("_e"))  # p * p / 2 entries
    part = lambda keep, field: F.transform(F.filter("_e", keep), lambda e: e[field])
    return whole.select(
        *by, F.get("_e", F.lit(0))["_s"].cast("long").alias("n"),
        part(lambda e: e["_j"] < p, "_s").alias("g"), part(lambda e: (e["_j"] == p) & (e["_i"] < p), "_s").alias("b"),
        F.get(part(lambda e: e["_i"] == p, "_s"), F.lit(0)).alias("yy"), F.get(part(lambda e: e["_j"] == p, "_s"), F.lit(0)).alias("y"),
        part(lambda e: (e["_i"] == e["_j"]) & (e["_i"] < p), "_m").alias("largest"),
    )


def solve(table: DataFrame, by: list[str], columns: list[str], models: dict[str, list[str]], ridge: float = 1e-6) -> DataFrame:
    """(by, model, n, coef, sse, mean): coefficients of each model over a subset of the columns, in the columns' order (0 where unused).

    sse is the sum of squared residuals and mean their mean, both from the sums; the first column must be the constant 1.
    """
    at = {c: i for i, c in enumerate(columns)}
    p = len(columns)
    upper = np.triu_indices(p)

    def work(batches):
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                g = np.zeros((p, p))
                g[upper] = r.g
                g = g + np.triu(g, 1).T
                b, largest = np.asarray(r.b), np.asarray(r.largest)
                for model, own in models.items():
                    pick = [at[c] for c in own]
                    w = np.zeros(p)
                    w[pick] = ridge_solve(g[np.ix_(pick, pick)], b[pick], largest[pick], ridge)
                    sse = max(0.0, float(r.yy - 2 * w @ b + w @ g @ w))
                    out.append((*[getattr(r, c) for c in by], model, r.n, w.tolist(), sse, float(r.y - w @ g[0]) / r.n))
            yield pd.DataFrame(out, columns=[*by, "model", "n", "coef", "sse", "mean"])

    kinds = ", ".join(f"`{c}` {table.schema[c].dataType.simpleString()}" for c in by)
    return table.mapInPandas(work, f"{kinds}, model string, n long, coef array<double>, sse double, mean double")


def dot(coef: Column | str, columns: list[Column]) -> Column:
    """A design row times coefficients, as one JVM expression."""
    c = F.col(coef) if isinstance(coef, str) else coef
    total = F.lit(0.0)
    for i, x in enumerate(columns):
        total = total + F.get(c, F.lit(i)) * x.cast("double")
    return total


def fourier(t: Column, period: float, order: int) -> list[Column]:
    """Sines, then cosines, of t (in days)."""
    angle = [2 * np.pi * k * t / period for k in range(1, order + 1)]
    return [F.sin(a) for a in angle] + [F.cos(a) for a in angle]


# --- seasonal designs as cells


def cell_sums(z: list[str]) -> dict[str, Column]:
    """Names and inputs of a cell's sums: rows, each column of z, and each product of two."""
    out = {"s": F.lit(1.0)} | {f"s_{a}": F.col(a) for a in z}
    return out | {f"s_{a}_{b}": F.col(a) * F.col(b) for i, a in enumerate(z) for b in z[i:]}


def cells(rows: DataFrame, by: list[str], z: list[str]) -> DataFrame:
    """(by, hour, day, s...): the sums of each hour and weekday of a series; the last of z is the value. Rows without nulls in z."""
    known = rows.na.drop(subset=z).withColumns({"hour": F.hour("ds"), "day": F.weekday("ds")})
    return known.groupBy(*by, "hour", "day").agg(*[F.sum(c).alias(n) for n, c in cell_sums(z).items()])


def _assembled(g: pd.DataFrame, z: list[str]) -> np.ndarray:
    """The Gram matrix over intercept, hours, weekdays and z, from the cells of one series."""
    h = np.column_stack([np.ones(len(g)), np.eye(24)[g["hour"]][:, 1:], np.eye(7)[g["day"]][:, 1:]])
    n, q = g["s"].to_numpy(float), len(z)
    out = np.zeros((SEASON + q, SEASON + q))
    out[:SEASON, :SEASON] = h.T @ (n[:, None] * h)
    out[:SEASON, SEASON:] = h.T @ g[[f"s_{a}" for a in z]].to_numpy(float)
    out[SEASON:, :SEASON] = out[:SEASON, SEASON:].T
    for i, a in enumerate(z):
        for j, b in enumerate(z[i:], i):
            out[SEASON + i, SEASON + j] = out[SEASON + j, SEASON + i] = g[f"s_{a}_{b}"].sum()
    return out


def solve_cells(table: DataFrame, by: list[str], z: list[str], models: dict[str, list[str]], ridge: float = 1e-3) -> DataFrame:
    """(by, model, n, mean, hours, days, coef): seasonal regressions on subsets of z, from at most 168 cells a group.

    The value is the last of z. hours holds the intercept; coef has an entry for each of z but the value, 0 where unused.
    Columns of z are scaled by their root mean squares for the ridge.
    """
    kinds = ", ".join(f"`{c}` {table.schema[c].dataType.simpleString()}" for c in by)
    x = z[:-1]

    def fit(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        whole = _assembled(g, z)
        n, out = whole[0, 0], []
        for model, own in models.items():
            pick = [*range(SEASON), *(SEASON + x.index(c) for c in own)]
            part = whole[np.ix_(pick, pick)]
            largest = np.where(np.arange(len(pick)) < SEASON, np.sign(np.diag(part)), np.sqrt(np.diag(part) / max(n, 1)))
            w = ridge_solve(part, whole[pick, -1], largest, ridge)
            coef = dict(zip(own, w[SEASON:], strict=True))
            hours, days = w[0] + np.concatenate([[0.0], w[1:24]]), np.concatenate([[0.0], w[24:SEASON]])
            out.append((*key, model, int(n), float(whole[0, -1] / max(n, 1)), hours.tolist(), days.tolist(), [float(coef.get(c, 0.0)) for c in x]))
        return pd.DataFrame(out, columns=[*by, "model", "n", "mean", "hours", "days", "coef"])

    return table.groupBy(*by).applyInPandas(fit, f"{kinds}, model string, n long, mean double, hours array<double>, days array<double>, coef array<double>")


def seasonal_score(x: list[str], ds: str = "ds") -> Column:
    """The prediction of a row that has hours, days, coef and the columns x."""
    return F.get("hours", F.hour(ds)) + F.get("days", F.weekday(ds)) + dot("coef", [F.col(c) for c in x])


def running_cells(rows: DataFrame, by: list[str], z: list[str]) -> DataFrame:
    """(by, seen, s...): the sums of a cell up to and including each of its hours. rows: hourly and regular by ``by``."""
    w = Window.partitionBy(*by, "hour", "day").orderBy("ds").rowsBetween(Window.unboundedPreceding, 0)
    own = rows.withColumns({"hour": F.hour("ds"), "day": F.weekday("ds"), "_ok": ~F.greatest(*[F.col(c).isNull() for c in z])})
    sums = [F.coalesce(F.sum(F.when(F.col("_ok"), c)).over(w), F.lit(0.0)).alias(n) for n, c in cell_sums(z).items()]
    return own.select(*by, F.col("ds").alias("seen"), *sums)


def filled(table: DataFrame, keep: list[str], x: str, known: str, missing: str, z: list[str]) -> DataFrame:
    """Cells of z from cells of [missing, known, *z[1:]]: x (= z[0]) is ``known``, and the cell's mean of the value where ``missing`` is 1."""
    m = F.col(f"s_{z[-1]}") / F.col("s")
    rest = [F.col(n) for n in cell_sums(z) if n == "s" or f"_{x}" not in n]
    own = [
        (F.col(f"s_{known}") + m * F.col(f"s_{missing}")).alias(f"s_{x}"),
        (F.col(f"s_{known}_{known}") + m * m * F.col(f"s_{missing}")).alias(f"s_{x}_{x}"),
        *[(F.col(f"s_{known}_{c}") + m * F.col(f"s_{missing}_{c}")).alias(f"s_{x}_{c}") for c in z[1:]],
    ]
    return table.select(*keep, *rest, *own)


def cells_as_of(running: DataFrame, cutoffs: DataFrame, by: list[str], z: list[str], history: int) -> DataFrame:
    """(by, cutoff, hour, day, s...): each cell over the ``history`` hours up to each cutoff; history in whole weeks.

    cutoffs: (id, cutoff). A cell's last hour up to a cutoff, and up to ``history`` before it, are known stamps: two equi joins.
    """
    if history % 168:
        raise ValueError("history must be a whole number of weeks")
    hours = lambda n: F.make_dt_interval(hours=n)
    wanted = cutoffs.select("id", "cutoff", F.explode(F.sequence(F.lit(0), F.lit(167))).alias("back"))
    wanted = wanted.select("id", "cutoff", (F.col("cutoff") - hours(F.col("back"))).alias("seen"))
    names = list(cell_sums(z))
    now = running.join(wanted, ["id", "seen"])
    before = running.select(*by, (F.col("seen") + hours(F.lit(history))).alias("seen"), *[F.col(n).alias(f"o_{n}") for n in names])
    both = now.join(before, [*by, "seen"], "left")
    return both.select(*by, "cutoff", F.hour("seen").alias("hour"), F.weekday("seen").alias("day"), *[(F.col(n) - F.coalesce(f"o_{n}", F.lit(0.0))).alias(n) for n in names])


# --- a label's probability


def logistic(rows: DataFrame, by: list[str], columns: dict[str, Column], label: Column, keep, steps: int = 8, ridge: float = 1e-4) -> DataFrame:
    """(by, coef): logistic regression by Newton steps; a step is one aggregate of the weighted Gram matrix and the gradient.

    label is 0 or 1. keep(df) writes a step's coefficients (a row a series) and reads them back, which cuts the lineage.
    """
    names = [f"_x{i}" for i in range(len(columns))]
    x = rows.select(*by, *[c.cast("double").alias(n) for n, c in zip(names, columns.values(), strict=True)], label.cast("double").alias("_y")).na.drop(subset=[*names, "_y"])
    p = len(names)
    upper = np.triu_indices(p)
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in by)
    coef = keep(x.select(*by).distinct().withColumn("coef", F.array(*[F.lit(0.0)] * p)))

    def step(batches):
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                h = np.zeros((p, p))
                h[upper] = r.h
                h = h + np.triu(h, 1).T
                w = np.asarray(r.coef)
                w = w + np.linalg.solve(h + ridge * np.eye(p), np.asarray(r.g) - ridge * w)
                out.append((*[getattr(r, c) for c in by], w.tolist()))
            yield pd.DataFrame(out, columns=[*by, "coef"])

    for _ in range(steps):
        prob = 1 / (1 + F.exp(-dot("coef", [F.col(c) for c in names])))
        own = x.join(coef, by).withColumn("_p", prob).withColumn("_w", F.col("_p") * (1 - F.col("_p")))
        sums = own.groupBy(*by).agg(
            F.array(*[F.sum(F.col("_w") * F.col(a) * F.col(b)) for i, a in enumerate(names) for b in names[i:]]).alias("h"),
            F.array(*[F.sum((F.col("_y") - F.col("_p")) * F.col(a)) for a in names]).alias("g"), F.first("coef").alias("coef"),
        )
        coef = keep(sums.mapInPandas(step, f"{kinds}, coef array<double>"))
    return coef
