"""Mixing to target weights with soft membership.

A softmax classifier learnt from the labelled table (a bounded sample, see features)
gives each document posteriors p over the domains. Document rates r >= 0 are fitted so
that the expected tokens of each domain, sum of r * tokens * p, meet the target weights:
projected gradient on the squared residuals from rate 1. Each pass over the documents tries a
plain gradient step, which always descends, and steps scaled by the domains' Gram matrix over
the documents whose rate is above 0, which need few passes where memberships overlap.

All documents take part in each step, but a step only returns domains x (domains + 1)
numbers: a document's rate follows from its posteriors and the steps so far, so the driver
keeps steps x domains numbers and no rate is ever stored or shuffled.

Documents whose most likely domain is the first keep a rate of 1 at least, so none of them
is dropped. The column ``residual`` holds the largest miss of a domain as a share of all
target tokens (and a miss is logged), where the bounds or the steps allowed leave one.

Rates become whole copies by floor(rate + u), u uniform from the hash of the key, which
keeps the expected totals.

Defined results: null and empty texts have no tokens and keep the rate that their
posteriors give; repeated rows repeat; domains without mass have residual 0; a single
class of labels is certain for all rows; without labels every document is in the first
domain; an empty table gives an empty result; other columns pass through ``mixed``.
"""

from __future__ import annotations

import logging
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import features as fx
from .common import table, written

_LOG = logging.getLogger(__name__)
DOMAINS = ("clean", "toxic", "junk")
#: Share of the mixed tokens, by default; clean tokens grow by HEADROOM at least, so that clean documents can be kept.
TARGETS = {"clean": 0.975, "toxic": 0.015, "junk": 0.010}
HEADROOM = 1.01
KEEP = 0  # documents most likely of this domain are never dropped
MOST_STEPS, CLOSE, RIDGE, STALLED = 60, 1e-6, 1e-9, 0.9999


def label_domains(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, cls): toxic rows, else junk where quality is 0, else clean; rows without labels are left out."""
    cls = (
        F.when(F.col("toxic") != 0, 1).when(F.col("quality") == 0, 2).when((F.col("quality") != 0) & (F.col("toxic") == 0), 0)
    )
    return labels.select(key, cls.alias("cls")).where("cls is not null")


def posteriors(docs: DataFrame, domain_labels: DataFrame, n_domains: int, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, tokens, p) for each row of docs."""
    sample = written(fx.labelled_sample(domain_labels, key), "mixing-sample")
    n_rows = sample.count()
    texts = docs.select(key, text_col)
    lexicons = fx.learn_lexicon(texts.join(F.broadcast(sample), key), text_col, n_domains, n_rows) if n_rows else []
    lexicon = sorted({f for part in lexicons for f in part})
    found = written(fx.hits(texts, key, text_col, lexicon), "mixing-hits")
    rows = found.join(F.broadcast(sample), key).orderBy(key, "tokens", "idx", "cnt").limit(2 * fx.MOST_ROWS).toPandas()  # the sample
    w = np.zeros((len(lexicon) + 1, n_domains), np.float32)
    w[-1, 0] = 50.0
    if len(rows):
        w = fx.fit_softmax(fx.design(rows["idx"], rows["cnt"], len(lexicon)), np.eye(n_domains, dtype=np.float32)[rows["cls"]], ridge=1e-4)
    w = w.astype(float)

    @F.pandas_udf("array<double>")
    def posterior(idx: pd.Series, cnt: pd.Series) -> pd.Series:
        z = [np.log1p(n) @ w[i] + w[-1] if len(i) else w[-1] for i, n in zip(idx, cnt, strict=True)]
        return pd.Series(list(fx.softmax(np.array(z).reshape(-1, n_domains))))

    return found.select(key, "tokens", posterior("idx", "cnt").alias("p"))


def rates(p: np.ndarray, steps: list[np.ndarray], keep: int | None = None) -> np.ndarray:
    """Each document's rate after the steps taken so far: project after every one.

    Documents whose most likely domain is ``keep`` stay at 1 at least.
    """
    r = np.ones(len(p))
    least = np.zeros(len(p)) if keep is None else (p.argmax(axis=1) == keep).astype(float)
    for s in steps:
        np.maximum(least, r - p @ s, out=r)
    return r


class Fit(NamedTuple):
    steps: list[np.ndarray]
    totals: np.ndarray  # expected tokens of each domain at the fitted rates
    targets: np.ndarray

    @property
    def residual(self) -> float:
        """The largest miss of a domain, as a share of all target tokens."""
        return float(np.abs(self.totals - self.targets).max() / max(1.0, self.targets.sum()))


def fit_rates(members: DataFrame, targets: np.ndarray, tokens: str = "tokens", p: str = "p", keep: int | None = None) -> Fit:
    """Steps whose rates bring the domains' expected tokens to the targets, or as near as the bounds allow.

    Reads members once a step: the pass returns totals and Gram matrix for every length tried, and
    the one with the least squared residual is taken. A gradient step of length 1 / (largest
    eigenvalue) is always among them and never raises the residual, so the fit descends. It ends when
    targets are met, or when no length lowers the residual any more.
    """
    n = len(targets)
    names = [f"m{i}" for i in range(1 + n + n * n)]

    def sums(steps: list[np.ndarray], tried: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each next step tried: expected tokens by domain, and the Gram matrix of the documents that can still move."""

        def work(batches):
            import pyarrow as pa

            total = np.zeros((len(tried), n + n * n))
            for b in batches:
                t = b.column(0).to_numpy(zero_copy_only=False).astype(float)
                q = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
                for i, s in enumerate(tried):
                    r = rates(q, [*steps, s], keep)
                    total[i, :n] += (t * r) @ q
                    total[i, n:] += ((q * (t * (r > 0))[:, None]).T @ q).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(tried), dtype=float)), *(pa.array(c) for c in total.T)], names)

        out = members.select(tokens, p).mapInArrow(work, ", ".join(f"{c} double" for c in names))
        found = np.zeros((len(tried), n + n * n))
        for row in out.groupBy("m0").agg(*[F.sum(c).alias(c) for c in names[1:]]).collect():  # a row for each length tried
            found[int(row["m0"])] = row[1:]
        return [(f[:n], f[n:].reshape(n, n)) for f in found]

    [(now, gram)] = sums([], [np.zeros(n)])
    mass = max(1.0, targets.sum())
    miss = lambda x: float(np.abs(x - targets).max()) / mass
    steps: list[np.ndarray] = []
    while len(steps) < MOST_STEPS and miss(now) > CLOSE:
        left = now - targets
        scaled = np.linalg.solve(gram + RIDGE * mass * np.eye(n), left)
        tried = [left / max(RIDGE * mass, float(np.linalg.eigvalsh(gram)[-1])), *(scaled * 4.0**-i for i in range(4))]
        found = sums(steps, tried)
        best = min(range(len(tried)), key=lambda i: ((found[i][0] - targets) ** 2).sum())
        if ((found[best][0] - targets) ** 2).sum() >= STALLED * (left**2).sum():
            break
        steps.append(tried[best])
        now, gram = found[best]
    if miss(now) > CLOSE:
        _LOG.warning("targets missed after %d steps, by shares of the target tokens: %s", len(steps), ((now - targets) / mass).tolist())
    return Fit(steps, now, targets)


def target_totals(members: DataFrame, weights: list[float]) -> np.ndarray:
    """Tokens of each domain in a mix of these weights.

    The mix has as many tokens as members, or, where the first domain's share would then need less
    than HEADROOM times the tokens it has, so many that it needs no less. Domains without tokens get none.
    """
    found = members.agg(*[F.sum(F.col("tokens") * F.col("p")[i]) for i in range(len(weights))]).first()
    mass = np.array([x or 0.0 for x in found])
    share = np.array(weights) * (mass > 0)
    share /= max(1e-12, share.sum())
    total = max(mass.sum(), HEADROOM * mass[0] / share[0] if share[0] else 0.0)
    return total * share


def with_rates(members: DataFrame, fit: Fit, keep: int | None = None) -> DataFrame:
    steps = fit.steps

    @F.pandas_udf("double")
    def rate(p: pd.Series) -> pd.Series:
        return pd.Series(rates(np.stack(p.to_list()) if len(p) else np.zeros((0, 1)), steps, keep))

    return members.withColumn("rate", rate("p")).withColumn("residual", F.lit(fit.residual))


def copies(key: str, seed: int = 11) -> Column:
    u = F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(seed)), 11) / float(1 << 53)
    return F.floor(F.col("rate") + u).cast("int")


def mixture(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text_col: str = "text", targets: dict[str, float] | None = None
) -> DataFrame:
    """(key, tokens, p, rate, residual, copies) for each row of docs; targets: weight of each of DOMAINS."""
    weights = [(targets or TARGETS)[d] for d in DOMAINS]
    members = written(posteriors(docs, label_domains(labels, key), len(DOMAINS), key, text_col), "mixing-members")
    fit = fit_rates(members, target_totals(members, weights), keep=KEEP)
    return with_rates(members, fit, KEEP).withColumn("copies", copies(key))


def mixed(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text_col: str = "text", targets: dict[str, float] | None = None) -> DataFrame:
    """docs, each row as often as its whole copies; rows with a null key stay once."""
    of_key = mixture(docs, labels, key, text_col, targets).where(F.col(key).isNotNull())
    of_key = written(of_key.groupBy(F.col(key).alias("k")).agg(F.max("copies").alias("n")), "mixing-copies")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"), F.col(f"`{key}`").alias("k"))
    often = whole.join(of_key, "k", "left").select("r", F.explode(F.array_repeat(F.lit(1), F.coalesce("n", F.lit(1)))))
    return often.select("r.*")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return mixed.select("doc_id", "tokens", *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(DOMAINS)], "rate", "copies", "residual")
