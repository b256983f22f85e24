"""Quality classifier by importance resampling with hashed n-gram models.

Word unigrams and bigrams are hashed to ``BUCKETS`` counts. The target model counts the
rows labelled good (at most features.MOST_ROWS rows, by the hash of the key); the raw
model counts every document. A document's log weight is the sum over its n-grams of
log p_target - log p_raw, plus a correction for the bias of logs of small counts.

Documents are then drawn without replacement in proportion to their weights: Gumbel noise
from the hash of the key is added to the log weight and the k highest keys stay. A caller may
give k; as a filter, k is the number of documents whose log weight reaches ``MARGIN``, so the
size of the sample follows the corpus. Weights of whole texts spread over hundreds, so there
the noise decides among documents near the margin only. The k-th key is found by counting
in narrowing bins, never by sorting all rows in one place.

Defined results: null and empty texts have log weight 0; repeated rows share their fate
(ties with the k-th key all stay); without good labels every weight is 0 and all rows stay;
an empty table gives an empty result; other columns pass through untouched. Where docs has
columns called log_weight or sample_key, they stay and the new ones get a leading underscore.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import features as fx
from .common import free_name, table, written

BUCKETS = 1 << 15
SMOOTHING = 1.0
MARGIN = -3.0
BINS = 4096
_TOKEN = re.compile(r"\w+|[^\w\s]+")


class Hasher:
    """Text -> bucket numbers of its unigrams and bigrams."""

    def __init__(self):
        self.known: dict[str, bytes] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        chunks = (text or "").split()
        known = self.known
        if len(known) > fx.MOST_CACHED:
            known.clear()
        for c in set(chunks).difference(known):
            known[c] = np.array([zlib.crc32(t.encode()) for t in _TOKEN.findall(c)], "<u4").tobytes()
        one = np.frombuffer(b"".join([known[c] for c in chunks]), "<u4")
        two = one[:-1] * np.uint32(0x9E3779B1) ^ one[1:]
        two = (two ^ two >> np.uint32(15)) * np.uint32(0x85EBCA6B)
        return np.concatenate([one % BUCKETS, (two >> np.uint32(8)) % BUCKETS]).astype(np.int64)


def ngram_counts(docs: DataFrame, text_col: str, flag: Column) -> DataFrame:
    """(bucket, raw, target): counts over all rows, and over those with the flag."""

    def work(batches):
        grams, raw, target = Hasher(), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text, good in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                n = np.bincount(grams(text.as_py()), minlength=BUCKETS)
                raw += n
                if good:
                    target += n
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"])

    counts = docs.select(F.col(text_col).cast("string").alias("_t"), flag.alias("_g")).mapInArrow(
        work, "bucket bigint, raw bigint, target bigint"
    )
    return counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """log p_target - log p_raw for each bucket (at most BUCKETS rows come to the driver)."""
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts.collect():
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    p = lambda n: np.log((n + SMOOTHING) / (n.sum() + SMOOTHING * BUCKETS))
    # a log of estimated shares is low by about (buckets in use) / 2N on average; the target's counts are the scarce ones
    bias = np.count_nonzero(target) / target.sum()
    return p(target) - p(raw) + bias


def gumbel(key: str, seed: int) -> Column:
    """Standard Gumbel noise, a function of the key and the seed alone."""
    bits = F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(seed)), 11).cast("double")
    return -F.log(-F.log((bits + 0.5) / float(1 << 53)))


def weight_names(docs: DataFrame) -> tuple[str, str]:
    """The names of the two weights beside docs' own columns."""
    return free_name("log_weight", docs.columns), free_name("sample_key", docs.columns)


def weighted(docs: DataFrame, good: DataFrame, key: str = "doc_id", text_col: str = "text", seed: int = 7) -> DataFrame:
    """docs + log_weight, sample_key. good: (key, cls) rows of the bounded sample; cls 1 is the target."""
    weight, drawn = weight_names(docs)
    flagged = docs.select(key, text_col).join(F.broadcast(good.where("cls = 1")), key, "left")
    ratios = log_ratios(ngram_counts(flagged, text_col, F.coalesce(F.col("cls") == 1, F.lit(False))))
    shared = docs.sparkSession.sparkContext.broadcast(ratios.astype(np.float64))

    @F.pandas_udf("double")
    def weigh(texts):
        import pandas as pd

        grams, ratio = Hasher(), shared.value
        return pd.Series([float(ratio[grams(t)].sum()) for t in texts], dtype="float64")

    scored = docs.withColumn(weight, weigh(F.col(text_col).cast("string")))
    return scored.withColumn(drawn, F.col(weight) + gumbel(key, seed))


def kth_largest(df: DataFrame, col: str, k: int, most: int = 20_000) -> float | None:
    """The k-th largest value of col, by counts in narrowing bins; None if k is 0."""
    lo, hi, n = df.agg(F.min(col), F.max(col), F.count(col)).first()
    if not n or k <= 0:
        return None
    k = min(k, n)
    above = 0
    inside = df.select(F.col(col).alias("x"))
    while n > most and lo < hi:
        step = (hi - lo) / BINS
        bin_of = F.least(F.floor((F.col("x") - lo) / step), F.lit(BINS - 1))
        rows = inside.where(F.col("x").between(lo, hi)).groupBy(bin_of.alias("b")).agg(F.count("x"), F.min("x"), F.max("x")).collect()
        for _, c, least, largest in sorted(rows, key=lambda r: -r[0]):
            if above + c >= k:
                n, same = c, (least, largest) == (lo, hi)
                lo, hi = least, largest
                break
            above += c
        if same:
            break
    if lo == hi:
        return lo
    # at most ``most`` rows, or rows of values too close to part
    found = inside.where(F.col("x").between(lo, hi)).orderBy(F.col("x").desc()).limit(k - above)
    return found.agg(F.min("x")).first()[0]


def cut(scored: DataFrame, k: int | None = None, margin: float = MARGIN, names: tuple[str, str] = ("log_weight", "sample_key")) -> float | None:
    """The least sample_key of the k drawn; k is by default the number of rows whose log weight reaches the margin."""
    weight, drawn = names
    if k is None:
        k = scored.where(F.col(weight) >= margin).count()
    return kth_largest(scored, drawn, k)


def good_sample(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    good = labels.where("quality is not null").select(key, F.col("quality").cast("int").alias("cls")).where("cls = 1")
    return written(fx.labelled_sample(good, key), "quality-sample")


def resample(
    docs: DataFrame, labels: DataFrame, keep_text: bool, key: str = "doc_id", text_col: str = "text", k: int | None = None
) -> DataFrame:
    """The k drawn rows of docs, with log_weight and sample_key; keep_text=False returns key and weights alone.

    Where k is 0, or no weight reaches the margin, no row is drawn.
    """
    names = weight_names(docs)
    scored = weighted(docs, good_sample(labels, key), key, text_col)
    compact = written(scored if keep_text else scored.select(key, *names), "quality-scores")
    least = cut(compact, k, names=names)
    return compact.where(F.lit(False) if least is None else F.col(names[1]) >= least)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(docs, table(spark, sf_dir, "labels"), keep_text=False)
