"""Text features shared by the classifiers: discriminative lexicons and a softmax model.

A lexicon is learnt from a bounded sample of labelled rows (at most ``MOST_ROWS``, those
with the lowest hash of the key). Everything after that runs over all rows: one pass looks
the lexicon's features up in each text and gives sparse hits, without a shuffle.

Features of a text: its lower-case words, their prefixes of 4 to 6 letters, runs of
punctuation, words in capitals, and words and lines that repeat (a word that equals the
one before it; a line that the text had already). Words are looked up once for each task.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_ROWS = 20_000  # labelled rows that a classifier learns from
MOST_FEATURES = 200  # for each class
ROWS_A_TASK = 2_500
LEAST_DOCS = 3
LEAST_ODDS = 4.0
MOST_CACHED = 400_000

_WORD = re.compile(r"\w+")
_PUNCT = re.compile(r"[^\w\s]{2,}|\|")


def chunk_features(chunk: str) -> list[str]:
    """Features of one white-space delimited piece of text."""
    out = []
    for w in _WORD.findall(chunk.lower()):
        w = w[:40]
        out.append(f"w:{w}")
        out += [f"{n}:{w[:n]}" for n in (4, 5, 6) if len(w) > n]
    out += [f"p:{p[-4:]}" for p in _PUNCT.findall(chunk)]
    if len(chunk) > 3 and chunk.isupper():
        out.append("caps")
    return out


def repeats(text: str, chunks: list[str]) -> tuple[int, int]:
    """Words that equal the word before them (0 below a fifth of the text), and lines that occurred before."""
    lines = [x for x in text.split("\n") if x]
    same = sum(map(str.__eq__, chunks[1:], chunks))
    return same if 5 * same >= len(chunks) else 0, len(lines) - len(set(lines))


REPEATS = ("rep:word", "rep:line")


def labelled_sample(labels: DataFrame, key: str, most: int = MOST_ROWS) -> DataFrame:
    """At most ``most`` rows of (key, cls), those with the lowest hash: a proven bound for a broadcast.

    The hash is uniform, so a cut a half above the share wanted leaves enough rows, and few for the last sort.
    """
    u = F.shiftrightunsigned(F.xxhash64(key), 11) / float(1 << 53)
    one = (
        labels.where(F.col(key).isNotNull() & F.col("cls").isNotNull())
        .groupBy(key).agg(F.max("cls").cast("int").alias("cls"))
    )
    share = 1.5 * most / max(1, one.count())
    return one.where(u < share).orderBy(u, key).limit(most)


def learn_lexicon(sample_docs: DataFrame, text_col: str, n_classes: int, n_rows: int, most: int = MOST_FEATURES) -> list[list[str]]:
    """For each class, its most telling features by documents x log-odds, from (text, cls) rows of the sample."""
    tasks = max(1, -(-n_rows // ROWS_A_TASK))

    def work(batches):
        counts: dict[str, list[int]] = {}
        known: dict[str, list[str]] = {}
        totals = [0] * n_classes
        for batch in batches:
            for text, cls in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                chunks = (text or "").split()
                seen = {f for f, n in zip(REPEATS, repeats(text or "", chunks), strict=True) if n}
                for c in set(chunks):
                    if c not in known:
                        if len(known) > MOST_CACHED:
                            known.clear()
                        known[c] = chunk_features(c)
                    seen.update(known[c])
                totals[cls] += 1
                for f in seen:
                    counts.setdefault(f, [0] * n_classes)[cls] += 1
        items = [("", totals), *((f, n) for f, n in counts.items() if tasks == 1 or sum(n) > 1)]
        for i in range(0, len(items), 50_000):
            part = items[i : i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f for f, _ in part], pa.string()), *(pa.array([n[c] for _, n in part], pa.int64()) for c in range(n_classes))],
                ["f", *(f"n{c}" for c in range(n_classes))],
            )

    schema = ", ".join(["f string", *(f"n{c} bigint" for c in range(n_classes))])
    counted = (
        sample_docs.select(F.col(text_col).cast("string"), "cls").repartition(tasks).mapInArrow(work, schema)
        .groupBy("f").agg(*[F.sum(f"n{c}").alias(f"n{c}") for c in range(n_classes)])
    )
    all_n = sum(F.col(f"n{c}") for c in range(n_classes))
    counted = counted.where((F.col("f") == "") | (all_n >= LEAST_DOCS)).persist()
    total = counted.where("f = ''").first()
    lexicons = []
    for c in range(n_classes):
        own, rest = total[f"n{c}"] if total else 0, sum(total[f"n{x}"] for x in range(n_classes) if x != c) if total else 0
        n, m = F.col(f"n{c}"), all_n - F.col(f"n{c}")
        odds = ((n + 0.5) / (own + 1.0)) / ((m + 0.5) / (rest + 1.0))
        best = counted.where((F.col("f") != "") & (n >= LEAST_DOCS) & (odds >= LEAST_ODDS))
        best = best.orderBy((n * F.log(odds)).desc(), "f").limit(most).select("f")
        lexicons.append([r["f"] for r in best.collect()])  # at most ``most`` rows
    counted.unpersist()
    return lexicons


ENDS = ".,;:!?"


class Lookup:
    """A chunk -> its features' numbers, as 32-bit bytes. Plain words are looked up without making the names of their features."""

    def __init__(self, features: list[str]):
        self.index = {f: i for i, f in enumerate(features)}
        named = lambda kind: {f[2:]: i for f, i in self.index.items() if f.startswith(f"{kind}:")}
        self.words, self.starts = named("w"), [(n, own) for n in (4, 5, 6) if (own := named(n))]

    def __call__(self, chunk: str) -> bytes:
        low, end = chunk.lower(), -1 if chunk[-1:] in ENDS else None
        if chunk[:end].isalnum() and low[:end].isalnum():  # \w+ matches all of it, and there is no run of punctuation
            w = low[:end][:40]
            found = [self.words[w]] if w in self.words else []
            found += [own[w[:n]] for n, own in self.starts if len(w) > n and w[:n] in own]
            if "caps" in self.index and len(chunk) > 3 and chunk.isupper():
                found.append(self.index["caps"])
        else:
            found = [self.index[f] for f in chunk_features(chunk) if f in self.index]
        return np.array(found, "<i4").tobytes() if found else b""


def hits(docs: DataFrame, key: str, text_col: str, features: list[str]) -> DataFrame:
    """(key, tokens, idx, cnt): number of white-space delimited words, and the lexicon's features with their counts."""
    lookup = Lookup(features)
    index = lookup.index
    kind = docs.schema[key].dataType.simpleString()

    def work(batches):
        known: dict[str, bytes] = {}
        for batch in batches:
            tokens, idx, cnt = [], [], []
            for text in batch.column(1):
                whole = text.as_py() or ""
                chunks = whole.split()
                if len(known) > MOST_CACHED:
                    known.clear()
                for c in set(chunks).difference(known):
                    known[c] = lookup(c)
                found = np.frombuffer(b"".join([known[c] for c in chunks]), "<i4")
                i, n = np.unique(found, return_counts=True)
                for f, times in zip(REPEATS, repeats(whole, chunks), strict=True):
                    if times and f in index:
                        i, n = np.append(i, index[f]), np.append(n, times)
                tokens.append(len(chunks))
                idx.append(i.tolist())
                cnt.append(n.tolist())
            cols = [pa.array(tokens, pa.int64()), pa.array(idx, pa.list_(pa.int32())), pa.array(cnt, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], [key, "tokens", "idx", "cnt"])

    picked = docs.select(F.col(f"`{key}`"), F.col(f"`{text_col}`").cast("string"))
    return picked.mapInArrow(work, f"`{key}` {kind}, tokens bigint, idx array<int>, cnt array<int>")


def design(idx: list, cnt: list, n_features: int) -> np.ndarray:
    """Dense rows log1p(count), and a last column of ones."""
    x = np.zeros((len(idx), n_features + 1), np.float32)
    x[:, -1] = 1
    for r, (i, n) in enumerate(zip(idx, cnt, strict=True)):
        x[r, i] = np.log1p(n)
    return x


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_softmax(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 150) -> np.ndarray:
    """Weights (columns of x by classes) for soft labels y, by accelerated gradient descent with restarts."""
    n = max(1, len(x))
    v = np.ones(x.shape[1], np.float32)
    for _ in range(12):  # the largest eigenvalue of x'x/n
        v = x.T @ (x @ v)
        v /= max(1e-9, float(np.linalg.norm(v)))
    rate = 1 / (0.5 * float(np.linalg.norm(x @ v)) ** 2 / n + ridge)
    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    ahead, t = w, 1.0
    for _ in range(steps):
        g = x.T @ (softmax(x @ ahead) - y) / n + ridge * ahead
        new = ahead - rate * g.astype(np.float32)
        if float((g * (new - w)).sum()) > 0:
            t = 1.0
        s = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead, w, t = new + (t - 1) / s * (new - w), new, s
    return w
