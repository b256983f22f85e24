"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

1. Lexicons of telling words and prefixes are learnt from labelled training rows.
2. One pass over all documents finds the lexicon's hits; voters are lexicon tiers,
   a fixed list, counts, density and patterns. Each votes or stays silent.
3. The label model sees how often each pattern of votes occurs over all documents
   (at most 2^voters rows). EM estimates the class share, each voter's rates in both
   classes and the voters' correlations within a class; a voter's evidence is divided
   by its total correlation with the others. A training label is one more, reliable, vote.
4. A softmax classifier learns the posteriors of a bounded sample, half of rows without a
   training label, and scores every document. ``posterior`` is what the voters alone say.

Labels come only from rows with crc32(key as text) mod 4 <> 2 and, of those, from at
most features.MOST_ROWS rows. Language, source and key are never inputs.

Defined results: null and empty texts are scored like a text without hits; repeated rows
repeat; without usable labels of both classes every score is 0; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import features as fx
from .common import table, written

THRESHOLD = 0.3
NEVER = -50.0  # log-odds where nothing is known: a score of 0
# Common English insults, a voter of its own.
INSULTS = (
    "idiot moron scum loser clown trash pathetic worthless disgusting stupid garbage vermin imbecile filth "
    "dumb retard bastard jerk fool coward"
).split()
VOTERS = ("insult", "word_top", "word_rest", "prefix4", "prefix5", "prefix6", "two", "four", "dense", "shout")


def held_out(key: str) -> F.Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2


def vote_masks(lexicon: list[str]) -> dict[str, frozenset]:
    """Voter -> positions in the lexicon that make it vote."""
    words = [i for i, f in enumerate(lexicon) if f[:2] == "w:"]
    masks = {"word_top": words[:30], "word_rest": words[30:]}
    masks |= {f"prefix{n}": [i for i, f in enumerate(lexicon) if f[:2] == f"{n}:"][:60] for n in (4, 5, 6)}
    masks["insult"] = [i for i, f in enumerate(lexicon) if f[:2] == "w:" and f[2:] in INSULTS]
    masks["shout"] = [i for i, f in enumerate(lexicon) if f == "caps" or f[:3] in ("p:!", "p:*")]
    return {k: frozenset(v) for k, v in masks.items()}


def votes(found: DataFrame, lexicon: list[str]) -> DataFrame:
    """found + pattern: bit v is set if voter v votes."""
    masks = vote_masks(lexicon)
    lists = lambda v: F.array(*map(F.lit, sorted(masks[v]))).cast("array<int>")
    n = F.aggregate("cnt", F.lit(0), lambda a, x: a + x)
    fired = {v: F.arrays_overlap("idx", lists(v)) for v in masks}
    fired |= {"two": n >= 2, "four": n >= 4, "dense": n >= F.greatest(F.lit(1.0), F.col("tokens") * 0.01)}
    bits = sum(F.when(F.coalesce(fired[v], F.lit(False)), 1 << i).otherwise(0) for i, v in enumerate(VOTERS))
    return found.withColumn("pattern", bits.cast("int"))


def voted_sample(marked: DataFrame, key: str):
    """(idx, cnt, pattern, cls) of rows to learn posteriors from, as pandas: at most MOST_ROWS, by the hash of the key.

    Half are rows without a training label, whose posteriors are the voters' alone; half are labelled.
    """
    u = F.shiftrightunsigned(F.xxhash64(key), 11) / float(1 << 53)
    half = fx.MOST_ROWS // 2
    parts = []
    for own in (F.col("cls") < 0, F.col("cls") >= 0):
        rows = marked.where(own & F.col(key).isNotNull())
        share = 1.5 * half / max(1, rows.count())
        parts.append(rows.where(u < share).orderBy(u, key, "pattern", "idx", "cnt").limit(half))
    return parts[0].union(parts[1]).select("idx", "cnt", "pattern", "cls").toPandas()


class LabelModel:
    """Two classes; rates[y, v] = P(voter v votes | y), with evidence shared by correlated voters."""

    def __init__(self, n_voters: int, label_rate: float = 0.99):
        self.n, self.label_rate = n_voters, label_rate
        self.share, self.rates, self.weight = 0.1, None, np.ones(n_voters)

    def bits(self, patterns: np.ndarray) -> np.ndarray:
        return (np.asarray(patterns)[:, None] >> np.arange(self.n) & 1).astype(float)

    def posterior(self, patterns, labels) -> np.ndarray:
        """P(toxic | votes, label); labels: 1, 0, or -1 for none."""
        b, labels = self.bits(patterns), np.asarray(labels)
        odds = np.log(self.rates[1] / self.rates[0]) * b + np.log((1 - self.rates[1]) / (1 - self.rates[0])) * (1 - b)
        sure = np.log(self.label_rate / (1 - self.label_rate))
        z = np.log(self.share / (1 - self.share)) + odds @ self.weight + np.where(labels < 0, 0, np.where(labels == 1, sure, -sure))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))

    def fit(self, patterns, labels, counts, steps: int = 30) -> "LabelModel":
        b, n, labels = self.bits(patterns), np.asarray(counts, float), np.asarray(labels)
        p = np.where(labels == 1, 0.99, np.where(labels == 0, 0.01, 0.1))
        known = labels >= 0
        for step in range(steps):
            use = n * known if step == 0 else n  # starts from the labelled rows
            rates = []
            for q in (1 - p, p):
                w = use * q
                rates.append((w @ b + 0.5) / (w.sum() + 1))
            self.rates = np.clip(np.array(rates), 1e-4, 1 - 1e-4)
            self.share = float(np.clip((use @ p + 0.5) / (use.sum() + 1), 1e-4, 0.5))
            shared = np.zeros((self.n, self.n))
            for y, q in enumerate((1 - p, p)):
                d = (b - self.rates[y]) / np.sqrt(self.rates[y] * (1 - self.rates[y]))
                w = use * q
                shared += (self.share if y else 1 - self.share) * np.abs((d * w[:, None]).T @ d / max(1e-9, w.sum()))
            np.fill_diagonal(shared, 0)
            self.correlations = np.clip(shared, 0, 1)
            self.weight = 1 / (1 + self.correlations.sum(axis=1))
            p = self.posterior(patterns, labels)
        return self


def toxicity_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(key, held_out, score, posterior, n_hits, votes) for every row of docs."""
    train = labels.where(~held_out(key)).select(key, (F.col(label_col) != 0).cast("int").alias("cls"))
    sample = written(fx.labelled_sample(train, key), "toxic-sample")
    n_rows = sample.count()
    texts = docs.select(key, text_col)
    lexicon = fx.learn_lexicon(texts.join(F.broadcast(sample), key), text_col, 2, n_rows)[1] if n_rows else []
    lexicon += [f for f in (f"w:{w}" for w in INSULTS) if f not in lexicon]
    found = written(votes(fx.hits(texts, key, text_col, lexicon), lexicon), "toxic-hits")
    marked = found.join(F.broadcast(sample), key, "left").withColumn("cls", F.coalesce("cls", F.lit(-1)))
    seen = [(r["pattern"], r["cls"], r["count"]) for r in marked.groupBy("pattern", "cls").count().collect()]  # at most 3 * 2^voters rows
    w = np.zeros(len(lexicon) + 1)
    w[-1] = NEVER
    posterior = dict.fromkeys({p for p, _, _ in seen}, 0.0)
    if {c for _, c, _ in seen} >= {0, 1}:
        model = LabelModel(len(VOTERS)).fit(*zip(*seen, strict=True))
        posterior = dict(zip(posterior, model.posterior(list(posterior), [-1] * len(posterior)).tolist(), strict=True))
        rows = voted_sample(marked, key)
        p = model.posterior(rows["pattern"], rows["cls"]).astype(np.float32)
        fitted = fx.fit_softmax(fx.design(rows["idx"], rows["cnt"], len(lexicon)), np.stack([1 - p, p], 1), ridge=1e-4)
        w = (fitted[:, 1] - fitted[:, 0]).astype(float)

    @F.pandas_udf("double")
    def score(idx, cnt):
        import pandas as pd

        z = [w[i] @ np.log1p(n) + w[-1] if len(i) else w[-1] for i, n in zip(idx, cnt, strict=True)]
        return pd.Series(np.where(np.array(z) <= NEVER, 0.0, 1 / (1 + np.exp(-np.clip(np.array(z, float), -500, 500)))))

    known = F.create_map(*[F.lit(x) for item in posterior.items() for x in item]) if posterior else F.create_map().cast("map<int,double>")
    return found.select(
        key, held_out(key).alias("held_out"), score("idx", "cnt").alias("score"), known[F.col("pattern")].alias("posterior"),
        F.aggregate("cnt", F.lit(0), lambda a, x: a + x).cast("bigint").alias("n_hits"),
        F.bit_count("pattern").alias("votes"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_hits",
    )
