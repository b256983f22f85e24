"""Bundles of shingles: near copies meet once, and few pairs become rows."""

import random

from pyspark.sql import functions as F

from opspulse.llm import jaccard
from opspulse.llm.common import Scratch


def test_pairs_of_near_copies_do_not_repeat_for_each_shingle(spark, monkeypatch):
    """A crowd of copies with many edits: most pairs are below 0.8, and all share dozens of shingles."""
    r = random.Random(6)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(240):
        own = [*base]
        for _ in range(r.choice((1, 2, 6, 7, 8))):
            own[r.randrange(150)] = f"x{r.random()}"
        texts.append(own)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scratch = Scratch(spark, "test")
    known = jaccard.signatures(docs, "doc_id", "text", jaccard.heavy_shingles(docs.select("text")))
    nodes = scratch.write(known.select("h", F.col("k").alias("rep"), "n", "bits", "prefix", F.col("k").alias("id")))
    made, whole = [], jaccard.tile_pairs

    def counted(*args):
        out = scratch.write(whole(*args))
        made.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "tile_pairs", counted)
    found = jaccard.links(docs, nodes, "doc_id", "text", scratch)
    assert sum(made) <= 10 * len(rows)
    sets = [{tuple(t[i : i + 5]) for i in range(146)} for t in texts]
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                up[root(i)] = root(j)
    roots = {x.id: x.root for x in found.classed(nodes.select("id")).collect()}
    assert len({(root(k), v) for k, v in roots.items()}) == len(set(roots.values())) == len({root(k) for k in roots})
