"""N-gram Jaccard join, embedding whitening and importance resampling against brute force and on edge rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from opspulse.llm import importance, jaccard, whitening
from opspulse.llm.common import Scratch

# --- op11


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def all_pairs(rows):
    """doc_id -> (size, least doc_id reachable), by comparing all pairs."""
    sets = {k: shingles(t) for k, t in rows}
    up = {k: k for k in sets}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    ids = [k for k in sets if sets[k]]
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {k: (len(s), root(k)) for k, s in sets.items()}


def joined(spark, rows):
    out = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in out}


def test_jaccard_against_all_pairs(spark):
    """Chains of edits, a star of copies, a passage that is everywhere, short texts, white space and cases."""
    r = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    passage = [r.choice(words) for _ in range(60)]
    some = lambda n: [r.choice(words) for _ in range(n)]
    texts = []
    for n in (8, 40, 90, 200):
        own = some(n)
        for _ in range(12):  # drifts away step by step
            own = [*own]
            own[r.randrange(n)] = "edit"
            texts.append(own)
        star = some(n)
        for _ in range(25):
            texts.append([*star[: (k := r.randrange(n))], f"x{r.random()}", *star[k + r.randrange(3) :]])
    texts += [[*some(40), *passage, *some(r.randrange(30))] for _ in range(40)]
    texts += [["a"], ["A"], ["a", "b"], ["a b"], ["a", "b", "c", "d", "e"], ["A\tb\x0bc\x0cd\ne"], ["é"], ["É"], [], [" x"], ["x"]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(1000, None), (1001, "  \n")]
    assert joined(spark, rows) == all_pairs(rows)


def test_texts_from_a_stock_of_sentences(spark):
    """All shingles are common and no two texts link: pairs are refuted by bitmaps, none becomes a row to intersect."""
    r = random.Random(4)
    stock = [" ".join(f"s{i}w{j}" for j in range(10)) for i in range(40)]
    rows = [(i, " ".join(stock[j] for j in sorted(r.sample(range(40), 20)))) for i in range(300)]
    want = all_pairs(rows)
    assert joined(spark, rows) == want
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scratch = Scratch(spark, "test")
    known = jaccard.signatures(docs, "doc_id", "text", jaccard.heavy_shingles(docs.select("text")))
    nodes = scratch.write(known.select("h", F.col("k").alias("rep"), "n", "bits", "prefix", F.col("k").alias("id")))
    tested = jaccard.links(docs, nodes, "doc_id", "text", scratch).tried.count()
    assert tested <= 3 * len(rows)


def test_tiles_hold_blocks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CROWD", 10**9)  # no leaders: tiles alone
    r = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*base[: (k := r.randrange(60))], f"x{i}", *base[k:]])) for i in range(150)]
    rows += [(500 + i, " ".join(f"{i}v{j}" for j in range(30))) for i in range(50)]
    whole = jaccard.tiles
    seen = []

    def small(df):
        out = whole(df, 16)
        seen.append(out.groupBy("s", "band", "p", "q").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(jaccard, "tiles", small)
    assert joined(spark, rows) == all_pairs(rows)
    assert 2 <= seen[0] <= 64


@pytest.mark.parametrize("n", [1, 2, 9, 63, 64, 65, 500, 3000])
def test_bitmaps_bound_the_intersection(n):
    r = np.random.default_rng(n)
    a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
    b = np.unique(np.concatenate([a[: max(1, len(a) * 9 // 10)], r.integers(0, 1 << 63, n // 10).astype(np.uint64)]))
    flat, at = jaccard.bitmaps(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
    x, y = flat[: at[1]][None], flat[at[1] :][None]
    words = min(x.shape[1], y.shape[1])
    apart = int(np.bitwise_count((jaccard.folded(x, words) ^ jaccard.folded(y, words)).view(np.uint64)).sum())
    assert apart <= len(np.setxor1d(a, b))
    assert apart > 0.3 * len(np.setxor1d(a, b)) - 1 or n > 2000


def test_jaccard_edge_rows(spark, edge_docs):
    out = jaccard.jaccard_components(edge_docs)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    got = sorted(map(tuple, out.collect()), key=str)
    assert len(got) == 8
    by = {r[0]: r for r in got}
    assert by[1][1:] == (0, 1, 0) and by[2][1:] == (0, 2, 0) and by[None][1:] == (3, None, 0) and by[4][1:3] == (3, 4)
    assert jaccard.jaccard_components(edge_docs.limit(0)).count() == 0


def test_jaccard_repeated_keys_with_other_texts(spark):
    one, two = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = [(1, one), (1, two), (2, two + " b50"), (3, one), (3, one)]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(1, 46, 1), (1, 46, 1), (2, 47, 1), (3, 46, 1), (3, 46, 1)]


# --- op12


def test_whitening_against_numpy(spark):
    r = np.random.default_rng(1)
    m = r.normal(size=(400, 12)) @ r.normal(size=(12, 12)) * 0.2 + 3
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(m)]
    odd = [(900, None), (901, [float("nan")] * 12), (902, [None] * 12), (903, [float("inf")] * 12), (904, [1.0] * 5), (905, [1e300] * 12), (906, [])]
    out = whitening.whiten(spark.createDataFrame(rows + odd + [(7, rows[7][1])], "vec_id long, embedding array<double>").repartition(7)).toPandas()
    x = np.floor(1024 * np.vstack([m, m[7:8]])).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    e, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    e, vectors = e[::-1][:8], vectors[:, ::-1][:, :8]
    want = (x - sums / n) @ vectors / np.sqrt(e)
    assert set(out["n"]) == {n} and len(out) == 8 * n and set(out["vec_id"]) == set(range(400))
    got = out[out.vec_id != 7].pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    want = np.delete(want, [7, n - 1], axis=0)
    assert np.abs(got - want * np.sign((got * want).sum(axis=0))).max() < 1e-9
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    assert {(k, d) for k, d in zip(out.vec_id, out.deviation, strict=True)} == {(k, int(deviation[k])) for k in range(400)}
    trace = np.trace(np.cov(x.T, bias=True))
    assert np.allclose(out.groupby("component").explained.first(), e / trace, rtol=1e-9)
    assert out.identity_error.iloc[0] < 1e-9


def test_polarisation_is_exact_for_entries_that_overflow_longs(spark):
    rows = [(i, [2.0**51 * (-1) ** i + i, float(i * i)]) for i in range(6)]
    x = whitening.fit_list(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    n, sums = whitening.column_sums(x)
    own = [[1024 * int(c) + 100_000 for c in v] for _, v in rows]
    assert (n, sums) == (6, [sum(v[i] for v in own) for i in (0, 1)])
    centre = [s // n for s in sums]
    found = whitening.polarised_squares(x, centre)
    y = [[c - m for c, m in zip(v, centre, strict=True)] for v in own]
    assert found == {(0, 0): sum(a * a for a, _ in y), (1, 1): sum(b * b for _, b in y), (0, 1): sum((a + b) ** 2 for a, b in y)}


def test_whitening_without_variance_and_without_rows(spark):
    kind = "vec_id long, embedding array<float>, component string, whitened string"
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], "x", "y"), (None, [1.0, 2.0], "x", "y")], kind)).collect()
    assert sorted((r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one) == [(c, 2, 0, None, 0.0, 0.0) for c in (1, 1, 2, 2)]
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    flat = whitening.whiten(spark.createDataFrame([(i, [float(i), 5.0, 0.5 * i], "", "") for i in range(20)], kind)).collect()
    assert {r.component for r in flat if r.whitened is not None} == {1} and abs(flat[0].identity_error) < 1e-9


# --- op13


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def test_importance_against_brute_force(spark):
    r = random.Random(6)
    words = ["a", "Be", "c9", "ÜBER", "日本", "z" * 70, "q" * 65, "x-y", "_", "don't", *(f"w{i}" for i in range(200))]
    docs = [(i, r.choice([" ", "\n", "  ", "-"]).join(r.choice(words) for _ in range(r.choice([0, 1, 2, 3, 19, 20, 21, 90])))) for i in range(300)]
    docs += [(301, None), (302, ""), (303, "," * 500)]
    goal = [(0, " ".join(words[10:60])), (1, None), (2, "w1 w2 w3 ÜBER 日本")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = {x.doc_id: (x.n_features, x.weight, x.score, x["rank"]) for x in importance.importance_resample(df, spark.createDataFrame(goal, "item_id long, text string")).collect()}
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = (collections.Counter(bucket(f) for _, text in rows for f in features(text)[1]) for rows in (docs, goal))
    big_s, big_t = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t)))
    want, able = {}, []
    for k, text in docs:
        own, found = features(text)
        weight = sum(gain(bucket(f)) for f in found)
        h = int(hashlib.sha256(f"42:{k}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        want[k] = [len(found), weight, score, None]
        if len(own) >= 20:
            able.append((-score, k))
    for i, (_, k) in enumerate(sorted(able)[: 5 * len(able) // 100], 1):
        want[k][3] = i
    assert got == {k: tuple(v) for k, v in want.items()}
    assert sum(v[3] is not None for v in want.values()) >= 5


@pytest.mark.parametrize("segments", [1, 3, 16])
def test_ranks_with_hot_ties(spark, segments):
    """Half of the rows are equal: they are spread over segments, and ranks are 1, 2, 3..."""
    rows = [(r := i % 97 if i % 2 else 5, i % 7 if i % 2 else 0) for i in range(2000)]
    df = spark.createDataFrame(rows, "score long, k long").repartition(5)
    got = importance.exact_ranks(df, [("score", False), "k"], Scratch(spark, "test"), segments).collect()
    assert [(r.score, r.k) for r in sorted(got, key=lambda r: r["rank"])] == sorted(rows, key=lambda r: (-r[0], r[1]))
    assert sorted(r["rank"] for r in got) == list(range(1, 2001)) and r is not None


def test_segments_are_even_with_hot_ties(spark):
    df = spark.range(4000).select(F.lit(1).cast("long").alias("score"), F.lit(2).cast("long").alias("k")).repartition(4)
    out = importance.exact_ranks(df, [("score", False), "k"], Scratch(spark, "test"), 8)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 1000


def test_importance_edge_rows(spark, edge_docs):
    goal = spark.createDataFrame([(1, "another word third")], "item_id long, text string")
    out = {r.doc_id: r for r in importance.importance_resample(edge_docs, goal, percent=100).collect()}
    assert out[1].n_features == 0 and out[1].weight == 0 and out[4]["rank"] == 1 and out[None].score is None and out[3]["rank"] is None
    assert importance.importance_resample(edge_docs, goal).count() == 8
    assert importance.importance_resample(edge_docs.limit(0), goal).count() == 0
    assert importance.importance_resample(edge_docs, goal.limit(0)).count() == 8
