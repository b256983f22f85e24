"""Joins of a few rows with a large table move few rows of the large one, and lose none."""

from pyspark.sql import functions as F

from opspulse.llm import common, jaccard
from opspulse.llm.common import Scratch


def test_each_turn_thins_the_others_and_keeps_all_keys(spark):
    rows, keys = spark.range(200_000), spark.range(0, 200_000, 100)
    left = {t: common.maybe_in(rows, F.col("id"), keys, turns=t).agg(F.count("*").alias("n"), F.count_if(F.expr("id % 100 = 0")).alias("own")).first() for t in (1, 2)}
    assert left[1].own == left[2].own == 2000
    assert left[2].n - 2000 < (left[1].n - 2000) / 5


def test_bitmaps_of_the_pairs_nodes_alone_are_moved(spark, monkeypatch):
    scratch, seen, whole = Scratch(spark, "test"), [], common.maybe_in
    texts = [(i, " ".join(f"w{i // 2}-{k}" for k in range(60)) + (" z" if i % 2 else "")) for i in range(3000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    known = jaccard.signatures(docs, "doc_id", "text", jaccard.heavy_shingles(docs.select("text")))
    nodes = scratch.write(known.select("h", F.col("k").alias("rep"), "n", "bits", "prefix", F.col("k").alias("id")))

    def counted(rows, *args, **more):
        out = whole(rows, *args, **more)
        if "bits" in rows.columns:
            seen.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "maybe_in", counted)
    pairs = scratch.write(spark.createDataFrame([(2 * i, 2 * i + 1) for i in range(20)] + [(0, 9)], "x long, y long"))
    assert sorted(map(tuple, jaccard._refuted(pairs, nodes).collect())) == [(2 * i, 2 * i + 1) for i in range(20)]
    assert len(seen) == 2 and max(seen) < 300
    jaccard.links(docs, nodes, "doc_id", "text", scratch)
    assert len(seen) > 2


def test_a_set_is_written_once_for_repeated_keys_and_copies(spark):
    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    docs = spark.createDataFrame([(1, a), (1, a), (1, b), (2, a), (3, None)], "doc_id long, text string")
    scratch = Scratch(spark, "test")
    known = jaccard.signatures(docs, "doc_id", "text", jaccard.heavy_shingles(docs.select("text")))
    own = scratch.write(known.where("n > 0").groupBy("h").agg(F.min("k").alias("k")).withColumn("id", F.monotonically_increasing_id()))
    sets = jaccard._sets_of(docs, own, "doc_id", "text", scratch, "sets")
    assert sorted(len(r.s) for r in sets.collect()) == [26, 26]
    assert {r.id for r in sets.collect()} == {r.id for r in own.collect()}
