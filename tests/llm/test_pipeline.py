"""The pipeline's stages, each against a plain version on its own input."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from opspulse.llm import mixing, neardup, packing, quality, secrets
from opspulse.llm.common import written

KEY = "0123456789abcdef0123456789abcdef"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    r = random.Random(12)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(300)]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    rows, labels = [], []
    for i in range(160):
        kind = "junk" if i % 8 == 0 else "toxic" if i % 8 == 1 else "clean"
        t = say(r.randint(20, 150))
        if kind == "junk":
            t = " ".join(w + r.choice(["***", "$$$"]) for w in t.split())
        if kind == "toxic":
            t += " you idiot, you scum, you moron"
        if i % 20 == 7:
            t += f' token = "{KEY}"'
        rows.append((i, t, "en", "s", len(t)))
        if i < 120:
            labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    rows += [(200 + i, rows[i][1] + (" tail" if i % 2 else ""), "en", "s", 0) for i in range(2, 40, 3)]
    out = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return out


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "MinHash near-dedup", "secret scans", "mixing to target weights", "packing"]
    stage = [f for _, f in corpus_pipeline.STAGES]
    run = lambda k, d: written(stage[k](spark, d, sf_dir), "stage")

    good = run(0, docs)
    assert good.columns == docs.columns
    kept = {x.doc_id for x in good.collect()}
    assert kept == {x.doc_id for x in quality.resample(docs, labels, keep_text=False).collect()}
    assert not any(i % 8 == 0 for i in kept if i < 160) and all(i in kept for i in range(160) if i % 8 > 1)

    one = run(1, good)
    text = {x.doc_id: x.text for x in good.collect()}
    s = neardup.Shingler()
    sh = {i: s(t) for i, t in text.items()}
    like = lambda a, b: neardup.aligned_similarity(sh[a], sh[b]) >= 0.8
    want = {i for i in text if not any(j < i and like(i, j) for j in text)}
    assert {x.doc_id for x in one.collect()} == want and one.columns == docs.columns

    clean = run(2, one)
    got = {x.doc_id: x for x in clean.collect()}
    assert set(got) == want and not any(KEY in x.text for x in got.values())
    assert all(x.n_chars == len(x.text) for x in got.values())
    assert all(got[i].text == text[i] for i in want if KEY not in text[i])
    assert secrets.find_secrets(clean).where("size(base) > 0").count() == 0

    mix = run(3, clean)
    often = {x.doc_id: x["count"] for x in mix.groupBy("doc_id").count().collect()}
    assert often == {x.doc_id: x.copies for x in mixing.mixture(clean, labels).collect() if x.copies}
    assert all(i in often for i in want if i % 8 > 1)
    assert sum(i in often for i in want if i % 8 == 1 and i < 160) < sum(i % 8 == 1 and i < 160 for i in want) / 2

    pieces = run(4, mix).toPandas()
    enc = packing.encoder(packing.default_tokenizer())
    assert set(pieces.doc_id) == set(often)
    for x in pieces.itertuples():
        ids = np.frombuffer(enc.encode([got[x.doc_id].text])[0], "<u4").tolist() + [2]
        own = np.array(ids[x.start : x.start + x.length], "<u4").tobytes()
        assert zlib.crc32(own) == x.ids_crc32 and x.doc_tokens == len(ids)
    assert pieces.groupby("sequence_id").length.sum().max() <= 4096


def test_run_is_the_stages_in_order(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.where(F.col("doc_id").isNotNull()).count() > 0


CLASHING = ["_row", "_key", "_copy", "_copies", "_added", "cls", "class_id", "rate", "spans", "h", "t", "start", "length", "sequence_id"]


def clashing(df):
    """Names that the stages use themselves, as columns of the user."""
    return df.withColumns({c: F.lit("clash") for c in CLASHING if c not in df.columns})


def test_stages_on_edge_rows(spark, sf_dir, edge_docs):
    """Nulls, empty and long texts, repeated rows, ties and clashing names, through every stage."""
    docs = clashing(edge_docs)
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, sf_dir), "edge")
        assert out.columns == docs.columns, name
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        assert all(r[c] == "clash" for r in out.select(*CLASHING).collect() for c in CLASHING), name
        counts.append(out.count())
        given = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
        assert {(r.doc_id, r.text) for r in out.select("doc_id", "text").collect()} <= given, name  # edge_docs have no secrets
    assert counts[0] >= 1 and counts[2] == 8
    near = {r.text for r in corpus_pipeline.STAGES[1][1](spark, docs, sf_dir).select("text").collect()}
    texts = [r.text for r in docs.select("text").collect()]
    assert near >= {t for t in texts if t and t.strip()}  # one document of each group stays
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert pieces.select("doc_id").distinct().count() == 7 and pieces.agg(F.max("length")).first()[0] <= 4096


def test_stages_on_an_empty_table(spark, sf_dir, edge_docs):
    docs = clashing(edge_docs).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() == 0, name
        assert name == "packing" or out.columns == docs.columns, name
