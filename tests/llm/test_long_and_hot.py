"""Long runs, many secrets, hot lengths and extreme components."""

import time

import numpy as np
import pytest

from opspulse.llm import packing, secrets, topk


def test_a_run_of_a_million_characters(spark):
    keys = "aB3dE6gH9jK2mN5pQ8sT1vW4yZ7" * 40_000
    path = "ab/12/" * 100_000
    docs = spark.createDataFrame([(1, f"x {keys} y"), (2, path), (3, "0123456789abcdef" * 50_000)], "doc_id long, text string")
    start = time.time()
    got = {r.doc_id: r.spans for r in secrets.find_secrets(docs).collect()}
    assert time.time() - start < 60
    assert [(s.kind, s.start, s.end) for s in got[1]] == [("entropy", 2, 2 + len(keys))]
    assert got[2] == [] and [(s.kind, s.start, s.end) for s in got[3]] == [("hex", 0, 800_000)]


def test_redaction_equals_plain_replacement(spark):
    secret = lambda i: f"token={i:06d}Qw{i * 7919 % 999983:06d}"
    long = " é日 ".join(secret(i) for i in range(3000)) + " tail " + "é" * 9000 + secret(1) + secret(2)
    rows = [(1, long), (2, None), (3, ""), (4, "nothing"), (5, secret(9)), (6, "a" * 4096 + " " + secret(3)), (7, "b" * 4090 + " " + secret(3) + "\n" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in secrets.find_secrets(docs).collect()}
    got = {r.doc_id: r.text for r in secrets.redact_secrets(docs).collect()}
    for i, t in rows:
        if t is None:
            assert got[i] is None
            continue
        out, at = [], 0
        for s in spans[i]:
            if s.start >= at:
                out += [t[at : s.start], "[SECRET]"]
            at = max(at, s.end)
        assert got[i] == "".join([*out, t[at:]]), i


@pytest.mark.parametrize("length", [3000, 2049, 2700, 3414, 1366, 820, 4095])
def test_hot_lengths_are_cut_until_they_fit(length):
    counts = {length: 100_000}
    plain = packing.wasted(counts)
    cut = {}
    ends = packing.cuts(length, 4096, packing.LEAST_CUT)
    for a, b in zip([0, *ends], ends, strict=False):
        cut[b - a] = cut.get(b - a, 0) + 100_000
    assert sum(n * k for n, k in cut.items()) == 100_000 * length
    assert min(plain, packing.wasted(cut)) < 0.05


def test_hot_lengths_in_documents(spark):
    docs = spark.createDataFrame([(i, "word " * 2999) for i in range(40)], "doc_id long, text string")
    got = packing.packed_documents(docs, keep_ids=True).toPandas()
    assert got.sequence_id.nunique() <= 31  # 30 hold all ids
    for _, own in got.groupby("doc_id"):
        own = own.sort_values("start")
        assert list(own.start) == [0, *np.cumsum(own.length)[:-1]] and own.length.sum() == 3000
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert list(s.offset) == [0, *np.cumsum(s.length)[:-1]] and s.length.sum() <= 4096


def test_components_near_the_limit_of_a_double():
    q = topk._floored(np.array([[1.7e308, -1.0, 0.0005], [-1e-320, 3.3, 2.0**53]]))
    c = topk._floored(np.array([[-1.7e308, 2.5, 7.0], [0.3, 0.2, -0.1]]))
    whole = lambda v: [[int(x * 1024) if abs(x) < 2**53 else int(x) * 1024 for x in r] for r in v.tolist()]
    want = [[max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(x, y, strict=True)))) for y in whole(c)] for x in whole(q)]
    assert topk._products(q, c).tolist() == want
    assert whole(q)[1] == [-1, 3379, 2**63]
