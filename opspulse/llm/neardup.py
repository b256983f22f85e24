"""Near-duplicate classes by Order MinHash and banded alignment.

A text is its sequence of five-word shingles (all its words, if fewer), each labelled
with its occurrence number so that repeats stay apart. Each of ``PERMUTATIONS`` hashes
orders the labelled shingles and deals them to ``GROUPS`` groups; a band is the ``PICK``
least of a group, kept in text order. Texts that share long stretches in the same order
meet in a band's bucket. Exact copies are one node from the start, found by digest.

Links are verified on whole texts: the chain of equal labelled shingles within the band
that the threshold leaves open is the alignment; similarity is its length over the
shingles of both texts counted once. Matches of 0.8 or more are links, classes are the
connected components of links.

Candidates in a bucket are never all pairs. They are settled in this order:

1. Two leaders of each bucket, least by hash, are compared with its members, then a hub
   (the member with the most links, as the original of many copies has) and one more
   leader. Members already in one class are not compared again, and a bucket of one class is done.
2. Texts of buckets that still have several classes are *open*. Two texts at 0.8 share a
   shingle among the rarest fifth of the longer one, and the rarest ninth of the shorter, in
   any common order of shingles (prefix filter), and the places of the first shared one
   bound what they can share in all. So the open texts' shingles are counted, each text
   keeps its rarest ones, and pairs of different classes that share one, and whose places
   allow 0.8, are compared. Nothing is lost here: the filter only drops pairs that cannot
   match. A passage that is everywhere is common, hence late in the order, and brings no pairs where texts
   have rarer shingles; texts made wholly from one stock of sentences still meet in many pairs.

So every pair at 0.8 that shares a band is in one class at the end; a pair at exactly 0.8
shares none of the 24 bands with a probability of about 7 x 10^-5.

Defined results: null texts count as empty, and all empty texts are copies of each other;
rows with a null key get a null class and are never dropped; repeated rows share a class,
and one of them stays; of a key with unlike texts each class keeps a row of its own; an empty table gives an empty result; only key and text are read.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, table
from .components import components

WORDS, LEAST = 5, 0.8
PERMUTATIONS, GROUPS, PICK = 3, 8, 5
TURNS = ((2, 0), (1, 1))  # leaders by hash, hubs by links
MOST_CACHED = 400_000
_MIX = np.random.default_rng(20240501).integers(1, 1 << 63, (2, PERMUTATIONS), dtype=np.uint64) | np.uint64(1)
_EDGES = np.arange(1, GROUPS, dtype=np.uint64) << np.uint64(61)  # GROUPS is 8: the top three bits name the group


class Shingler:
    """Text -> 64-bit hashes of its labelled shingles, in text order."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        import xxhash

        words = (text or "").split()
        known = self.known
        if len(known) > MOST_CACHED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if not len(h):
            return h
        size = min(WORDS, len(h))
        out = np.zeros(len(h) - size + 1, np.uint64)
        for i in range(size):
            out = (out ^ h[i : i + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        order = np.argsort(out, kind="stable")
        s = out[order]
        same = s[1:] == s[:-1]
        if same.any():
            start = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(len(s)), 0))
            label = np.empty(len(s), np.uint64)
            label[order] = np.arange(len(s)) - start
            out = out + label * np.uint64(0xC2B2AE3D27D4EB4F)
        return out


def bands(shingles: np.ndarray) -> np.ndarray:
    """A key for each group of each permutation that has shingles: its PICK least, in text order."""
    n = len(shingles)
    last = np.append(shingles, np.uint64(0))
    found = []
    for p in range(PERMUTATIONS):
        mixed = (shingles ^ _MIX[0, p]) * _MIX[1, p]
        mixed ^= mixed >> np.uint64(32)
        few = 4 * PICK * GROUPS
        at = None
        if n > 2 * few:  # the least of each group are among its low values, but for rare cases
            at = np.flatnonzero((mixed << np.uint64(3)) < np.uint64(int(few / n * 2.0**64)))
            if np.bincount(mixed[at] >> np.uint64(61), minlength=GROUPS).min() < PICK:
                at = None
        if at is None:
            at = np.arange(n)
        own = mixed[at]
        order = np.argsort(own)
        start = np.concatenate([[0], np.searchsorted(own[order], _EDGES), [len(own)]])
        take = start[:-1, None] + np.arange(PICK)
        real = take < start[1:, None]
        place = np.where(real, at[order[np.minimum(take, len(own) - 1)]], n)
        place.sort(axis=1)
        size = real.sum(axis=1)
        key = np.arange(p * GROUPS, (p + 1) * GROUPS, dtype=np.uint64) * np.uint64(PICK + 1) + size.astype(np.uint64)
        for i in range(PICK):
            key = (key ^ last[place[:, i]]) * np.uint64(0xD6E8FEB86659FD93)
            key ^= key >> np.uint64(31)
        found.append(key[size > 0])
    return np.concatenate(found).view(np.int64)


def aligned_similarity(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> float:
    """Shingles on the best in-order chain within the band, over all shingles of both.

    Below ``least`` the value is an upper bound, which is all that the verdict needs.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    total = len(a) + len(b)
    bound = len(ia) / (total - len(ia))
    if bound < least:
        return bound
    free = total - 2 * int(np.ceil(least / (1 + least) * total))  # shingles that may stay unaligned
    order = np.argsort(ia)
    ia, ib = ia[order], ib[order]
    ib = ib[np.abs(ib - ia) <= max(0, free)]
    if (np.diff(ib) < 0).any():
        tails: list[int] = []
        for x in ib.tolist():
            i = bisect_left(tails, x)
            tails[i : i + 1] = [x]
        m = len(tails)
    else:
        m = len(ib)
    return m / (total - m)


def _digest(text_col: str) -> tuple[Column, Column]:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return F.unhex(F.md5(text)), text


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64)))


def sketches(docs: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, h, n, bands): digest of the text, number of shingles and band keys. One pass, no shuffle."""
    kind = docs.schema[key].dataType.simpleString()

    def work(batches):
        shingle = Shingler()
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                n, keys = [], []
                for text in part.column(2):
                    s = shingle(text.as_py())
                    n.append(len(s))
                    keys.append(bands(s) if len(s) else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n, pa.int64()), _lists(keys)], [key, "h", "n", "bands"])

    h, text = _digest(text_col)
    picked = docs.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`"), h.alias("h"), text.alias("t"))
    return picked.mapInArrow(work, f"`{key}` {kind}, h binary, n bigint, bands array<bigint>")


def _shingle_rows(texts: DataFrame) -> DataFrame:
    """(h, s): the labelled shingles of each text, as one array."""

    def work(batches):
        shingle = Shingler()
        for batch in batches:
            for i in range(0, batch.num_rows, 128):
                part = batch.slice(i, 128)
                own = [shingle(t.as_py()).view(np.int64) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(own)], ["h", "s"])

    return texts.select("h", "text").mapInArrow(work, "h binary, s array<bigint>")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(x, y, link): whether the two texts align. Joins that carry texts or all bands are merge joins at every size."""
    one = texts.select(F.col("h").alias("x"), F.col("text").alias("tx"))
    two = texts.select(F.col("h").alias("y"), F.col("text").alias("ty"))

    def work(batches):
        shingle, last, own = Shingler(), None, None
        for batch in batches:
            ty = batch.column(3)
            out = []
            for i, x in enumerate(batch.column(0).to_pylist()):
                if x != last:
                    last, own = x, shingle(batch.column(2)[i].as_py())
                out.append(aligned_similarity(own, shingle(ty[i].as_py())) >= LEAST)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.bool_())], ["x", "y", "link"])

    both = pairs.join(two.hint("merge"), "y").join(one.hint("merge"), "x").select("x", "y", "tx", "ty")
    return both.mapInArrow(work, "x binary, y binary, link boolean")


def _fits(a: Column, b: Column) -> Column:
    return F.least(a, b) >= LEAST * F.greatest(a, b)


class _Links:
    """The verified links found so far, with the classes and degrees that they make."""

    def __init__(self, texts: DataFrame, scratch: Scratch):
        self.texts, self.scratch, self.tried, self.known = texts, scratch, None, None

    def test(self, pairs: DataFrame) -> None:
        """pairs: (a, b) digests, in any order, repeated or tested before."""
        own = pairs.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct()
        if self.tried is not None:
            own = own.join(self.tried.select("x", "y"), ["x", "y"], "left_anti")
        done = self.scratch.write(_verified(self.scratch.write(own), self.texts))
        self.tried = done if self.tried is None else self.tried.union(done)
        edges = self.found()
        self.known = self.scratch.write(components(edges, "x", "y", self.scratch).withColumnRenamed("node", "h").join(degrees(edges), "h"))

    def found(self) -> DataFrame:
        return self.tried.where("link").select("x", "y")

    def classed(self, members: DataFrame) -> DataFrame:
        """members with the root of their class and their number of links so far."""
        own = members.drop("root", "deg").join(self.known, "h", "left")
        return own.withColumns({"root": F.coalesce("root", "h"), "deg": F.coalesce("deg", F.lit(0))})


def degrees(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("x").alias("h")).union(edges.select(F.col("y").alias("h")))
    return both.groupBy("h").agg(F.count("*").alias("deg"))


def links(docs: DataFrame, nodes: DataFrame, key: str, text_col: str, scratch: Scratch) -> _Links:
    """The links between distinct texts, and their classes. nodes: written (h, rep, n, bands)."""
    placed = nodes.where("n > 0").select("h", "n", F.explode("bands").alias("g"))
    shared = placed.groupBy("g").agg(F.count("*").alias("c")).where("c > 1").select("g")
    members = scratch.write(placed.join(scratch.write(shared).hint("merge"), "g"))
    links = _Links(_texts_of(docs, members.select("h").distinct(), nodes, key, text_col, scratch), scratch)
    members = members.withColumns({"root": F.col("h"), "deg": F.lit(0).cast("bigint")})
    for turn, (leaders, hubs) in enumerate(TURNS):
        one = F.struct("h", "n", "root")
        picks = [F.min_by(one, F.xxhash64("h", F.lit(10 * turn + i))) for i in range(leaders)]
        picks += [F.max_by(one, F.struct("deg", F.xxhash64("h", F.lit(-1 - i)))) for i in range(hubs)]
        heads = members.groupBy("g").agg(F.array_distinct(F.array(*picks)).alias("heads"), (F.min("root") != F.max("root")).alias("several"))
        led = members.join(scratch.write(heads.where("several").drop("several")), "g")
        tests = led.select("h", "n", "root", F.explode("heads").alias("l"))
        links.test(tests.where((F.col("l.root") != F.col("root")) & _fits(F.col("l.n"), F.col("n"))).select(F.col("l.h").alias("a"), F.col("h").alias("b")))
        # a leader has been compared with all of its bucket; the others stay while classes are apart
        led = led.where(~F.exists("heads", lambda x: x["h"] == F.col("h"))).select("g", "h", "n")
        members = scratch.write(links.classed(led))
    apart = members.groupBy("g").agg((F.min("root") != F.max("root")).alias("several")).where("several").select("g")
    open_texts = scratch.write(members.join(apart, "g", "left_semi").select("h", "n").distinct())
    if not open_texts.isEmpty():
        links.test(_rare_pairs(links.classed(_rarest(links.texts, open_texts, scratch)), scratch))
    return links


def _rarest(texts: DataFrame, own: DataFrame, scratch: Scratch) -> DataFrame:
    """(s, h, n, i): for each text in own, its shingles in order of rarity up to the prefix that LEAST asks for.

    i counts from 1, shingles that no other text in own has (never listed) included.
    """
    sets = scratch.write(_shingle_rows(texts.join(own.select("h"), "h", "left_semi")))
    rows = sets.select("h", F.explode("s").alias("s"))
    common = rows.groupBy("s").agg(F.count("*").alias("df")).where("df > 1")
    known = rows.join(scratch.write(common), "s").join(own, "h")
    text = Window.partitionBy("h")
    at = F.col("n") - F.count("*").over(text) + F.row_number().over(text.orderBy("df", "s"))
    placed = known.withColumn("i", at.cast("bigint")).select("s", "h", "n", "i")
    return scratch.write(placed.where(F.col("i") <= F.col("n") - F.ceil(LEAST * F.col("n") - 1e-9) + 1))


def _rare_pairs(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b) of different classes that share a rare shingle and, by its places, may reach LEAST."""
    apart = rows.groupBy("s").agg((F.min("root") != F.max("root")).alias("several")).where("several").select("s")
    rows = scratch.write(rows.join(apart, "s").select("s", "h", "n", "i", "root"))
    share = LEAST / (1 + LEAST)
    short = rows.where(F.col("i") <= F.col("n") - F.ceil(2 * share * F.col("n") - 1e-9) + 1)
    short = short.select("s", *[F.col(c).alias(f"{c}2") for c in ("h", "n", "i", "root")])
    most = 1 + F.least(F.col("n") - F.col("i"), F.col("n2") - F.col("i2"))
    order = (F.col("n") > F.col("n2")) | ((F.col("n") == F.col("n2")) & (F.col("h") > F.col("h2")))
    fits = order & _fits(F.col("n"), F.col("n2")) & (most >= share * (F.col("n") + F.col("n2")) - 1e-9)
    both = rows.join(short, (rows["s"] == short["s"]) & (rows["root"] != short["root2"]) & fits)
    return both.select(F.col("h").alias("a"), F.col("h2").alias("b"))


def _texts_of(docs: DataFrame, tests: DataFrame, nodes: DataFrame, key: str, text_col: str, scratch: Scratch) -> DataFrame:
    """Written (h, text), once for each text in tests: that of the row whose key is the text's least."""
    ids = tests.join(nodes.select("h", F.col("rep").alias("k")), "h")
    h, text = _digest(text_col)
    own = docs.select(F.col(f"`{key}`").alias("k"), h.alias("h"), text.alias("text")).join(scratch.write(ids).hint("merge"), ["h", "k"], "left_semi")
    return scratch.write(own.groupBy("h").agg(F.first("text").alias("text")))


def _classed(docs: DataFrame, key: str, text_col: str, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Written tables: (key, h, ...) of each row, and (h, rep, root, n_links) of each text; rep is the text's least key."""
    known = scratch.write(sketches(docs, key, text_col))
    nodes = known.groupBy("h").agg(F.min(key).alias("rep"), F.max("n").alias("n"), F.first("bands").alias("bands"))
    nodes = scratch.write(nodes)
    classed = links(docs, nodes, key, text_col, scratch).classed(nodes.select("h", "rep"))
    return known, scratch.write(classed.select("h", "rep", "root", F.col("deg").alias("n_links")))


def near_duplicate_classes(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, class_id, n_links) for each row of docs; class_id is the least key of the class.

    n_links counts the verified links that made the class, not all similar texts.
    """
    scratch = Scratch(docs.sparkSession, "near")
    known, classed = _classed(docs, key, text_col, scratch)
    least = scratch.write(classed.groupBy("root").agg(F.min("rep").alias("class_id")))
    of_text = scratch.write(classed.join(least, "root").select("h", "class_id", "n_links"))
    out = known.select(key, "h").join(of_text, "h").select(key, "class_id", F.col("n_links").cast("bigint"))
    kind = docs.schema[key].dataType.simpleString()
    lost = docs.where(F.col(key).isNull()).select(key, F.lit(None).cast(kind).alias("class_id"), F.lit(0).cast("bigint").alias("n_links"))
    return scratch.result(out.unionAll(lost))


def deduplicated(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each class: that of its least key, and of its least digest where this key has several texts.

    A row is known by its key and its text's digest, so a key that is repeated with unlike texts keeps one row
    for each class it is the least of. Of rows equal in both, that of the least hash of all columns stays.
    """
    scratch = Scratch(docs.sparkSession, "near")
    known, classed = _classed(docs, key, text_col, scratch)
    first = classed.groupBy("root").agg(F.min(F.struct(F.col("rep").alias("k"), "h")).alias("m")).select("m.k", "m.h")
    rows = known.groupBy(F.col(f"`{key}`").alias("k"), "h").agg(F.count("*").alias("c"))
    stay = scratch.result(rows.join(first, ["k", "h"]))
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r")
    whole = docs.select(own, F.col(f"`{key}`").alias("k"), _digest(text_col)[0].alias("h"))
    kept = whole.join(stay.hint("merge"), ["k", "h"])
    again = kept.where("c > 1").groupBy("k", "h").agg(F.min_by("r", F.xxhash64(F.to_json("r"))).alias("r")).select("r")
    return kept.where("c = 1").select("r").union(again).union(whole.where("k is null").select("r")).select("r.*")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_duplicate_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return classes.withColumn("is_representative", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))
