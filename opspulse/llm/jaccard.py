"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersection.

A document's set holds its distinct five-word shingles, as 64-bit hashes. Documents of
equal sets are one node. Two nodes link when 100 * |a & b| >= 80 * |a | b|, in whole numbers.

Which nodes can link at all follows from a common order of shingles (prefix filter): two
linked nodes share a shingle among the first fifth of the larger one and the first ninth of
the smaller one, and its places in both bound what they may share in all. Any fixed order is
right; ours puts the ``HEAVY`` most repeated shingles last, by counts over all documents, so
that passages found everywhere bring few pairs.

1. Shingles found in about the same nodes (equal least and greatest ids of their nodes) make one
   *bundle*, which holds the nodes of all of them, each once: near copies share dozens of
   shingles and would otherwise meet dozens of times. Bundles only decide which nodes meet.
2. Nodes of a large bundle are compared with four leaders by hash first, then with two hubs: nodes that
   link to most leaders. Nodes in one class need no comparison.
3. Bundles whose nodes are still in several classes are cut into *tiles*: nodes of one size
   band, and of the next, in blocks of about ``TILE`` rows each, two blocks a tile. A linked
   pair is never more than one band apart. A tile is one small array job: no pair becomes a row
   before it has passed the classes, sizes and bitmaps. Tiles of a single block come first; then
   more hubs join the classes of different blocks, and only what is still apart meets in tiles of two blocks.
4. Bitmaps: bit k is the parity of the shingles hashed to k, so that two bitmaps differ in at
   most |a - b| + |b - a| bits, which bounds the intersection from above. They have two to four
   bits a shingle (at most ``MOST_BITS``), so that few pairs below 0.8 pass them.
5. What is left is intersected exactly, on sorted arrays of both whole sets.

Every link between nodes of different classes is found; within a class links need not be
(n_links counts those that were verified). A bundle of very many nodes that stay in
different classes costs a quadratic number of bitmap comparisons, spread over tiles.

Defined results: a null text, or one without words, has an empty set, is linked with nothing
and is its own component; fewer than five words are one shingle; rows with a null key get a
null component and link nobody; repeated rows share a component; rows that repeat a key with
other texts are nodes of their own; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, maybe_in, table
from .components import components

WORDS = 5
LEAST, MOST_BITS = 64, 4096
HEAVY = 1 << 17
CROWD = 16  # nodes of a bundle beyond which leaders are tried first
TURNS = ((4, 0), (2, 4))  # leaders by hash, then hubs: how many, and links that count
FAR = (4, 8)  # hubs for classes of different blocks
TILE = 512
PAIRS = 1 << 18  # of small tiles that are compared together
AT_ONCE = 1 << 14  # pairs whose bitmaps are compared together
CHUNK = 512
MOST_CACHED = 400_000


class ShingleSets:
    """A block of texts -> 64-bit hashes of their shingles, as arrays over the whole block."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def raw(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All shingles in text order, and the number of each text's first one (and, last, of all)."""
        import xxhash

        words = [(t or "").encode().lower().split() for t in texts]  # of bytes: A-Z alone, and white space of ASCII alone
        known = self.known
        if len(known) > MOST_CACHED:
            known.clear()
        flat = [w for own in words for w in own]
        for w in set(flat).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, flat), np.uint64, len(flat))
        n = np.fromiter(map(len, words), np.int64, len(words))
        size = np.minimum(n, WORDS)
        first = np.cumsum(n) - n
        count = np.where(n > 0, n - size + 1, 0)
        ends = np.concatenate([[0], np.cumsum(count)])
        at = np.arange(ends[-1]) + np.repeat(first - ends[:-1], count)
        size = np.repeat(size, count)
        out = size.astype(np.uint64)
        for i in range(WORDS):
            more = slice(None) if i == 0 or (size > i).all() else size > i
            mixed = (out[more] ^ h[at[more] + i]) * np.uint64(0x9E3779B97F4A7C15)
            out[more] = mixed ^ (mixed >> np.uint64(29))
        return out, ends

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct shingles of each text, one after the other, and where each text's begin."""
        out, ends = self.raw(texts)
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            out[a:b].sort()
        fresh = np.ones(len(out), bool)
        fresh[1:] = out[1:] != out[:-1]
        fresh[ends[:-1][np.diff(ends) > 0]] = True
        return out[fresh], np.concatenate([[0], np.cumsum(fresh)])[ends]


def bitmaps(s: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parities of each set's hashes in a number of bits that follows its size, as 64-bit words, and where each begins."""
    n = np.diff(ends)
    width = np.where(n > 0, np.clip(1 << np.ceil(np.log2(np.maximum(n, 2) * 2)).astype(np.int64), LEAST, MOST_BITS), 0)
    start = np.concatenate([[0], np.cumsum(width)])
    at = ((s * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)).astype(np.int64) & np.repeat(width - 1, n)
    odd = np.bincount(at + np.repeat(start[:-1], n), minlength=start[-1]) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64), start // 64


def folded(b: np.ndarray, words: int) -> np.ndarray:
    """The bitmaps (rows) in fewer 64-bit words: parities of halves add up."""
    while b.shape[1] > words:
        half = b.shape[1] // 2
        b = b[:, :half] ^ b[:, half:]
    return b


def needed(n, m):
    """The least intersection of a link between sets of n and m shingles."""
    return -(-4 * (n + m) // 9)


def prefix_lengths(n):
    """Shingles of a set of n among which a linked set shares one: any linked set; one that is not smaller."""
    return n - -(-4 * n // 5) + 1, n - -(-8 * n // 9) + 1


def may_link(n1, b1, n2, b2):
    """Bounds by sizes and bitmaps. Arrays, bitmaps in the last axis."""
    apart = np.bitwise_count((b1 ^ b2).view(np.uint64)).sum(axis=-1, dtype=np.int64)  # of a signed number it would count the absolute value's bits
    return ((n1 + n2 - apart) // 2 >= needed(n1, n2)) & (5 * np.minimum(n1, n2) >= 4 * np.maximum(n1, n2))


def _pieces(batches, rows: int):
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def _list_column(flat: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat.view(np.int64)))


def _digests(s: np.ndarray, ends: np.ndarray) -> list[bytes]:
    whole, at = s.tobytes(), (8 * ends).tolist()
    return [hashlib.blake2b(whole[a:b], digest_size=16).digest() for a, b in zip(at[:-1], at[1:], strict=True)]


def heavy_shingles(texts: DataFrame, most: int = HEAVY) -> np.ndarray:
    """The most repeated shingles, the most repeated last. Counts are of those that repeat within a block of different texts."""

    def work(batches):
        sets = ShingleSets()
        for part in _pieces(batches, CHUNK):
            s, n = np.unique(sets.raw(list(dict.fromkeys(part.column(0).to_pylist())))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(s[n > 1].view(np.int64)), pa.array(n[n > 1])], ["s", "n"])

    counted = texts.mapInArrow(work, "s bigint, n bigint").groupBy("s").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "s").limit(most).collect()  # at most ``most`` rows
    return np.array([r["s"] for r in reversed(top)], np.int64).view(np.uint64)


def prefixes(s: np.ndarray, ends: np.ndarray, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of each set in the common order: light ones by hash, then heavy ones as in ``heavy``."""
    n = np.diff(ends)
    count = np.where(n > 0, prefix_lengths(n)[0], 0)
    start = np.concatenate([[0], np.cumsum(count)])
    rank = np.zeros(len(s), np.int64)
    if len(heavy):
        places = np.argsort(heavy)
        by = heavy[places]
        at = np.minimum(np.searchsorted(by, s), len(by) - 1)
        rank = np.where(by[at] == s, places[at] + 1, 0)
    own = np.repeat(np.arange(len(n)), n)
    order = np.arange(len(s))
    for d in np.unique(own[rank > 0]).tolist():
        a, b = ends[d], ends[d + 1]
        order[a:b] = a + np.argsort(rank[a:b], kind="stable")
    at = np.arange(start[-1]) + np.repeat(ends[:-1] - start[:-1], count)
    return s[order[at]], start


def signatures(docs: DataFrame, key: str, text_col: str, heavy: np.ndarray) -> DataFrame:
    """(k, h, n, bits, prefix) of each row with a key: digest, size, bitmap and first shingles of its set."""
    kind = docs.schema[key].dataType.simpleString()

    def work(batches):
        sets = ShingleSets()
        for part in _pieces(batches, CHUNK):
            s, ends = sets(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(_digests(s, ends), pa.binary()), pa.array(np.diff(ends)), _list_column(*bitmaps(s, ends)), _list_column(*prefixes(s, ends, heavy))],
                ["k", "h", "n", "bits", "prefix"],
            )

    picked = docs.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("k"), F.col(f"`{text_col}`").cast("string").alias("t"))
    return picked.mapInArrow(work, f"k {kind}, h binary, n bigint, bits array<bigint>, prefix array<bigint>")


def _sets_of(docs: DataFrame, own: DataFrame, key: str, text_col: str, scratch: Scratch, name: str) -> DataFrame:
    """Written (id, s): whole sorted sets. own: (id, k, h), k the key of a row that has the set."""

    def work(batches):
        sets = ShingleSets()
        for part in _pieces(batches, CHUNK):
            s, ends = sets(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_digests(s, ends), pa.binary()), _list_column(s, ends)], ["k", "h", "s"])

    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text_col}`").cast("string").alias("t"))
    rows = maybe_in(texts, F.col("k"), own.select("k"), turns=2).mapInArrow(work, f"k {kind}, h binary, s array<bigint>")
    # a key may have other texts, and copies; grouped as they were joined, sets are dealt once
    return scratch.write(rows.join(own, ["k", "h"]).groupBy("k", "h").agg(F.first("id").alias("id"), F.first("s").alias("s")).select("id", "s"), name)


class Links:
    """The verified links found so far, and the classes and numbers of links that they make."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, key: str, text_col: str, scratch: Scratch):
        self.docs, self.nodes, self.key, self.text_col, self.scratch = docs, nodes, key, text_col, scratch
        self.turn, self.tried = 0, None
        self.known = None

    def test(self, pairs: DataFrame, bits: bool = True) -> None:
        """pairs: (a, b) node ids, in any order; bits: whether the bitmaps are still to be compared."""
        own = pairs.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct()
        if self.tried is not None:
            own = own.join(self.tried.select("x", "y"), ["x", "y"], "left_anti")
        own = self.scratch.write(own)
        if bits:
            own = self.scratch.write(_refuted(own, self.nodes))
        if self.tried is not None and own.isEmpty():
            return
        ids = own.select(F.col("x").alias("id")).union(own.select(F.col("y").alias("id"))).distinct()
        sets = _sets_of(self.docs, self.scratch.write(self.nodes.select("id", F.col("rep").alias("k"), "h").join(ids, "id")), self.key, self.text_col, self.scratch, f"sets-{self.turn}")
        done = self.scratch.write(intersected(own, sets))
        self.scratch.drop(f"sets-{self.turn}")
        self.turn += 1
        self.tried = done if self.tried is None else self.tried.union(done)
        edges = self.tried.where("link").select("x", "y")
        both = edges.select(F.col("x").alias("id")).union(edges.select(F.col("y").alias("id")))
        degrees = both.groupBy("id").agg(F.count("*").alias("deg"))
        self.known = self.scratch.write(components(edges, "x", "y", self.scratch).withColumnRenamed("node", "id").join(degrees, "id"))

    def classed(self, rows: DataFrame) -> DataFrame:
        """rows with the root of their class and their number of verified links."""
        own = rows.drop("root", "deg")
        if self.known is None:
            return own.withColumns({"root": F.col("id"), "deg": F.lit(0).cast("bigint")})
        return own.join(self.known, "id", "left").withColumns({"root": F.coalesce("root", "id"), "deg": F.coalesce("deg", F.lit(0))})


def _refuted(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (x, y) that the bitmaps leave open."""

    def work(batches):
        for part in _pieces(batches, CHUNK):
            n = [part.column(c).to_numpy() for c in ("n1", "n2")]
            keep = np.zeros(part.num_rows, bool)
            b1, b2 = (np.asarray(part.column(c).flatten()) for c in ("b1", "b2"))
            w1, w2 = (np.asarray(part.column(c).value_lengths()) for c in ("b1", "b2"))
            e1, e2 = np.cumsum(w1), np.cumsum(w2)
            for u, v in set(zip(w1.tolist(), w2.tolist(), strict=True)):
                at = np.flatnonzero((w1 == u) & (w2 == v))
                one, two = b1[(e1[at] - u)[:, None] + np.arange(u)], b2[(e2[at] - v)[:, None] + np.arange(v)]
                keep[at] = may_link(n[0][at], folded(one, min(u, v)), n[1][at], folded(two, min(u, v)))
            yield part.filter(pa.array(keep)).select(["x", "y"])

    one = maybe_in(nodes, F.col("id"), pairs.select("x").distinct()).select(F.col("id").alias("x"), F.col("n").alias("n1"), F.col("bits").alias("b1"))
    two = maybe_in(nodes, F.col("id"), pairs.select("y").distinct()).select(F.col("id").alias("y"), F.col("n").alias("n2"), F.col("bits").alias("b2"))
    both = pairs.join(two, "y").join(one, "x").select("x", "y", "n1", "n2", "b1", "b2")
    return both.mapInArrow(work, "x bigint, y bigint")


def intersected(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(x, y, link): exact intersections of sorted arrays."""

    def work(batches):
        for part in _pieces(batches, CHUNK):
            s1, s2 = part.column("s1"), part.column("s2")
            link = []
            for i in range(part.num_rows):
                a, b = np.asarray(s1[i].values), np.asarray(s2[i].values)
                both = np.sort(np.concatenate([a, b]), kind="stable")  # merges two runs
                link.append(int((both[1:] == both[:-1]).sum()) >= needed(len(a), len(b)))
            yield pa.RecordBatch.from_arrays([part.column("x"), part.column("y"), pa.array(link, pa.bool_())], ["x", "y", "link"])

    one = sets.select(F.col("id").alias("x"), F.col("s").alias("s1"))
    two = sets.select(F.col("id").alias("y"), F.col("s").alias("s2"))
    both = pairs.join(two.hint("merge"), "y").join(one.hint("merge"), "x").select("x", "y", "s1", "s2")
    return both.mapInArrow(work, "x bigint, y bigint, link boolean")


def size_band(n: Column) -> Column:
    """Bands whose sizes grow by 5/4: sets that link are in one band or in neighbours."""
    return F.floor(F.log(n.cast("double")) / float(np.log(1.25)) - 1e-9).cast("int")


def tiles(rows: DataFrame, tile: int = TILE) -> DataFrame:
    """rows (s, id, n, i, root), s a bundle -> the rows of each tile (s, band, p, q), with upper (of the next band) and block.

    A row is in tiles of its own band and of the band below; blocks are dealt by hash and have about ``tile`` rows.
    """
    band = size_band(F.col("n"))
    both = F.explode(F.array(F.struct(band.alias("band"), F.lit(False).alias("upper")), F.struct((band - 1).alias("band"), F.lit(True).alias("upper")))).alias("e")
    spread = rows.select("*", both).select("s", "id", "n", "i", "root", "e.band", "e.upper")
    sizes = spread.groupBy("s", "band").agg(F.count("*").alias("c"), F.count_if(~F.col("upper")).alias("own"), F.min("root").alias("a"), F.max("root").alias("z"))
    sizes = sizes.where("c > 1 and own > 0 and a <> z").select("s", "band", F.ceil(F.col("c") / tile).cast("int").alias("blocks"))
    placed = spread.join(sizes, ["s", "band"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    placed = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    return placed.select("s", "band", F.least("block", "o").alias("p"), F.greatest("block", "o").alias("q"), "block", "upper", "id", "n", "i", "root")


def _open_pairs(t: pa.RecordBatch, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pairs that may link, of all tiles of t at once; a tile is the rows from one of ``starts`` to the next."""
    col = lambda c: t.column(c).to_numpy(zero_copy_only=False)
    ids, n, i, root, upper, block = (col(c) for c in ("id", "n", "i", "root", "upper", "block"))
    same = col("p") == col("q")
    short = prefix_lengths(n)[1]
    width = np.asarray(t.column("bits").value_lengths())
    flat = np.asarray(t.column("bits").flatten())
    first = np.cumsum(width) - width
    size = np.diff(starts)
    base, each = np.repeat(starts[:-1], size), np.repeat(size, size)
    each = np.where(upper, 0, each)  # rows of the own band are compared with all of the tile
    u = np.repeat(np.arange(len(ids)), each)
    v = np.arange(len(u)) + np.repeat(base - (np.cumsum(each) - each), each)
    ok = (root[u] != root[v]) & (upper[v] | (ids[v] < ids[u])) & (same[u] | (block[u] != block[v]))
    u, v = u[ok], v[ok]
    ok = ((n[u] > n[v]) | (i[u] < short[u]) | (n[u] == n[v])) & ((n[v] > n[u]) | (i[v] < short[v]) | (n[u] == n[v]))
    u, v = u[ok], v[ok]
    ok = 5 * np.minimum(n[u], n[v]) >= 4 * np.maximum(n[u], n[v])
    u, v = u[ok], v[ok]
    keep = np.zeros(len(u), bool)
    widths = np.unique(width).tolist()
    for a in widths:
        for b in widths:
            at = np.flatnonzero((width[u] == a) & (width[v] == b))
            for k in range(0, len(at), AT_ONCE):
                x, y = u[at[k : k + AT_ONCE]], v[at[k : k + AT_ONCE]]
                one, two = (folded(flat[first[z][:, None] + np.arange(w)], min(a, b)) for z, w in ((x, a), (y, b)))
                keep[at[k : k + AT_ONCE]] = may_link(n[x], one, n[y], two)
    return ids[u[keep]], ids[v[keep]]


def tile_pairs(placed: DataFrame, parts: int) -> DataFrame:
    """(a, b) of different classes that may link. placed: rows of tiles with bits. A tile is whole in a task, and small ones are done together."""
    names = ["s", "band", "p", "q"]

    def done(rows: pa.RecordBatch):
        """Tiles in groups of at most about PAIRS pairs."""
        keys = np.stack([rows.column(c).to_numpy() for c in names], axis=1)
        starts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])
        group = np.cumsum(np.diff(starts) ** 2) // PAIRS
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            own = starts[lo : hi + 1]
            a, b = _open_pairs(rows.slice(own[0], own[-1] - own[0]), own - own[0])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def work(batches):
        held: pa.RecordBatch | None = None
        for batch in batches:
            if held is not None:
                batch = pa.concat_batches([held, batch])
            keys = np.stack([batch.column(c).to_numpy() for c in names], axis=1)
            last = int(np.flatnonzero((keys == keys[-1]).all(axis=1))[0]) if len(keys) else 0
            held = batch.slice(last)
            if last:
                yield from done(batch.slice(0, last))
        if held is not None and held.num_rows:
            yield from done(held)

    dealt = placed.repartition(parts, *names).sortWithinPartitions(*names)
    return dealt.mapInArrow(work, "a bigint, b bigint")


def bundles(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Written (s, id, n, i): the nodes of each bundle s of shared shingles, i the first place of one of these in the node's prefix."""
    rows = nodes.select("id", "n", F.posexplode("prefix").alias("i", "s")).select("s", "id", "n", F.col("i").cast("bigint").alias("i"))
    shared = rows.groupBy("s").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a <> z")  # most are in one node: short rows
    shared = scratch.write(shared.select("s", F.xxhash64("a", "z").alias("b")))
    rows = maybe_in(rows, F.col("s"), shared.select("s"), turns=2).join(shared.hint("merge"), "s")
    return scratch.write(rows.groupBy(F.col("b").alias("s"), "id").agg(F.first("n").alias("n"), F.min("i").alias("i")))


def _led(rows: DataFrame, picks: int, most: int, scratch: Scratch) -> DataFrame:
    """(a, b): the nodes of each bundle with a few of them, where they may link by size.

    Picked are nodes with ``most`` links or more (all have 0), by hash: who was compared with all has more, but few were.
    """
    one = F.struct("id", "n", "root")
    picks = [F.max_by(one, F.struct(F.least("deg", F.lit(most)), F.xxhash64("id", F.lit(f"{most} {j}")))) for j in range(picks)]
    heads = rows.groupBy("s").agg(F.array_distinct(F.array(*picks)).alias("heads"))
    led = rows.join(scratch.write(heads), "s").select("id", "n", "root", F.explode("heads").alias("l"))
    n, m = F.col("n"), F.col("l.n")
    fits = (F.col("l.root") != F.col("root")) & (5 * F.least(n, m) >= 4 * F.greatest(n, m))
    return led.where(fits).select(F.col("l.id").alias("a"), F.col("id").alias("b"))


def _apart(rows: DataFrame, scratch: Scratch, least: int = 2) -> DataFrame:
    """Written: the rows of bundles of ``least`` nodes or more that are in several classes, whole bundles."""
    own = rows.groupBy("s").agg(F.count("*").alias("c"), (F.min("root") != F.max("root")).alias("several"))
    own = scratch.write(own.where(F.col("several") & (F.col("c") >= least)).select("s"))
    return scratch.write(rows.join(own.hint("merge"), "s"))


def _with_bits(placed: DataFrame, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """placed with bitmaps; rows: written, with the ids of all that was placed."""
    bits = maybe_in(nodes.select("id", "bits"), F.col("id"), rows.select("id").distinct())
    return placed.join(bits.hint("merge"), "id")


def links(docs: DataFrame, nodes: DataFrame, key: str, text_col: str, scratch: Scratch) -> Links:
    """All links that join different classes. nodes: written (id, rep, h, n, bits, prefix), without empty sets."""
    found = Links(docs, nodes, key, text_col, scratch)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = bundles(nodes, scratch)
    crowd = _apart(found.classed(rows), scratch, CROWD + 1)
    for picks, most in TURNS:
        found.test(_led(crowd, picks, most, scratch))
        crowd = _apart(found.classed(crowd), scratch)
    rows = _apart(found.classed(rows), scratch)
    found.test(tile_pairs(_with_bits(tiles(rows).where("p = q"), rows, nodes), parts), bits=False)
    large = scratch.write(tiles(rows).where("p <> q").select("s").distinct())
    if large.isEmpty():
        return found
    rows = _apart(found.classed(rows.join(large, "s", "left_semi")), scratch)
    found.test(_led(rows, *FAR, scratch))
    rows = _apart(found.classed(rows), scratch)
    found.test(tile_pairs(_with_bits(tiles(rows).where("p <> q"), rows, nodes), parts), bits=False)
    return found


def jaccard_components(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, n_links) of each row of docs; component_id is the least key that links reach."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    heavy = heavy_shingles(docs.select(F.col(f"`{text_col}`").cast("string")))
    whole = scratch.write(signatures(docs, key, text_col, heavy), "signatures")
    nodes = whole.where("n > 0").groupBy("h").agg(F.min("k").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("prefix").alias("prefix"))
    nodes = scratch.write(nodes.withColumn("id", F.monotonically_increasing_id()))
    known = scratch.write(whole.select("k", "h", "n"))
    scratch.drop("signatures")
    classed = scratch.write(links(docs, nodes, key, text_col, scratch).classed(nodes.select("id", "h", "rep")))
    least = classed.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_set = scratch.write(classed.join(scratch.write(least), "root").select("h", "component_id", F.col("deg").alias("n_links")))
    kind = docs.schema[key].dataType.simpleString()
    none = F.lit(0).cast("bigint").alias("n_links")
    out = known.where("n > 0").join(of_set, "h").select(F.col("k").alias(key), F.col("n").alias("n_shingles"), "component_id", "n_links")
    empty = known.where("n = 0").select(F.col("k").alias(key), F.col("n").alias("n_shingles"), F.col("k").alias("component_id"), none)
    keyless = docs.where(F.col(f"`{key}`").isNull()).select(F.lit(None).cast(kind).alias("k"), F.col(f"`{text_col}`").cast("string").alias("t"))
    size = keyless.mapInArrow(_sizes, "n_shingles bigint")
    lost = size.select(F.lit(None).cast(kind).alias(key), "n_shingles", F.lit(None).cast(kind).alias("component_id"), none)
    return scratch.result(out.unionAll(empty).unionAll(lost))


def _sizes(batches):
    sets = ShingleSets()
    for part in _pieces(batches, CHUNK):
        yield pa.RecordBatch.from_arrays([pa.array(np.diff(sets(part.column(1).to_pylist())[1]))], ["n_shingles"])


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


#: The words of a text and its distinct shingles, one a row; pairs meet by a shared shingle and are counted.
OP11_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s FROM words
), nodes AS (
  SELECT min(doc_id) AS id, s, CAST(len(s) AS BIGINT) AS n FROM sets WHERE len(s) > 0 GROUP BY s
), shingles AS (
  SELECT id, n, unnest(s) AS s FROM nodes
), pairs AS (
  SELECT a.id AS x, b.id AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.id < b.id AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), edges AS (
  SELECT x AS a, y AS b FROM pairs UNION ALL SELECT y, x FROM pairs
), walk(id, other) AS (
  SELECT id, id FROM nodes
  UNION SELECT walk.id, edges.b FROM walk JOIN edges ON walk.other = edges.a
), roots AS (
  SELECT id, min(other) AS component_id FROM walk GROUP BY id
)
SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM sets LEFT JOIN nodes ON nodes.s = sets.s LEFT JOIN roots USING (id)
"""
