"""Removal of repeated 200-byte strings: difference-cover samples, then one bucket at a time.

Only equality of 200-byte prefixes of suffixes matters here, so a suffix's rank is the
class of its prefix, and sorting is by prefix hash.

1. Distinct texts are packed by digest into *groups* of a few MB, in a bucketed table that is
   dropped at the end; exact copies are one text with a count. Matches never cross documents.
2. Cover sample: positions whose residue mod 133 lies in a perfect difference set of 12
   residues. For any two positions some shift below 133 moves both onto the sample, so a
   repeated 200-byte string contains a 68-byte string that starts at a sample position in
   both places. The samples' 68-byte strings are dealt to buckets; each bucket is sorted
   by itself and answers which of them repeat (these are the cover's ranks: same or not).
3. Only suffixes within 132 bytes before a repeated sample can start a repeated string.
   Their 200-byte prefixes are dealt to buckets again, sorted bucket by bucket, and the
   repeated ones come back as bits, in the order in which they were sent.
4. Each group marks the bytes that repeated strings cover.

A group sends each key once with a bit for more than one place, so a passage that is
everywhere costs a bucket one key for each group. The number of buckets grows with the
bytes, so a bucket's size does not. Keys of the second deal are 64 bits of one hash within a
bucket that an independent hash chooses: with 4 million keys a bucket, about 4 x 10^-7 pairs a
bucket meet by chance. The first deal's 32-bit keys are only a filter.

Defined results: null texts count as empty; texts under 200 bytes lose nothing; repeated
rows are copies and lose everything from 200 bytes on; an empty table gives an empty
result; only the text is read. The input should be a table or a written result, since
it is read three times.
"""

from __future__ import annotations

import functools
import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

LENGTH = 200
# A perfect difference set; every difference mod 133 occurs exactly once.
MODULUS = 133
COVER = (0, 1, 8, 21, 39, 43, 48, 54, 73, 105, 117, 131)
PREFIX = LENGTH - MODULUS + 1
GROUP_BYTES = 2_000_000
SEGMENT = 1 << 20
BUCKET_KEYS = 4_000_000
MOST_SEEN = 200_000  # digests of texts with copies that a task remembers
BUCKET_BYTES = 64_000_000  # of texts, in one bucket of the group table
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # of two independent string hashes


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


@functools.cache
def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    n = SEGMENT + LENGTH
    return tuple(np.cumprod(np.full(n, b, np.uint64)) for b in (base, pow(base, -1, 1 << 64)))


def string_hashes(data: np.ndarray, at: np.ndarray, length: int, base: int = _BASES[0]) -> np.ndarray:
    """64-bit hashes of data[i:i+length] for the sorted positions i, by prefix sums over segments."""
    out = np.empty(len(at), np.uint64)
    n = SEGMENT + length
    power, inverse = _powers(base)
    for start in range(0, len(data), SEGMENT):
        lo, hi = np.searchsorted(at, (start, start + SEGMENT))
        if lo == hi:
            continue
        part = data[start : start + n].astype(np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((part + np.uint64(11)) * power[: len(part)])])
        i = at[lo:hi] - start
        out[lo:hi] = (sums[i + length] - sums[i]) * inverse[i]
    return _mix(out)


def runs(marked: np.ndarray) -> np.ndarray:
    """(start, end) rows of the runs of true."""
    edge = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1)


class Group:
    """Texts one after the other, with what may start where."""

    def __init__(self, row: dict, buckets: int, window_buckets: int):
        self.data = np.frombuffer(row["bytes"], np.uint8)
        self.ends = np.cumsum(np.array(row["lens"], np.int64))
        self.copied = np.array(row["copied"], bool)
        self.buckets, self.window_buckets = buckets, window_buckets
        self.left = np.repeat(self.ends, row["lens"]) - np.arange(len(self.data))  # bytes to the text's end

    def sample(self) -> tuple[np.ndarray, ...]:
        at = (np.arange(0, len(self.data), MODULUS)[:, None] + np.array(COVER)).ravel()
        at = at[at < len(self.data)]
        at = at[self.left[at] >= PREFIX]
        h = string_hashes(self.data, at, PREFIX)
        return at, (h >> np.uint64(32)).astype(np.uint32), (h & np.uint64(0xFFFFFFFF)).astype(np.int64) % self.buckets

    def candidates(self, repeated_samples: np.ndarray) -> np.ndarray:
        change = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(change, np.maximum(0, repeated_samples - (MODULUS - 1)), 1)
        np.add.at(change, repeated_samples + 1, -1)
        return np.flatnonzero((np.cumsum(change[:-1]) > 0) & (self.left >= LENGTH))

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys, buckets, and whether the window's text has copies."""
        keys = string_hashes(self.data, at, LENGTH, _BASES[1])
        deal = string_hashes(self.data, at, LENGTH, _BASES[0])
        copied = self.copied[np.searchsorted(self.ends, at, side="right")]
        return keys, (deal >> np.uint64(20)).astype(np.int64) % self.window_buckets, copied


def send(keys: np.ndarray, buckets: np.ndarray, known: np.ndarray | None = None):
    """(bucket, sorted distinct keys, more: seen twice here or known to repeat), bucket by bucket."""
    if not len(keys):
        return
    order = np.lexsort((keys, buckets))
    k, b = keys[order], buckets[order]
    first = np.ones(len(k), bool)
    first[1:] = (k[1:] != k[:-1]) | (b[1:] != b[:-1])
    index = np.flatnonzero(first)
    more = np.diff(np.append(index, len(k))) > 1
    if known is not None:
        more |= np.maximum.reduceat(known[order].astype(np.int8), index) > 0
    cuts = np.flatnonzero(np.diff(b[index], prepend=-1))
    for lo, hi in zip(cuts, np.append(cuts[1:], len(index)), strict=True):
        yield int(b[index[lo]]), k[index[lo:hi]], more[lo:hi]


def receive(keys: np.ndarray, buckets: np.ndarray, answers: dict[int, bytes]) -> np.ndarray:
    """For each key, whether its bucket answered that it repeats."""
    order = np.lexsort((keys, buckets))
    k, b = keys[order], buckets[order]
    out = np.zeros(len(keys), bool)
    if not len(keys):
        return out
    cuts = np.flatnonzero(np.diff(b, prepend=-1))
    for lo, hi in zip(cuts, np.append(cuts[1:], len(b)), strict=True):
        if (bits := answers.get(int(b[lo]))) is not None:
            nth = np.cumsum(np.diff(k[lo:hi].astype(np.uint64), prepend=k[lo] ^ k[lo].dtype.type(1)) != 0) - 1
            out[order[lo:hi]] = np.unpackbits(np.frombuffer(bits, np.uint8))[nth].astype(bool)
    return out


_SENT = "bucket bigint, gid bigint, keys binary, more binary"


def _message(bucket, gid, keys, more) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket], pa.int64()), pa.array([gid], pa.int64()),
         pa.array([keys.tobytes()], pa.binary()), pa.array([np.packbits(more).tobytes()], pa.binary())],
        ["bucket", "gid", "keys", "more"],
    )


def _answer(kind: str):
    """A bucket's groups: sort its keys, answer to each group which of its keys occur elsewhere or twice."""

    def work(tab: pa.Table) -> pa.Table:
        gids = tab["gid"].to_pylist()
        keys = [np.frombuffer(x.as_buffer(), kind) for x in tab["keys"]]
        more = [np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=len(k)) for x, k in zip(tab["more"], keys, strict=True)]
        flat = np.concatenate(keys)
        twice = np.concatenate(more)
        order = np.argsort(flat, kind="stable")
        s = flat[order]
        same = np.concatenate([s[1:] == s[:-1], [False]])
        hit = same | np.concatenate([[False], same[:-1]])
        start = np.flatnonzero(np.concatenate([[True], ~same[:-1]]))
        hit |= np.repeat(np.maximum.reduceat(twice[order], start) > 0, np.diff(np.append(start, len(s))))
        out = np.empty(len(flat), bool)
        out[order] = hit
        parts = np.split(out, np.cumsum([len(k) for k in keys])[:-1])
        rows = [(int(tab["bucket"][0].as_py()), g, np.packbits(p).tobytes()) for g, p in zip(gids, parts, strict=True) if p.any()]
        cols = list(zip(*rows, strict=True)) or [[], [], []]
        return pa.table({"bucket": pa.array(cols[0], pa.int64()), "gid": pa.array(cols[1], pa.int64()), "bits": pa.array(cols[2], pa.binary())})

    return work


def groups(docs: DataFrame, text_col: str) -> tuple[DataFrame, str]:
    """(gid, hs, lens, copied, bytes): the distinct texts, packed, in a table bucketed by gid; and the table's name.

    Answers join it by gid without moving the texts again. The number of buckets grows with the bytes.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.md5(text).alias("h"), F.encode(text, "utf-8").alias("t"))
    total = rows.agg(F.sum(F.octet_length("t").cast("bigint"))).first()[0] or 0
    n_groups = max(1, -(-total // GROUP_BYTES))
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))

    def first_in_task(batches):
        """Copies may be a large share of all rows: a task sends each text once, and once more if it comes again."""
        sent: dict[str, bool] = {}
        for batch in batches:
            seen: dict[str, int] = {}
            again = np.zeros(batch.num_rows, bool)
            for i, h in enumerate(batch.column(0).to_pylist()):
                again[seen.setdefault(h, i)] |= h in sent or seen[h] != i
            fresh = [i for h, i in seen.items() if h not in sent or not sent[h] and again[i]]
            if len(sent) > MOST_SEEN:
                sent.clear()
            sent.update((h, bool(again[i])) for h, i in seen.items())
            own = batch.take(pa.array(fresh, pa.int64()))
            yield pa.RecordBatch.from_arrays([own.column(0), pa.array(again[fresh]), own.column(1)], ["h", "copied", "t"])

    def pack(batches):
        """Rows come by gid and digest: one group for each gid, each text once."""
        gid, held = None, []

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array([gid], pa.int64()), pa.array([[h for h, _, _ in held]], pa.list_(pa.string())),
                 pa.array([[len(t) for _, _, t in held]], pa.list_(pa.int64())), pa.array([[c for _, c, _ in held]], pa.list_(pa.bool_())),
                 pa.array([b"".join(t for _, _, t in held)], pa.large_binary()).cast(pa.binary())],
                ["gid", "hs", "lens", "copied", "bytes"],
            )

        for batch in batches:
            for g, h, c, t in zip(*(batch.column(i) for i in range(4)), strict=True):
                g, h = g.as_py(), h.as_py()
                if held and g != gid:
                    yield flush()
                    held = []
                gid = g
                if held and held[-1][0] == h:  # the same text from elsewhere
                    held[-1] = (h, True, held[-1][2])
                else:
                    held.append((h, c.as_py(), t.as_py()))
        if held:
            yield flush()

    own = rows.mapInArrow(first_in_task, "h string, copied boolean, t binary")
    placed = own.select(F.pmod(F.xxhash64("h"), F.lit(n_groups)).alias("gid"), "h", "copied", "t")
    packed = placed.repartition(n_buckets, "gid").sortWithinPartitions("gid", "h").mapInArrow(
        pack, "gid bigint, hs array<string>, lens array<bigint>, copied array<boolean>, bytes binary"
    )
    name = f"groups_{uuid.uuid4().hex}"
    packed.write.bucketBy(n_buckets, "gid").sortBy("gid").option("compression", "zstd").saveAsTable(name)
    return spark.table(name), name


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(n)[i].as_py() for n in batch.schema.names}


def _with_answers(found: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    per_group = answers.groupBy("gid").agg(F.collect_list(F.struct("bucket", "bits")).alias(name))
    return found.join(per_group, "gid", "left")


def _of(row: dict, name: str) -> dict[int, bytes]:
    return {x["bucket"]: x["bits"] for x in row[name] or []}


def _release(spark: SparkSession) -> None:
    """Shuffle files of finished steps go once the driver's garbage is collected; ask for it between the large steps."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def repeated_spans(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """(h, n_bytes, n_removed, n_spans, kept_sha256, kept) for each distinct text; h is md5 of the text."""
    spark = docs.sparkSession
    found, name = groups(docs, text_col)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = found.agg(F.sum(F.length("bytes"))).first()[0] or 0
    n = max(2 * least, -(-total * len(COVER) // MODULUS // BUCKET_KEYS))
    m = max(2 * least, -(-total // 4 // BUCKET_KEYS))
    _release(spark)

    def send_samples(batches):
        for row in _rows(batches):
            _, keys, buckets = Group(row, n, m).sample()
            for bucket, k, more in send(keys, buckets):
                yield _message(bucket, row["gid"], k, more)

    answer = "bucket bigint, gid bigint, bits binary"
    sent = found.select("gid", "lens", "copied", "bytes").mapInArrow(send_samples, _SENT)
    samples = written(sent.groupBy("bucket").applyInArrow(_answer("<u4"), answer), "samples")
    _release(spark)

    def of_samples(row: dict) -> tuple[Group, np.ndarray]:
        g = Group(row, n, m)
        at, keys, buckets = g.sample()
        return g, g.candidates(at[receive(keys, buckets, _of(row, "samples"))])

    def send_windows(batches):
        for row in _rows(batches):
            if row["samples"]:
                g, at = of_samples(row)
                for bucket, k, more in send(*g.windows(at)):
                    yield _message(bucket, row["gid"], k, more)

    sent = _with_answers(found, samples, "samples").select("gid", "lens", "copied", "bytes", "samples").mapInArrow(send_windows, _SENT)
    windows = written(sent.groupBy("bucket").applyInArrow(_answer("<u8"), answer), "windows")
    _release(spark)

    def mark(batches):
        for row in _rows(batches):
            g, at = of_samples(row)
            keys, buckets, _ = g.windows(at)
            at = at[receive(keys, buckets, _of(row, "windows"))]
            change = np.zeros(len(g.data) + 1, np.int32)
            change[at] += 1
            np.add.at(change, at + LENGTH, -1)
            covered = np.cumsum(change[:-1]) > 0
            starts = g.ends - np.array(row["lens"])
            out = []
            for h, a, b, copied in zip(row["hs"], starts.tolist(), g.ends.tolist(), row["copied"], strict=True):
                gone = covered[a:b]
                if copied and b - a >= LENGTH:
                    gone = np.ones(b - a, bool)
                kept = g.data[a:b][~gone].tobytes()
                out.append((h, b - a, int(gone.sum()), len(runs(gone)), hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            cols = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, ["h", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    both = _with_answers(_with_answers(found, samples, "samples"), windows, "windows")
    schema = "h string, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    out = written(both.mapInArrow(mark, schema), "repeats")
    spark.sql(f"DROP TABLE {name}")
    return out


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    of_text = repeated_spans(docs, keep_text=False).drop("kept")
    keys = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("h"))
    return keys.join(of_text, "h").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
