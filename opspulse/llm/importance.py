"""Target-distribution importance resampling: array-scored weights, ranks by sorting with regular samples.

Features are the runs of one to three words; a feature's bucket is the CRC-32 of its UTF-8
bytes, modulo ``BUCKETS``. CRC-32 is linear, so that the checksum of "a b" follows from those
of "a " and "b" by table look-ups: all features of a block of texts are scored as arrays, and
only distinct words are hashed one by one. A first scan counts buckets in the documents and in
the target texts; the gains of the buckets (``BUCKETS`` numbers, whatever the input) go to a
second scan, which adds them up for each text.

Ranks are exact and global, without a sort in one task (parallel sorting by regular sampling):

1. scored rows are sorted within their partitions, and these runs are written;
2. regularly spaced rows of each run, at most ``MOST_SAMPLES`` in all, give splitters;
3. each row goes to the segment that the splitters name, and is merged with its segment's others;
4. the numbers of rows of earlier segments are added to the place within the segment.

The order ends with a number that is unique to a row, so equal rows are spread over segments too.

Defined results: a null text has no words; a text without words has no features and weight 0;
a row with a null key has a weight, no score and no rank, and is not among the rows drawn from;
repeated rows are rows of their own; without rows of enough words nothing is drawn; an empty
table gives an empty result; without target texts all t are 0; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table

BUCKETS = 10_000
SCALE = 1000
LEAST_WORDS, PERCENT, SEED = 20, 5, 42
LONGEST = 3  # words of a feature
MOST_SAMPLES = 1 << 16
MOST_CACHED = 400_000
BLOCK_WORDS = 1 << 15
TABLED = 64  # longer words are hashed one by one

# A-Z become a-z; other ASCII that is neither letter nor digit separates words
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_STEP = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def _zeros() -> np.ndarray:
    """[n, i, b]: what n zero bytes make of a checksum register whose i-th byte is b, for n up to TABLED + 1."""
    out = np.zeros((TABLED + 2, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, len(out)):
        out[n] = (out[n - 1] >> np.uint32(8)) ^ _STEP[out[n - 1] & np.uint32(255)]
    return out.reshape(-1)


class Buckets:
    """Blocks of texts -> the buckets of all their features, by arrays."""

    def __init__(self):
        self.zeros = _zeros()
        self._forget(1 << 12)

    def _forget(self, room: int) -> None:
        self.known: dict[bytes, int] = {}
        self.words: list[bytes] = []
        self.crc, self.open, self.size = (np.zeros(room, t) for t in (np.uint32, np.uint32, np.int64))

    def _learn(self, words: list[bytes]) -> None:
        fresh = set(words).difference(self.known)
        if not fresh:
            return
        if len(self.known) + len(fresh) > MOST_CACHED:
            self._forget(len(self.crc))
            fresh = set(words)
        while len(self.known) + len(fresh) > len(self.crc):
            self.crc, self.open, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.crc, self.open, self.size))
        for w in fresh:
            i = self.known[w] = len(self.known)
            self.words.append(w)
            self.crc[i] = c = zlib.crc32(w)
            self.open[i], self.size[i] = zlib.crc32(b" ", c), len(w)

    def _joined(self, left: np.ndarray, ids: np.ndarray, spaced: bool) -> np.ndarray:
        """Checksums of texts with checksum ``left``, each followed by a word (and a space)."""
        n = self.size[ids]
        at = (np.minimum(n, TABLED) + spaced) * 1024
        out = (self.open if spaced else self.crc)[ids]
        for i in range(4):
            out = out ^ self.zeros[at + (256 * i + ((left >> np.uint32(8 * i)) & np.uint32(255)).astype(np.int64))]
        for j in np.flatnonzero(n > TABLED):
            out[j] = zlib.crc32(self.words[ids[j]] + b" " * spaced, int(left[j]))
        return out

    def __call__(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """(number of the text, bucket) of each feature of the texts, given as lists of words."""
        words = [w for own in texts for w in own]
        self._learn(words)
        ids = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        row = np.repeat(np.arange(len(texts)), [len(own) for own in texts])
        left, crc = self.open[ids], self.crc[ids]
        rows, found = [row], [crc]
        for k in range(1, LONGEST):
            ends = ids[k:]
            same = row[k:] == row[: len(row) - k]
            crc = self._joined(left[: len(ends)], ends, False)
            rows.append(row[k:][same])
            found.append(crc[same])
            if k + 1 < LONGEST:
                left = self._joined(left[: len(ends)], ends, True)
        return np.concatenate(rows), (np.concatenate(found) % np.uint32(BUCKETS)).astype(np.int64)


def _blocks(column: pa.Array):
    """Lists of the texts' words, in blocks of about BLOCK_WORDS words."""
    texts, n = [], 0
    for text in column:
        own = words_of(text.as_py().encode()) if text.is_valid else []
        texts.append(own)
        n += len(own)
        if n >= BLOCK_WORDS:
            yield texts
            texts, n = [], 0
    if texts:
        yield texts


def bucket_counts(docs: DataFrame, text_col: str) -> np.ndarray:
    """Features in each bucket, over all texts; a task sends a row for each bucket at most."""

    def work(batches):
        buckets, total = Buckets(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for texts in _blocks(batch.column(0)):
                total += np.bincount(buckets(texts)[1], minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    part = docs.select(F.col(f"`{text_col}`").cast("string").alias("t")).mapInArrow(work, "bucket bigint, n bigint")
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in part.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        out[bucket] = n
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(SCALE * ln(p_target / p_raw)) of each bucket, with one added to every count."""
    s, t = float(raw.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(SCALE * math.log((b + 1.0) * s / ((a + 1.0) * t))) for a, b in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, key: str, text_col: str) -> DataFrame:
    """(key, n_words, n_features, weight) of each row of docs."""
    kind = docs.schema[key].dataType.simpleString()

    def work(batches):
        buckets, gain = Buckets(), gains.astype(np.float64)
        for batch in batches:
            words, features, weights = [], [], []
            for texts in _blocks(batch.column(1)):
                row, bucket = buckets(texts)
                words += map(len, texts)
                features.append(np.bincount(row, minlength=len(texts)))
                weights.append(np.bincount(row, gain[bucket], minlength=len(texts)))  # whole numbers below 2^53: exact
            cat = lambda parts: pa.array(np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), cat(features), cat(weights)], ["k", "n_words", "n_features", "weight"]
            )

    picked = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text_col}`").cast("string").alias("t"))
    return picked.mapInArrow(work, f"k {kind}, n_words bigint, n_features bigint, weight bigint")


def noise(key: str, seed: int = SEED):
    """floor of SCALE times Gumbel noise, by the first 32 bits of sha256("<seed>:<key>"); null for a null key."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / float(1 << 32)))).cast("bigint")


def exact_ranks(rows: DataFrame, order: list, scratch: Scratch, segments: int | None = None) -> DataFrame:
    """rows + rank: 1, 2, 3... by the columns in ``order`` (names ascending, or (name, False) for descending numbers).

    rows without nulls in these columns; the names run, at, segment and rank are this function's own.
    """
    spark = rows.sparkSession
    segments = segments or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(o) if isinstance(o, str) else -F.col(o[0]) for o in order]
    names = [f"_k{i}" for i in range(len(keys))]
    runs = rows.withColumns(dict(zip(names, keys, strict=True))).sortWithinPartitions(*names)
    low = F.lit((1 << 33) - 1)
    runs = scratch.write(runs.withColumn("at", F.monotonically_increasing_id()).withColumn("run", F.shiftright("at", 33)))
    # 2. regular samples, as (key, rows that it stands for)
    lengths = runs.groupBy("run").agg(F.count("*").alias("n"))
    n_runs = lengths.count()
    each = max(1, min(segments, MOST_SAMPLES // max(1, n_runs)))
    step = F.ceil(F.col("n") / each)
    place = F.col("at").bitwiseAND(low)
    sampled = runs.join(lengths, "run").where(place % step == F.floor(step / 2)).select(*names, "at", step.alias("stands"))
    samples = sorted((tuple(r[:-1]), r[-1]) for r in sampled.collect())  # at most MOST_SAMPLES, or one a run
    total, seen, splitters = sum(n for _, n in samples), 0, []
    for value, n in samples:
        if total and (seen + n) * segments // total > seen * segments // total and len(splitters) < segments - 1:
            splitters.append(value)
        seen += n

    def assign(batches):
        for batch in batches:
            own = zip(*(batch.column(c).to_pylist() for c in (*names, "at")), strict=True)
            yield batch.append_column("segment", pa.array([bisect_right(splitters, v) for v in own], pa.int32()))

    # 3. exchange and merge; 4. prefix counts
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in runs.schema)
    dealt = runs.mapInArrow(assign, f"{schema}, segment int")
    counts = dict(dealt.groupBy("segment").agg(F.count("*")).collect())  # one row a segment
    before = np.cumsum([0, *(counts.get(i, 0) for i in range(segments))]).tolist()

    def place_in(batches):
        seen: dict[int, int] = {}
        for batch in batches:
            ranks = []
            for s in batch.column("segment").to_pylist():
                seen[s] = seen.get(s, 0) + 1
                ranks.append(before[s] + seen[s])
            yield batch.append_column("rank", pa.array(ranks, pa.int64()))

    merged = dealt.repartitionById(segments, F.col("segment")).sortWithinPartitions("segment", *names, "at")
    return merged.mapInArrow(place_in, f"{schema}, segment int, rank bigint").select(*rows.columns, "rank")


def importance_resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text_col: str = "text", target_col: str = "text",
    percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """(key, n_features, weight, score, rank) of each row of docs; rank is null where the row is not drawn.

    Of the N rows of at least ``least_words`` words and a key, floor(percent * N / 100) are drawn.
    """
    scratch = Scratch(docs.sparkSession, "importance")
    gains = bucket_gains(bucket_counts(docs, text_col), bucket_counts(target, target_col))
    scored = scratch.write(weighed(docs, gains, key, text_col).withColumn("score", F.col("weight") + noise("k", seed)))
    able = (F.col("n_words") >= least_words) & F.col("k").isNotNull()
    drawn = scored.where(able).count() * percent // 100
    ranked = exact_ranks(scored.where(able), [("score", False), "k", "n_features"], scratch)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(~able).withColumn("rank", F.lit(None).cast("bigint"))
    return scratch.result(ranked.unionByName(rest).select(F.col("k").alias(key), "n_features", "weight", "score", "rank"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _crc_sql(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, a byte at a time."""
    byte = f"CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT)"
    steps = f"list_transform(range(octet_length(encode({text}))), lambda i: {byte})"
    return f"xor(list_reduce({steps}, lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)]), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"


OP13_SQL = f"""
WITH RECURSIVE rounds(r, b, c) AS (
  SELECT 0, CAST(range AS BIGINT), CAST(range AS BIGINT) FROM range(256)
  UNION ALL SELECT r + 1, b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END FROM rounds WHERE r < 8
), crc AS (
  SELECT list(c ORDER BY b) AS tab FROM rounds WHERE r = 8
), texts AS (
  SELECT 0 AS kind, CAST(row_number() OVER () AS BIGINT) AS row, doc_id, text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark
), words AS (
  SELECT kind, row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts
), grams AS (
  SELECT kind, row, unnest(w) AS f FROM words
  UNION ALL SELECT kind, row, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
  UNION ALL SELECT kind, row, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words
), buckets AS (
  SELECT f, {_crc_sql("f")} % {BUCKETS} AS bucket FROM (SELECT DISTINCT f FROM grams), crc
), counted AS (
  SELECT kind, row, bucket, count(*) AS n FROM grams JOIN buckets USING (f) GROUP BY ALL
), sums AS (
  SELECT b.range AS bucket, coalesce(sum(n) FILTER (kind = 0), 0) AS s, coalesce(sum(n) FILTER (kind = 1), 0) AS t
  FROM range({BUCKETS}) b LEFT JOIN counted c ON c.bucket = b.range GROUP BY 1
), gains AS (
  SELECT bucket, CAST(floor({SCALE} * ln((CAST(t AS DOUBLE) + 1) * (CAST(sum(s) OVER () AS DOUBLE) + {BUCKETS}) / ((CAST(s AS DOUBLE) + 1) * (CAST(sum(t) OVER () AS DOUBLE) + {BUCKETS})))) AS BIGINT) AS gain FROM sums
), weights AS (
  SELECT row, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight
  FROM counted JOIN gains USING (bucket) WHERE kind = 0 GROUP BY 1
), scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-{SCALE} * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM words LEFT JOIN weights USING (row) WHERE kind = 0
), placed AS (
  SELECT *, n_words >= {LEAST_WORDS} AND doc_id IS NOT NULL AS able,
    row_number() OVER (PARTITION BY n_words >= {LEAST_WORDS} AND doc_id IS NOT NULL ORDER BY score DESC, doc_id, n_features) AS k,
    count(*) OVER (PARTITION BY n_words >= {LEAST_WORDS} AND doc_id IS NOT NULL) AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND k <= n * {PERCENT} // 100 THEN k END AS rank FROM placed
"""
