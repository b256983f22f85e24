"""Exact top-k search: tiled matrix products, selection in each tile, tree merging.

Vectors are packed into blocks of a fixed number of bytes. Candidates are dealt to shards and
queries (the stated small share of the rows) to strips, both of bounded bytes; every shard
meets every strip, and one task multiplies small matrices only. A tile keeps the k best of
each query; the lists then merge in two levels, first within a group of tiles, then over all.

Scores are integers: each component becomes floor(1024 * x). Blocks hold that number
divided by 1024, which is exact and stays finite for every finite double. Products run as
float64 where their exact bound is below 2^53, else as Python integers; a score beyond a
long is held at the long's limit.

Defined results: a null vector, or one with a null or non-finite component, takes no
part; vectors of unequal length are not compared; ties go to the smaller vec_id, and
repeated rows of one vec_id count as separate candidates (never the query's own id), and
as one query, by the least of their vectors;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

BLOCK_BYTES = 1 << 18
SHARD_BYTES, STRIP_BYTES = 1 << 26, 1 << 24
FAN = 16  # tiles merged together at the first level
SCALE = 1024


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v): vectors whose components are all finite numbers, as doubles."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return df.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", fine)
    )


def _floored(x: np.ndarray) -> np.ndarray:
    """floor(1024 x) / 1024, exactly; doubles from 2^53 on are whole numbers already."""
    small = np.abs(x) < 2.0**53
    return np.where(small, np.floor(SCALE * np.where(small, x, 0.0)) / SCALE, x)


def _pack(batches):
    """Rows -> blocks of one dimension: (block, dim, ids, comps), components as float64 of floor(1024 x) / 1024."""
    from pyspark import TaskContext

    part, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        lists = batch.column(1)
        dims = np.asarray(lists.value_lengths())
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(dims)
        for d in np.unique(dims):
            pick = np.flatnonzero(dims == d)
            step = max(1, BLOCK_BYTES // (8 * max(1, int(d))))
            for i in range(0, len(pick), step):
                own = pick[i : i + step]
                m = _floored(flat[(ends[own] - d)[:, None] + np.arange(d)]) if d else np.zeros((len(own), 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(part << 33) + n], pa.int64()), pa.array([int(d)], pa.int32()),
                     pa.array([ids[own].astype("<i8").tobytes()], pa.binary()), pa.array([m.astype("<f8").tobytes()], pa.binary())],
                    ["block", "dim", "ids", "comps"],
                )
                n += 1


_BLOCKS = "block bigint, dim int, ids binary, comps binary"


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of the integers 1024 * q and 1024 * c, exact, as int64, held at the limits of a long."""
    top = float(np.abs(q).max(initial=0)) * SCALE * float(np.abs(c).max(initial=0)) * SCALE * max(1, q.shape[1])
    if top < 2**53:
        return ((q @ c.T) * SCALE**2).astype(np.int64)
    whole = lambda x: int(x * SCALE) if abs(x) < 2.0**53 else int(x) * SCALE
    big = lambda m: np.array([[whole(float(x)) for x in row] for row in m], dtype=object).reshape(m.shape)
    exact = big(q) @ big(c).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def best_of_tile(q_ids, q, c_ids, c, k: int):
    """The k highest (score, then smaller id) for each query of a tile, its own id left out."""
    scores = _products(q, c)
    out = []
    for i, own in enumerate(q_ids):
        s, ok = scores[i], c_ids != own
        s, ids = s[ok], c_ids[ok]
        if len(s) > k:
            least = np.partition(s, len(s) - k)[len(s) - k]
            keep = np.flatnonzero(s >= least)  # all that tie with the k-th
            s, ids = s[keep], ids[keep]
        order = np.lexsort((ids, -s.astype(object) if len(s) and s.min() == -(2**63) else -s))[:k]
        out.append((s[order], ids[order]))
    return out


def _tiles(k: int):
    def work(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r] for n in batch.schema.names}
                d = row["dim"].as_py()
                ids = lambda n: np.frombuffer(row[n].as_buffer(), "<i8")  # noqa: B023, E731
                mat = lambda n, m: np.frombuffer(row[n].as_buffer(), "<f8").reshape(m, d) if d else np.zeros((m, 0))  # noqa: B023, E731
                q_ids, c_ids = ids("q_ids"), ids("ids")
                found = best_of_tile(q_ids, mat("q_comps", len(q_ids)), c_ids, mat("comps", len(c_ids)), k)
                n = [len(s) for s, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(q_ids, n)), pa.array(np.concatenate([i for _, i in found])),
                     pa.array(np.concatenate([s for s, _ in found])), pa.array(np.full(sum(n), row["block"].as_py()))],
                    ["query_id", "vec_id", "score", "tile"],
                )

    return work


def _parts(df: DataFrame, most: int) -> int:
    """How many parts of ``most`` bytes the vectors make."""
    size = df.agg(F.sum(8 * F.size("v").cast("bigint"))).first()[0] or 0
    return max(1, -(-size // most))


def exact_top_k(
    candidates: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
    shards: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates of highest integer inner product for each query id."""
    spark = candidates.sparkSession
    c = usable(candidates, id_col, vec_col)
    q = usable(queries, id_col, vec_col).groupBy("vec_id").agg(F.min("v").alias("v"))
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), _parts(c, SHARD_BYTES))
    strips = _parts(q, STRIP_BYTES)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    c = c.mapInArrow(_pack, _BLOCKS).select(
        F.pmod(F.xxhash64("block"), F.lit(shards)).alias("shard"), every(strips).alias("strip"), "block", "dim", "ids", "comps"
    )
    q = q.mapInArrow(_pack, _BLOCKS).select(
        every(shards).alias("shard"), F.pmod(F.xxhash64("block"), F.lit(strips)).alias("strip"), "dim",
        F.col("ids").alias("q_ids"), F.col("comps").alias("q_comps"),
    )
    # a merge join buffers the queries of one strip, never all of them
    tiles = c.join(q.hint("merge"), ["shard", "strip", "dim"]).select("block", "dim", "ids", "comps", "q_ids", "q_comps")
    part = tiles.mapInArrow(_tiles(k), "query_id bigint, vec_id bigint, score bigint, tile bigint")
    order = [F.col("score").desc(), F.col("vec_id")]
    near = Window.partitionBy("query_id", F.pmod(F.xxhash64("tile"), F.lit(FAN))).orderBy(*order)
    part = part.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k)
    last = Window.partitionBy("query_id").orderBy(*order)
    return (
        part.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return exact_top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


OP8_SQL = """
WITH u AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS d
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS (
  SELECT vec_id, list_transform(d, lambda x: CAST(floor(1024 * x) AS BIGINT)) AS c FROM u
), q AS (
  SELECT vec_id, list_transform(min(d), lambda x: CAST(floor(1024 * x) AS BIGINT)) AS c FROM u WHERE vec_id % 100 = 0 GROUP BY vec_id
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.c, v.c), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM q JOIN v ON q.vec_id <> v.vec_id
  WHERE len(q.c) = len(v.c)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
