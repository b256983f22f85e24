"""Shared helpers: table access and tables written to the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_BITS = 1 << 26


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(name: str, taken: list[str]) -> str:
    """The name, with as many leading underscores as keep it apart from those taken."""
    known = {t.lower() for t in taken}
    while name.lower() in known:
        name = f"_{name}"
    return name


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which the driver and every executor must reach.

    Where it is unset, a local session (tests) gets a temporary folder; a cluster gets an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='opspulse-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Cut the lineage: write df as Parquet in the shared folder and read it back.

    Later stages read the files, so a lost executor costs no earlier stage.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    out = df.write.option("compression", "zstd")
    (out.partitionBy(partition_by) if partition_by else out).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one job, in one folder that is emptied once the job's result is written."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self.path, self.count = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0

    def write(self, df: DataFrame, name: str = "") -> DataFrame:
        """df, written and read back; a table with a name of its own can be dropped early."""
        self.count += 1
        path = f"{self.path}/{name or self.count}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Free the space of a named table that nothing reads any more."""
        self.spark.range(0).write.mode("overwrite").parquet(f"{self.path}/{name}")

    def result(self, df: DataFrame) -> DataFrame:
        """df, written elsewhere; an empty table takes the place of the folder, which frees its space."""
        out = written(df, self.name)
        self.spark.range(0).write.mode("overwrite").parquet(self.path)
        return out


def maybe_in(rows: DataFrame, column: Column, keys: DataFrame, most_bits: int = MOST_BITS, turns: int = 1) -> DataFrame:
    """rows whose column may be among the keys (one column): all that are, and about a tenth of the others.

    A bitmap of the keys' hashes, of at most ``most_bits`` bits however many keys there are, is broadcast as
    64-bit words, so that a shuffled join afterwards moves fewer rows. It never changes what that join returns.
    Each further turn has a bitmap of other hashes and leaves about a tenth of the others that were left.
    """
    bits = 1 << max(16, min(most_bits.bit_length() - 1, (8 * keys.count()).bit_length()))

    def places(of: Column, turn: int) -> tuple[Column, Column]:
        at = (F.xxhash64(of, F.lit(turn)) if turn else F.xxhash64(of)).bitwiseAND(F.lit(bits - 1).cast("bigint"))
        return F.shiftright(at, 6), F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(63).cast("int"))

    own = [F.col(f"`{c}`") for c in rows.columns]
    for turn in range(turns):
        word, bit = places(F.col(keys.columns[0]), turn)
        words = keys.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
        word, bit = places(column, turn)
        both = rows.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(words), "_word")
        rows = both.where(F.col("_bits").bitwiseAND(F.col("_bit")) != 0).select(*own)
    return rows
