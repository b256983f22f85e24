"""Sources: report files, typed CSV tables, many same-shaped files, shift records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import parse_ts
from ..schema import REPORT_RAW, SHIFTS


def read_report(spark: SparkSession, path: str, schema: T.StructType = REPORT_RAW) -> DataFrame:
    """Rows by position, all text, with file and line_no (order within the file).

    A report is a few hundred lines, so each file is one split and ids rise with its lines.
    """
    raw = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("multiLine", True).csv(path)
    return raw.withColumns({"file": F.col("_metadata.file_path"), "line_no": F.monotonically_increasing_id()})


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, ts_cols: Iterable[str] = (), on_error: str = "raise",
    drop_null: Iterable[str] = (),
) -> DataFrame:
    """CSV with a header. Stamps are read as text and parsed; repeated header lines fall out with drop_null on a stamp."""
    stamps = set(ts_cols)
    text = T.StructType([T.StructField(f.name, T.StringType()) if f.name in stamps else f for f in schema])
    df = parse_ts(spark.read.schema(text).option("header", True).csv(path), ts_cols, on_error)
    return df.na.drop(subset=list(drop_null)) if drop_null else df


def read_many(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.csv") -> DataFrame:
    """Every file that matches, unreadable ones skipped."""
    return (
        spark.read.schema(schema).option("header", True).option("pathGlobFilter", pattern)
        .option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).csv(path)
    )


def read_shifts(spark: SparkSession, path: str, schema: T.StructType = SHIFTS) -> DataFrame:
    """JSON records, one a line; stamps that do not parse are null."""
    stamps = [f.name for f in schema if isinstance(f.dataType, T.TimestampNTZType)]
    text = T.StructType([T.StructField(f.name, T.StringType()) if f.name in stamps else f for f in schema])
    return parse_ts(spark.read.schema(text).json(path), stamps)
