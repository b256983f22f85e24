"""Queries of file sources and sinks: a stand-in is written, read back through the operator, and compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cleaning as cl
from ..sources import sinks as sk
from ..sources import tables as tb
from ..streaming import stream as st
from . import standins as si
from .models import _scratch
from .queries import query
from .standins import TYPES

_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in ("dateflg", "timeflg", *TYPES)])
_INTS = ", ".join(f"CAST({t} AS INTEGER) AS {t}" for t in TYPES)
_HOURS = f"SELECT id, ds, {', '.join(TYPES)}, n FROM hourly"


def _report_files(spark: SparkSession, d: str) -> str:
    """The report of each site in a file of its own, lines in order."""
    out = f"{_scratch(spark)}/report"
    lines = si.report(spark, d).repartition("file").sortWithinPartitions("file", "line_no").withColumnRenamed("file", "site")
    lines.select("site", *_TEXT.names).write.partitionBy("site").option("header", True).csv(out)
    return out


def _site(file: str):
    return F.regexp_extract(file, "site=([^/]+)/", 1)


@query(f"SELECT id, ds + INTERVAL 1 HOUR AS ds, {_INTS} FROM hourly", "hourly")
def read_report_files(spark, d):
    rows = tb.read_report(spark, f"{_report_files(spark, d)}/*/*.csv", _TEXT)
    rows = cl.fill_down(rows, "dateflg", "line_no", "file").withColumn("ds", cl.hour_ending("dateflg", "timeflg"))
    return cl.to_int(rows, TYPES).select(_site("file").alias("id"), "ds", *TYPES)


def _hours_csv(spark: SparkSession, d: str, junk: bool) -> tuple[str, T.StructType]:
    out = f"{_scratch(spark)}/hours"
    h = si.hourly(spark, d)
    text = h.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c == "ds" else F.col(c).cast("string").alias(c) for c in h.columns])
    if junk:  # header lines in the middle, as concatenated files have them
        text = text.union(h.limit(3).select(*[F.lit(c).alias(c) for c in h.columns]))
    text.write.option("header", True).csv(out)
    return out, h.schema


@query(_HOURS, "hourly")
def read_csv_strict(spark, d):
    path, schema = _hours_csv(spark, d, junk=False)
    return tb.read_table(spark, path, schema, ["ds"])


@query(_HOURS, "hourly")
def read_csv_coerced(spark, d):
    path, schema = _hours_csv(spark, d, junk=True)
    return tb.read_table(spark, path, schema, ["ds"], on_error="null", drop_null=["ds"])


@query("SELECT event_id, event_type FROM events")
def read_many_files(spark, d):
    out = f"{_scratch(spark)}/many"
    e = si.events(spark, d).select("event_id", "event_type")
    e.withColumn("part", F.col("event_id") % 7).write.partitionBy("part").option("header", True).csv(out)
    si.orders(spark, d).limit(1).select("o_orderkey").write.json(f"{out}/other")  # does not match the pattern
    return tb.read_many(spark, out, e.schema)


@query("SELECT user_id, shift_start, shift_end, code FROM shifts", "shifts")
def read_shift_json(spark, d):
    out = f"{_scratch(spark)}/shifts"
    rows = si.shifts(spark, d).select("user_id", "shift_start", "shift_end", "code")
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
    rows.select("user_id", stamp("shift_start"), stamp("shift_end"), "code").write.json(out)
    schema = T.StructType([T.StructField(f.name, T.TimestampNTZType()) if f.name.startswith("shift") else f for f in rows.schema])
    return tb.read_shifts(spark, out, schema)


@query("SELECT id, ds, CASE WHEN id = 's1' THEN n + 1000 ELSE n END AS n FROM hourly", "hourly")
def replace_partitions(spark, d):
    """Only the partitions that the second write touches are replaced."""
    out = f"{_scratch(spark)}/table"
    h = si.hourly(spark, d).select("id", "ds", "n")
    sk.write_table(h, out, ["id"])
    sk.write_table(h.where("id = 's1'").withColumn("n", F.col("n") + 1000), out, ["id"])
    return spark.read.schema("ds timestamp_ntz, n long, id string").parquet(out).select("id", "ds", "n")


@query("SELECT id, ds, n FROM hourly WHERE id = 's2'", "hourly")
def replace_table(spark, d):
    out = f"{_scratch(spark)}/table"
    h = si.hourly(spark, d).select("id", "ds", "n")
    sk.write_table(h, out)
    sk.write_table(h.where("id = 's2'"), out)
    return spark.read.parquet(out)


def _with_site(batch: DataFrame) -> DataFrame:
    sites = batch.select("*", _site("file").alias("site"))
    rows = sites.withColumn("line_no", F.monotonically_increasing_id())
    rows = cl.fill_down(rows, "dateflg", "line_no", "file").withColumn("ds", cl.hour_ending("dateflg", "timeflg"))
    return cl.to_int(rows, TYPES).select(F.col("site").alias("id"), "ds", *TYPES, F.col("line_no").alias("_order"))


@query(f"SELECT id, ds + INTERVAL 1 HOUR AS ds, {_INTS} FROM hourly", "hourly")
def stream_report_files(spark, d):
    """New report files through the stream and the batch cleaning code."""
    path, out = _report_files(spark, d), _scratch(spark)
    stream = st.report_stream(spark, f"{path}/*", _TEXT)
    q = st.start_ingest(stream, out, f"{out}/checkpoint", ["id", "ds"], _with_site, F.unix_date(F.to_date("ds")))
    q.awaitTermination()
    schema = spark.read.parquet(f"{out}/v={q.lastProgress['batchId']}").schema
    return st.newest_version(spark, out, schema).drop("v", "part")


@query("SELECT id, ds, metric, CASE WHEN metric = 'error' AND hour(ds) = 5 THEN value + 100 ELSE value END AS value FROM long", "long")
def stream_corrections(spark, d):
    """A second run brings corrected hours, however late; they replace the old ones."""
    out = _scratch(spark)
    rows = si.long(spark, d)
    stream = lambda: spark.readStream.schema(rows.schema).parquet(f"{out}/in/*")
    newest = lambda batch: batch.withColumn("_order", F.lit(1))
    rows.write.parquet(f"{out}/in/first")
    day = F.unix_date(F.to_date("ds"))
    st.start_ingest(stream(), out, f"{out}/checkpoint", ["id", "ds", "metric"], newest, day).awaitTermination()
    late = rows.where("metric = 'error' and hour(ds) = 5").withColumn("value", F.col("value") + 100)
    late.write.parquet(f"{out}/in/second")
    st.start_ingest(stream(), out, f"{out}/checkpoint", ["id", "ds", "metric"], newest, day).awaitTermination()
    return st.newest_version(spark, out, rows.schema).drop("v", "part")
