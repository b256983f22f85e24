import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    tmp = tempfile.mkdtemp(prefix="opspulse-test-")
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", f"{tmp}/warehouse")
        .config("spark.checkpoint.dir", f"file://{tmp}/shared").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and very long texts, repeated rows, ties, and columns with clashing names."""
    long = "word another third " * 20_000
    rows = [
        (1, None, "x"), (2, "", "x"), (3, "plain words that mean nothing at all here", None), (3, "plain words that mean nothing at all here", None),
        (4, long, "y"), (5, "é ü 日本 \u0000 tab\there", "z"), (None, "a row without a key has text", "z"), (6, "   \n ", "q"),
    ]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clash = ["log_weight", "spans", "base", "h", "n", "cls", "copies", "rate", "p", "tokens", "idx", "row", "_t", "bands", "length", "start"]
    return df.withColumns({c: F.lit("clash") for c in clash})


@pytest.fixture(scope="session")
def edge_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 1, 0), (4, None, None), (None, 1, 1), (5, 0, 1)], "doc_id long, quality int, toxic int")
