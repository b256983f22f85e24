"""Streams joined with streams, in several batches, against the batch operators."""

import datetime as dt

from opspulse.operators import intervals
from opspulse.streaming import stream


def at(h):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


def test_oncall_blocks_in_batches_equal_the_batch_result(spark, tmp_path):
    shift = "user_id long, shift_start timestamp_ntz, shift_end timestamp_ntz"
    acts = [(1, at(h)) for h in (1, 2, 5, 9, 13, 30, 31, 40)] + [(2, at(h)) for h in (1, 2, 3, 50)] + [(3, at(4)), (None, at(4))]
    oncall = [(1, at(0), at(12)), (1, at(28), at(45)), (2, at(0), at(3)), (2, at(48), at(60)), (4, at(0), at(9)), (None, at(0), at(9))]
    regular = [(1, at(5), at(9)), (1, at(31), at(31.5)), (2, at(1), at(1.5)), (1, at(7), at(7))]
    end = at(2000)  # moves the watermarks
    parts = {"activity": ("user_id long, ts timestamp_ntz", acts), "oncall": (shift, oncall), "regular": (shift, regular)}
    out, q = f"file://{tmp_path}", None
    for batch in range(3):
        for name, (kind, rows) in parts.items():
            mine = [r for r in rows if (r[1] < at(20)) == (batch == 0)] if batch < 2 else [(-1, end, end)[: len(rows[0])]]
            spark.createDataFrame(mine, kind).write.mode("append").parquet(f"{out}/{name}")
        streams = [spark.readStream.schema(kind).parquet(f"{out}/{n}") for n, (kind, _) in parts.items()]
        q = stream.oncall_blocks_stream(*streams).writeStream.format("parquet").outputMode("append")
        q = q.option("checkpointLocation", f"{out}/checkpoint").option("path", f"{out}/blocks").trigger(availableNow=True).start()
        q.awaitTermination()
    got = sorted((r["user_id"], r["start"], r["end"], r["n"]) for r in spark.read.parquet(f"{out}/blocks").collect())
    batch = intervals.activity_oncall(*[spark.createDataFrame(rows, kind) for kind, rows in parts.values()])
    hits = sorted((r.user_id, r.ts) for r in batch.collect())
    assert hits == [(1, at(1)), (1, at(2)), (1, at(9)), (1, at(30)), (1, at(40)), (2, at(2)), (2, at(50))]
    gap = dt.timedelta(hours=2)
    want = [(1, at(1), at(2) + gap, 2), (1, at(9), at(9) + gap, 1), (1, at(30), at(30) + gap, 1), (1, at(40), at(40) + gap, 1), (2, at(2), at(2) + gap, 1), (2, at(50), at(50) + gap, 1)]
    assert got == want
    rows = sum(op["numRowsTotal"] for p in q.recentProgress[-1:] for op in p["stateOperators"])
    assert rows <= 6  # the markers alone: nothing of the days before is kept
