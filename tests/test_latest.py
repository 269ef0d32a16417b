"""Latest copies from a stream: any order of arrival and a restart give what a batch gives."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from millrace.operators.dedupe import keep_latest
from millrace.session import scratch_path
from millrace.streaming.latest import latest_copies

SCHEMA = "bronze_row_id long, purchase_order_id string, status string, quantity string, event_time timestamp"
DAY = datetime(2025, 1, 1)
CLOSING = (None, "closing", None, None, DAY + timedelta(days=400))


def copies():
    rng = random.Random(4)
    rows, n = [], 0
    for order in range(40):
        for _ in range(rng.randint(1, 4)):
            n += 1
            rows.append((n, None if order == 7 else f"PO{order}", rng.choice(["CREATED", None, "DELIVERED"]), str(n), DAY + timedelta(minutes=rng.randint(0, 600))))
    return [*rows, (n, "PO39", "CREATED", "tie", DAY)]


def emitted(spark, parts, restart_after=None):
    base = scratch_path(spark, "latest")

    def read():
        rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        latest_copies(rows, "purchase_order_id", "2 days", 60_000).writeStream.option("checkpointLocation", f"{base}/state").trigger(
            availableNow=True
        ).start(f"{base}/out", format="parquet").awaitTermination()

    for n, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
        if n == restart_after:
            read()
    read()
    return Counter(tuple(r) for r in spark.read.parquet(f"{base}/out").collect())


def batch(spark, rows):
    ranked = spark.createDataFrame(rows, SCHEMA).drop("event_time")
    return Counter(tuple(r) for r in keep_latest(ranked, "purchase_order_id", ["bronze_row_id", "purchase_order_id", "status", "quantity"]).collect())


@pytest.mark.parametrize(("seed", "restart"), [(1, None), (2, 1)])
def test_stream_equals_batch_in_any_order(spark, seed, restart):
    rows = copies()
    random.Random(seed).shuffle(rows)
    parts = [rows[i::4] for i in range(4)]
    assert emitted(spark, [*parts, [CLOSING]], restart) == batch(spark, rows)


def test_an_order_is_emitted_once_and_only_after_its_wait(spark):
    early, late = (1, "PO1", "CREATED", "1", DAY), (2, "PO1", "DELIVERED", "2", DAY + timedelta(hours=3))
    assert emitted(spark, [[early], [late]]) == Counter()
    too_late = (3, "PO1", "CANCELLED", "3", DAY + timedelta(hours=4))
    found = emitted(spark, [[early], [late], [CLOSING], [too_late], [(None, "closing", None, None, DAY + timedelta(days=900))]], restart_after=2)
    assert found == Counter({late[:4]: 1})


def test_ids_of_one_bucket_end_their_waits_apart(spark):
    """Ids share a state, but neither their copies nor their time."""
    base = scratch_path(spark, "bucket")
    parts = [
        [(1, "PO1", "CREATED", "1", DAY), (2, "PO2", "CREATED", "1", None), (3, "PO3", None, "1", DAY + timedelta(days=20))],
        [(5, "PO1", "DELIVERED", "2", DAY + timedelta(hours=1)), (4, "PO1", "CANCELLED", "2", DAY + timedelta(hours=2))],
        [(6, "PO4", "CREATED", "1", DAY + timedelta(days=19))],
    ]
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
    rows = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
    latest = latest_copies(rows, "purchase_order_id", "2 days", 60_000, buckets=1)
    latest.writeStream.option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start(f"{base}/out", format="parquet").awaitTermination()
    found = {tuple(r) for r in spark.read.schema(latest.schema).parquet(f"{base}/out").collect()}
    assert found == {(5, "PO1", "DELIVERED", "2"), (2, "PO2", "CREATED", "1")}


def test_a_call_into_python_takes_many_ids(spark):
    """The groups don't grow with the ids."""
    path = scratch_path(spark, "none")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    rows = spark.readStream.schema(SCHEMA).parquet(path)
    plan = latest_copies(rows, "purchase_order_id", "2 days", 60_000)._jdf.queryExecution().analyzed().toString()
    assert "[_bucket#" in plan.split("FlatMapGroupsInPandasWithState", 1)[1].split("\n", 1)[0]
