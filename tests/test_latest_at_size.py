"""A stream that waits for many orders: states on disk, small, and in buckets and partitions enough."""

from __future__ import annotations

import json
import random
from collections import Counter
from datetime import date
from glob import glob

import pytest

from millrace.registry.queries import QUERIES
from millrace.session import scratch_path
from millrace.streaming import latest
from millrace.streaming.latest import buckets_for, latest_copies, room_for
from tests.test_latest import CLOSING, DAY, SCHEMA, batch, copies

LINES = """l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string,
    l_linestatus string"""
ORDERS = "o_orderkey long, o_custkey long, o_orderdate date, o_orderpriority string"


def settings(state: str) -> dict:
    with open(f"{state}/offsets/0") as file:
        return json.loads(file.read().split("\n")[1])["conf"]


def read(rows, base, **options):
    latest_copies(rows, "purchase_order_id", "2 days", 60_000, **options).writeStream.option("checkpointLocation", f"{base}/state").trigger(
        availableNow=True
    ).start(f"{base}/out", format="parquet").awaitTermination()


@pytest.fixture
def few(monkeypatch):
    """So that some ten copies are many."""
    monkeypatch.setattr(latest, "BUCKETS", 2)
    monkeypatch.setattr(latest, "COPIES_A_BUCKET", 4)
    monkeypatch.setattr(latest, "COPIES_A_PARTITION", 40)
    monkeypatch.setattr(latest, "PARTITIONS", 2)
    monkeypatch.setattr(latest, "MESSAGE_BYTES", 100)


def test_states_on_disk_give_what_a_batch_gives(spark, few):
    rows = copies()
    random.Random(3).shuffle(rows)
    base = scratch_path(spark, "disk")
    for part in (rows[::2], rows[1::2], [CLOSING]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
        # a restart for each part, the later ones without the settings: the checkpoint has them
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        if part[0] == rows[0]:
            with room_for(spark, len(rows)):
                read(stream, base, buckets=buckets_for(len(rows)))
        else:
            read(stream, base, buckets=buckets_for(len(rows)))
    assert Counter(tuple(r) for r in spark.read.parquet(f"{base}/out").collect()) == batch(spark, rows)
    assert glob(f"{base}/state/state/0/*/*.zip") and not glob(f"{base}/state/state/0/*/*.delta")


def test_room_grows_with_the_copies_and_the_session_stays_as_it_was(spark, monkeypatch):
    monkeypatch.setattr(latest, "PARTITIONS", 2)
    names = [*latest.ON_DISK, "spark.sql.shuffle.partitions"]
    before = [spark.conf.get(name, None) for name in names]
    with pytest.raises(ZeroDivisionError), room_for(spark, 3 * latest.COPIES_A_PARTITION):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        assert [spark.conf.get(name) for name in latest.ON_DISK] == list(latest.ON_DISK.values())
        raise ZeroDivisionError
    for copies, partitions in ((0, "2"), (10**8, "100")):
        with room_for(spark, copies):
            assert spark.conf.get("spark.sql.shuffle.partitions") == partitions
    assert [spark.conf.get(name, None) for name in names] == before
    assert buckets_for(0) == latest.BUCKETS
    assert buckets_for(100_000_000) * latest.COPIES_A_BUCKET == 100_000_000


def test_a_waiting_order_takes_few_bytes(spark):
    rng = random.Random(5)
    rows = [(rng.getrandbits(62), f"PO{n:06d}", rng.choice(["CREATED", "DELIVERED"]), str(rng.randint(1, 50)), DAY) for n in range(2000)]
    base = scratch_path(spark, "bytes")
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{base}/in")
    read(spark.readStream.schema(SCHEMA).parquet(f"{base}/in"), base, buckets=1)
    held = spark.read.format("statestore").load(f"{base}/state").selectExpr("length(value.groupState.held) n").collect()
    assert 10 * len(rows) < sum(r.n for r in held) < 30 * len(rows)


def test_the_query_makes_room_for_its_copies(spark, few, tmp_path):
    orders = [(n, n, date(1995, 1, 1), "1-URGENT") for n in range(1, 31)]
    lines = [(n, line, 5 + n, 1 + n % 3, 1.0 + copy, "N", "O") for n in range(1, 31) for line in (1, 2, 3) for copy in range(2)]
    for name, rows, schema in (("orders", orders, ORDERS), ("lineitem", lines, LINES)):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    states = f"{scratch_path(spark, 'x').rsplit('/', 1)[0]}/latest-*/state"
    earlier = set(glob(states))
    found = QUERIES["stream_latest"](spark, str(tmp_path))
    assert found.count() == found.select("purchase_order_id").distinct().count() == 60
    [state] = set(glob(states)) - earlier
    used = settings(state)
    # 120 copies and what closes the stream
    assert used["spark.sql.shuffle.partitions"] == "3"
    assert used["spark.sql.streaming.stateStore.providerClass"].endswith("RocksDBStateStoreProvider")
    buckets = spark.read.format("statestore").option("batchId", 2).load(state).select("key").distinct().count()
    assert 15 < buckets <= 30
