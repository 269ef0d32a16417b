"""Ledger folders that are read, stock as base plus changes, masters by bucket."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from millrace.plans.inventory import balances
from millrace.plans.movements import goods_receipts
from millrace.session import scratch_database, scratch_path
from millrace.sources import sinks
from millrace.streaming import references, stock
from millrace.streaming.receipts import book_batch, read_ledger, seed_ledger
from tests import rows


def orders(spark, numbers, prefix="PO", **changed):
    return rows.purchase(spark, [{"purchase_order_id": f"{prefix}{n:06d}", **changed} for n in numbers])


@pytest.fixture
def booked(spark):
    """A ledger with a seed and three batches of far apart numbers."""
    m = rows.masters(spark)
    base = scratch_path(spark, "booked").removeprefix("file:")
    ledger, balance = f"{base}/ledger", f"{base}/balances"
    seed_ledger(goods_receipts(orders(spark, [3]), m["materials"], m["warehouses"]), ledger, balance)
    write = book_batch(ledger, balance, m["materials"], m["warehouses"], run="run")
    for batch, first in enumerate((100, 40_000, 80_000)):
        write(orders(spark, range(first, first + 5)), batch)
    return write, ledger, balance


def quantities(df):
    return {(r.warehouse_id, r.material_id): r.quantity for r in df.collect()}


def test_only_folders_that_meet_a_batch_are_read(spark, booked):
    _, ledger, _ = booked
    every = references.folders(spark, ledger)
    assert every == {("seed", 0), ("run", 0), ("run", 1), ("run", 2)}

    def met(batch):
        return references.meeting(batch, ledger, every)

    assert met(orders(spark, [40_002, 999_999])) == {("run", 1)}
    assert met(orders(spark, [3, 80_001])) == {("seed", 0), ("run", 2)}
    assert met(orders(spark, [104, 105, 40_005])) == {("run", 0)}
    assert met(orders(spark, [7])) == met(orders(spark, []).limit(0)) == met(orders(spark, [1], "XX")) == set()
    assert met(orders(spark, [3], purchase_order_id=None)) == set()
    read = read_ledger(spark, ledger).where(references.of_folders(met(orders(spark, [40_002]))))
    folders_read = {f.split("receipt_batch=")[0][-4:-1] + f.split("receipt_batch=")[1][0] for f in read.inputFiles()}
    assert len(read.inputFiles()) <= 8 and read.count() == 5 and folders_read


def test_a_folder_without_bitmaps_is_read(spark, booked):
    write, ledger, balance = booked
    references_of = references.folder(references.references_path(ledger), "run", 1)
    for path in glob.glob(f"{references_of}/*") + glob.glob(f"{references_of}/.*"):
        os.remove(path)
    every = references.folders(spark, ledger)
    assert references.meeting(orders(spark, [7]), ledger, every) == {("run", 1)}
    write(orders(spark, [40_001, 500]), 3)
    assert sorted(r.reference_id for r in read_ledger(spark, ledger).where("receipt_batch = 3").collect()) == ["PO000500"]


def test_ids_of_another_form_are_compared_too(spark, booked):
    write, ledger, _ = booked
    odd = orders(spark, [1, 2], "X-").unionByName(orders(spark, [0], purchase_order_id="PO40001")).withColumn("bronze_row_id", F.monotonically_increasing_id())
    write(odd, 3)
    write(odd, 4)
    ids = [r.reference_id for r in read_ledger(spark, ledger).where("receipt_batch >= 3").collect()]
    assert sorted(ids) == ["PO40001", "X-000001", "X-000002"]  # another text than PO040001, so another order
    numbers = [r.transaction_id for r in read_ledger(spark, ledger).collect()]
    assert len(set(numbers)) == len(numbers) == 19


def test_stock_before_and_after_compaction(spark, booked):
    write, ledger, balance = booked
    whole = lambda: quantities(balances(read_ledger(spark, ledger)))
    assert quantities(stock.read_balances(spark, balance)) == whole()
    write(orders(spark, [200], quantity="7"), 3)
    while stock.compact(spark, balance, share=0.0):
        pass
    assert quantities(stock.read_balances(spark, balance)) == whole()
    assert not stock.compact(spark, balance, share=0.0)
    before = quantities(stock.read_stock(spark, balance))
    write(orders(spark, [200], quantity="7"), 3)  # a replay of what the base has already
    assert quantities(stock.read_stock(spark, balance)) == before == whole()
    write(orders(spark, [201], quantity="9"), 4)
    assert quantities(stock.read_stock(spark, balance)) == whole() != before
    for batch in range(5, 9):
        write(orders(spark, [300 + batch]), batch)
        stock.compact(spark, balance, share=0.0)
    assert len(glob.glob(f"{balance}/base/version=*")) == 2
    assert len(references.folders(spark, f"{balance}/changes")) <= 2
    name = f"{scratch_database(spark, 'stock')}.inventory"
    assert stock.publish_stock(spark, balance, name) == len(whole())
    assert quantities(spark.table(name)) == whole()


def test_changes_of_a_writer_that_was_ended_are_added(spark, booked):
    _, ledger, balance = booked
    m = rows.masters(spark)
    goods_receipts(orders(spark, [900]), m["materials"], m["warehouses"], 50).write.parquet(references.folder(ledger, "run", 3))
    book_batch(ledger, balance, m["materials"], m["warehouses"], run="another")(orders(spark, [901]), 0)
    assert quantities(stock.read_balances(spark, balance)) == quantities(balances(read_ledger(spark, ledger)))
    numbers = [r.transaction_id for r in read_ledger(spark, ledger).collect()]
    assert len(set(numbers)) == len(numbers)


def test_a_batch_rewrites_its_own_buckets_only(spark):
    name = f"{scratch_database(spark, 'masters')}.suppliers"
    written = {}
    for size in (200, 4000):
        table = f"{name}_{size}"
        many = spark.range(size).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("k"), F.lit("old").alias("v"))
        assert sinks.upsert_buckets(many, table, "k", buckets=16) == size
        before = set(spark.table(table).inputFiles())
        batch = spark.createDataFrame([("S7", "new"), ], "k string, v string")
        assert sinks.upsert_buckets(batch, table, "k", buckets=16) == 1
        now = set(spark.table(table).inputFiles())
        assert len({f.split("_bucket=")[1].split("/")[0] for f in now - before}) == 1
        written[size] = len(now - before)
        found = {r.k: (r.v, r.created_at <= r.updated_at) for r in spark.table(table).collect()}
        assert len(found) == size and found["S7"] == ("new", True) and found["S8"] == ("old", True)
        assert sinks.upsert_buckets(spark.createDataFrame([("new key", "x")], "k string, v string"), table, "k", buckets=16) == 1
        assert spark.table(table).count() == size + 1
        assert sinks.upsert_buckets(batch.limit(0), table, "k", buckets=16) == 0
        with pytest.raises(ValueError):
            sinks.upsert_buckets(batch.union(batch), table, "k", buckets=16)
    assert written[200] == written[4000] == 1
