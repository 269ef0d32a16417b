import pytest
from pyspark.sql import functions as F

from millrace import model
from millrace.plans.inventory import balances, inventory_snapshot
from millrace.plans.movements import goods_receipts
from millrace.session import scratch_database, scratch_path
from millrace.sources.sinks import without_audit, write_csv
from millrace.plans.bronze import row_ids
from millrace.streaming.ingest import ingest_files, write_batch
from millrace.streaming.masters import upsert_stream
from millrace.streaming.receipts import book_batch, book_receipts, read_ledger, seed_ledger, stream_bronze
from tests import rows


def orders(spark, numbers):
    return rows.purchase(spark, [{"purchase_order_id": f"PO{n:06d}"} for n in numbers])


def test_each_file_is_ingested_once(spark):
    base = scratch_path(spark, "ingest")
    write_csv(orders(spark, range(10)).drop("bronze_row_id"), f"{base}/landing/one")

    def run():
        ingest_files(spark, f"{base}/landing/*", model.RAW_PURCHASE_ORDERS, f"{base}/bronze", f"{base}/state").awaitTermination()
        return spark.read.parquet(f"{base}/bronze")

    assert run().count() == 10
    assert run().count() == 10
    write_csv(orders(spark, range(10, 15)).drop("bronze_row_id"), f"{base}/landing/two")
    table = run()
    assert table.count() == 15
    assert table.select("bronze_row_id").distinct().count() == 15
    assert table.where("source_file IS NULL OR ingested_at IS NULL").count() == 0
    ranges = table.groupBy("ingest_batch").agg(F.min("bronze_row_id").alias("a"), F.max("bronze_row_id").alias("b"))
    (low, high) = sorted((r.a, r.b) for r in ranges.collect())
    assert low[1] < high[0]


def test_a_replayed_ingest_batch_writes_the_same(spark):
    target = scratch_path(spark, "replay")
    batch = orders(spark, range(20)).drop("bronze_row_id").coalesce(1)
    for _ in range(2):
        write_batch(target, "run")(batch, 3)
    table = spark.read.parquet(target)
    assert table.count() == 20 and table.select("bronze_row_id").distinct().count() == 20


def test_row_ids_raise_when_none_is_left(spark):
    assert spark.range(1).coalesce(1).select(row_ids(2**62)).first()[0] == 2**62 + 1
    with pytest.raises(Exception, match="no row ids left"):
        spark.range(5).coalesce(1).select(row_ids(2**63 - 4)).collect()


def test_two_landing_folders_and_a_batch_load_fill_one_table(spark):
    base = scratch_path(spark, "ingest")
    for part, numbers in enumerate((range(4), range(4, 9))):
        write_csv(orders(spark, numbers).drop("bronze_row_id"), f"{base}/landing-{part}")
        ingest_files(
            spark, f"{base}/landing-{part}", model.RAW_PURCHASE_ORDERS, f"{base}/bronze", f"{base}/state-{part}", floor=lambda: 10**15
        ).awaitTermination()
    table = spark.read.parquet(f"{base}/bronze")
    assert table.count() == table.select("bronze_row_id").distinct().count() == 9
    assert table.agg(F.min("bronze_row_id")).first()[0] > 10**15


def test_an_older_change_in_a_later_batch_changes_nothing(spark):
    base, table = scratch_path(spark, "masters"), f"{scratch_database(spark, 'masters')}.suppliers"
    fields = "supplier_id string, supplier_name string, country string, change int"

    def run(changes, state):
        spark.createDataFrame(changes, fields).write.mode("append").parquet(f"{base}/changes")
        stream = spark.readStream.schema(fields).parquet(f"{base}/changes")
        upsert_stream(stream, table, "supplier_id", "change", f"{base}/{state}").awaitTermination()
        spark.catalog.refreshTable(table)
        return {r.supplier_id: (r.supplier_name, r.change) for r in spark.table(table).collect()}

    assert run([("S1", "new", "NL", 5)], "one") == {"S1": ("new", 5)}
    assert run([("S1", "old", "NL", 4), ("S2", "first", "NL", None)], "one") == {"S1": ("new", 5), "S2": ("first", None)}
    stamps = {r.supplier_id: r.updated_at for r in spark.table(table).collect()}
    assert run([("S1", "older", "NL", 1), ("S2", "second", "NL", 1)], "fresh") == {"S1": ("new", 5), "S2": ("second", 1)}
    assert next(r.updated_at for r in spark.table(table).collect() if r.supplier_id == "S1") == stamps["S1"]


def test_a_fresh_checkpoint_books_nothing_twice(spark):
    m = rows.masters(spark)
    base, snapshot = scratch_path(spark, "receipts"), f"{scratch_database(spark, 'stock')}.inventory"
    ledger, balance = f"{base}/ledger", f"{base}/balances"
    seed_ledger(goods_receipts(orders(spark, [3]), m["materials"], m["warehouses"]), ledger, balance)
    for run in range(3):
        orders(spark, range(2 * run, 2 * run + 4)).coalesce(1).write.mode("append").parquet(f"{base}/bronze")
        stream = stream_bronze(spark, f"{base}/bronze", model.BRONZE_PURCHASE_ORDERS, files_per_batch=1)
        book_receipts(stream, ledger, balance, m["materials"], m["warehouses"], snapshot, f"{base}/state-{run}").awaitTermination()
    booked = read_ledger(spark, ledger)
    assert booked.count() == booked.select("reference_id").distinct().count() == booked.select("transaction_id").distinct().count() == 8
    assert [r.quantity for r in spark.table(snapshot).collect()] == [80]


def test_later_change_of_a_master_wins(spark):
    base, table = scratch_path(spark, "masters"), f"{scratch_database(spark, 'masters')}.suppliers"
    fields = "supplier_id string, supplier_name string, country string, change int"

    def run(changes):
        spark.createDataFrame(changes, fields).write.mode("append").parquet(f"{base}/changes")
        stream = spark.readStream.schema(fields).parquet(f"{base}/changes")
        upsert_stream(stream, table, "supplier_id", "change", f"{base}/state").awaitTermination()
        spark.catalog.refreshTable(table)
        return {r.supplier_id: r.supplier_name for r in spark.table(table).collect()}

    assert run([("S1", "old", "NL", 1), ("S1", "new", "NL", 2), ("S2", "two", "NL", 1)]) == {"S1": "new", "S2": "two"}
    assert run([("S2", "three", "NL", 3)]) == {"S1": "new", "S2": "three"}


def test_streamed_receipts_equal_one_batch(spark):
    m = rows.masters(spark)
    base, snapshot = scratch_path(spark, "receipts"), f"{scratch_database(spark, 'stock')}.inventory"
    ledger, balance = f"{base}/ledger", f"{base}/balances"
    everything = orders(spark, range(30))
    seed_ledger(goods_receipts(orders(spark, [3, 7]), m["materials"], m["warehouses"]), ledger, balance)

    def run():
        stream = stream_bronze(spark, f"{base}/bronze", model.BRONZE_PURCHASE_ORDERS, files_per_batch=1)
        book_receipts(stream, ledger, balance, m["materials"], m["warehouses"], snapshot, f"{base}/state").awaitTermination()
        return read_ledger(spark, ledger)

    everything.where("bronze_row_id <= 12").coalesce(1).write.mode("append").parquet(f"{base}/bronze")
    assert run().count() == 12
    everything.where("bronze_row_id > 12").coalesce(1).write.mode("append").parquet(f"{base}/bronze")
    # Orders that arrive a second time change nothing.
    everything.coalesce(1).write.mode("append").parquet(f"{base}/bronze")
    booked = run()
    once = goods_receipts(everything, m["materials"], m["warehouses"])
    columns = ["transaction_date", "warehouse_id", "material_id", "transaction_type", "quantity", "reference_id"]
    assert sorted(map(tuple, booked.select(*columns).collect())) == sorted(map(tuple, once.select(*columns).collect()))
    assert booked.select("transaction_id").distinct().count() == 30
    assert sorted(map(tuple, without_audit(spark.table(snapshot)).collect())) == sorted(map(tuple, inventory_snapshot(once).collect()))


def test_a_replayed_receipt_batch_books_nothing_twice(spark):
    m = rows.masters(spark)
    base, snapshot = scratch_path(spark, "receipts"), f"{scratch_database(spark, 'stock')}.inventory"
    ledger, balance = f"{base}/ledger", f"{base}/balances"
    empty = goods_receipts(orders(spark, [1]).limit(0), m["materials"], m["warehouses"])
    seed_ledger(empty, ledger, balance)
    write = book_batch(ledger, balance, m["materials"], m["warehouses"], snapshot, "run")
    write(orders(spark, range(5)), 0)
    write(orders(spark, range(3, 9)), 1)
    before = sorted(map(tuple, read_ledger(spark, ledger).collect()))
    write(orders(spark, range(3, 9)), 1)
    assert sorted(map(tuple, read_ledger(spark, ledger).collect())) == before
    assert len(before) == 9
    assert [r.quantity for r in spark.table(snapshot).collect()] == [90]
    assert [r.quantity for r in balances(read_ledger(spark, ledger)).collect()] == [90]
