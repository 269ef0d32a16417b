from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from millrace import model
from millrace.model import PURCHASE
from millrace.plans import bronze, gold
from millrace.session import CHECKPOINT_SETTING, checkpoint_root, scratch_database, scratch_path
from millrace.sources import ledger as stored
from millrace.sources import readers, sinks
from millrace.sources.gold import refresh_gold, refresh_silver, write_gold
from tests import rows


@pytest.fixture
def db(spark):
    return scratch_database(spark, "test")


def test_scratch_lies_in_the_shared_folder_the_cluster_names(spark):
    named = spark.conf.get(CHECKPOINT_SETTING)
    assert checkpoint_root(spark) == named
    assert scratch_path(spark, "x").startswith(named)


def test_append_keeps_duplicates_and_stamps_rows(spark, db):
    frame = spark.createDataFrame([("a",), ("a",)], "id string")
    assert sinks.append_table(frame, f"{db}.t") == 2
    assert sinks.append_table(frame, f"{db}.t") == 2
    table = spark.table(f"{db}.t")
    assert table.count() == 4 and table.where("created_at IS NULL OR updated_at IS NULL").count() == 0


def test_replace_may_read_its_own_table(spark, db):
    name = f"{db}.snapshot"
    assert sinks.replace_table(spark.range(5), name) == 5
    assert sinks.replace_table(spark.table(name).where("id > 2"), name) == 2
    assert {r.id for r in spark.table(name).collect()} == {3, 4}


def test_replace_by_nothing_leaves_nothing(spark, db):
    name = f"{db}.snapshot"
    sinks.replace_table(spark.range(5), name)
    assert sinks.replace_table(spark.range(0), name) == 0
    assert spark.table(name).count() == 0


def test_replace_that_fails_leaves_the_old_rows(spark, db):
    name = f"{db}.snapshot"
    sinks.replace_table(spark.range(5), name)
    broken = spark.range(5).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="boom"):
        sinks.replace_table(broken, name)
    assert spark.table(name).count() == 5


def test_replace_keeps_two_versions(spark, db):
    for n in range(5):
        sinks.replace_table(spark.range(n), f"{db}.snapshot")
    assert len(sinks._versions(spark, f"{db}.snapshot")) == sinks.KEPT_VERSIONS


def test_append_replace_append_repair_keep_all_rows(spark, db):
    name = f"{db}.orders"
    first, second = (rows.purchase(spark, [{"purchase_order_id": x, "material_id": m}]) for x, m in (("A", "RM0001"), ("B", "FG0001")))
    assert sinks.append_table(first, name) == 1
    assert sinks.replace_table(spark.table(name), name) == 1
    assert sinks.append_table(second, name) == 1
    assert stored.repair_stored_orders(spark, name, rows.masters(spark)["materials"], PURCHASE) == 2
    assert {(r.purchase_order_id, r.material_id) for r in spark.table(name).collect()} == {("A", "RM0001"), ("B", None)}


def test_names_that_look_like_versions_are_left_alone(spark, db):
    spark.range(3).write.saveAsTable(f"{db}.stock__v0_audit")
    spark.range(3).write.saveAsTable(f"{db}.stock__v1")
    for n in range(4):
        sinks.replace_table(spark.range(n), f"{db}.stock")
    assert sinks.append_table(spark.range(5).withColumns({"created_at": F.current_timestamp(), "updated_at": F.current_timestamp()}), f"{db}.other") == 5
    assert spark.table(f"{db}.stock__v0_audit").count() == spark.table(f"{db}.stock__v1").count() == 3
    assert spark.table(f"{db}.stock").count() == 3


def test_a_plain_table_is_not_replaced(spark, db):
    spark.range(3).write.saveAsTable(f"{db}.plain")
    before = {t.name for t in spark.catalog.listTables(db)}
    with pytest.raises(ValueError, match="plain"):
        sinks.replace_table(spark.range(1), f"{db}.plain")
    assert {t.name for t in spark.catalog.listTables(db)} == before
    assert spark.table(f"{db}.plain").count() == 3


def test_a_version_left_over_is_written_anew(spark, db):
    name = f"{db}.snapshot"
    sinks.replace_table(spark.range(2), name)
    spark.range(99).write.saveAsTable(sinks._version_name(name, 2))
    assert sinks.replace_table(spark.range(7), name) == 7
    assert spark.table(name).count() == 7


def test_columns_that_would_be_lost_raise(spark, db):
    name = f"{db}.suppliers"
    sinks.upsert_table(rows.masters(spark)["suppliers"], name, "supplier_id")
    batch = spark.createDataFrame([("SUP001", "x", "BE", 1)], "supplier_id string, supplier_name string, country string, rank int")
    for other in (batch, batch.drop("rank", "country")):
        with pytest.raises(ValueError, match="columns"):
            sinks.upsert_table(other, name, "supplier_id")


def test_upsert_table(spark, db):
    name, first, second = f"{db}.suppliers", datetime(2025, 1, 1), datetime(2025, 2, 1)
    m = rows.masters(spark)["suppliers"]
    assert sinks.upsert_table(m, name, "supplier_id", now=first) == 3
    batch = spark.createDataFrame([("SUP001", "renamed", "BE"), ("SUP009", "new", "BE")], model.SUPPLIERS)
    assert sinks.upsert_table(batch, name, "supplier_id", now=second) == 2
    got = {r.supplier_id: (r.supplier_name, r.created_at, r.updated_at) for r in spark.table(name).collect()}
    assert got["SUP001"] == ("renamed", first, second)
    assert got["SUP009"] == ("new", second, second)
    assert got["SUP002"] == ("two", first, first)
    with pytest.raises(ValueError):
        sinks.upsert_table(batch.union(batch), name, "supplier_id")
    with pytest.raises(ValueError):
        sinks.upsert_table(batch.union(batch), f"{db}.fresh", "supplier_id")
    assert sinks.upsert_table(batch.limit(0), name, "supplier_id") == 0


def test_replace_months_leaves_the_others(spark):
    path = scratch_path(spark, "months")
    frame = spark.createDataFrame([(date(2025, 1, 1), 1), (date(2025, 2, 1), 2)], "order_month date, v int")
    sinks.replace_months(frame, path)
    assert sinks.replace_months(frame.where("v = 2").withColumn("v", F.lit(9)), path) == 1
    assert {r.v for r in spark.read.parquet(path).collect()} == {1, 9}


def test_a_month_without_orders_goes(spark, db):
    name = f"{db}.silver"
    for month in (1, 2):
        sinks.write_silver(spark.createDataFrame([(1, date(2025, month, 5))], "id int, order_date date"), name)
    assert [(r.id, r.order_month) for r in spark.table(name).collect()] == [(1, date(2025, 2, 1))]


def test_silver_that_fails_or_reads_itself_keeps_the_old_orders(spark, db):
    name = f"{db}.silver"
    sinks.write_silver(spark.createDataFrame([(n, date(2025, n, 5)) for n in (1, 2, 3)], "id int, order_date date"), name)
    with pytest.raises(Exception, match="boom"):
        sinks.write_silver(spark.table(name).withColumn("id", F.raise_error(F.lit("boom")).cast("int")), name)
    assert spark.table(name).count() == 3
    assert sinks.write_silver(spark.table(name).where("id > 1").drop("order_month"), name) == 2
    assert {r.id for r in spark.table(name).collect()} == {2, 3}


def test_silver_is_stored_by_month_in_few_files(spark, db):
    name = f"{db}.silver"
    orders = spark.range(2000).repartition(16).selectExpr(
        "id", "CASE WHEN id % 3 > 0 THEN make_date(2025, cast(id % 6 + 1 AS int), 5) END AS order_date"
    )
    assert sinks.write_silver(orders, name) == 2000
    stored_orders = spark.table(name)
    assert stored_orders.count() == 2000
    assert len(stored_orders.inputFiles()) <= 3 * 5
    assert stored_orders.where("order_month IS NULL").count() == 667


def test_csv_keeps_padding_and_can_keep_empty_text(spark):
    orders = rows.purchase(spark, [{"supplier_id": " SUP001 ", "status": "", "quantity": None}]).drop("bronze_row_id")
    plain, exact = scratch_path(spark, "csv"), scratch_path(spark, "csv")
    assert sinks.write_csv(orders, plain) == 1
    sinks.write_csv(orders, exact, "\\N")
    back = readers.read_csv(spark, plain, model.RAW_PURCHASE_ORDERS).first()
    assert (back.supplier_id, back.status, back.quantity) == (" SUP001 ", None, None)
    back = readers.read_csv(spark, exact, model.RAW_PURCHASE_ORDERS, "\\N").first()
    assert (back.supplier_id, back.status, back.quantity) == (" SUP001 ", "", None)


def test_csv_is_read_by_name_with_standard_quotes(spark, tmp_path):
    swapped = tmp_path / "swapped.csv"
    swapped.write_text('supplier_name,extra,supplier_id\n"Acme ""Best"", Ltd",1,SUP001\n')
    got = readers.read_csv(spark, str(swapped), model.SUPPLIERS).collect()
    assert [tuple(r) for r in got] == [("SUP001", 'Acme "Best", Ltd', None)]
    frame = spark.createDataFrame([("SUP001", 'two\nlines, "quoted"', " NL ")], model.SUPPLIERS)
    path = scratch_path(spark, "csv")
    sinks.write_csv(frame, path)
    assert readers.read_csv(spark, path, model.SUPPLIERS, multi_line=True).collect() == frame.collect()


def test_surplus_fields_and_another_header_raise(spark, tmp_path):
    (tmp_path / "a.csv").write_text("supplier_id,supplier_name,country\nSUP001,Acme, Inc,DE\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE"):
        readers.read_csv(spark, str(tmp_path / "a.csv"), model.SUPPLIERS).select("supplier_id").collect()
    (tmp_path / "a.csv").write_text("supplier_id,supplier_name,country\nSUP001,Acme,DE\n")
    (tmp_path / "b.csv").write_text("supplier_name,supplier_id,country\nAcme,SUP002,DE\n")
    with pytest.raises(Exception, match="(?i)header|FAILED_READ_FILE"):
        readers.read_csv(spark, str(tmp_path), model.SUPPLIERS).collect()


def test_import_keeps_the_last_row_in_file_order(spark, tmp_path):
    header = ",".join(model.RAW_PURCHASE_ORDERS.names)
    for name, quantities in (("purchase_orders_b.csv", [3, 4]), ("purchase_orders_a.csv", [1, 2])):
        lines = [f"PO1,2025-01-01,SUP001,RM0001,{q},2025-01-02,CREATED" for q in quantities]
        (tmp_path / name).write_text("\n".join([header, *lines]) + "\n")
    got = readers.import_csv(spark, f"{tmp_path}/purchase_orders_*.csv", model.RAW_PURCHASE_ORDERS, PURCHASE.id)
    assert [(r.purchase_order_id, r.quantity) for r in got.collect()] == [("PO1", "4")]


def test_rows_in_file_order_carry_no_path(spark, tmp_path):
    header = ",".join(model.RAW_PURCHASE_ORDERS.names)
    for n, name in enumerate(("a b.csv", "a%20b.csv", "ä.csv", "z.csv")):
        (tmp_path / name).write_text(f"{header}\nPO1,2025-01-01,SUP001,RM0001,{n},2025-01-02,CREATED\n")
    ordered = readers.with_file_order(readers.read_csv(spark, str(tmp_path), model.RAW_PURCHASE_ORDERS))
    assert dict(ordered.dtypes)["_file"] == "int"
    paths = [r[0] for r in readers.read_csv(spark, str(tmp_path), model.RAW_PURCHASE_ORDERS).select("_metadata.file_path").collect()]
    by_number = ordered.orderBy("_file").select("_file", "quantity").collect()
    assert [r._file for r in by_number] == [0, 1, 2, 3] and len(set(paths)) == 4
    got = readers.import_csv(spark, str(tmp_path), model.RAW_PURCHASE_ORDERS, PURCHASE.id).collect()
    assert [r.quantity for r in got] == [by_number[-1].quantity]


def test_import_order_holds_over_many_splits(spark, tmp_path):
    header = ",".join(model.RAW_PURCHASE_ORDERS.names)
    lines = [f"PO{n % 50},2025-01-01,SUP001,RM0001,{n},2025-01-02,CREATED" for n in range(4000)]
    (tmp_path / "orders.csv").write_text("\n".join([header, *lines]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        scan = readers.read_csv(spark, str(tmp_path), model.RAW_PURCHASE_ORDERS)
        assert scan.select(F.spark_partition_id()).distinct().count() > 5
        got = readers.import_csv(spark, str(tmp_path), model.RAW_PURCHASE_ORDERS, PURCHASE.id).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(int(r.quantity) for r in got) == list(range(3950, 4000))


def test_bronze_conform_is_text_with_fresh_row_ids(spark):
    typed = spark.createDataFrame([("PO1", date(2025, 1, 1), 5)], "purchase_order_id string, order_date date, quantity long")
    got = bronze.conform(typed, model.RAW_PURCHASE_ORDERS, above=41)
    assert got.columns == model.BRONZE_PURCHASE_ORDERS.names
    row = got.first()
    assert (row.order_date, row.quantity, row.status) == ("2025-01-01", "5", None)
    assert row.bronze_row_id > 41 and bronze.highest_row_id(got) == row.bronze_row_id
    assert bronze.highest_row_id(got.limit(0)) == 0


def test_read_table_gives_declared_columns(spark, db):
    sinks.append_table(rows.masters(spark)["suppliers"], f"{db}.suppliers")
    assert readers.read_table(spark, "suppliers", db).columns == model.SUPPLIERS.names


def test_jdbc_scan_is_split_on_the_row_id():
    split = readers.JdbcSplit("bronze_row_id", 1, 1001, 8)
    options = readers.jdbc_options("jdbc:db:x", "purchase_orders", split)
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == (
        "bronze_row_id", "1", "1001", "8",
    )
    assert "partitionColumn" not in readers.jdbc_options("jdbc:db:x", "purchase_orders")


def test_rebuild_replaces_and_sync_adds_once(spark, db):
    m = rows.masters(spark)
    book, stock = f"{db}.inventory_transactions", f"{db}.inventory"
    orders = rows.purchase(spark, [{"purchase_order_id": f"PO{n}"} for n in (1, 2, 3)])
    sold = rows.sales(spark, [{}])
    early = orders.where("bronze_row_id < 3")
    for _ in range(2):
        counts = stored.rebuild_ledger(early, sold, m["materials"], m["warehouses"], book, stock)
        assert counts == {"inventory_transactions": 3, "inventory": 1}
    assert spark.table(book).count() == 3
    assert [tuple(r) for r in sinks.without_audit(spark.table(stock)).collect()] == [("WH001", "RM0001", 20)]
    assert spark.table(stock).first().updated_at is not None

    counts = stored.sync_receipts(orders, m["materials"], m["warehouses"], book, stock)
    assert counts == {"goods_receipts": 1, "inventory_transactions": 1, "inventory": 1}
    assert spark.table(stock).first().quantity == 30
    counts = stored.sync_receipts(orders, m["materials"], m["warehouses"], book, stock)
    assert counts == {"goods_receipts": 0, "inventory_transactions": 0, "inventory": 1}
    ids = sorted(r.transaction_id for r in spark.table(book).collect())
    assert ids == ["IT000001", "IT000002", "IT000003", "IT000004"]


def test_stored_orders_are_repaired_in_place(spark, db):
    name = f"{db}.purchase_orders"
    sinks.replace_table(rows.purchase(spark, [{"purchase_order_id": "A"}, {"purchase_order_id": "B", "material_id": "FG0001"}]), name)
    assert stored.repair_stored_orders(spark, name, rows.masters(spark)["materials"], PURCHASE) == 2
    assert {(r.purchase_order_id, r.material_id) for r in spark.table(name).collect()} == {("A", "RM0001"), ("B", None)}


def test_written_gold_equals_computed_gold(spark, db):
    from tests.test_gold import example

    bought, sold, m = example(spark)
    counts = write_gold(bought, sold, m["suppliers"], m["customers"], m["materials"], db)
    tables = gold.gold_tables(bought, sold, m["suppliers"], m["customers"], m["materials"])
    assert set(counts) == set(tables) and len(tables) == 9
    for name, table in tables.items():
        written = sorted(map(str, spark.table(f"{db}.{name}").collect()))
        assert written == sorted(map(str, table.collect())), name
        assert counts[name] == len(written)


def test_bronze_to_gold_through_stored_tables(spark, db):
    from tests.test_gold import example

    m = rows.masters(spark)
    changes = [{"purchase_order_id": "A", "quantity": " 5 "}, {"purchase_order_id": "B", "material_id": "FG0001"}]
    sinks.append_table(rows.purchase(spark, changes), f"{db}.purchase_orders")
    sinks.append_table(rows.sales(spark, [{}, {"status": "CANCELLED"}]), f"{db}.sales_orders")
    for name in ("materials", "suppliers", "customers"):
        sinks.upsert_table(m[name], f"{db}.{name}", model.MASTER_KEYS[name])
    assert refresh_silver(spark, db, db) == {
        "silver_purchase_orders": 2, "silver_sales_orders": 1,
        "silver_materials": 3, "silver_suppliers": 3, "silver_customers": 2,
    }
    assert spark.table(f"{db}.silver_purchase_orders").columns == model.SILVER_PURCHASE_ORDERS.names
    counts = refresh_gold(spark, db, db)
    assert set(counts) == set(gold.gold_tables(*example(spark)[:2], m["suppliers"], m["customers"], m["materials"]))
    row = spark.table(f"{db}.gold_supplier_performance").first()
    assert (row.total_orders, row.total_quantity) == (2, 15)
    assert refresh_gold(spark, db, db) == counts


def test_names_do_not_clash(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
