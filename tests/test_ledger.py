import hashlib
from datetime import date

import pytest

from millrace.model import PURCHASE, SALES
from millrace.plans import inventory, movements
from millrace.plans.deliveries import delivery_status, evaluate_suppliers
from millrace.plans.production import production_lines
from millrace.plans.reconcile import reconcile
from tests import rows


def test_dedupe_comes_before_the_status(spark):
    orders = rows.purchase(spark, [{"status": "DELIVERED"}, {"status": "CANCELLED"}])
    assert movements.fulfilled_orders(orders, PURCHASE).count() == 0


def test_status_is_exact(spark):
    orders = rows.sales(
        spark,
        [{"sales_order_id": str(i), "status": s} for i, s in enumerate(["SHIPPED", "DELIVERED", "shipped", "SHIPPED ", "", None])],
    )
    assert {r.sales_order_id for r in movements.fulfilled_orders(orders, SALES).collect()} == {"0", "1"}


def test_goods_receipts(spark):
    m = rows.masters(spark)
    changes = [
        {"quantity": "12.7"},
        {"quantity": "0"},
        {"quantity": None},
        {"material_id": None},
        {"material_id": "FG0001"},
        {"material_id": " RM0001 "},
        {"expected_delivery_date": None},
        {"expected_delivery_date": ""},
        {"expected_delivery_date": "   "},
        {"supplier_id": "SUP999", "order_date": "bad"},
        {"quantity": "9999999"},
        {"status": "DELIVERD"},
    ]
    orders = rows.purchase(spark, [{"purchase_order_id": f"PO{n:06d}", **c} for n, c in enumerate(changes)])
    got = movements.goods_receipts(orders, m["materials"], m["warehouses"], start=999_998).orderBy("transaction_date", "reference_id")
    assert {tuple(r) for r in got.collect()} == {
        ("IT999998", "2025-02-10", "WH001", "RM0001", "GOODS_RECEIPT", 12, "PO000000"),
        ("IT999999", "   ", "WH001", "RM0001", "GOODS_RECEIPT", 10, "PO000008"),
        ("IT1000000", "2025-02-10", "WH001", "RM0001", "GOODS_RECEIPT", 10, "PO000009"),
        ("IT1000001", "2025-02-10", "WH001", "RM0001", "GOODS_RECEIPT", 9999999, "PO000010"),
    }


def test_null_ids_give_no_receipt(spark):
    m = rows.masters(spark)
    orders = rows.purchase(spark, [{"purchase_order_id": None}, {"purchase_order_id": None}, {"purchase_order_id": ""}])
    assert movements.goods_receipts(orders, m["materials"], m["warehouses"]).count() == 0


def test_shipments_go_where_the_hash_says(spark):
    m = rows.masters(spark)
    orders = rows.sales(spark, [{"sales_order_id": f"SO{n:06d}"} for n in range(50)])
    got = movements.sales_shipments(orders, m["materials"], m["warehouses"]).collect()
    finished = ["WH002", "WH003"]
    assert len(got) == 50
    for row in got:
        assert row.warehouse_id == finished[int(hashlib.md5(row.reference_id.encode()).hexdigest(), 16) % 2]


def test_full_ledger_numbers_receipts_first(spark):
    m = rows.masters(spark)
    bought = rows.purchase(spark, [{"purchase_order_id": f"PO{n}"} for n in (3, 1, 2)])
    sold = rows.sales(spark, [{"sales_order_id": f"SO{n}"} for n in (2, 1)])
    got = movements.inventory_transactions(bought, sold, m["materials"], m["warehouses"]).collect()
    assert [(r.transaction_id, r.reference_id) for r in sorted(got, key=lambda r: r.transaction_id)] == [
        ("IT000001", "PO3"), ("IT000002", "PO1"), ("IT000003", "PO2"), ("IT000004", "SO2"), ("IT000005", "SO1"),
    ]


@pytest.mark.parametrize(("kept", "message"), [("%raw%", "finished"), ("%Center", "raw")])
def test_both_kinds_of_warehouse_are_needed(spark, kept, message):
    m = rows.masters(spark)
    some = m["warehouses"].where(f"lower(warehouse_name) LIKE lower('{kept}')")
    with pytest.raises(ValueError, match=message):
        movements.ledger_lines(rows.purchase(spark, [{}]), rows.sales(spark, [{}]), m["materials"], some)


def test_new_receipts_are_booked_once(spark):
    m = rows.masters(spark)
    orders = rows.purchase(spark, [{"purchase_order_id": f"PO{n}"} for n in (1, 2, 3)])
    first = movements.goods_receipts(orders.where("bronze_row_id < 3"), m["materials"], m["warehouses"])
    more = movements.new_receipts(orders, first, m["materials"], m["warehouses"])
    assert [(r.transaction_id, r.reference_id) for r in more.collect()] == [("IT000003", "PO3")]
    again = movements.new_receipts(orders, first.unionByName(more), m["materials"], m["warehouses"])
    assert again.count() == 0
    empty = movements.new_receipts(orders, first.limit(0), m["materials"], m["warehouses"])
    assert empty.count() == 3


def movement(kind, quantity, warehouse="WH001", material="RM0001"):
    return ("IT", "2025-01-01", warehouse, material, kind, quantity, "ref")


def test_inventory_signs_and_guards(spark):
    book = rows.ledger(
        spark,
        [
            movement("GOODS_RECEIPT", 10),
            movement("PRODUCTION_CONSUMPTION", 4),
            movement("STOCK_TRANSFER", 100),
            movement("STOCK_ADJUSTMENT", 100),
            movement("GOODS_RECEIPT", -5),
            movement("GOODS_RECEIPT", None),
            movement(None, 7),
            movement("", 7),
            movement("GOODS_RECEIPT", 5, "", "RM0001"),
            movement("GOODS_RECEIPT", 5, "WH001", None),
            movement("PRODUCTION_RECEIPT", 5, "WH002", "FG0001"),
            movement("SALES_SHIPMENT", 5, "WH002", "FG0001"),
            movement("GOODS_RECEIPT", 5, "WH003", "FG0001"),
            movement("SALES_SHIPMENT", 9, "WH003", "FG0001"),
            movement("STOCK_TRANSFER", 9, "WH004", "FG0001"),
        ],
    )
    assert {tuple(r) for r in inventory.inventory_snapshot(book).collect()} == {("WH001", "RM0001", 6)}
    assert {tuple(r) for r in inventory.balances(book).collect()} == {
        ("WH001", "RM0001", 6), ("WH002", "FG0001", 0), ("WH003", "FG0001", -4),
    }


def test_inventory_reads_text_quantities(spark):
    book = rows.ledger(spark, [movement("GOODS_RECEIPT", 10), movement("SALES_SHIPMENT", 4)])
    text = book.withColumn("quantity", book["quantity"].cast("string"))
    odd = text.unionByName(text.limit(1).selectExpr("* EXCEPT (quantity)", "'2.9' AS quantity"))
    odd = odd.unionByName(text.limit(1).selectExpr("* EXCEPT (quantity)", "'many' AS quantity"))
    assert inventory.inventory_snapshot(odd).first().quantity == 8


def test_balances_can_grow_by_parts(spark):
    one = rows.ledger(spark, [movement("SALES_SHIPMENT", 9)])
    two = rows.ledger(spark, [movement("GOODS_RECEIPT", 10), movement("GOODS_RECEIPT", 1, "WH002")])
    grown = inventory.add_movements(inventory.balances(one), two)
    whole = inventory.balances(one.unionByName(two))
    assert sorted(map(tuple, grown.collect())) == sorted(map(tuple, whole.collect()))


def test_reconciliation_explains_the_gap(spark):
    m = rows.masters(spark)
    orders = rows.purchase(
        spark,
        [
            {"purchase_order_id": "A", "quantity": "10"},
            {"purchase_order_id": "A", "quantity": "11"},
            {"purchase_order_id": "B", "quantity": "7", "material_id": None},
            {"purchase_order_id": "C", "quantity": "-3"},
            {"purchase_order_id": "D", "quantity": "20", "status": "CREATED"},
            {"purchase_order_id": "E", "quantity": "2", "expected_delivery_date": None},
            {"purchase_order_id": "F", "quantity": "x"},
        ],
    )
    receipts = movements.receipt_lines(orders, m["materials"], m["warehouses"])
    row = reconcile(orders, m["materials"], receipts, PURCHASE).first()
    assert row.naive_quantity == 10 + 11 + 7 - 3 + 2
    assert row.superseded_quantity == 10
    assert (row.incomplete_quantity, row.wrong_material_quantity, row.non_positive_quantity) == (2, 7, -3)
    assert (row.not_delivered_quantity, row.clean_quantity, row.ledger_quantity, row.unexplained) == (20, 11, 11, 0)


def test_deliveries(spark):
    orders = rows.purchase(
        spark, [{"purchase_order_id": "A"}, {"purchase_order_id": "B", "expected_delivery_date": "soon"}]
    )
    delivered = spark.createDataFrame(
        [("1", "A", "SUP001", "2025-02-10"), ("2", "A", "SUP001", "2025-02-13"), ("3", "B", "SUP001", "2025-02-13"),
         ("4", "Z", "SUP002", "2025-02-13")],
        "delivery_id string, purchase_order_id string, supplier_id string, delivery_date string",
    ).selectExpr("delivery_id", "purchase_order_id", "supplier_id", "cast(delivery_date as date) delivery_date")
    dated = delivery_status(delivered, orders)
    assert {(r.delivery_id, r.status, r.delay_days) for r in dated.collect()} == {
        ("1", "ON_TIME", 0), ("2", "DELAYED", 3), ("3", None, None), ("4", None, None),
    }
    assert [tuple(r) for r in evaluate_suppliers(dated, date(2025, 3, 1)).collect()] == [
        ("SUP001", date(2025, 3, 1), 50.0, 1.5)
    ]


def test_production_moves_both_sides(spark):
    m = rows.masters(spark)
    output = spark.createDataFrame(
        [("P1", "MO1", "RM0001", 4, "FG0001", 9, "2025-02-01")],
        "production_output_id string, production_order_id string, input_material_id string, input_quantity long, "
        "output_material_id string, output_quantity long, output_date string",
    )
    got = {(r.transaction_type, r.material_id, r.quantity, r.reference_id): r.warehouse_id
           for r in production_lines(output, m["warehouses"]).collect()}
    assert got[("PRODUCTION_CONSUMPTION", "RM0001", 4, "MO1")] == "WH001"
    assert got[("PRODUCTION_RECEIPT", "FG0001", 9, "MO1")] in ("WH002", "WH003")
