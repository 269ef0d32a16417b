"""Lineage of order copies: causes, and sums that close the gap of the reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.model import PURCHASE, SALES
from millrace.plans.lineage import lineage_by_flag, trace
from millrace.plans.movements import receipt_lines, shipment_lines
from millrace.plans.reconcile import reconcile
from tests import rows

COPIES = [
    {"purchase_order_id": "A", "quantity": "1"},
    {"purchase_order_id": "A", "quantity": "2"},
    {"purchase_order_id": "B", "quantity": "4"},
    {"purchase_order_id": "B", "quantity": "8", "status": "Delivered"},
    {"purchase_order_id": "C", "quantity": "16"},
    {"purchase_order_id": "C", "quantity": "32", "status": "CREATED"},
    {"purchase_order_id": "D", "quantity": "64"},
    {"purchase_order_id": "D", "quantity": "128", "material_id": "FG0001"},
    {"purchase_order_id": "E", "quantity": "-5"},
    {"purchase_order_id": "E", "quantity": "256"},
    {"purchase_order_id": None, "quantity": "512"},
    {"purchase_order_id": None, "quantity": "1024"},
    {"purchase_order_id": "", "quantity": "2048"},
    {"purchase_order_id": "F", "quantity": None},
    {"purchase_order_id": "G", "quantity": "many"},
    {"purchase_order_id": "H", "quantity": "4096", "expected_delivery_date": ""},
    {"purchase_order_id": "I", "quantity": "8192", "material_id": None},
    {"purchase_order_id": "J", "quantity": "9", "status": "CANCELLED"},
]


def test_causes_of_each_copy(spark):
    m = rows.masters(spark)
    orders = rows.purchase(spark, COPIES)
    ledger = receipt_lines(orders, m["materials"], m["warehouses"])
    traced = trace(orders, m["materials"], ledger, PURCHASE)
    found = {r.bronze_row_id: (r.flag, r.outcome) for r in traced.collect()}
    assert found == {
        1: ("DUPLICATE_ID", "DELAYED"),
        2: ("CLEAN", "BOOKED"),
        3: ("INVALID_STATUS", "SUPPRESSED"),
        5: ("NOT_DELIVERED", "SUPPRESSED"),
        7: ("INVALID_MATERIAL", "SUPPRESSED"),
        8: ("INVALID_MATERIAL", "SUPPRESSED"),
        9: ("NON_POSITIVE_QUANTITY", "SUPPRESSED"),
        10: ("CLEAN", "BOOKED"),
        11: ("MISSING_ID", "SUPPRESSED"),
        12: ("MISSING_ID", "SUPPRESSED"),
        13: ("MISSING_ID", "SUPPRESSED"),
        14: ("MISSING_QUANTITY", "SUPPRESSED"),
        15: ("UNREADABLE_QUANTITY", "SUPPRESSED"),
        16: ("MISSING_DELIVERY_DATE", "SUPPRESSED"),
        17: ("MISSING_MATERIAL", "SUPPRESSED"),
    }
    gap = reconcile(orders, m["materials"], ledger, PURCHASE).select(F.col("naive_quantity") - F.col("ledger_quantity")).first()[0]
    sums = lineage_by_flag(traced).groupBy((F.col("outcome") == "BOOKED").alias("booked")).agg(F.sum("quantity").alias("q"))
    totals = {r.booked: r.q for r in sums.collect()}
    assert totals[False] == gap and totals[True] == ledger.agg(F.sum("quantity")).first()[0] == 258


def test_nothing_to_trace(spark):
    m = rows.masters(spark)
    orders = rows.sales(spark, [{}]).limit(0)
    ledger = shipment_lines(orders, m["materials"], m["warehouses"])
    assert trace(orders, m["materials"], ledger, SALES).collect() == []
