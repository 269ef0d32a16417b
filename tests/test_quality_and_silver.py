import pytest

from millrace import model
from millrace.model import PURCHASE, SALES
from millrace.operators.foreign_keys import repair_material
from millrace.plans import quality
from millrace.plans.silver import silver_orders
from tests import rows

# One bronze purchase order per defect, and the flags it must get.
DEFECTS = [
    ({}, []),
    ({"supplier_id": "SUP901"}, ["UNKNOWN_PARTNER"]),
    ({"material_id": None}, ["MISSING_MATERIAL"]),
    ({"supplier_id": None}, ["MISSING_PARTNER"]),
    ({"order_date": None}, ["MISSING_ORDER_DATE"]),
    ({"quantity": None}, ["MISSING_QUANTITY"]),
    ({"expected_delivery_date": "2025-02-01"}, ["DELIVERY_BEFORE_ORDER"]),
    *(({"status": s}, ["INVALID_STATUS"]) for s in ("DELIVERD", "CONFIRMED ", "confirmed", "PENDING", "SHIPPED", "", None)),
    *(({"quantity": q}, ["NON_POSITIVE_QUANTITY"]) for q in ("0", "-1", "-50")),
    ({"quantity": "9999999"}, ["QUANTITY_OUTLIER"]),
    ({"quantity": "50000"}, []),
    ({"quantity": "many"}, ["UNREADABLE_QUANTITY"]),
    ({"supplier_id": " SUP001 "}, ["PADDED_PARTNER"]),
    *(({"order_date": d}, ["BAD_ORDER_DATE"]) for d in ("15/06/2025", "2025-06-15T00:00:00", "15-Jun-2025", "invalid-date")),
    ({"order_date": ""}, ["MISSING_ORDER_DATE", "BAD_ORDER_DATE"]),
    ({"material_id": "RM999999"}, ["MISSING_MATERIAL", "INVALID_MATERIAL"]),
    ({"material_id": "FG0001"}, ["MISSING_MATERIAL", "INVALID_MATERIAL"]),
    ({"material_id": " RM0001 "}, ["PADDED_MATERIAL"]),
    ({"material_id": "  "}, ["MISSING_MATERIAL", "PADDED_MATERIAL"]),
    ({"expected_delivery_date": ""}, ["MISSING_DELIVERY_DATE"]),
    ({"expected_delivery_date": None}, ["MISSING_DELIVERY_DATE"]),
]


def defective(spark):
    return rows.purchase(spark, [{"purchase_order_id": f"PO{n:06d}", **change} for n, (change, _) in enumerate(DEFECTS)])


@pytest.mark.parametrize("limit", [64 * 1024 * 1024, -1])
def test_every_defect_is_flagged_and_no_other(spark, limit):
    m = rows.masters(spark)
    flagged = quality.flag_orders(defective(spark), m["suppliers"], m["materials"], PURCHASE, limit)
    got = {r.purchase_order_id: r.dq_flags for r in flagged.collect()}
    assert got == {f"PO{n:06d}": flags for n, (_, flags) in enumerate(DEFECTS)}


def test_flags_leave_the_row_as_it_is(spark):
    m = rows.masters(spark)
    flagged = quality.flag_orders(defective(spark), m["suppliers"], m["materials"], PURCHASE)
    assert sorted(map(str, flagged.drop("dq_flags").collect())) == sorted(map(str, defective(spark).collect()))


def test_sales_vocabulary(spark):
    m = rows.masters(spark)
    orders = rows.sales(
        spark, [{"sales_order_id": f"SO{i}", "status": s} for i, s in enumerate(["SHIPPED", "Shipped", "INVOICED", "pending"])]
    )
    flagged = quality.flag_orders(orders, m["customers"], m["materials"], SALES)
    assert {r.status: r.dq_flags for r in flagged.collect()} == {
        "SHIPPED": [], "Shipped": ["INVALID_STATUS"], "INVOICED": ["INVALID_STATUS"], "pending": ["INVALID_STATUS"],
    }


def test_duplicates_conflicting_and_null(spark):
    m = rows.masters(spark)
    orders = rows.purchase(
        spark,
        [{"purchase_order_id": i} for i in ("A", "A", "B", None, None)],
    )
    flagged = quality.flag_orders(orders, m["suppliers"], m["materials"], PURCHASE)
    assert {r.bronze_row_id: "DUPLICATE_ID" in r.dq_flags for r in flagged.collect()} == {
        1: True, 2: True, 3: False, 4: True, 5: True,
    }


def test_silver_types_repairs_and_keeps_rows(spark):
    m = rows.masters(spark)
    orders = rows.purchase(
        spark,
        [
            {"purchase_order_id": "A", "status": "DELIVERED", "supplier_id": " SUP002 ", "quantity": "12.7"},
            {"purchase_order_id": "B", "quantity": "-5", "material_id": "FG0001", "order_date": "15/06/2025"},
            {"purchase_order_id": "A", "status": "CANCELLED", "supplier_id": " SUP002 ", "quantity": "12.7"},
            {"purchase_order_id": None, "quantity": "x"},
            {"purchase_order_id": None},
        ],
    )
    silver = silver_orders(orders, m["suppliers"], m["materials"], PURCHASE)
    assert dict(silver.dtypes)["order_date"] == "date" and dict(silver.dtypes)["quantity"] == "bigint"
    got = {r.purchase_order_id: r for r in silver.collect()}
    assert set(got) == {"A", "B", None}
    a, b, nameless = got["A"], got["B"], got[None]
    assert (a.status, a.supplier_id, a.quantity, a.dq_flags) == ("CANCELLED", "SUP002", 12, ["PADDED_PARTNER", "DUPLICATE_ID"])
    assert (b.quantity, b.material_id, b.order_date) == (-5, None, None)
    assert b.dq_flags == ["MISSING_MATERIAL", "NON_POSITIVE_QUANTITY", "BAD_ORDER_DATE", "INVALID_MATERIAL"]
    assert (nameless.bronze_row_id, nameless.quantity, nameless.dq_flags) == (5, 10, ["DUPLICATE_ID", "MISSING_ID"])


def test_silver_of_an_empty_table(spark):
    m = rows.masters(spark)
    assert silver_orders(rows.purchase(spark, [{}]).limit(0), m["suppliers"], m["materials"], PURCHASE).count() == 0


def test_repair_material(spark):
    m = rows.masters(spark)
    repaired = repair_material(defective(spark), m["materials"], PURCHASE)
    assert repaired.columns == model.BRONZE_PURCHASE_ORDERS.names
    arrived = {r.bronze_row_id: r.material_id for r in defective(spark).collect()}
    for row in repaired.collect():
        text = arrived[row.bronze_row_id]
        assert row.material_id == ("RM0001" if text is not None and text.strip() == "RM0001" else None)


def test_profile_counts_every_flag(spark):
    m = rows.masters(spark)
    flagged = quality.flag_orders(defective(spark), m["suppliers"], m["materials"], PURCHASE)
    got = {r.flag: r.flagged_rows for r in quality.profile(flagged).collect()}
    wanted = {flag: sum(flag in flags for _, flags in DEFECTS) for flag in quality.FLAGS}
    assert got == wanted
    empty = {r.flag: (r.flagged_rows, r.share) for r in quality.profile(flagged.limit(0)).collect()}
    assert set(empty.values()) == {(0, None)}


def test_quarantine_splits_without_loss(spark):
    m = rows.masters(spark)
    flagged = quality.flag_orders(defective(spark), m["suppliers"], m["materials"], PURCHASE)
    accepted, held = quality.quarantine(flagged)
    ids = [r.bronze_row_id for r in accepted.collect()] + [r.bronze_row_id for r in held.collect()]
    assert sorted(ids) == list(range(1, len(DEFECTS) + 1))
    assert all(set(r.dq_flags) & set(quality.BLOCKING) for r in held.collect())


def test_impact_tells_what_reached_the_ledger(spark):
    m = rows.masters(spark)
    orders = rows.purchase(
        spark,
        [{"purchase_order_id": "A"}, {"purchase_order_id": "B", "quantity": "0"}, {"purchase_order_id": "C", "supplier_id": "SUP9"}],
    )
    silver = silver_orders(orders, m["suppliers"], m["materials"], PURCHASE)
    ledger = rows.ledger(
        spark, [(f"IT{i}", "d", "WH001", "RM0001", "GOODS_RECEIPT", 1, ref) for i, ref in enumerate(["A", "C", "C"])]
    )
    got = {tuple(r) for r in quality.impact(silver, ledger, PURCHASE).collect()}
    assert got == {("CLEAN", 1, 1, 0), ("NON_POSITIVE_QUANTITY", 1, 0, 1), ("UNKNOWN_PARTNER", 1, 1, 0)}


def test_flag_vocabulary_is_complete():
    assert set(quality._conditions(PURCHASE)) == set(quality.FLAGS)
