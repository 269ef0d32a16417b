"""Ledger, stock and flags against plain Python on random defective orders."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from millrace.model import PURCHASE, SALES
from millrace.plans import quality
from millrace.plans.inventory import inventory_snapshot
from millrace.plans.movements import inventory_transactions, new_receipts
from tests import rows

QUANTITIES = ["5", "12.7", " 8 ", "1e2", "0", "-3", "0.9", "", None, "x", "nan", "inf", "1_0", "9999999"]
MATERIALS = ["RM0001", "RM0002", "FG0001", "FG0002", " RM0001", "", None]
DAYS = ["2025-02-03", "2025-01-31", "03/02/2025", "", " ", None]
STATUSES = ["DELIVERED", "DELIVERED", "DELIVERED", "SHIPPED", "CONFIRMED", "delivered", "DELIVERED ", "", None]


def random_orders(kind, prefix, seed):
    rng = random.Random(seed)

    def pick(values):
        """Half of the time a good value, which comes first."""
        return values[0] if rng.random() < 0.5 else rng.choice(values)

    materials = MATERIALS if kind is PURCHASE else ["FG0001", *MATERIALS]
    return [
        {
            kind.id: rng.choice([None, "", *(f"{prefix}{n:06d}" for n in range(200))]),
            kind.partner: pick(["SUP001", "CUS001", " SUP002 ", "SUP900", "", None]),
            "material_id": pick(materials),
            "quantity": pick(QUANTITIES),
            "order_date": pick(DAYS),
            kind.delivery: pick(DAYS),
            "status": pick(STATUSES),
        }
        for _ in range(400)
    ]


def whole(text):
    try:
        value = float(text)
        return int(value)
    except (TypeError, ValueError, OverflowError):
        return None


def movements_of(orders, kind, material_type, warehouse_of):
    latest = {}
    for number, order in enumerate(orders):
        latest[order[kind.id]] = (number, order)
    known = {m for m, _, t in rows.MATERIALS if t == material_type}
    for _, order in sorted(latest.values(), key=lambda pair: pair[0]):
        quantity = whole(order["quantity"])
        usable = order[kind.id] and order["material_id"] in known and order[kind.delivery] and quantity and quantity > 0
        if usable and order["status"] in kind.moves_stock:
            yield (order[kind.delivery], warehouse_of(order[kind.id]), order["material_id"], kind.movement, quantity, order[kind.id])


def finished(order_id):
    return ["WH002", "WH003"][int(hashlib.md5(order_id.encode()).hexdigest(), 16) % 2]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ledger_and_stock(spark, seed):
    m = rows.masters(spark)
    bought, sold = random_orders(PURCHASE, "PO", seed), random_orders(SALES, "SO", seed + 100)
    receipts = list(movements_of(bought, PURCHASE, "RAW_MATERIAL", lambda _: "WH001"))
    shipments = list(movements_of(sold, SALES, "FINISHED_GOOD", finished))
    wanted = [(f"IT{n:06d}", *line) for n, line in enumerate(receipts + shipments, 1)]

    ledger = inventory_transactions(
        rows.purchase(spark, bought), rows.sales(spark, sold), m["materials"], m["warehouses"]
    )
    assert sorted(map(tuple, ledger.collect())) == sorted(wanted)
    assert len(receipts) > 5 and len(shipments) > 5

    stock = defaultdict(int)
    for _, _, warehouse, material, movement, quantity, _ in wanted:
        stock[warehouse, material] += quantity if movement == "GOODS_RECEIPT" else -quantity
    positive = {(*key, quantity) for key, quantity in stock.items() if quantity > 0}
    assert {tuple(r) for r in inventory_snapshot(ledger).collect()} == positive


@pytest.mark.parametrize("seed", [4, 5])
def test_receipts_in_two_steps_cover_the_same_orders(spark, seed):
    """Whatever was booked first, afterwards every order that earns a receipt has exactly one."""
    m = rows.masters(spark)
    orders = random_orders(PURCHASE, "PO", seed)
    frame = rows.purchase(spark, orders)
    empty = rows.ledger(spark, [])
    first = new_receipts(frame.where("bronze_row_id <= 150"), empty, m["materials"], m["warehouses"])
    second = new_receipts(frame, first, m["materials"], m["warehouses"])
    early = {r[-1] for r in movements_of(orders[:150], PURCHASE, "RAW_MATERIAL", lambda _: "WH001")}
    late = {r[-1] for r in movements_of(orders, PURCHASE, "RAW_MATERIAL", lambda _: "WH001")}
    booked = Counter(r.reference_id for r in first.unionByName(second).collect())
    assert booked == Counter(early | late)
    numbers = sorted(r.transaction_id for r in first.unionByName(second).collect())
    assert numbers == [f"IT{n:06d}" for n in range(1, len(numbers) + 1)]


@pytest.mark.parametrize("seed", [6, 7])
def test_flag_counts(spark, seed):
    m = rows.masters(spark)
    orders = random_orders(PURCHASE, "PO", seed)
    flagged = quality.flag_orders(rows.purchase(spark, orders), m["suppliers"], m["materials"], PURCHASE)
    got = {r.flag: r.flagged_rows for r in quality.profile(flagged).collect()}
    copies = Counter(o["purchase_order_id"] for o in orders)
    partners = {s for s, _, _ in rows.SUPPLIERS}
    blank = lambda text: text is None or not text.strip(" ")
    assert got["DUPLICATE_ID"] == sum(copies[o["purchase_order_id"]] > 1 for o in orders)
    assert got["MISSING_PARTNER"] == sum(blank(o["supplier_id"]) for o in orders)
    assert got["UNKNOWN_PARTNER"] == sum(
        not blank(o["supplier_id"]) and o["supplier_id"].strip(" ") not in partners for o in orders
    )
    assert got["MISSING_QUANTITY"] == sum(blank(o["quantity"]) for o in orders)
    assert got["UNREADABLE_QUANTITY"] == sum(not blank(o["quantity"]) and whole(o["quantity"]) is None for o in orders)
    assert got["NON_POSITIVE_QUANTITY"] == sum(whole(o["quantity"]) is not None and whole(o["quantity"]) <= 0 for o in orders)
    assert got["INVALID_STATUS"] == sum(o["status"] not in PURCHASE.statuses for o in orders)
