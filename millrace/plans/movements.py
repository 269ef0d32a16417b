"""Stock movements derived from bronze orders: goods receipts and sales shipments.

They read bronze, not silver: the copy is chosen before the status is looked at, and the
dates are passed on as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import format_id, hash_bucket
from millrace.model import (
    GOODS_RECEIPT,
    INVENTORY_TRANSACTIONS,
    PURCHASE,
    RAW_WAREHOUSE_MARK,
    SALES,
    TRANSACTION_DIGITS,
    TRANSACTION_PREFIX,
    OrderKind,
)
from millrace.operators.dedupe import keep_latest
from millrace.operators.filters import in_status, materials_of, movable
from millrace.operators.lookup import drop_known, keep_known, lookup
from millrace.operators.sequence import dense_numbers, next_number, settled

MAX_WINDOWED_WAREHOUSES = 100_000


def fulfilled_orders(bronze: DataFrame, kind: OrderKind) -> DataFrame:
    """Latest copy per id, then only statuses that move stock. The order matters: a superseded
    DELIVERED copy must not come back because the latest copy was filtered first."""
    return in_status(keep_latest(bronze, kind.id), kind.moves_stock)


def mark_raw_warehouses(warehouses: DataFrame) -> DataFrame:
    """``is_raw``: the name contains the mark, in any case; a NULL name is not raw."""
    matches = F.lower(F.col("warehouse_name")).contains(RAW_WAREHOUSE_MARK)
    return warehouses.withColumn("is_raw", F.coalesce(matches, F.lit(False)))


def raw_warehouse(warehouses: DataFrame) -> str:
    """First raw-material warehouse by id."""
    first = mark_raw_warehouses(warehouses).agg(F.min(F.when(F.col("is_raw"), F.col("warehouse_id")))).first()[0]
    if first is None:
        raise ValueError("the warehouse master has no raw-materials warehouse")
    return first


def finished_goods_routes(warehouses: DataFrame) -> tuple[DataFrame, int]:
    """Warehouses for finished goods, numbered from 0 in id order, and how many there are."""
    finished = mark_raw_warehouses(warehouses).where(~F.col("is_raw")).select("warehouse_id")
    size = finished.count()
    if size == 0:
        raise ValueError("the warehouse master has no finished-goods warehouse")
    if size <= MAX_WINDOWED_WAREHOUSES:
        by_id = Window.orderBy("warehouse_id")
        return finished.withColumn("_route", F.row_number().over(by_id).cast("bigint") - 1), size
    return dense_numbers(finished, ["warehouse_id"], start=0, name="_route"), size


def route_by_hash(df: DataFrame, key: str, warehouses: DataFrame, row_id: str = "bronze_row_id") -> DataFrame:
    """Adds ``warehouse_id``: the finished-goods warehouse at the stable hash of the key."""
    routes, size = finished_goods_routes(warehouses)
    return lookup(df.withColumn("_route", hash_bucket(F.col(key), size)), routes, "_route", row_id).drop("_route")


def _movement_lines(
    bronze: DataFrame, materials: DataFrame, kind: OrderKind, booked: DataFrame | None, orders: DataFrame | None = None
) -> DataFrame:
    """Movable orders of the right material type as ledger rows without id and warehouse.

    Orders whose id is in ``booked`` stay out. With ``orders``, the fulfilled ones, bronze isn't read.
    """
    delivered = in_status(bronze, kind.moves_stock) if orders is None else orders
    if orders is None:
        orders = fulfilled_orders(bronze, kind)
    if booked is not None:
        orders = drop_known(orders, booked, kind.id)
    wanted = orders.select("bronze_row_id", kind.id, "material_id", "quantity", kind.delivery)
    known = keep_known(
        movable(wanted, kind),
        materials_of(materials, kind.material_type),
        "material_id",
        weighed_by=delivered.select("material_id"),
    )
    return known.select(
        "bronze_row_id",
        F.col(kind.delivery).alias("transaction_date"),
        "material_id",
        F.lit(kind.movement).alias("transaction_type"),
        "quantity",
        F.col(kind.id).alias("reference_id"),
    )


def receipt_lines(
    bronze: DataFrame, materials: DataFrame, warehouses: DataFrame, booked: DataFrame | None = None, orders: DataFrame | None = None
) -> DataFrame:
    """Goods receipts of purchase orders, unnumbered, into the raw-material warehouse."""
    lines = _movement_lines(bronze, materials, PURCHASE, booked, orders)
    return lines.withColumn("warehouse_id", F.lit(raw_warehouse(warehouses)))


def shipment_lines(bronze: DataFrame, materials: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Shipments of sales orders, unnumbered, each from the warehouse its order id hashes to."""
    return route_by_hash(_movement_lines(bronze, materials, SALES, None), "reference_id", warehouses)


def _numbered(lines: DataFrame, order: list[str], start: int) -> DataFrame:
    numbered = dense_numbers(settled(lines), order, start, by="bronze_row_id")
    transaction_id = format_id(TRANSACTION_PREFIX, F.col("number"), TRANSACTION_DIGITS)
    return numbered.withColumn("transaction_id", transaction_id).select(*INVENTORY_TRANSACTIONS.names)


def goods_receipts(bronze: DataFrame, materials: DataFrame, warehouses: DataFrame, start: int = 1) -> DataFrame:
    """All receipts of the purchase orders, numbered in the order of the bronze rows."""
    lines = receipt_lines(bronze, materials, warehouses)
    return _numbered(lines, ["bronze_row_id", "reference_id"], start)


def sales_shipments(bronze: DataFrame, materials: DataFrame, warehouses: DataFrame, start: int = 1) -> DataFrame:
    """All shipments of the sales orders, numbered in the order of the bronze rows."""
    lines = shipment_lines(bronze, materials, warehouses)
    return _numbered(lines, ["bronze_row_id", "reference_id"], start)


def ledger_lines(
    purchase_orders: DataFrame, sales_orders: DataFrame, materials: DataFrame, warehouses: DataFrame
) -> DataFrame:
    """Receipts and shipments before numbering. Enough for balances, which do not look at ids."""
    receipts = receipt_lines(purchase_orders, materials, warehouses)
    shipments = shipment_lines(sales_orders, materials, warehouses)
    return receipts.unionByName(shipments)


def inventory_transactions(
    purchase_orders: DataFrame,
    sales_orders: DataFrame,
    materials: DataFrame,
    warehouses: DataFrame,
    start: int = 1,
) -> DataFrame:
    """The full ledger: receipts first, shipments continue their numbers.

    A pure function of the orders: writing it replaces the ledger. Additions to an
    existing ledger go through :func:`new_receipts`.
    """
    lines = ledger_lines(purchase_orders, sales_orders, materials, warehouses)
    shipments_last = lines.withColumn("_turn", (F.col("transaction_type") != GOODS_RECEIPT).cast("int"))
    return _numbered(shipments_last, ["_turn", "bronze_row_id", "reference_id"], start)


def receipt_references(ledger: DataFrame) -> DataFrame:
    """Order ids that already have a goods receipt."""
    return (
        ledger.where((F.col("transaction_type") == GOODS_RECEIPT) & F.col("reference_id").isNotNull())
        .select(F.col("reference_id").cast("string").alias(PURCHASE.id))
        .distinct()
    )


def next_transaction(ledger: DataFrame) -> int:
    """First transaction number that is free."""
    return next_number(ledger, "transaction_id", TRANSACTION_PREFIX).first()[0]


def new_receipts(
    batch: DataFrame,
    ledger: DataFrame,
    materials: DataFrame,
    warehouses: DataFrame,
    start: int | None = None,
    orders: DataFrame | None = None,
) -> DataFrame:
    """Receipts of delivered orders that have none yet, numbered after the ledger's last id.

    Running it again over the extended ledger gives no rows. A caller that knows the next
    number passes ``start`` and saves the look at all ids. One that has stored the batch's
    :func:`fulfilled_orders` passes them as ``orders``, and the batch isn't read.
    """
    lines = receipt_lines(batch, materials, warehouses, receipt_references(ledger), orders)
    if start is None:
        start = next_transaction(ledger)
    return _numbered(lines, ["bronze_row_id", "reference_id"], start)


def counts_by_type(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("transaction_type").agg(F.count(F.lit(1)).alias("transactions"))
