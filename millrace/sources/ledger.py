"""Ledger and inventory as stored tables: full rebuild, addition of new receipts, repair of orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.model import OrderKind
from millrace.operators.foreign_keys import repair_material
from millrace.operators.upsert import with_audit
from millrace.plans.inventory import inventory_snapshot
from millrace.plans.movements import inventory_transactions, new_receipts
from millrace.sources.sinks import append_table, replace_table


def refresh_inventory(spark: SparkSession, ledger: str, inventory: str, fmt: str = "parquet") -> int:
    """Snapshot of all movements in place of the old one, also when no stock is left."""
    return replace_table(with_audit(inventory_snapshot(spark.table(ledger))), inventory, fmt)


def rebuild_ledger(
    purchase_orders: DataFrame,
    sales_orders: DataFrame,
    materials: DataFrame,
    warehouses: DataFrame,
    ledger: str,
    inventory: str,
    fmt: str = "parquet",
) -> dict[str, int]:
    """Derives the whole ledger again and replaces it, so that no order is booked twice."""
    spark = purchase_orders.sparkSession
    movements = inventory_transactions(purchase_orders, sales_orders, materials, warehouses)
    return {
        "inventory_transactions": replace_table(with_audit(movements), ledger, fmt),
        "inventory": refresh_inventory(spark, ledger, inventory, fmt),
    }


def sync_receipts(
    batch: DataFrame,
    materials: DataFrame,
    warehouses: DataFrame,
    ledger: str,
    inventory: str,
    fmt: str = "parquet",
) -> dict[str, int]:
    """Books delivered orders of the batch that have no receipt yet, then refreshes the snapshot."""
    spark = batch.sparkSession
    receipts = append_table(new_receipts(batch, spark.table(ledger), materials, warehouses), ledger, fmt)
    return {
        "goods_receipts": receipts,
        "inventory_transactions": receipts,
        "inventory": refresh_inventory(spark, ledger, inventory, fmt),
    }


def repair_stored_orders(
    spark: SparkSession, table: str, materials: DataFrame, kind: OrderKind, fmt: str = "parquet"
) -> int:
    """Rewrites an order table with unknown materials set to NULL."""
    return replace_table(repair_material(spark.table(table), materials, kind), table, fmt)
