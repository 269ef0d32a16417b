"""Production output as stock movements: raw material consumed, finished goods received."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.model import PRODUCTION_CONSUMPTION, PRODUCTION_RECEIPT
from millrace.plans.movements import raw_warehouse, route_by_hash


def production_lines(output: DataFrame, warehouses: DataFrame, day: str = "output_date") -> DataFrame:
    """Two ledger rows per output row, unnumbered; the reference is the production order.

    Consumption leaves the raw-material warehouse; the product goes to the finished-goods
    warehouse its production order hashes to.
    """
    routed = route_by_hash(output, "production_order_id", warehouses, "production_output_id")
    consumed = F.struct(
        F.lit(PRODUCTION_CONSUMPTION).alias("transaction_type"),
        F.lit(raw_warehouse(warehouses)).alias("warehouse_id"),
        F.col("input_material_id").alias("material_id"),
        F.col("input_quantity").alias("quantity"),
    )
    produced = F.struct(
        F.lit(PRODUCTION_RECEIPT).alias("transaction_type"),
        F.col("warehouse_id"),
        F.col("output_material_id").alias("material_id"),
        F.col("output_quantity").alias("quantity"),
    )
    return routed.select(
        F.col(day).cast("string").alias("transaction_date"),
        F.col("production_order_id").alias("reference_id"),
        "production_output_id",
        F.explode(F.array(consumed, produced)).alias("_move"),
    ).select("transaction_date", "reference_id", "production_output_id", "_move.*")
