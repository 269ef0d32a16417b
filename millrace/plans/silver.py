"""Typed orders, one row per id, with repaired references and their defects as flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.model import OrderKind
from millrace.operators.dedupe import keep_latest_counted
from millrace.operators.lookup import BROADCAST_LIMIT
from millrace.plans.quality import flag_array, mark_references, with_readings


def silver_orders(
    bronze: DataFrame,
    partners: DataFrame,
    materials: DataFrame,
    kind: OrderKind,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Latest copy per id, typed. Only older copies leave; a bad value becomes NULL and a flag.

    Padding, repeated ids and wrong materials are flagged as they arrived, then repaired.
    The status stays as it is: a variant spelling is not a status. Quantities keep their
    sign, dates must be strict ISO.
    """
    latest = keep_latest_counted(bronze.select("bronze_row_id", *kind.bronze_columns), kind.id)
    counted = latest.withColumns({"_repeated": F.col("_copies") > 1, "_arrived_material": F.col("material_id")})
    marked = mark_references(counted, partners, materials, kind, broadcast_limit, bronze)
    return with_readings(marked, kind).select(
        "bronze_row_id",
        kind.id,
        F.col("_ordered").alias("order_date"),
        F.col("_partner_key").alias(kind.partner),
        F.when(F.col("_material_known"), F.col("material_id")).alias("material_id"),
        F.col("_quantity").alias("quantity"),
        F.col("_due").alias(kind.delivery),
        "status",
        flag_array(kind).alias("dq_flags"),
    )
