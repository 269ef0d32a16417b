"""What became of every copy of an order whose status moves stock: which movement it made, delayed or never made.

:mod:`millrace.plans.reconcile` says how much the movements fall short of the delivered orders; here each
copy says why. The quantities of all copies that made no movement add up to that gap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import blank_to_null, tolerant_long
from millrace.model import OrderKind
from millrace.operators.dedupe import keep_latest
from millrace.operators.filters import has_text, materials_of
from millrace.operators.lookup import lookup, mark_known

CLEAN, NOT_DELIVERED = "CLEAN", "NOT_DELIVERED"
BOOKED, DELAYED, SUPPRESSED = "BOOKED", "DELAYED", "SUPPRESSED"


def _cause(kind: OrderKind) -> Column:
    """The first defect that keeps a copy from moving stock, whatever its status."""

    def lacking(column: str) -> Column:
        return ~F.coalesce(has_text(F.col(column)), F.lit(False))

    quantity = F.col("_quantity")
    return (
        F.when(lacking(kind.id), "MISSING_ID")
        .when(lacking(kind.delivery), "MISSING_DELIVERY_DATE")
        .when(lacking("material_id"), "MISSING_MATERIAL")
        .when(~F.col("_material_known"), "INVALID_MATERIAL")
        .when(blank_to_null(F.col("quantity")).isNull(), "MISSING_QUANTITY")
        .when(quantity.isNull(), "UNREADABLE_QUANTITY")
        .when(quantity <= 0, "NON_POSITIVE_QUANTITY")
        .otherwise(CLEAN)
    )


def trace(orders: DataFrame, materials: DataFrame, ledger: DataFrame, kind: OrderKind) -> DataFrame:
    """One row per copy of a moving status: bronze_row_id, order_id, quantity, flag, outcome.

    - ``BOOKED``: the latest copy, without a defect; it made the movement.
    - ``DELAYED``: a sound copy whose movement was made by a later copy instead; the flag is ``DUPLICATE_ID``.
    - ``SUPPRESSED``: no movement. The flag is the copy's own defect, or, if it was sound, what is wrong
      with the latest copy that took its place: a defect, an invalid status, or a status that moves nothing yet.

    Rows without an id are copies of one order, as everywhere. An id with many copies is spread over tasks.
    """
    moving = F.coalesce(F.col("status").isin(*kind.moves_stock), F.lit(False))
    known = F.coalesce(F.col("status").isin(*kind.statuses), F.lit(False))
    wanted = orders.select("bronze_row_id", kind.id, "material_id", "quantity", kind.delivery, "status")
    marked = mark_known(wanted, materials_of(materials, kind.material_type), "material_id", "_material_known")
    order = F.coalesce(F.concat(F.lit("="), F.col(kind.id)), F.lit(""))
    copies = marked.withColumn("_quantity", tolerant_long(F.col("quantity"))).select(
        "bronze_row_id",
        F.col(kind.id).alias("order_id"),
        order.alias("_order"),
        F.col("_quantity").alias("quantity"),
        moving.alias("_moving"),
        _cause(kind).alias("_own"),
        F.when(moving, _cause(kind)).when(known, NOT_DELIVERED).otherwise("INVALID_STATUS").alias("_last_cause"),
    )
    references = ledger.where(F.col("transaction_type") == kind.movement).select(F.col("reference_id").alias("order_id"))
    latest = mark_known(keep_latest(copies, "_order"), references, "order_id", "_booked")
    latest = latest.select("_order", F.col("bronze_row_id").alias("_latest"), "_last_cause", "_booked")
    delivered = copies.where("_moving").drop("_last_cause")
    traced = lookup(delivered, latest, "_order", weighed_by=copies.where("_moving").select("_order"))
    last, sound = F.col("bronze_row_id") == F.col("_latest"), F.col("_own") == CLEAN
    flag = F.when(~sound, F.col("_own")).when(last, CLEAN).when(F.col("_booked"), "DUPLICATE_ID").otherwise(F.col("_last_cause"))
    outcome = F.when(sound & last, BOOKED).when(sound & F.col("_booked"), DELAYED).otherwise(SUPPRESSED)
    return traced.select("bronze_row_id", "order_id", "quantity", flag.alias("flag"), outcome.alias("outcome"))


def lineage_by_flag(traced: DataFrame) -> DataFrame:
    """Copies and quantity per flag and outcome."""
    return traced.groupBy("flag", "outcome").agg(
        F.count(F.lit(1)).alias("copies"), F.coalesce(F.sum("quantity"), F.lit(0)).alias("quantity")
    )
