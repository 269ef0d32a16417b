"""Why the movements sum to less than the delivered or shipped orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import tolerant_long
from millrace.model import OrderKind
from millrace.operators.dedupe import keep_latest
from millrace.operators.filters import has_text, materials_of
from millrace.operators.lookup import mark_known

PARTS = (
    "naive_quantity",
    "latest_quantity",
    "incomplete_quantity",
    "wrong_material_quantity",
    "non_positive_quantity",
    "clean_quantity",
    "not_delivered_quantity",
    "ledger_quantity",
)


def _total(quantity, condition):
    return F.coalesce(F.sum(F.when(condition, quantity)), F.lit(0))


def reconcile(orders: DataFrame, materials: DataFrame, ledger: DataFrame, kind: OrderKind) -> DataFrame:
    """One row that walks from the naive total to the ledger, for purchase or sales orders.

    ``naive`` sums every bronze row whose status moves stock. Superseded copies, then of the latest copies
    those without id or date, without a valid material, and with a quantity at or below zero
    are taken off; what is left is ``clean`` and must equal the movements: ``unexplained``
    is 0. Each cause counts a row once, in that order.
    """
    quantity = tolerant_long(F.col("quantity"))
    delivered = F.col("status").isin(*kind.moves_stock)
    naive = orders.agg(_total(quantity, delivered).alias("naive_quantity"))

    wanted = orders.select("bronze_row_id", kind.id, "material_id", "quantity", kind.delivery, "status")
    latest = mark_known(
        keep_latest(wanted, kind.id), materials_of(materials, kind.material_type), "material_id", "_material_known"
    )
    complete = has_text(F.col(kind.id)) & has_text(F.col(kind.delivery))
    complete = F.coalesce(complete, F.lit(False))
    known = F.col("_material_known")
    survivors = latest.agg(
        _total(quantity, delivered).alias("latest_quantity"),
        _total(quantity, delivered & ~complete).alias("incomplete_quantity"),
        _total(quantity, delivered & complete & ~known).alias("wrong_material_quantity"),
        _total(quantity, delivered & complete & known & (quantity <= 0)).alias("non_positive_quantity"),
        _total(quantity, delivered & complete & known & (quantity > 0)).alias("clean_quantity"),
        _total(quantity, ~F.coalesce(delivered, F.lit(False))).alias("not_delivered_quantity"),
    )
    moved = ledger.where(F.col("transaction_type") == kind.movement).agg(
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("ledger_quantity")
    )
    # Three one-row frames side by side: stacked with gaps, then summed.
    stacked = naive.unionByName(survivors, allowMissingColumns=True).unionByName(moved, allowMissingColumns=True)
    return (
        stacked.agg(*(F.sum(part).alias(part) for part in PARTS))
        .withColumn("superseded_quantity", F.col("naive_quantity") - F.col("latest_quantity"))
        .withColumn("unexplained", F.col("clean_quantity") - F.col("ledger_quantity"))
    )
