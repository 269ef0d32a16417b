"""Stock on hand: the signed sum of the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from millrace.functions import tolerant_long
from millrace.model import INCOMING_TYPES, OUTGOING_TYPES
from millrace.operators.filters import has_text


def signed_quantity(quantity: Column) -> Column:
    return F.when(F.col("transaction_type").isin(*INCOMING_TYPES), quantity).otherwise(-quantity)


def balances(ledger: DataFrame) -> DataFrame:
    """Signed sum per warehouse and material over all usable movements, of either sign.

    Transfers and adjustments do not count, nor do rows without warehouse, material, type
    or a positive quantity. Sums combine before the shuffle, so one busy pair is harmless.
    """
    if not isinstance(ledger.schema["quantity"].dataType, LongType):
        ledger = ledger.withColumn("quantity", tolerant_long(F.col("quantity")))
    usable = (
        ledger.where(has_text(F.col("warehouse_id")) & has_text(F.col("material_id")) & (F.col("quantity") > 0))
        .where(F.col("transaction_type").isin(*INCOMING_TYPES, *OUTGOING_TYPES))
    )
    return usable.groupBy("warehouse_id", "material_id").agg(
        F.sum(signed_quantity(F.col("quantity"))).alias("quantity")
    )


def inventory_snapshot(ledger: DataFrame) -> DataFrame:
    """Positive balances; a pair at or below zero is absent."""
    return balances(ledger).where("quantity > 0")


def add_movements(balances_before: DataFrame, movements: DataFrame) -> DataFrame:
    """Balances after further movements, without reading the old ledger again.

    Takes balances of either sign: a snapshot has lost the negative ones.
    """
    parts = balances_before.unionByName(balances(movements))
    return parts.groupBy("warehouse_id", "material_id").agg(F.sum("quantity").alias("quantity"))
