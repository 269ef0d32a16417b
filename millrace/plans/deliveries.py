"""Supplier deliveries against their purchase orders, and the supplier evaluation they give."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import iso_date, lead_days
from millrace.operators.dedupe import keep_latest
from millrace.operators.lookup import lookup


def delivery_status(deliveries: DataFrame, purchase_orders: DataFrame) -> DataFrame:
    """ON_TIME up to the expected date of the latest copy of the order, DELAYED after it; NULL
    without an order or a readable expected date. Partial deliveries cannot be told: a
    delivery carries no quantity."""
    due = keep_latest(
        purchase_orders.select("bronze_row_id", "purchase_order_id", "expected_delivery_date"), "purchase_order_id"
    ).select("purchase_order_id", iso_date(F.col("expected_delivery_date")).alias("expected_date"))
    bare = deliveries.select("delivery_id", "purchase_order_id", "supplier_id", "delivery_date")
    late = lead_days(F.col("expected_date"), F.col("delivery_date"))
    return (
        lookup(bare, due.where(F.col("purchase_order_id").isNotNull()), "purchase_order_id", "delivery_id")
        .withColumn("delay_days", F.when(late > 0, late).when(late <= 0, 0))
        .withColumn("status", F.when(late <= 0, "ON_TIME").when(late > 0, "DELAYED"))
    )


def evaluate_suppliers(dated_deliveries: DataFrame, evaluation_date: date) -> DataFrame:
    """Per supplier: percentage of deliveries on time and mean days late, 0 for those in time."""
    judged = dated_deliveries.where(F.col("status").isNotNull())
    return judged.groupBy("supplier_id").agg(
        F.lit(evaluation_date).alias("evaluation_date"),
        F.round(
            F.try_divide(F.count_if(F.col("status") == "ON_TIME") * 100, F.count(F.lit(1))), 2
        ).alias("on_time_delivery_rate"),
        F.round(F.avg("delay_days"), 2).alias("average_delay_days"),
    )
