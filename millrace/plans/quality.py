"""Defects of bronze orders: flags per row, profile, quarantine, and their effect on the ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import blank_to_null, iso_date, is_missing, tolerant_long
from millrace.model import LARGEST_USUAL_QUANTITY, OrderKind
from millrace.operators.dedupe import mark_repeated
from millrace.operators.filters import has_text
from millrace.operators.foreign_keys import mark_material
from millrace.operators.lookup import BROADCAST_LIMIT, mark_known

FLAGS = (
    "UNKNOWN_PARTNER",
    "MISSING_MATERIAL",
    "MISSING_PARTNER",
    "MISSING_ORDER_DATE",
    "MISSING_QUANTITY",
    "DELIVERY_BEFORE_ORDER",
    "INVALID_STATUS",
    "NON_POSITIVE_QUANTITY",
    "QUANTITY_OUTLIER",
    "UNREADABLE_QUANTITY",
    "PADDED_PARTNER",
    "BAD_ORDER_DATE",
    "DUPLICATE_ID",
    "INVALID_MATERIAL",
    "MISSING_ID",
    "MISSING_DELIVERY_DATE",
    "PADDED_MATERIAL",
)

# Flags that keep an order from ever moving stock.
BLOCKING = (
    "MISSING_MATERIAL",
    "MISSING_QUANTITY",
    "INVALID_STATUS",
    "NON_POSITIVE_QUANTITY",
    "UNREADABLE_QUANTITY",
    "MISSING_ID",
    "MISSING_DELIVERY_DATE",
    "PADDED_MATERIAL",
)


def with_readings(orders: DataFrame, kind: OrderKind) -> DataFrame:
    """``_quantity``, ``_ordered`` and ``_due``: what the texts say, read once per row."""
    return orders.withColumns(
        {
            "_quantity": tolerant_long(F.col("quantity")),
            "_ordered": iso_date(F.col("order_date")),
            "_due": iso_date(F.col(kind.delivery)),
        }
    )


def _conditions(kind: OrderKind) -> dict[str, Column]:
    """One condition per flag over a bronze row with its readings and its three markers."""
    partner, quantity, ordered = F.col(kind.partner), F.col("_quantity"), F.col("_ordered")
    return {
        "UNKNOWN_PARTNER": F.col("_partner_key").isNotNull() & ~F.col("_partner_known"),
        "MISSING_MATERIAL": ~F.col("_material_known"),
        "MISSING_PARTNER": F.col("_partner_key").isNull(),
        "MISSING_ORDER_DATE": is_missing(F.col("order_date")),
        "MISSING_QUANTITY": is_missing(F.col("quantity")),
        "DELIVERY_BEFORE_ORDER": F.col("_due") < ordered,
        "INVALID_STATUS": ~F.coalesce(F.col("status").isin(*kind.statuses), F.lit(False)),
        "NON_POSITIVE_QUANTITY": quantity <= 0,
        "QUANTITY_OUTLIER": quantity > LARGEST_USUAL_QUANTITY,
        "UNREADABLE_QUANTITY": ~is_missing(F.col("quantity")) & quantity.isNull(),
        "PADDED_PARTNER": partner != F.trim(partner),
        "BAD_ORDER_DATE": F.col("order_date").isNotNull() & ordered.isNull(),
        "DUPLICATE_ID": F.col("_repeated"),
        "INVALID_MATERIAL": F.col("material_id").isNotNull() & ~F.col("_material_known"),
        "MISSING_ID": ~has_text(F.col(kind.id)),
        "MISSING_DELIVERY_DATE": ~has_text(F.col(kind.delivery)),
        "PADDED_MATERIAL": F.col("_arrived_material") != F.trim("_arrived_material"),
    }


def flag_array(kind: OrderKind) -> Column:
    """Names of the flags that hold, in the fixed order of :data:`FLAGS`."""
    conditions = _conditions(kind)
    return F.array_compact(F.array(*(F.when(conditions[flag], F.lit(flag)) for flag in FLAGS)))


def mark_references(
    orders: DataFrame,
    partners: DataFrame,
    materials: DataFrame,
    kind: OrderKind,
    broadcast_limit: int = BROADCAST_LIMIT,
    weighed_by: DataFrame | None = None,
) -> DataFrame:
    """Orders with ``_partner_key``, ``_partner_known`` and ``_material_known``; the material comes out trimmed.

    ``weighed_by`` is the bronze scan the orders come from.
    """
    partner_key = blank_to_null(F.col(kind.partner)).alias("_partner_key")
    keyed = orders.select("*", partner_key)
    keys = partners.select(F.col(kind.partner).alias("_partner_key"))
    scan = orders if weighed_by is None else weighed_by
    marked = mark_known(
        keyed, keys, "_partner_key", "_partner_known", "bronze_row_id", broadcast_limit, scan.select(partner_key)
    )
    return mark_material(marked, materials, kind, "_material_known", "bronze_row_id", broadcast_limit, scan)


def flag_orders(
    orders: DataFrame,
    partners: DataFrame,
    materials: DataFrame,
    kind: OrderKind,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Every bronze row, unchanged, with ``dq_flags ARRAY<STRING>``."""
    kept = orders.withColumn("_arrived_material", F.col("material_id"))
    marked = mark_references(mark_repeated(kept, kind.id), partners, materials, kind, broadcast_limit, orders)
    values = [
        F.col("_arrived_material").alias("material_id") if c == "material_id" else F.col(c) for c in orders.columns
    ]
    return with_readings(marked, kind).select(*values, flag_array(kind).alias("dq_flags"))


def profile(flagged: DataFrame) -> DataFrame:
    """Rows and share per flag, all flags listed. One aggregate, nothing exploded."""
    return _shares(
        flagged.agg(
            F.count(F.lit(1)).alias("total_rows"),
            *(F.count_if(F.array_contains("dq_flags", flag)).alias(flag) for flag in FLAGS),
        )
    )


def profile_orders(
    orders: DataFrame,
    partners: DataFrame,
    materials: DataFrame,
    kind: OrderKind,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """:func:`profile` of bronze rows, without flagging each of them.

    How many rows repeat an id follows from the counts of the ids, so no row has to meet its copies.
    """
    kept = orders.withColumns({"_arrived_material": F.col("material_id"), "_repeated": F.lit(False)})
    marked = with_readings(mark_references(kept, partners, materials, kind, broadcast_limit, orders), kind)
    conditions = _conditions(kind)
    del conditions["DUPLICATE_ID"]
    counts = marked.agg(
        F.count(F.lit(1)).alias("total_rows"), *(F.count_if(conditions[x]).alias(x) for x in conditions)
    )
    copies = orders.groupBy(kind.id).agg(F.count(F.lit(1)).alias("_n"))
    repeated = copies.agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("DUPLICATE_ID"))
    return _shares(counts.crossJoin(F.broadcast(repeated)).select("total_rows", *FLAGS))  # one row each


def _shares(counts: DataFrame) -> DataFrame:
    return counts.unpivot("total_rows", list(FLAGS), "flag", "flagged_rows").withColumn(
        "share", F.round(F.try_divide("flagged_rows", "total_rows"), 4)
    )


def is_blocked(blocking: Sequence[str] = BLOCKING) -> Column:
    return F.arrays_overlap(F.col("dq_flags"), F.array(*(F.lit(flag) for flag in blocking)))


def quarantine(flagged: DataFrame, blocking: Sequence[str] = BLOCKING) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined): together all rows, no row in both."""
    return flagged.where(~is_blocked(blocking)), flagged.where(is_blocked(blocking))


def impact(flagged_latest: DataFrame, ledger: DataFrame, kind: OrderKind) -> DataFrame:
    """Per flag: orders that carry it and how many of them did and did not reach the ledger.

    Expects one row per order id, so both join sides are unique on it. Orders without any
    flag are counted under ``CLEAN``.
    """
    moved = (
        ledger.where(F.col("transaction_type") == kind.movement)
        .select(F.col("reference_id").alias(kind.id))
        .distinct()
        .withColumn("_moved", F.lit(True))
    )
    per_order = flagged_latest.join(moved, kind.id, "left").select(
        F.explode(F.when(F.size("dq_flags") == 0, F.array(F.lit("CLEAN"))).otherwise(F.col("dq_flags"))).alias("flag"),
        F.coalesce(F.col("_moved"), F.lit(False)).alias("moved"),
    )
    return per_order.groupBy("flag").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if("moved").alias("moved_orders"),
        F.count_if(~F.col("moved")).alias("held_back_orders"),
    )
