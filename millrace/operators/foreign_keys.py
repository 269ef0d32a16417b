"""Material references of orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import blank_to_null
from millrace.model import OrderKind
from millrace.operators.filters import materials_of
from millrace.operators.lookup import BROADCAST_LIMIT, mark_known


def mark_material(
    orders: DataFrame,
    materials: DataFrame,
    kind: OrderKind,
    marker: str = "_material_known",
    row_id: str = "bronze_row_id",
    broadcast_limit: int = BROADCAST_LIMIT,
    weighed_by: DataFrame | None = None,
) -> DataFrame:
    """Trim the material, blank to NULL, and mark the rows whose material exists with the type of this order kind."""
    trimmed = orders.withColumn("material_id", blank_to_null(F.col("material_id")))
    valid = materials_of(materials, kind.material_type)
    if weighed_by is not None:
        weighed_by = weighed_by.select(blank_to_null(F.col("material_id")).alias("material_id"))
    return mark_known(trimmed, valid, "material_id", marker, row_id, broadcast_limit, weighed_by)


def repair_material(orders: DataFrame, materials: DataFrame, kind: OrderKind, row_id: str = "bronze_row_id") -> DataFrame:
    """Rows stay; a material that is unknown or of the wrong type becomes NULL."""
    marked = mark_material(orders, materials, kind, "_material_known", row_id)
    return marked.withColumn("material_id", F.when(F.col("_material_known"), F.col("material_id"))).select(
        *orders.columns
    )
