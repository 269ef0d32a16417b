"""The nine KPI tables.

Orders are aggregated before they meet a master table: the join then sees one row per
key, whatever the share of a single supplier, customer or material, and a distinct count
of partners becomes a plain count. KPIs of the same grain share one aggregate. No table is
sorted; a sort before a write promises nothing to the reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import count_where, month_of, rate, sum_where
from millrace.model import PURCHASE, SALES, TOP_MATERIALS, OrderKind
from millrace.operators.topk import top_k


def has_status(status: str) -> Column:
    return F.col("status") == F.lit(status)


def is_active(kind: OrderKind) -> Column:
    return F.col("status").isin(*kind.active)


def partner_totals(orders: DataFrame, kind: OrderKind) -> DataFrame:
    """One row per partner with every measure the partner and country KPIs need."""
    per_status = [count_where(has_status(s)).alias(f"{s.lower()}_orders") for s in kind.statuses]
    active = is_active(kind)
    return orders.groupBy(kind.partner).agg(
        F.count(kind.id).alias("total_orders"),
        F.sum("quantity").alias("total_quantity"),
        *per_status,
        sum_where(has_status("DELIVERED"), F.col("quantity")).alias("delivered_quantity"),
        F.avg("quantity").alias("mean_quantity"),
        F.count_if(active).alias("active_rows"),
        F.count(F.when(active, F.col(kind.id))).alias("active_orders"),
        F.sum(F.when(active, F.col("quantity"))).alias("active_quantity"),
    )


def supplier_performance(purchase_totals: DataFrame, suppliers: DataFrame) -> DataFrame:
    return purchase_totals.join(suppliers, "supplier_id").select(
        "supplier_id",
        "supplier_name",
        "country",
        "total_orders",
        "total_quantity",
        "delivered_orders",
        "confirmed_orders",
        "created_orders",
        "cancelled_orders",
        "delivered_quantity",
        rate(F.col("delivered_orders"), F.col("total_orders")).alias("delivery_rate"),
        rate(F.col("cancelled_orders"), F.col("total_orders")).alias("cancellation_rate"),
        rate(F.col("delivered_quantity"), F.col("total_quantity")).alias("fulfillment_rate"),
    )


def customer_sales_summary(sales_totals: DataFrame, customers: DataFrame) -> DataFrame:
    return sales_totals.join(customers, "customer_id").select(
        "customer_id",
        "customer_name",
        "country",
        "total_orders",
        "total_quantity",
        "delivered_orders",
        "shipped_orders",
        "confirmed_orders",
        "created_orders",
        "cancelled_orders",
        "delivered_quantity",
        F.round("mean_quantity", 2).alias("avg_order_quantity"),
        rate(F.col("delivered_orders"), F.col("total_orders")).alias("delivery_rate"),
    )


def _country_wise(totals: DataFrame, partners: DataFrame, kind: OrderKind, partner_count: str) -> DataFrame:
    """Active orders per country. A partner counts when it has an active order."""
    active = totals.where("active_rows > 0").select(kind.partner, "active_orders", "active_quantity")
    return (
        active.join(partners.select(kind.partner, "country"), kind.partner)
        .groupBy("country")
        .agg(
            F.sum("active_orders").alias("order_count"),
            F.sum("active_quantity").alias("total_quantity"),
            F.count(F.lit(1)).alias(partner_count),
        )
    )


def country_wise_procurement(purchase_totals: DataFrame, suppliers: DataFrame) -> DataFrame:
    return _country_wise(purchase_totals, suppliers, PURCHASE, "supplier_count")


def country_wise_sales(sales_totals: DataFrame, customers: DataFrame) -> DataFrame:
    return _country_wise(sales_totals, customers, SALES, "customer_count")


def _active_lines(orders: DataFrame, kind: OrderKind, key: Column, name: str) -> DataFrame:
    """Active orders in the shape both sides share: key, order kind, whether the id counts, quantity."""
    return orders.where(is_active(kind)).select(
        key.alias(name),
        F.lit(kind.name).alias("kind"),
        F.col(kind.id).isNotNull().alias("has_id"),
        "quantity",
    )


def _both_sides() -> list[Column]:
    """Order counts and quantities per side, 0 where a side has none."""
    measures = []
    for kind, side in ((PURCHASE, "procurement"), (SALES, "sales")):
        own = F.col("kind") == kind.name
        quantity = F.sum(F.when(own, F.col("quantity")))
        measures.append(F.count_if(own & F.col("has_id")).alias(f"{side}_orders"))
        measures.append(F.coalesce(quantity, F.lit(0)).alias(f"{side}_quantity"))
    return measures


def material_demand(purchase_orders: DataFrame, sales_orders: DataFrame, materials: DataFrame) -> DataFrame:
    """Demand of every material, 0 where nothing was ordered.

    Both order tables are united and aggregated once: one shuffle and one join instead of
    two of each.
    """
    lines = _active_lines(purchase_orders, PURCHASE, F.col("material_id"), "material_id").unionByName(
        _active_lines(sales_orders, SALES, F.col("material_id"), "material_id")
    )
    return with_all_materials(lines.groupBy("material_id").agg(*_both_sides()), materials)


def with_all_materials(demand: DataFrame, materials: DataFrame) -> DataFrame:
    """Every material with its demand, 0 where it has none, and the totals of both sides."""
    measures = ["procurement_orders", "procurement_quantity", "sales_orders", "sales_quantity"]
    return (
        materials.join(demand, "material_id", "left")
        .select(
            "material_id",
            "material_name",
            "material_type",
            *(F.coalesce(F.col(m), F.lit(0)).alias(m) for m in measures),
        )
        .withColumn("total_demand_quantity", F.col("procurement_quantity") + F.col("sales_quantity"))
        .withColumn("total_orders", F.col("procurement_orders") + F.col("sales_orders"))
    )


def top_moving_materials(demand: DataFrame, k: int = TOP_MATERIALS) -> DataFrame:
    moving = demand.where("total_demand_quantity > 0")
    return top_k(moving, k, "total_demand_quantity", "material_id", "movement_rank").select(
        "movement_rank",
        "material_id",
        "material_name",
        "material_type",
        "procurement_orders",
        "procurement_quantity",
        "sales_orders",
        "sales_quantity",
        "total_orders",
        "total_demand_quantity",
    )


def procurement_vs_sales(purchase_orders: DataFrame, sales_orders: DataFrame, null_safe: bool = False) -> DataFrame:
    """Active orders of both sides per month.

    Orders without a month stay one row per side, as in a full join on the month, where
    NULL never matches NULL; ``null_safe`` puts them in one row.
    """
    month = month_of(F.col("order_date"))
    lines = _active_lines(purchase_orders, PURCHASE, month, "order_month").unionByName(
        _active_lines(sales_orders, SALES, month, "order_month")
    )
    apart = F.lit(None).cast("string") if null_safe else F.when(F.col("order_month").isNull(), F.col("kind"))
    return (
        lines.groupBy("order_month", apart.alias("_side"))
        .agg(*_both_sides())
        .drop("_side")
        .withColumn("quantity_gap", F.col("procurement_quantity") - F.col("sales_quantity"))
    )


def monthly_trend(orders: DataFrame, kind: OrderKind) -> DataFrame:
    """All orders per month; orders without a month form a group of their own."""
    return (
        orders.groupBy(month_of(F.col("order_date")).alias("order_month"))
        .agg(
            F.count(kind.id).alias("order_count"),
            F.sum("quantity").alias("total_quantity"),
            sum_where(has_status("DELIVERED"), F.col("quantity")).alias("delivered_quantity"),
            count_where(has_status("CANCELLED")).alias("cancelled_orders"),
        )
        .withColumn("delivered_share", rate(F.col("delivered_quantity"), F.col("total_quantity")))
    )


# Order in which a reader sees each table: column and whether the largest comes first.
SHOWN_BY = {
    "gold_supplier_performance": ("total_quantity", True),
    "gold_material_demand": ("total_demand_quantity", True),
    "gold_customer_sales_summary": ("total_quantity", True),
    "gold_procurement_vs_sales": ("order_month", False),
    "gold_monthly_procurement_trend": ("order_month", False),
    "gold_monthly_sales_trend": ("order_month", False),
    "gold_country_wise_procurement": ("total_quantity", True),
    "gold_country_wise_sales": ("total_quantity", True),
    "gold_top_moving_materials": ("movement_rank", False),
}


def shown(name: str, table: DataFrame) -> DataFrame:
    """A gold table in reading order, for display only."""
    column, largest_first = SHOWN_BY[name]
    return table.orderBy(F.desc(column) if largest_first else F.asc(column))


def gold_tables(
    purchase_orders: DataFrame,
    sales_orders: DataFrame,
    suppliers: DataFrame,
    customers: DataFrame,
    materials: DataFrame,
) -> dict[str, DataFrame]:
    """All nine tables by name, unwritten. Partner totals and demand each feed two tables;
    :func:`millrace.sources.gold.write_gold` computes them once."""
    bought = partner_totals(purchase_orders, PURCHASE)
    sold = partner_totals(sales_orders, SALES)
    demand = material_demand(purchase_orders, sales_orders, materials)
    return {
        "gold_supplier_performance": supplier_performance(bought, suppliers),
        "gold_material_demand": demand,
        "gold_customer_sales_summary": customer_sales_summary(sold, customers),
        "gold_procurement_vs_sales": procurement_vs_sales(purchase_orders, sales_orders),
        "gold_monthly_procurement_trend": monthly_trend(purchase_orders, PURCHASE),
        "gold_monthly_sales_trend": monthly_trend(sales_orders, SALES),
        "gold_country_wise_procurement": country_wise_procurement(bought, suppliers),
        "gold_country_wise_sales": country_wise_sales(sold, customers),
        "gold_top_moving_materials": top_moving_materials(demand),
    }
