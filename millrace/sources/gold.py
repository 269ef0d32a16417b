"""Writes silver from stored bronze and the nine gold tables from stored silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.model import PURCHASE, SALES
from millrace.plans import gold
from millrace.plans.silver import silver_orders
from millrace.sources.readers import read_table
from millrace.sources.sinks import replace_table


def refresh_silver(spark: SparkSession, bronze: str, silver: str, fmt: str = "parquet") -> dict[str, int]:
    """The five ``silver_*`` tables of one database from the bronze and master tables of another."""
    masters = {name: read_table(spark, name, bronze) for name in ("materials", "suppliers", "customers")}
    materials = masters["materials"]
    tables = {
        **masters,
        "purchase_orders": silver_orders(
            read_table(spark, "purchase_orders", bronze), masters["suppliers"], materials, PURCHASE
        ),
        "sales_orders": silver_orders(read_table(spark, "sales_orders", bronze), masters["customers"], materials, SALES),
    }
    return {f"silver_{name}": replace_table(table, f"{silver}.silver_{name}", fmt) for name, table in tables.items()}


def refresh_gold(spark: SparkSession, silver: str, target: str, fmt: str = "parquet") -> dict[str, int]:
    """The nine gold tables of one database from the ``silver_*`` tables of another."""
    names = ("purchase_orders", "sales_orders", "suppliers", "customers", "materials")
    return write_gold(*(read_table(spark, f"silver_{name}", silver) for name in names), target, fmt)


def write_gold(
    purchase_orders: DataFrame,
    sales_orders: DataFrame,
    suppliers: DataFrame,
    customers: DataFrame,
    materials: DataFrame,
    namespace: str,
    fmt: str = "parquet",
) -> dict[str, int]:
    """Rows written per table. Partner totals are kept while two tables read them, and the
    top materials come from the demand table just written instead of a second computation."""
    spark = purchase_orders.sparkSession
    rows: dict[str, int] = {}

    def put(name: str, table: DataFrame) -> None:
        rows[name] = replace_table(table, f"{namespace}.{name}", fmt)

    bought = gold.partner_totals(purchase_orders, PURCHASE).persist()
    try:
        put("gold_supplier_performance", gold.supplier_performance(bought, suppliers))
        put("gold_country_wise_procurement", gold.country_wise_procurement(bought, suppliers))
    finally:
        bought.unpersist()

    sold = gold.partner_totals(sales_orders, SALES).persist()
    try:
        put("gold_customer_sales_summary", gold.customer_sales_summary(sold, customers))
        put("gold_country_wise_sales", gold.country_wise_sales(sold, customers))
    finally:
        sold.unpersist()

    put("gold_material_demand", gold.material_demand(purchase_orders, sales_orders, materials))
    written = spark.table(f"{namespace}.gold_material_demand")
    put("gold_top_moving_materials", gold.top_moving_materials(written))

    put("gold_procurement_vs_sales", gold.procurement_vs_sales(purchase_orders, sales_orders))
    put("gold_monthly_procurement_trend", gold.monthly_trend(purchase_orders, PURCHASE))
    put("gold_monthly_sales_trend", gold.monthly_trend(sales_orders, SALES))
    return rows
