"""KPIs from aggregates that are kept per month and can be merged.

A partial holds counts and sums of one month and one partner or material; a mean is kept as sum and
count. Partials of any months add up to what the KPI tables compute from all orders, so a change
needs the partials of the months it touches and nothing else.

Distinct partners don't add up. They are kept as bitmaps: each partner has a number, a country and month
has the bits of its active partners, and months are merged by OR.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import count_where, rate, sum_where
from millrace.model import PURCHASE, SALES, OrderKind
from millrace.plans.gold import has_status, is_active, with_all_materials

MONTH = "order_month"
SIDES = ((PURCHASE, "procurement"), (SALES, "sales"))


def partner_partials(orders: DataFrame, kind: OrderKind) -> DataFrame:
    """One row per month and partner; orders without a month or partner form groups of their own."""
    active = is_active(kind)
    return orders.groupBy(MONTH, kind.partner).agg(
        F.count(kind.id).alias("total_orders"),
        F.sum("quantity").alias("total_quantity"),
        F.count("quantity").alias("quantities"),
        *(count_where(has_status(s)).alias(f"{s.lower()}_orders") for s in kind.statuses),
        sum_where(has_status("DELIVERED"), F.col("quantity")).alias("delivered_quantity"),
        count_where(active).alias("active_rows"),
        F.count(F.when(active, F.col(kind.id))).alias("active_orders"),
        F.sum(F.when(active, F.col("quantity"))).alias("active_quantity"),
    )


def material_partials(orders: DataFrame, kind: OrderKind) -> DataFrame:
    """Active orders, one row per month and material."""
    return (
        orders.where(is_active(kind))
        .groupBy(MONTH, "material_id")
        .agg(F.count(kind.id).alias("orders"), F.sum("quantity").alias("quantity"))
    )


def partner_bits(partials: DataFrame, numbered: DataFrame, kind: OrderKind) -> DataFrame:
    """Active partners of a month and country as bits; ``numbered`` has the partners with country and number.

    A bitmap covers a fixed range of numbers, so many partners are several rows of a fixed size. Partners are
    brought together before bits are set: a task that sets bits of partners as they come has a bitmap, four
    kilobytes of it, for each month, country and range it meets one of, and all tasks meet nearly all.
    """
    active = partials.where("active_rows > 0").select(MONTH, kind.partner)
    known = active.join(numbered.select(kind.partner, "country", "number"), kind.partner)
    placed = known.select(MONTH, "country", F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("bit"))
    keys = (MONTH, "country", "bucket")
    return placed.repartition(*keys).groupBy(*keys).agg(F.bitmap_construct_agg("bit").alias("bits"))


def distinct_partners(bits: DataFrame, name: str, *by: Column) -> DataFrame:
    """Partners with an active order in any of the months, per country and what else is asked for."""
    keys = [F.col("country"), *by]
    merged = bits.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    names = [c for c in merged.columns if c not in ("bucket", "bits")]
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("bits")).alias(name))


def between(partials: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Partials of a range of months, which prunes the folders that are read; all when nothing is given."""
    if first is not None:
        partials = partials.where(F.col(MONTH) >= F.lit(first))
    if last is not None:
        partials = partials.where(F.col(MONTH) <= F.lit(last))
    return partials


def partner_totals(partials: DataFrame, kind: OrderKind) -> DataFrame:
    """What :func:`millrace.plans.gold.partner_totals` gives, from partials of any months."""
    sums = [c for c in partials.columns if c not in (MONTH, kind.partner)]
    totals = partials.groupBy(kind.partner).agg(*(F.sum(c).alias(c) for c in sums))
    return totals.withColumn("mean_quantity", F.try_divide("total_quantity", "quantities")).drop("quantities")


def country_wise(partials: DataFrame, bits: DataFrame, partners: DataFrame, kind: OrderKind, partner_count: str) -> DataFrame:
    """Active orders per country, partners counted by merging the bitmaps of the months."""
    per_partner = partials.where("active_rows > 0").groupBy(kind.partner).agg(F.sum("active_orders").alias("n"), F.sum("active_quantity").alias("q"))
    totals = (
        per_partner.join(partners.select(kind.partner, "country"), kind.partner)
        .groupBy("country")
        .agg(F.sum("n").alias("order_count"), F.sum("q").alias("total_quantity"))
    )
    counted = distinct_partners(bits, partner_count).withColumnRenamed("country", "_country")
    return totals.join(counted, F.col("country").eqNullSafe(F.col("_country")), "left").drop("_country")


def monthly_trend(partials: DataFrame) -> DataFrame:
    """All orders per month, from the partners' partials."""
    return (
        partials.groupBy(MONTH)
        .agg(
            F.sum("total_orders").alias("order_count"),
            F.sum("total_quantity").alias("total_quantity"),
            F.sum("delivered_quantity").alias("delivered_quantity"),
            F.sum("cancelled_orders").alias("cancelled_orders"),
        )
        .withColumn("delivered_share", rate(F.col("delivered_quantity"), F.col("total_quantity")))
    )


def _both(purchase: DataFrame, sales: DataFrame, *keys: str) -> DataFrame:
    """Both sides' material partials summed by keys: orders and quantity per side, 0 where a side has none."""
    rows = purchase.withColumn("side", F.lit("procurement")).unionByName(sales.withColumn("side", F.lit("sales")))
    measures = []
    for _, side in SIDES:
        for measure in ("orders", "quantity"):
            own = F.sum(F.when(F.col("side") == side, F.col(measure)))
            measures.append(F.coalesce(own, F.lit(0)).alias(f"{side}_{measure}"))
    apart = [F.when(F.col(MONTH).isNull(), F.col("side")).alias("_side")] if MONTH in keys else []
    return rows.groupBy(*keys, *apart).agg(*measures).drop("_side")


def material_demand(purchase: DataFrame, sales: DataFrame, materials: DataFrame) -> DataFrame:
    return with_all_materials(_both(purchase, sales, "material_id"), materials)


def procurement_vs_sales(purchase: DataFrame, sales: DataFrame) -> DataFrame:
    """Per month; orders without one stay one row per side."""
    return _both(purchase, sales, MONTH).withColumn("quantity_gap", F.col("procurement_quantity") - F.col("sales_quantity"))
