"""Silver orders stored by month, and KPIs that are refreshed month by month.

Beside the orders of a kind lie their partials and bitmaps, by the same months. A batch of changed orders
rewrites the months that its orders leave or enter, and then the partials of those months, reading no other.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import month_of
from millrace.model import OrderKind
from millrace.operators.lookup import drop_known, fits_broadcast
from millrace.operators.sequence import dense_numbers
from millrace.operators.upsert import require_unique
from millrace.plans import gold, partials
from millrace.plans.partials import MONTH
from millrace.session import discard, scratch_path
from millrace.sources.sinks import replace_folders, replace_table, write_silver

#: Before every date that a text can give.
EARLIEST = -9999


def orders_table(namespace: str, kind: OrderKind) -> str:
    return f"{namespace}.silver_{kind.name}_orders"


def partial_table(namespace: str, kind: OrderKind, what: str) -> str:
    """``partners``, ``materials``, ``bits`` or ``numbers`` of one kind."""
    return f"{namespace}.monthly_{kind.name}_{what}"


def read_months(stored: DataFrame, months: DataFrame) -> DataFrame:
    """Rows of the months that a frame holds. Which these are is known only when it runs; the scan is then
    pruned to their folders. A null among them stands for the rows without a month."""
    wanted = months.select(F.col(MONTH).alias("_wanted")).distinct()
    # the comparison tells Spark that the months are few enough to be worth pruning by
    dated = F.broadcast(wanted.where(F.col("_wanted") >= F.make_date(F.lit(EARLIEST), F.lit(1), F.lit(1))))
    undated = F.broadcast(wanted.where(F.col("_wanted").isNull()))
    with_month = stored.join(dated, F.col(MONTH) == F.col("_wanted"), "left_semi")
    return with_month.unionByName(stored.where(F.col(MONTH).isNull()).join(undated, F.col(MONTH).eqNullSafe(F.col("_wanted")), "left_semi"))


def number_partners(spark: SparkSession, namespace: str, partners: DataFrame, kind: OrderKind) -> DataFrame:
    """Partners with country and number. Known ones keep their number, new ones get the next.

    Those that are numbered together are numbered by country, so that a bitmap's range is most often one
    country's. Numbers that don't follow countries would make a bitmap of each range for every country.
    """
    name, order = partial_table(namespace, kind, "numbers"), ["country", kind.partner]
    if not spark.catalog.tableExists(name):
        replace_table(dense_numbers(partners.select(*order), order).drop("country"), name)
    else:
        known = spark.table(name)
        new = drop_known(partners.select(*order), known.select(kind.partner), kind.partner)
        if not new.isEmpty():
            above = known.agg(F.max("number")).first()[0] or 0
            replace_table(known.unionByName(dense_numbers(new, order, above + 1).select(*known.columns)), name)
    return partners.join(spark.table(name), kind.partner)


def refresh_partials(spark: SparkSession, namespace: str, partners: DataFrame, kind: OrderKind, months: Sequence[date | None] | None = None) -> None:
    """Partials and bitmaps of some months anew from the stored orders, or of all of them."""
    orders = spark.table(orders_table(namespace, kind))
    numbered = number_partners(spark, namespace, partners, kind)
    names = {what: partial_table(namespace, kind, what) for what in ("partners", "materials", "bits")}
    chosen = None if months is None else spark.createDataFrame([(m,) for m in months], f"{MONTH} date")

    def put(what: str, of_rows, rows: DataFrame) -> None:
        if chosen is None:
            replace_table(of_rows(rows).hint("rebalance", MONTH), names[what], partition_by=[MONTH])
            return
        # no partials are made of their own table, and replacing runs the frame once
        replace_folders(of_rows(read_months(rows, chosen)), names[what], MONTH, months)

    put("partners", lambda rows: partials.partner_partials(rows, kind), orders)
    put("materials", lambda rows: partials.material_partials(rows, kind), orders)
    put("bits", lambda rows: partials.partner_bits(rows, numbered, kind), spark.table(names["partners"]))


def store_orders(orders: DataFrame, partners: DataFrame, kind: OrderKind, namespace: str) -> int:
    """All silver orders by month, with their partials; replaces what was there."""
    rows = write_silver(orders, orders_table(namespace, kind))
    refresh_partials(orders.sparkSession, namespace, partners, kind)
    return rows


def change_orders(batch: DataFrame, partners: DataFrame, kind: OrderKind, namespace: str) -> list[date | None]:
    """Silver orders of the batch in place of those with the same id; the months that were rewritten.

    An id occurs once in the batch; an order without an id takes the place of the one without. An order
    that changes its month leaves the old one. Two columns of the store are read to find the old months.
    """
    spark = batch.sparkSession
    name, staged, rewritten = orders_table(namespace, kind), scratch_path(spark, "batch"), scratch_path(spark, "months")
    stored = spark.table(name)
    batch.withColumn(MONTH, month_of(F.col("order_date"))).select(*stored.columns).write.parquet(staged)
    new = spark.read.schema(stored.schema).parquet(staged)
    require_unique(new.where(F.col(kind.id).isNotNull()), kind.id)
    ids = new.select(F.col(kind.id).alias("_id"))
    ids = F.broadcast(ids) if fits_broadcast(ids) else ids
    same = F.col(kind.id).eqNullSafe(F.col("_id"))
    left = stored.select(kind.id, MONTH).join(ids, same, "left_semi").select(MONTH)
    months = [r[0] for r in left.unionByName(new.select(MONTH)).distinct().collect()]
    chosen = spark.createDataFrame([(m,) for m in months], f"{MONTH} date")
    read_months(stored, chosen).join(ids, same, "left_anti").unionByName(new).write.parquet(rewritten)
    replace_folders(spark.read.schema(stored.schema).parquet(rewritten), name, MONTH, months)
    discard(spark, staged)
    discard(spark, rewritten)
    refresh_partials(spark, namespace, partners, kind, months)
    return months


def gold_of_months(
    spark: SparkSession, namespace: str, suppliers: DataFrame, customers: DataFrame, materials: DataFrame, kinds: Sequence[OrderKind],
    first: date | None = None, last: date | None = None,
) -> dict[str, DataFrame]:
    """The KPI tables of a range of months, or of all, from the stored partials; no order is read.

    ``kinds`` says which of the two sides are stored; tables that need both are there if both are.
    """
    held = {}
    for kind in kinds:
        held[kind.name] = {w: partials.between(spark.table(partial_table(namespace, kind, w)), first, last) for w in ("partners", "materials", "bits")}
    tables: dict[str, DataFrame] = {}
    if "purchase" in held:
        kind, own = next(k for k in kinds if k.name == "purchase"), held["purchase"]
        tables["gold_supplier_performance"] = gold.supplier_performance(partials.partner_totals(own["partners"], kind), suppliers)
        tables["gold_monthly_procurement_trend"] = partials.monthly_trend(own["partners"])
        tables["gold_country_wise_procurement"] = partials.country_wise(own["partners"], own["bits"], suppliers, kind, "supplier_count")
    if "sales" in held:
        kind, own = next(k for k in kinds if k.name == "sales"), held["sales"]
        tables["gold_customer_sales_summary"] = gold.customer_sales_summary(partials.partner_totals(own["partners"], kind), customers)
        tables["gold_monthly_sales_trend"] = partials.monthly_trend(own["partners"])
        tables["gold_country_wise_sales"] = partials.country_wise(own["partners"], own["bits"], customers, kind, "customer_count")
    if len(held) == 2:
        bought, sold = held["purchase"]["materials"], held["sales"]["materials"]
        tables["gold_material_demand"] = partials.material_demand(bought, sold, materials)
        tables["gold_procurement_vs_sales"] = partials.procurement_vs_sales(bought, sold)
    return tables
