"""One callable per query: (spark, data folder) to DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from millrace.functions import blank_to_null, hash_bucket, is_numeric_text, iso_date, lead_days, parse_id
from millrace.model import (
    BRONZE_PURCHASE_ORDERS,
    PURCHASE,
    RAW_PURCHASE_ORDERS,
    RAW_SALES_ORDERS,
    SALES,
    SUPPLIERS,
    OrderKind,
)
from millrace.operators.dedupe import keep_latest
from millrace.operators.filters import in_month, materials_of
from millrace.operators.foreign_keys import repair_material
from millrace.operators.sequence import dense_numbers, next_number, settled
from millrace.operators.upsert import upsert
from millrace.plans import gold, movements, quality
from millrace.plans.bronze import conform, highest_row_id
from millrace.plans.deliveries import delivery_status, evaluate_suppliers
from millrace.plans.inventory import balances, inventory_snapshot
from millrace.plans.lineage import lineage_by_flag, trace
from millrace.plans.partials import distinct_partners
from millrace.plans.production import production_lines
from millrace.plans.reconcile import reconcile
from millrace.plans.silver import silver_orders
from millrace.registry.bridge import Bridge
from millrace.session import scratch_database, scratch_path
from millrace.sources.gold import write_gold
from millrace.sources.readers import import_csv, read_csv, read_table
from millrace.sources.ledger import repair_stored_orders
from millrace.sources.monthly import change_orders, gold_of_months, partial_table, read_months, store_orders
from millrace.sources.sinks import append_table, replace_table, upsert_buckets, without_audit, write_csv, write_silver
from millrace.streaming.ingest import ingest_files
from millrace.streaming.latest import buckets_for, latest_copies, room_for
from millrace.streaming.masters import upsert_stream
from millrace.streaming.receipts import book_receipts, read_ledger, seed_ledger, stream_bronze
from millrace.streaming.rescue import ingest_rescued
from millrace.streaming.stock import publish_stock

Query = Callable[[SparkSession, str], DataFrame]

# Orders placed before this day count as already booked in the incremental queries.
BOOKED_BEFORE = "1998-06-01"
# What differs between the earlier and the present state in the queries that refresh months.
CHANGED_MONTHS = (date(1995, 3, 1), date(1996, 7, 1))
MOVED_MONTH, UNDATED_MONTH, NEW_MONTH = date(1994, 2, 1), date(1997, 9, 1), date(1998, 4, 1)
# Rows that a reader sees first.
SHOWN = 50
NULL_TEXT = "\\N"
EVALUATED_ON = date(2002, 1, 1)
MASTER_LOADED, MASTER_CHANGED = datetime(2025, 1, 1, 12), datetime(2025, 2, 1, 12)


def _flat(df: DataFrame) -> DataFrame:
    """Flags as one text, so that results compare on plain values."""
    return df.withColumn("dq_flags", F.array_join("dq_flags", "|"))


def _typed(b: Bridge, kind: OrderKind) -> DataFrame:
    return b.typed_purchase_orders if kind is PURCHASE else b.typed_sales_orders


def _typed_and_stored(b: Bridge, kind: OrderKind) -> DataFrame:
    orders, path = _typed(b, kind), scratch_path(b.spark, "typed")
    orders.write.parquet(path)
    return b.spark.read.schema(orders.schema).parquet(path)


def _bronze(b: Bridge, kind: OrderKind) -> DataFrame:
    return b.purchase_orders if kind is PURCHASE else b.sales_orders


def _partners(b: Bridge, kind: OrderKind) -> DataFrame:
    return b.suppliers if kind is PURCHASE else b.customers


def _silver(b: Bridge, kind: OrderKind) -> DataFrame:
    return silver_orders(_bronze(b, kind), _partners(b, kind), b.materials, kind)


def _flagged(b: Bridge, kind: OrderKind) -> DataFrame:
    return quality.flag_orders(_bronze(b, kind), _partners(b, kind), b.materials, kind)


# Gold, over typed orders without defects and over silver built from defective bronze.

GOLD: dict[str, Callable[[Bridge, Callable[[Bridge, OrderKind], DataFrame]], DataFrame]] = {
    "gold_supplier_performance": lambda b, orders: gold.supplier_performance(
        gold.partner_totals(orders(b, PURCHASE), PURCHASE), b.suppliers
    ),
    "gold_material_demand": lambda b, orders: gold.material_demand(
        orders(b, PURCHASE), orders(b, SALES), b.materials
    ),
    "gold_customer_sales_summary": lambda b, orders: gold.customer_sales_summary(
        gold.partner_totals(orders(b, SALES), SALES), b.customers
    ),
    "gold_procurement_vs_sales": lambda b, orders: gold.procurement_vs_sales(orders(b, PURCHASE), orders(b, SALES)),
    "gold_monthly_procurement_trend": lambda b, orders: gold.monthly_trend(orders(b, PURCHASE), PURCHASE),
    "gold_monthly_sales_trend": lambda b, orders: gold.monthly_trend(orders(b, SALES), SALES),
    "gold_country_wise_procurement": lambda b, orders: gold.country_wise_procurement(
        gold.partner_totals(orders(b, PURCHASE), PURCHASE), b.suppliers
    ),
    "gold_country_wise_sales": lambda b, orders: gold.country_wise_sales(
        gold.partner_totals(orders(b, SALES), SALES), b.customers
    ),
    "gold_top_moving_materials": lambda b, orders: gold.top_moving_materials(
        gold.material_demand(orders(b, PURCHASE), orders(b, SALES), b.materials)
    ),
}


def _gold_query(name: str, orders: Callable[[Bridge, OrderKind], DataFrame]) -> Query:
    return lambda spark, folder: GOLD[name](Bridge(spark, folder), orders)


def _digested(table: DataFrame, name: str) -> DataFrame:
    """Rows and the sum of row digests; rates and means count in whole ten-thousandths."""
    doubles = {c for c, kind in table.dtypes if kind == "double"}
    values = [F.round(F.col(c) * 10000).cast("bigint") if c in doubles else F.col(c) for c in sorted(table.columns)]
    text = F.concat_ws("|", *(F.coalesce(v.cast("string"), F.lit("NULL")) for v in values))
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return table.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(number), F.lit(0)).alias("digest"))


def catalog_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers stored with audit columns and read back from the catalog in their declared columns."""
    namespace = scratch_database(spark, "masters")
    append_table(Bridge(spark, folder).suppliers, f"{namespace}.suppliers")
    return read_table(spark, "suppliers", namespace)


def rows_written(spark: SparkSession, folder: str) -> DataFrame:
    """What each kind of write says it has written."""
    b = Bridge(spark, folder)
    namespace = scratch_database(spark, "written")
    said = {
        "append": append_table(b.sales_orders, f"{namespace}.orders"),
        "replace": replace_table(b.materials, f"{namespace}.materials"),
        "upsert": upsert_buckets(b.customers, f"{namespace}.customers", "customer_id"),
        "csv": write_csv(b.warehouses, scratch_path(spark, "csv")),
        "silver": write_silver(b.typed_purchase_orders, f"{namespace}.silver"),
    }
    return spark.createDataFrame(list(said.items()), "write string, written bigint")


def gold_shown(spark: SparkSession, folder: str) -> DataFrame:
    """The demand table in reading order: each material with the one shown before it."""
    table = GOLD["gold_material_demand"](Bridge(spark, folder), _typed).where("total_demand_quantity > 0")
    return gold.shown("gold_material_demand", table).limit(SHOWN).select("total_demand_quantity")


def gold_written(spark: SparkSession, folder: str) -> DataFrame:
    """All nine tables written to a fresh database and read back: row counts, and a digest of all values in any order."""
    b = Bridge(spark, folder)
    namespace = scratch_database(spark, "gold")
    # seven tables read the orders; lines meet their orders once for all of them
    orders = [_typed_and_stored(b, kind) for kind in (PURCHASE, SALES)]
    rows = write_gold(*orders, b.suppliers, b.customers, b.materials, namespace)
    counts = [_digested(spark.table(f"{namespace}.{name}"), name) for name in rows]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


# Bronze, silver and quality.


def bronze_conform(spark: SparkSession, folder: str) -> DataFrame:
    typed = Bridge(spark, folder).typed_purchase_orders
    rows = conform(typed, RAW_PURCHASE_ORDERS, above=1000)
    return rows.withColumn("above_the_floor", F.col("bronze_row_id") > 1000).drop("bronze_row_id")


def silver_purchase_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_silver(Bridge(spark, folder), PURCHASE))


def silver_sales_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_silver(Bridge(spark, folder), SALES))


def dedupe_keep_last(spark: SparkSession, folder: str) -> DataFrame:
    return keep_latest(Bridge(spark, folder).purchase_orders, PURCHASE.id)


def fk_nullify(spark: SparkSession, folder: str) -> DataFrame:
    b = Bridge(spark, folder)
    return repair_material(b.sales_orders, b.materials, SALES)


def dq_flags_purchase(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_flagged(Bridge(spark, folder), PURCHASE))


def dq_flags_sales(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_flagged(Bridge(spark, folder), SALES))


def dq_profile(spark: SparkSession, folder: str) -> DataFrame:
    b = Bridge(spark, folder)
    per_kind = [
        quality.profile_orders(_bronze(b, kind), _partners(b, kind), b.materials, kind).withColumn("orders", F.lit(kind.name))
        for kind in (PURCHASE, SALES)
    ]
    return per_kind[0].unionByName(per_kind[1])


def dq_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    _, held = quality.quarantine(_flagged(Bridge(spark, folder), PURCHASE))
    return _flat(held)


def dq_impact(spark: SparkSession, folder: str) -> DataFrame:
    b = Bridge(spark, folder)
    receipts = movements.receipt_lines(b.purchase_orders, b.materials, b.warehouses)
    return quality.impact(_silver(b, PURCHASE), receipts, PURCHASE)


def dq_impact_sales(spark: SparkSession, folder: str) -> DataFrame:
    b = Bridge(spark, folder)
    shipments = movements.shipment_lines(b.sales_orders, b.materials, b.warehouses)
    return quality.impact(_silver(b, SALES), shipments, SALES)


def dq_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Per flag, the quantity of purchase copies that made no receipt of their own; with the booked ones all delivered copies."""
    b = Bridge(spark, folder)
    receipts = movements.receipt_lines(b.purchase_orders, b.materials, b.warehouses)
    return lineage_by_flag(trace(b.purchase_orders, b.materials, receipts, PURCHASE))


def dq_lineage_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Every sales copy of a moving status with what kept it from, or made it, a shipment."""
    b = Bridge(spark, folder)
    return trace(b.sales_orders, b.materials, movements.shipment_lines(b.sales_orders, b.materials, b.warehouses), SALES)


def reconcile_so_shipments(spark: SparkSession, folder: str) -> DataFrame:
    b = Bridge(spark, folder)
    return reconcile(b.sales_orders, b.materials, movements.shipment_lines(b.sales_orders, b.materials, b.warehouses), SALES)


def text_checks(spark: SparkSession, folder: str) -> DataFrame:
    """The tolerant readings side by side, over every bronze sales order."""
    orders = Bridge(spark, folder).sales_orders
    return orders.select(
        "bronze_row_id",
        parse_id(F.col("sales_order_id"), SALES.id_prefix).alias("order_number"),
        blank_to_null(F.col("customer_id")).alias("customer"),
        iso_date(F.col("order_date")).alias("strict_date"),
        iso_date(F.col("order_date"), lenient=True).alias("lenient_date"),
        is_numeric_text(F.col("quantity")).alias("numeric_quantity"),
        lead_days(iso_date(F.col("order_date")), iso_date(F.col("requested_delivery_date"))).alias("lead_days"),
    )


# Ledger and inventory.


def clean_delivered_po(spark: SparkSession, folder: str) -> DataFrame:
    return movements.fulfilled_orders(Bridge(spark, folder).purchase_orders, PURCHASE)


def clean_shipped_so(spark: SparkSession, folder: str) -> DataFrame:
    return movements.fulfilled_orders(Bridge(spark, folder).sales_orders, SALES)


def goods_receipts(spark: SparkSession, folder: str) -> DataFrame:
    b = Bridge(spark, folder)
    return movements.goods_receipts(b.purchase_orders, b.materials, b.warehouses)


def sales_shipments(spark: SparkSession, folder: str) -> DataFrame:
    b = Bridge(spark, folder)
    return movements.sales_shipments(b.sales_orders, b.materials, b.warehouses)


def inventory_transactions(spark: SparkSession, folder: str) -> DataFrame:
    b = Bridge(spark, folder)
    return movements.inventory_transactions(b.purchase_orders, b.sales_orders, b.materials, b.warehouses)


def _ledger_lines(b: Bridge) -> DataFrame:
    return movements.ledger_lines(b.purchase_orders, b.sales_orders, b.materials, b.warehouses)


def transaction_counts(spark: SparkSession, folder: str) -> DataFrame:
    return movements.counts_by_type(_ledger_lines(Bridge(spark, folder)))


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    return inventory_snapshot(_ledger_lines(Bridge(spark, folder)))


def inventory_with_production(spark: SparkSession, folder: str) -> DataFrame:
    """Balances of either sign, with production consuming and delivering stock."""
    b = Bridge(spark, folder)
    columns = ["warehouse_id", "material_id", "transaction_type", "quantity"]
    produced = production_lines(b.production_output, b.warehouses).select(*columns)
    return balances(_ledger_lines(b).select(*columns).unionByName(produced))


def receipt_references(spark: SparkSession, folder: str) -> DataFrame:
    return movements.receipt_references(_ledger_lines(Bridge(spark, folder)))


def _booked_ledger(b: Bridge) -> DataFrame:
    earlier = b.purchase_orders.where(F.col("order_date") < BOOKED_BEFORE)
    return movements.goods_receipts(earlier, b.materials, b.warehouses)


def incremental_receipts(spark: SparkSession, folder: str) -> DataFrame:
    b = Bridge(spark, folder)
    return movements.new_receipts(b.purchase_orders, _booked_ledger(b), b.materials, b.warehouses)


def reconcile_po_receipts(spark: SparkSession, folder: str) -> DataFrame:
    b = Bridge(spark, folder)
    receipts = movements.receipt_lines(b.purchase_orders, b.materials, b.warehouses)
    return reconcile(b.purchase_orders, b.materials, receipts, PURCHASE)


def next_id(spark: SparkSession, folder: str) -> DataFrame:
    b = Bridge(spark, folder)
    purchase = next_number(b.purchase_orders, PURCHASE.id, PURCHASE.id_prefix)
    sales = next_number(b.sales_orders, SALES.id, SALES.id_prefix)
    return purchase.withColumn("orders", F.lit("purchase")).unionByName(sales.withColumn("orders", F.lit("sales")))


def hash_routing(spark: SparkSession, folder: str) -> DataFrame:
    b = Bridge(spark, folder)
    routed = movements.route_by_hash(b.sales_orders, SALES.id, b.warehouses)
    return routed.select(
        "bronze_row_id",
        SALES.id,
        "warehouse_id",
        hash_bucket(F.col(SALES.id), 2).alias("of_2"),
        hash_bucket(F.col(SALES.id), 1_000_003).alias("of_1000003"),
    )


def dense_ids(spark: SparkSession, folder: str) -> DataFrame:
    orders = Bridge(spark, folder).purchase_orders.select("bronze_row_id", PURCHASE.id)
    return dense_numbers(orders, ["bronze_row_id"], start=1, name="row_number")


def warehouse_split(spark: SparkSession, folder: str) -> DataFrame:
    return movements.mark_raw_warehouses(Bridge(spark, folder).warehouses)


def month_filter(spark: SparkSession, folder: str) -> DataFrame:
    return in_month(Bridge(spark, folder).typed_purchase_orders, "order_date", 1998, 2)


def lead_times(spark: SparkSession, folder: str) -> DataFrame:
    """Days from order to expected delivery per supplier, over silver orders."""
    orders = _silver(Bridge(spark, folder), PURCHASE)
    days = lead_days(F.col("order_date"), F.col("expected_delivery_date"))
    return orders.groupBy("supplier_id").agg(
        F.count(days).alias("dated_orders"),
        F.min(days).alias("shortest"),
        F.max(days).alias("longest"),
        F.sum(days).alias("total_days"),
    )


# Masters, files, deliveries.


def materials_by_type(spark: SparkSession, folder: str) -> DataFrame:
    """Raw materials and finished goods, selected apart and put together again."""
    b = Bridge(spark, folder)
    return materials_of(b.materials, PURCHASE.material_type).unionByName(
        materials_of(b.materials, SALES.material_type)
    )


def _master_versions(b: Bridge) -> tuple[DataFrame, DataFrame]:
    """A loaded material master that misses some parts, and a later batch with new names and new parts."""
    text = (
        "SELECT concat('MT', cast(p_partkey AS string)) AS material_id, {name} AS material_name, "
        "p_type AS material_type FROM {{part}} WHERE {condition}"
    )
    part = b.source("part")
    loaded = b.spark.sql(text.format(name="p_name", condition="p_size <= 40"), part=part)
    batch = b.spark.sql(text.format(name="concat(p_name, ' ', p_brand)", condition="p_size >= 25"), part=part)
    at = F.lit(MASTER_LOADED)
    return loaded.withColumns({"created_at": at, "updated_at": at}), batch


def upsert_master(spark: SparkSession, folder: str) -> DataFrame:
    loaded, batch = _master_versions(Bridge(spark, folder))
    merged = upsert(loaded, batch, "material_id", MASTER_CHANGED)
    return merged.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd") for c in ("created_at", "updated_at")}
    )


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze orders written as CSV and read back, with NULL and empty text kept apart."""
    path = scratch_path(spark, "csv")
    write_csv(Bridge(spark, folder).purchase_orders.drop("bronze_row_id"), path, NULL_TEXT)
    return read_csv(spark, f"{path}/*.csv", RAW_PURCHASE_ORDERS, NULL_TEXT)


def csv_import(spark: SparkSession, folder: str) -> DataFrame:
    """CSV files imported together, the last row of an order kept in file order."""
    path = scratch_path(spark, "landing")
    orders = Bridge(spark, folder).purchase_orders
    halves = (F.col("bronze_row_id") < 2**59, F.col("bronze_row_id") >= 2**59)
    for part, condition in enumerate(halves):
        ordered = orders.where(condition).orderBy("bronze_row_id").drop("bronze_row_id")
        write_csv(ordered, f"{path}/purchase_orders_{part}")
    return import_csv(spark, f"{path}/*/*.csv", RAW_PURCHASE_ORDERS, PURCHASE.id)


def deliveries(spark: SparkSession, folder: str) -> DataFrame:
    b = Bridge(spark, folder)
    return delivery_status(b.supplier_deliveries, b.purchase_orders)


def supplier_evaluation(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate_suppliers(deliveries(spark, folder), EVALUATED_ON)


# Streams, run over all files that are there and then ended.


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_path(spark, "ingest")
    write_csv(Bridge(spark, folder).sales_orders.drop("bronze_row_id"), f"{base}/landing")
    query = ingest_files(
        spark, f"{base}/landing", RAW_SALES_ORDERS, f"{base}/bronze", f"{base}/state", files_per_batch=2
    )
    query.awaitTermination()
    return spark.read.parquet(f"{base}/bronze").select(*SALES.bronze_columns)


def _receipt_stream(spark: SparkSession, folder: str, runs: int) -> tuple[str, str]:
    """Ledger path and snapshot name after all bronze files were read, once by each of some fresh checkpoints."""
    b = Bridge(spark, folder)
    base = scratch_path(spark, "receipts")
    # One file per run of row ids would split copies over batches; hashing the id keeps them together.
    # There are two batches of files whatever the input, and a file for every core.
    files = max(4, spark.sparkContext.defaultParallelism)
    b.purchase_orders.repartition(files, PURCHASE.id).select(*BRONZE_PURCHASE_ORDERS.names).write.parquet(
        f"{base}/bronze"
    )
    seed_ledger(_booked_ledger(b), f"{base}/ledger", f"{base}/balances")
    snapshot = f"{scratch_database(spark, 'stock')}.inventory"
    for run in range(runs):
        book_receipts(
            stream_bronze(spark, f"{base}/bronze", BRONZE_PURCHASE_ORDERS, files_per_batch=-(-files // 2)),
            f"{base}/ledger",
            f"{base}/balances",
            b.materials,
            b.warehouses,
            None,
            f"{base}/state-{run}",
        ).awaitTermination()
    publish_stock(spark, f"{base}/balances", snapshot)
    return f"{base}/ledger", snapshot


def stream_receipts(spark: SparkSession, folder: str) -> DataFrame:
    """Receipts booked from a stream of bronze files over a ledger that already has some."""
    # Which batch a file falls into decides its numbers, so the id stays out of the result.
    return read_ledger(spark, _receipt_stream(spark, folder, 1)[0]).drop("transaction_id", "receipt_run", "receipt_batch")


def stream_receipts_restarted(spark: SparkSession, folder: str) -> DataFrame:
    """The same files read again by a fresh checkpoint: every order is booked once."""
    return read_ledger(spark, _receipt_stream(spark, folder, 2)[0]).drop("transaction_id", "receipt_run", "receipt_batch")


def stream_stock(spark: SparkSession, folder: str) -> DataFrame:
    """The stock snapshot that the receipt stream publishes."""
    return without_audit(spark.table(_receipt_stream(spark, folder, 1)[1]))


def stream_ingest_two_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Two landing folders, each with its own checkpoint, into one bronze folder."""
    base = scratch_path(spark, "ingest")
    orders = Bridge(spark, folder).sales_orders
    for part in (0, 1):
        own = orders.where(F.pmod("bronze_row_id", F.lit(2)) == part).drop("bronze_row_id")
        write_csv(own, f"{base}/landing-{part}")
        ingest_files(spark, f"{base}/landing-{part}", RAW_SALES_ORDERS, f"{base}/bronze", f"{base}/state-{part}").awaitTermination()
    rows = spark.read.parquet(f"{base}/bronze")
    repeated = rows.groupBy("bronze_row_id").agg(F.count(F.lit(1)).alias("times"))
    complete = F.col("source_file").isNotNull() & F.col("ingested_at").isNotNull()
    return rows.join(repeated, "bronze_row_id").select(*SALES.bronze_columns, (complete & (F.col("times") == 1)).alias("complete"))


def _write_lines(lines: DataFrame, header: str, path: str) -> None:
    """Records as they stand below a header, whatever they hold."""
    as_they_stand = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.toDF(header).write.options(header=True, sep="\x01", quote="\x02", nullValue="", **as_they_stand).csv(path)


def stream_ingest_rescued(spark: SparkSession, folder: str) -> DataFrame:
    """Files with columns in another order, without a column and with a new one, and with damaged records: none is lost."""
    base = scratch_path(spark, "rescued")
    orders = Bridge(spark, folder).sales_orders
    part, kind = F.pmod("bronze_row_id", F.lit(4)), F.pmod(F.shiftright("bronze_row_id", 2), F.lit(3))
    names = list(SALES.bronze_columns)
    write_csv(orders.where(part == 0).select(*reversed(names)), f"{base}/landing/reordered")
    note = F.concat(F.lit("n"), F.col("bronze_row_id").cast("string")).alias("note")
    write_csv(orders.where(part == 1).select(names[0], note, *names[1:-1]), f"{base}/landing/other")
    write_csv(orders.where(part == 2).select(*names), f"{base}/landing/plain")
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in names])
    damaged = F.when(kind == 0, F.concat(line, F.lit(",surplus"))).when(kind == 1, F.col(names[0])).otherwise(F.concat(F.lit('"'), line))
    _write_lines(orders.where(part == 3).select(damaged.alias("line")), ",".join(names), f"{base}/landing/damaged")
    state = (f"{base}/bronze", f"{base}/quarantine", f"{base}/state")
    ingest_rescued(spark, f"{base}/landing/*", RAW_SALES_ORDERS, *state, files_per_batch=5).awaitTermination()
    rescued = F.col("_rescued")
    rows = spark.read.parquet(f"{base}/bronze").select(
        *names, rescued["note"].alias("note"), rescued.isNotNull().alias("rescued"), F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("raw")
    )
    held = spark.read.parquet(f"{base}/quarantine").select("reason", F.col("_raw").alias("raw"), (F.col("_line") > 1).alias("rescued"))
    return rows.unionByName(held, allowMissingColumns=True)


def stream_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Latest copies of purchase orders from a stream of all copies, in files that are read one after the other."""
    base = scratch_path(spark, "latest")
    arrived = F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("bronze_row_id"), F.lit(86_400)))
    copies = Bridge(spark, folder).purchase_orders.withColumn("event_time", arrived)
    copies.repartition(3, "bronze_row_id").write.parquet(f"{base}/in")
    # something that comes long after, so that the watermark passes all of them
    nothing = {c: F.lit(None).cast(copies.schema[c].dataType) for c in copies.columns if c not in ("event_time", PURCHASE.id)}
    closing = spark.range(1).select(F.lit("closing").alias(PURCHASE.id), F.timestamp_seconds(F.lit(1_800_000_000)).alias("event_time"))
    closing.withColumns(nothing).select(*copies.columns).write.mode("append").parquet(f"{base}/in")
    rows = spark.readStream.schema(copies.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    waiting = spark.read.schema(copies.schema).parquet(f"{base}/in").count()
    latest = latest_copies(rows, PURCHASE.id, "2 days", 3_600_000, buckets=buckets_for(waiting))
    with room_for(spark, waiting):
        query = latest.writeStream.option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start(f"{base}/out", format="parquet")
    query.awaitTermination()
    return spark.read.schema(latest.schema).parquet(f"{base}/out")


def mixed_loads(spark: SparkSession, folder: str) -> DataFrame:
    """A batch load of early copies, then a stream of the final ones: what arrived last survives."""
    b = Bridge(spark, folder)
    base = scratch_path(spark, "mixed")
    early = b.purchase_orders.drop("bronze_row_id").withColumns({"status": F.lit("CREATED"), "quantity": F.lit("1")})
    conform(early, RAW_PURCHASE_ORDERS).write.parquet(f"{base}/batch")
    loaded = spark.read.parquet(f"{base}/batch")
    write_csv(keep_latest(b.purchase_orders, PURCHASE.id).drop("bronze_row_id"), f"{base}/landing")
    ingest_files(
        spark, f"{base}/landing", RAW_PURCHASE_ORDERS, f"{base}/stream", f"{base}/state", floor=lambda: highest_row_id(loaded)
    ).awaitTermination()
    columns = ("bronze_row_id", *PURCHASE.bronze_columns)
    streamed = spark.read.parquet(f"{base}/stream").select(*columns)
    return keep_latest(loaded.select(*columns).unionByName(streamed), PURCHASE.id).drop("bronze_row_id")


def stream_masters(spark: SparkSession, folder: str) -> DataFrame:
    """Supplier changes from a stream of files: known, new, changed, and late ones that change nothing."""
    base = scratch_path(spark, "masters")
    table = f"{scratch_database(spark, 'masters')}.suppliers"
    schema = StructType([*SUPPLIERS.fields, StructField("change", IntegerType(), True)])
    suppliers = Bridge(spark, folder).suppliers.withColumn("_number", F.substring("supplier_id", 4, 20).cast("int"))

    def changes(condition: str, addition: str, change: int) -> DataFrame:
        name = F.concat("supplier_name", F.lit(addition)).alias("supplier_name")
        return suppliers.where(condition).select("supplier_id", name, "country", F.lit(change).alias("change"))

    arriving = (
        changes("_number % 7 > 0", "", 1),
        changes("_number % 3 = 0", " Ltd", 3).unionByName(changes("_number % 7 = 0 AND _number % 3 > 0", "", 1)),
        changes("_number % 3 = 0", " late", 2),
    )
    for rows in arriving:
        rows.write.mode("append").parquet(f"{base}/changes")
        arrived = spark.readStream.schema(schema).parquet(f"{base}/changes")
        upsert_stream(arrived, table, "supplier_id", "change", f"{base}/state").awaitTermination()
    kept = F.col("created_at") <= F.col("updated_at")
    return spark.table(table).select("supplier_id", "supplier_name", "country", "change", kept.alias("audited"))


# Stored tables.


def append_then_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Append, replace, append and repair of one name: readers see every row."""
    b = Bridge(spark, folder)
    name = f"{scratch_database(spark, 'orders')}.sales_orders"
    halves = [b.sales_orders.where(F.pmod("bronze_row_id", F.lit(2)) == part) for part in (0, 1)]
    append_table(halves[0], name)
    replace_table(spark.table(name), name)
    append_table(halves[1], name)
    repair_stored_orders(spark, name, b.materials, SALES)
    return without_audit(spark.table(name))


def snapshot_replace(spark: SparkSession, folder: str) -> DataFrame:
    """All balances stored, then replaced by the positive ones among them."""
    name = f"{scratch_database(spark, 'stock')}.inventory"
    replace_table(balances(_ledger_lines(Bridge(spark, folder))), name)
    replace_table(spark.table(name).where("quantity > 0"), name)
    return spark.table(name)


def silver_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """Silver orders written by month over a version in which every order stood in another month."""
    name = f"{scratch_database(spark, 'silver')}.silver_purchase_orders"
    orders = settled(_silver(Bridge(spark, folder), PURCHASE))
    write_silver(orders.withColumn("order_date", F.add_months("order_date", -400)), name)
    write_silver(orders, name)
    return _flat(spark.table(name)).drop("order_month")


# KPIs refreshed month by month.


def _changed(orders: DataFrame, kind: OrderKind) -> tuple[DataFrame, DataFrame]:
    """An earlier state of the silver orders, and the batch that leads from it to the present one.

    Orders of two months had another quantity, status and partner, a third month's stood in a month that
    has no others, some had no date, and some weren't there yet.
    """
    month = F.trunc("order_date", "month")
    altered = month.isin(*(F.lit(m) for m in CHANGED_MONTHS))
    moved, undated, absent = month == F.lit(MOVED_MONTH), month == F.lit(UNDATED_MONTH), month == F.lit(NEW_MONTH)
    earlier = orders.where(~F.coalesce(absent, F.lit(False))).withColumns(
        {
            "quantity": F.when(altered, F.col("quantity") * 3).otherwise(F.col("quantity")),
            "status": F.when(altered, F.lit("CANCELLED")).otherwise(F.col("status")),
            kind.partner: F.when(altered, F.lit(None).cast("string")).otherwise(F.col(kind.partner)),
            "order_date": F.when(moved, F.lit(date(2031, 5, 9))).when(~F.coalesce(undated, F.lit(False)), F.col("order_date")),
        }
    )
    return earlier, orders.where(altered | moved | undated | absent)


@cache
def _monthly_database(spark: SparkSession, folder: str) -> str:
    return scratch_database(spark, "monthly")


def _monthly(b: Bridge, *kinds: OrderKind) -> str:
    """Database of orders stored by month in an earlier state and then changed by a batch; made once for each folder."""
    namespace = _monthly_database(b.spark, b.folder)
    for kind in kinds:
        if b.spark.catalog.tableExists(partial_table(namespace, kind, "bits")):
            continue
        # both states are made of the same orders, and these of two large joins
        earlier, batch = _changed(settled(_silver(b, kind)), kind)
        store_orders(earlier, _partners(b, kind), kind, namespace)
        change_orders(batch, _partners(b, kind), kind, namespace)
    return namespace


def _refreshed(name: str, *kinds: OrderKind) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        b = Bridge(spark, folder)
        return gold_of_months(spark, _monthly(b, *kinds), b.suppliers, b.customers, b.materials, kinds)[name]

    return query


def partners_by_year(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers and customers with an active order in each year, counted by merging the bitmaps of its months."""
    b = Bridge(spark, folder)
    namespace = _monthly(b, PURCHASE, SALES)
    year = F.year("order_month").alias("order_year")
    counts = [
        distinct_partners(spark.table(partial_table(namespace, kind, "bits")), "partners", year).withColumn("orders", F.lit(kind.name))
        for kind in (PURCHASE, SALES)
    ]
    return counts[0].unionByName(counts[1])


def gold_of_a_year(spark: SparkSession, folder: str) -> DataFrame:
    """Country table of one year from its months' partials and bitmaps."""
    b = Bridge(spark, folder)
    held = _monthly(b, PURCHASE)
    tables = gold_of_months(spark, held, b.suppliers, b.customers, b.materials, [PURCHASE], date(1996, 1, 1), date(1996, 12, 1))
    return tables["gold_country_wise_procurement"]


def orders_of_changed_months(spark: SparkSession, folder: str) -> DataFrame:
    """Stored orders of the months in which an order has no partner; which months these are is found when it runs."""
    b = Bridge(spark, folder)
    name = f"{scratch_database(spark, 'silver')}.silver_purchase_orders"
    write_silver(_silver(b, PURCHASE), name)
    months = spark.table(name).where("supplier_id IS NULL AND quantity > 30").select("order_month")
    return _flat(read_months(spark.table(name), months)).drop("order_month")


REFRESHED: dict[str, tuple[OrderKind, ...]] = {
    "gold_supplier_performance": (PURCHASE,),
    "gold_customer_sales_summary": (SALES,),
    "gold_material_demand": (PURCHASE, SALES),
    "gold_procurement_vs_sales": (PURCHASE, SALES),
    "gold_monthly_procurement_trend": (PURCHASE,),
    "gold_monthly_sales_trend": (SALES,),
    "gold_country_wise_procurement": (PURCHASE,),
    "gold_country_wise_sales": (SALES,),
}

QUERIES: dict[str, Query] = {
    **{name: _gold_query(name, _typed) for name in GOLD},
    **{f"{name}_on_silver": _gold_query(name, _silver) for name in GOLD},
    "gold_written": gold_written,
    "gold_shown": gold_shown,
    "catalog_scan": catalog_scan,
    "rows_written": rows_written,
    "bronze_conform": bronze_conform,
    "silver_purchase_orders": silver_purchase_orders,
    "silver_sales_orders": silver_sales_orders,
    "dedupe_keep_last": dedupe_keep_last,
    "fk_nullify": fk_nullify,
    "dq_flags_purchase": dq_flags_purchase,
    "dq_flags_sales": dq_flags_sales,
    "dq_profile": dq_profile,
    "dq_quarantine": dq_quarantine,
    "dq_impact": dq_impact,
    "dq_impact_sales": dq_impact_sales,
    "dq_lineage": dq_lineage,
    "dq_lineage_sales": dq_lineage_sales,
    "text_checks": text_checks,
    "clean_delivered_po": clean_delivered_po,
    "clean_shipped_so": clean_shipped_so,
    "goods_receipts": goods_receipts,
    "sales_shipments": sales_shipments,
    "inventory_transactions": inventory_transactions,
    "transaction_counts": transaction_counts,
    "inventory_snapshot": inventory,
    "inventory_with_production": inventory_with_production,
    "receipt_references": receipt_references,
    "incremental_receipts": incremental_receipts,
    "reconcile_po_receipts": reconcile_po_receipts,
    "reconcile_so_shipments": reconcile_so_shipments,
    "next_id": next_id,
    "hash_routing": hash_routing,
    "dense_ids": dense_ids,
    "warehouse_split": warehouse_split,
    "month_filter": month_filter,
    "lead_times": lead_times,
    "materials_by_type": materials_by_type,
    "upsert_master": upsert_master,
    "csv_roundtrip": csv_roundtrip,
    "csv_import": csv_import,
    "delivery_status": deliveries,
    "supplier_evaluation": supplier_evaluation,
    "stream_ingest": stream_ingest,
    "stream_receipts": stream_receipts,
    "append_then_repair": append_then_repair,
    "snapshot_replace": snapshot_replace,
    "silver_by_month": silver_by_month,
    "stream_ingest_two_sources": stream_ingest_two_sources,
    "stream_ingest_rescued": stream_ingest_rescued,
    "stream_latest": stream_latest,
    "mixed_loads": mixed_loads,
    "stream_receipts_restarted": stream_receipts_restarted,
    "stream_stock": stream_stock,
    "stream_masters": stream_masters,
    **{name.replace("gold_", "refreshed_", 1): _refreshed(name, *kinds) for name, kinds in REFRESHED.items()},
    "partners_by_year": partners_by_year,
    "gold_of_a_year": gold_of_a_year,
    "orders_of_changed_months": orders_of_changed_months,
}
