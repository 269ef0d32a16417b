"""How evenly tasks are filled when a third of the rows share an id, a supplier and a material.

A command, not a test: ``python -m tests.skew_probe [orders] [nobroadcast]`` from an empty folder. Spark's
own skew handling, coalescing and automatic broadcasts are off, so what is seen is the engine's doing.
"""

from __future__ import annotations

import glob
import json
import statistics
import sys
import tempfile
from collections import defaultdict

from pyspark.sql import functions as F

from millrace import model
from millrace.operators import lookup
from millrace.plans import movements, quality
from millrace.plans.silver import silver_orders
from tests.comparing import local_session


def skewed_orders(spark, rows: int):
    n = F.col("id")
    order_id = (
        F.when(n % 3 == 0, "PO000001")
        .when(n % 30 == 1, F.lit(None).cast("string"))
        .otherwise(F.format_string("PO%06d", (n / 2).cast("bigint")))
    )
    return spark.range(rows).select(
        n.alias("bronze_row_id"),
        order_id.alias("purchase_order_id"),
        F.lit("2025-02-03").alias("order_date"),
        F.when(n % 3 == 1, "SUP001").otherwise(F.format_string("SUP%03d", n % 100_000)).alias("supplier_id"),
        F.when(n % 3 == 1, "RM0001").otherwise(F.format_string("RM%04d", n % 200_000)).alias("material_id"),
        (n % 50).cast("string").alias("quantity"),
        F.lit("2025-03-01").alias("expected_delivery_date"),
        F.when(n % 5 == 0, "CREATED").otherwise("DELIVERED").alias("status"),
    )


def report(log: str) -> None:
    job, read = {}, defaultdict(list)
    for line in open(log):
        event = json.loads(line)
        if event["Event"] == "SparkListenerJobStart":
            for stage in event["Stage IDs"]:
                job.setdefault(stage, event["Properties"].get("spark.jobGroup.id"))
        elif event["Event"] == "SparkListenerTaskEnd":
            read[event["Stage ID"]].append(event["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"])
    for stage, records in sorted(read.items()):
        if job.get(stage) and max(records) > 10_000:
            middle = statistics.median(records)
            print(f"{job[stage]}: {len(records)} tasks, most {max(records)}, median {middle:.0f} records")


def main(rows: int, broadcast: bool) -> None:
    base = tempfile.mkdtemp(prefix="skew-", dir="/tmp")
    spark = local_session(
        8,
        **{
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{base}",
            "spark.eventLog.rolling.enabled": "false",
            "spark.eventLog.compress": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "32",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.enabled": "false",
        },
    )
    if not broadcast:
        lookup.fits_broadcast = lambda *_: False
    skewed_orders(spark, rows).write.parquet(f"{base}/orders")
    orders = spark.read.parquet(f"{base}/orders")
    suppliers = spark.range(0, 100_000, 2).select(F.format_string("SUP%03d", "id").alias("supplier_id"))
    materials = spark.range(200_000).select(
        F.format_string("RM%04d", "id").alias("material_id"), F.lit(model.RAW_MATERIAL).alias("material_type")
    )
    warehouses = spark.createDataFrame([("WH001", "raw materials", "PL001"), ("WH002", "x", "PL001")], model.WAREHOUSES)
    runs = {
        "silver": lambda: silver_orders(orders, suppliers, materials, model.PURCHASE),
        "flags": lambda: quality.flag_orders(orders, suppliers, materials, model.PURCHASE),
        "receipts": lambda: movements.goods_receipts(orders, materials, warehouses),
    }
    for name, run in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        run().write.format("noop").mode("overwrite").save()
    spark.stop()
    report(next(f for f in glob.glob(f"{base}/*") if "local-" in f))


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000, "nobroadcast" not in sys.argv)
