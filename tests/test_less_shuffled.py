"""Gold and profile: what is not worked out or shuffled more often than needed, with the same rows."""

from __future__ import annotations

from millrace.model import PURCHASE, SALES
from millrace.plans import quality
from millrace.registry import queries
from millrace.registry.bridge import Bridge

FOLDER = "/root/testdata/sf0.001"


def test_gold_tables_read_orders_that_are_joined_already(spark, monkeypatch):
    plans, write = [], queries.write_gold

    def seen(purchases, sales, *rest):
        plans.extend(x._jdf.queryExecution().optimizedPlan().toString() for x in (purchases, sales))
        return write(purchases, sales, *rest)

    monkeypatch.setattr(queries, "write_gold", seen)
    assert queries.gold_written(spark, FOLDER).count() == 9
    assert len(plans) == 2 and not any("Join" in x for x in plans)


def test_profile_counts_repeated_ids_without_marking_rows(spark):
    b = Bridge(spark, FOLDER)
    for kind, partners in ((PURCHASE, b.suppliers), (SALES, b.customers)):
        bronze = b.purchase_orders if kind is PURCHASE else b.sales_orders
        no_id = bronze.limit(2).selectExpr(*[f"CAST(NULL AS STRING) AS {kind.id}" if c == kind.id else c for c in bronze.columns])
        copies = bronze.limit(5).selectExpr(*["-bronze_row_id AS bronze_row_id" if c == "bronze_row_id" else c for c in bronze.columns])
        no_id = no_id.selectExpr(*["-1 - bronze_row_id AS bronze_row_id" if c == "bronze_row_id" else c for c in bronze.columns])
        for orders in (bronze.unionByName(copies).unionByName(no_id), bronze.limit(0)):
            orders = orders.localCheckpoint()
            marked = quality.profile(quality.flag_orders(orders, partners, b.materials, kind)).collect()
            found = quality.profile_orders(orders, partners, b.materials, kind)
            assert sorted(map(str, found.collect())) == sorted(map(str, marked))
            assert "_repeated" not in found._jdf.queryExecution().optimizedPlan().toString()
