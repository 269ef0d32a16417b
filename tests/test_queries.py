"""Every registered query against its SQL, all columns, rows and values."""

import pytest

import __spark_entry__ as contract
from millrace.operators import lookup
from millrace.registry.oracles import ORACLES
from millrace.registry.queries import QUERIES
from tests.comparing import compare, database

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    equal, report = compare(spark, connection, FOLDER, name)
    assert equal, report


@pytest.mark.parametrize(
    "name",
    [
        "silver_purchase_orders",
        "dq_flags_sales",
        "dq_impact",
        "fk_nullify",
        "inventory_with_production",
        "incremental_receipts",
        "reconcile_po_receipts",
        "delivery_status",
        "hash_routing",
        "gold_top_moving_materials_on_silver",
    ],
)
def test_query_equals_its_sql_without_any_broadcast(spark, connection, monkeypatch, name):
    """The way taken when no reference fits in memory: shuffled on both sides, heavy keys cut."""
    monkeypatch.setattr(lookup, "fits_broadcast", lambda *_: False)
    monkeypatch.setattr(lookup, "PIECES", 40)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        equal, report = compare(spark, connection, FOLDER, name)
    finally:
        spark.conf.unset(threshold)
    assert equal, report
