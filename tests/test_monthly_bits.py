"""Bitmaps of partners grow with the partners, not with tasks and countries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.model import PURCHASE
from millrace.plans.partials import partner_bits
from millrace.session import scratch_database
from millrace.sources.monthly import number_partners


def test_numbers_follow_countries_and_known_ones_stay(spark):
    name = scratch_database(spark, "numbers")
    partners = spark.createDataFrame([(f"SUP{i:03d}", None if i == 5 else "XYZ"[i % 3]) for i in range(30)], "supplier_id string, country string")
    first = {r.supplier_id: r.number for r in number_partners(spark, name, partners.where("supplier_id < 'SUP020'"), PURCHASE).collect()}
    found = number_partners(spark, name, partners, PURCHASE).collect()
    assert sorted(r.number for r in found) == list(range(1, 31)) and {r.supplier_id: r.number for r in found if r.supplier_id in first} == first
    runs = [r.country for r in sorted(found, key=lambda r: r.number) if r.supplier_id in first]
    assert sum(a != b for a, b in zip(runs, runs[1:])) == 3


def test_no_bitmap_is_shuffled_before_it_is_whole(spark):
    """Narrow rows are exchanged, then bits are set once."""
    partials = spark.range(1000).selectExpr("date_add(DATE'2025-01-01', cast(id % 3 AS int)) AS order_month", "cast(id AS string) AS supplier_id", "1L AS active_rows")
    numbered = spark.range(1000).selectExpr("cast(id AS string) AS supplier_id", "cast(id % 2 AS string) AS country", "id + 1 AS number").hint("broadcast")
    bits = partner_bits(partials, numbered, PURCHASE)
    executed = bits._jdf.queryExecution().executedPlan().toString()
    assert bits.agg(F.sum(F.bitmap_count("bits"))).first()[0] == 1000
    above = executed[: executed.index("REPARTITION_BY_COL")]
    assert "bitmap_construct_agg" in above and above.count("Exchange") == 1, executed
