"""Orders stored by month: refreshed KPIs equal full ones, and only the months of changed orders are read."""

from __future__ import annotations

from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace.model import PURCHASE, SALES
from millrace.plans import gold, partials
from millrace.session import scratch_database
from millrace.sources import monthly, sinks
from tests import rows

SCHEMAS = {
    "purchase": "bronze_row_id long, purchase_order_id string, order_date date, supplier_id string, material_id string, quantity long, expected_delivery_date date, status string, dq_flags array<string>",
    "sales": "bronze_row_id long, sales_order_id string, order_date date, customer_id string, material_id string, quantity long, requested_delivery_date date, status string, dq_flags array<string>",
}


def order(number, day, partner="SUP001", material="RM0001", quantity=5, status="DELIVERED", prefix="PO"):
    return (number, None if number is None else f"{prefix}{number:06d}", day, partner, material, quantity, None, status, [])


def frame(spark, orders, kind=PURCHASE):
    return spark.createDataFrame(orders, SCHEMAS[kind.name])


def plain(df):
    return Counter(tuple(sorted((k, repr(v)) for k, v in r.asDict().items())) for r in df.collect())


def same(a, b):
    assert plain(a) == plain(b.select(*a.columns))


def orders_of(spark, kind):
    """Orders of eight months and none, with nulls, unknown partners and all statuses."""
    made = []
    for n in range(160):
        day = None if n % 17 == 0 else date(2024, 1 + n % 8, 1 + n % 28)
        partner = [f"{kind.partner[:3].upper()}00{1 + n % 3}", None, "nobody"][0 if n % 11 else (1 if n % 2 else 2)]
        made.append(order(n, day, partner, f"{'RM' if kind is PURCHASE else 'FG'}000{1 + n % 2}", None if n % 13 == 0 else n, kind.statuses[n // 8 % len(kind.statuses)], kind.id_prefix))
    return made + [order(None, date(2024, 3, 3), prefix=kind.id_prefix)]


@pytest.fixture
def db(spark):
    return scratch_database(spark, "monthly")


def stored(spark, db, kind):
    name = monthly.orders_table(db, kind)
    return spark.table(name).drop("order_month")


def check_tables(spark, db, kinds, current):
    m = rows.masters(spark)
    held = [frame(spark, current.get(kind.name, []), kind) for kind in (PURCHASE, SALES)]
    whole = gold.gold_tables(*held, m["suppliers"], m["customers"], m["materials"])
    tables = monthly.gold_of_months(spark, db, m["suppliers"], m["customers"], m["materials"], kinds)
    assert len(tables) == (8 if len(kinds) == 2 else 3)
    for name, table in tables.items():
        same(whole[name], table)


def test_refreshed_tables_equal_full_ones(spark, db):
    m = rows.masters(spark)
    current = {kind.name: orders_of(spark, kind) for kind in (PURCHASE, SALES)}
    for kind, partners in ((PURCHASE, m["suppliers"]), (SALES, m["customers"])):
        assert monthly.store_orders(frame(spark, current[kind.name], kind), partners, kind, db) == 161
    check_tables(spark, db, (PURCHASE, SALES), current)

    held = {o[1]: o for o in current["purchase"]}
    batch = [order(3, date(2024, 4, 4), quantity=1000), order(11, date(2025, 1, 5)), order(17, date(2024, 2, 2)), order(900, None), order(None, date(2024, 6, 1), quantity=7)]
    months = monthly.change_orders(frame(spark, batch), m["suppliers"], PURCHASE, db)
    assert set(months) == {date(2024, 4, 1), date(2025, 1, 1), None, date(2024, 2, 1), date(2024, 6, 1), date(2024, 3, 1)}
    current["purchase"] = list((held | {o[1]: o for o in batch}).values())
    same(frame(spark, current["purchase"]), stored(spark, db, PURCHASE))
    check_tables(spark, db, (PURCHASE, SALES), current)


def test_a_month_that_all_orders_leave_is_gone(spark, db):
    m = rows.masters(spark)
    monthly.store_orders(frame(spark, [order(1, date(2024, 1, 1)), order(2, date(2024, 2, 1))]), m["suppliers"], PURCHASE, db)
    monthly.change_orders(frame(spark, [order(1, date(2024, 2, 9))]), m["suppliers"], PURCHASE, db)
    for what in ("partners", "materials", "bits"):
        assert [r[0] for r in spark.table(monthly.partial_table(db, PURCHASE, what)).select("order_month").distinct().collect()] == [date(2024, 2, 1)]
    check_tables(spark, db, (PURCHASE,), {"purchase": [order(1, date(2024, 2, 9)), order(2, date(2024, 2, 1))]})
    monthly.change_orders(frame(spark, []), m["suppliers"], PURCHASE, db)
    with pytest.raises(ValueError, match="occurs 2 times"):
        monthly.change_orders(frame(spark, [order(1, None), order(1, None)]), m["suppliers"], PURCHASE, db)


def test_only_touched_months_are_read_and_written(spark, db):
    m = rows.masters(spark)
    monthly.store_orders(frame(spark, orders_of(spark, PURCHASE)), m["suppliers"], PURCHASE, db)
    files = {}
    for what in ("partners", "materials", "bits"):
        name = monthly.partial_table(db, PURCHASE, what)
        files[what] = set(spark.table(name).inputFiles())
    # a month that can't be read any more: whoever reads it fails
    path = sinks.location(spark, monthly.orders_table(db, PURCHASE))
    spark._jvm.org.apache.commons.io.FileUtils.cleanDirectory(spark._jvm.java.io.File(f"{path}/order_month=2024-05-01".removeprefix("file:")))
    monthly.refresh_partials(spark, db, m["suppliers"], PURCHASE, [date(2024, 4, 1)])
    for what in ("partners", "materials", "bits"):
        now = set(spark.table(monthly.partial_table(db, PURCHASE, what)).inputFiles())
        gone = {f.split("order_month=")[1][:10] for f in files[what] - now}
        assert gone == {"2024-04-01"} and len(now) == len(files[what])


def test_months_known_at_run_time_prune_the_scan(spark, db):
    name = f"{db}.orders"
    sinks.write_silver(frame(spark, orders_of(spark, PURCHASE)), name)
    wanted = spark.table(name).where("quantity = 20").select("order_month")
    read = monthly.read_months(spark.table(name), wanted)
    text = read._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text
    months = {r[0] for r in wanted.collect()}
    assert plain(read) == plain(spark.table(name).where(F.col("order_month").isin(*months)))
    none = spark.createDataFrame([(None,)], "order_month date")
    assert monthly.read_months(spark.table(name), none).count() == spark.table(name).where("order_month IS NULL").count() > 0
    assert monthly.read_months(spark.table(name), none.limit(0)).count() == 0
    ranged = partials.between(spark.table(name), date(2024, 2, 1), date(2024, 3, 1))
    scan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in scan


def test_partners_keep_their_numbers(spark, db):
    m = rows.masters(spark)["suppliers"]
    first = {r.supplier_id: r.number for r in monthly.number_partners(spark, db, m.where("supplier_id <> 'SUP002'"), PURCHASE).collect()}
    again = {r.supplier_id: r.number for r in monthly.number_partners(spark, db, m, PURCHASE).collect()}
    assert first == {k: v for k, v in again.items() if k in first}
    assert sorted(again.values()) == [1, 2, 3]


def test_distinct_partners_of_any_months(spark):
    rows_ = [(date(2024, m, 1), n, "NL" if n % 3 else "FR") for m in range(1, 7) for n in range(1, 70_000, 7 * m)]
    active = spark.createDataFrame(rows_, "order_month date, number long, country string")
    bits = active.groupBy("order_month", "country", F.bitmap_bucket_number("number").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
    for first, last in ((1, 6), (2, 3), (5, 5)):
        months = (date(2024, first, 1), date(2024, last, 1))
        got = {r.country: r.n for r in partials.distinct_partners(partials.between(bits, *months), "n").collect()}
        exact = {c: len({n for m, n, k in rows_ if months[0] <= m <= months[1] and k == c}) for c in ("NL", "FR")}
        assert got == exact
