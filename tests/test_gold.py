from datetime import date

from millrace.model import PURCHASE, SALES
from millrace.plans import gold
from millrace.plans.silver import silver_orders
from tests import rows
from tests.test_operators import plan


def silver(spark, purchases, sold):
    m = rows.masters(spark)
    return (
        silver_orders(rows.purchase(spark, purchases), m["suppliers"], m["materials"], PURCHASE),
        silver_orders(rows.sales(spark, sold), m["customers"], m["materials"], SALES),
        m,
    )


def numbered(key, changes):
    return [{key: f"{n}", **c} for n, c in enumerate(changes)]


def example(spark):
    return silver(
        spark,
        numbered(
            "purchase_order_id",
            [
                {"quantity": "10"},
                {"quantity": "20", "status": "CANCELLED"},
                {"quantity": "3", "status": "confirmed"},
                {"quantity": "5", "supplier_id": "SUP002", "status": "CREATED", "order_date": "2025-03-01"},
                {"quantity": "0", "supplier_id": "SUP003"},
                {"quantity": "8", "supplier_id": "SUP900", "order_date": "bad"},
            ],
        ),
        numbered(
            "sales_order_id",
            [
                {"quantity": "7"},
                {"quantity": "2", "status": "CONFIRMED", "customer_id": "CUS002"},
                {"quantity": "2", "status": "CANCELLED", "order_date": None},
                {"quantity": "4", "status": "CREATED", "order_date": None},
            ],
        ),
    )


def test_supplier_performance(spark):
    bought, _, m = example(spark)
    table = gold.supplier_performance(gold.partner_totals(bought, PURCHASE), m["suppliers"])
    got = {r.supplier_id: r for r in table.collect()}
    assert set(got) == {"SUP001", "SUP002", "SUP003"}
    one = got["SUP001"]
    assert (one.total_orders, one.total_quantity, one.delivered_orders, one.cancelled_orders, one.delivered_quantity) == (
        3, 33, 1, 1, 10,
    )
    assert (one.delivery_rate, one.cancellation_rate, one.fulfillment_rate) == (0.3333, 0.3333, 0.303)
    assert got["SUP003"].fulfillment_rate is None and got["SUP003"].delivery_rate == 1.0


def test_customer_sales_summary(spark):
    _, sold, m = example(spark)
    table = gold.customer_sales_summary(gold.partner_totals(sold, SALES), m["customers"])
    got = {r.customer_id: r for r in table.collect()}
    one = got["CUS001"]
    assert (one.total_orders, one.total_quantity, one.shipped_orders, one.created_orders, one.cancelled_orders) == (3, 13, 1, 1, 1)
    assert (one.avg_order_quantity, one.delivery_rate) == (4.33, 0.0)


def test_material_demand_keeps_every_material(spark):
    bought, sold, m = example(spark)
    got = {r.material_id: tuple(r)[3:] for r in gold.material_demand(bought, sold, m["materials"]).collect()}
    assert got == {
        "RM0001": (4, 23, 0, 0, 23, 4),
        "RM0002": (0, 0, 0, 0, 0, 0),
        "FG0001": (0, 0, 3, 13, 13, 3),
    }


def test_months_without_a_date_stay_apart(spark):
    bought, sold, _ = example(spark)
    got = sorted((str(r.order_month), *tuple(r)[1:]) for r in gold.procurement_vs_sales(bought, sold).collect())
    assert got == [
        ("2025-02-01", 2, 10, 2, 9, 1),
        ("2025-03-01", 1, 5, 0, 0, 5),
        ("None", 0, 0, 1, 4, -4),
        ("None", 1, 8, 0, 0, 8),
    ]
    merged = [tuple(r) for r in gold.procurement_vs_sales(bought, sold, null_safe=True).collect() if r.order_month is None]
    assert merged == [(None, 1, 8, 1, 4, 4)]


def test_monthly_trend(spark):
    bought, _, _ = example(spark)
    got = {r.order_month: tuple(r)[1:] for r in gold.monthly_trend(bought, PURCHASE).collect()}
    assert got == {
        date(2025, 2, 1): (4, 33, 10, 1, 0.303),
        date(2025, 3, 1): (1, 5, 0, 0, 0.0),
        None: (1, 8, 8, 0, 1.0),
    }


def test_country_tables_count_partners_with_active_orders(spark):
    bought, sold, m = example(spark)
    got = {tuple(r) for r in gold.country_wise_procurement(gold.partner_totals(bought, PURCHASE), m["suppliers"]).collect()}
    assert got == {("NL", 2, 15, 2), ("UK", 1, 0, 1)}
    got = {tuple(r) for r in gold.country_wise_sales(gold.partner_totals(sold, SALES), m["customers"]).collect()}
    assert got == {("NL", 2, 11, 1), ("FR", 1, 2, 1)}


def test_top_movers_leave_out_materials_without_demand(spark):
    bought, sold, m = example(spark)
    top = gold.top_moving_materials(gold.material_demand(bought, sold, m["materials"]))
    assert [(r.movement_rank, r.material_id) for r in top.orderBy("movement_rank").collect()] == [(1, "RM0001"), (2, "FG0001")]
    assert "TakeOrderedAndProject" in plan(top)


def test_totals_agree_between_tables(spark):
    """What the months sum to is what the materials sum to, when every order has a material."""
    bought, sold, m = example(spark)
    months = gold.procurement_vs_sales(bought, sold).groupBy().sum("procurement_quantity", "sales_quantity").first()
    demand = gold.material_demand(bought, sold, m["materials"]).groupBy().sum("procurement_quantity", "sales_quantity").first()
    assert tuple(months) == tuple(demand)


def test_no_python_and_no_sort_in_gold_plans(spark):
    bought, sold, m = example(spark)
    for name, table in gold.gold_tables(bought, sold, m["suppliers"], m["customers"], m["materials"]).items():
        text = plan(table)
        assert not any(step in text for step in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas")), name
        assert "rangepartitioning" not in text, name
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name
        shown = gold.shown(name, table)
        assert shown.columns == table.columns
