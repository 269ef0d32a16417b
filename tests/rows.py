"""Small hand-made tables."""

from millrace import model

WAREHOUSES = [
    ("WH003", "Harbour Distribution Center", "PL002"),
    ("WH001", "North RAW MATERIALS Store", "PL001"),
    ("WH002", None, "PL001"),
    ("WH004", "South raw materials store", "PL002"),
]
MATERIALS = [
    ("RM0001", "resin", "RAW_MATERIAL"),
    ("RM0002", "dye", "RAW_MATERIAL"),
    ("FG0001", "bottle", "FINISHED_GOOD"),
]
SUPPLIERS = [("SUP001", "one", "NL"), ("SUP002", "two", "NL"), ("SUP003", "three", "UK")]
CUSTOMERS = [("CUS001", "c one", "NL"), ("CUS002", "c two", "FR")]


def masters(spark):
    return {
        "warehouses": spark.createDataFrame(WAREHOUSES, model.WAREHOUSES),
        "materials": spark.createDataFrame(MATERIALS, model.MATERIALS),
        "suppliers": spark.createDataFrame(SUPPLIERS, model.SUPPLIERS),
        "customers": spark.createDataFrame(CUSTOMERS, model.CUSTOMERS),
    }


def purchase(spark, rows):
    """Rows of overrides on a clean delivered purchase order; row ids count from 1."""
    clean = {
        "purchase_order_id": "PO000001",
        "order_date": "2025-02-03",
        "supplier_id": "SUP001",
        "material_id": "RM0001",
        "quantity": "10",
        "expected_delivery_date": "2025-02-10",
        "status": "DELIVERED",
    }
    return _orders(spark, rows, clean, model.BRONZE_PURCHASE_ORDERS)


def sales(spark, rows):
    clean = {
        "sales_order_id": "SO000001",
        "order_date": "2025-02-03",
        "customer_id": "CUS001",
        "material_id": "FG0001",
        "quantity": "10",
        "requested_delivery_date": "2025-02-10",
        "status": "SHIPPED",
    }
    return _orders(spark, rows, clean, model.BRONZE_SALES_ORDERS)


def _orders(spark, rows, clean, schema):
    full = [{"bronze_row_id": n, **clean, **row} for n, row in enumerate(rows, 1)]
    return spark.createDataFrame([tuple(r[c] for c in schema.names) for r in full], schema)


def ledger(spark, rows):
    return spark.createDataFrame(rows, model.INVENTORY_TRANSACTIONS)
