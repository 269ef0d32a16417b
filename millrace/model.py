"""Tables, fixed vocabularies and the two order kinds.

Schemas are declared here and applied at the scan; nothing is inferred.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Status, type and flag vocabularies, statuses that move stock, id formats.
RAW_MATERIAL = "RAW_MATERIAL"
FINISHED_GOOD = "FINISHED_GOOD"
PURCHASE_STATUSES = ("CREATED", "CONFIRMED", "DELIVERED", "CANCELLED")
SALES_STATUSES = ("CREATED", "CONFIRMED", "SHIPPED", "DELIVERED", "CANCELLED")
ACTIVE_PURCHASE_STATUSES = ("CREATED", "CONFIRMED", "DELIVERED")
ACTIVE_SALES_STATUSES = ("CREATED", "CONFIRMED", "SHIPPED", "DELIVERED")
GOODS_RECEIPT = "GOODS_RECEIPT"
SALES_SHIPMENT = "SALES_SHIPMENT"
PRODUCTION_RECEIPT = "PRODUCTION_RECEIPT"
PRODUCTION_CONSUMPTION = "PRODUCTION_CONSUMPTION"
INCOMING_TYPES = (GOODS_RECEIPT, PRODUCTION_RECEIPT)
OUTGOING_TYPES = (SALES_SHIPMENT, PRODUCTION_CONSUMPTION)
LARGEST_USUAL_QUANTITY = 50_000
RAW_WAREHOUSE_MARK = "raw materials"
TRANSACTION_PREFIX, TRANSACTION_DIGITS = "IT", 6
TOP_MATERIALS = 20


@dataclass(frozen=True)
class OrderKind:
    """What differs between purchase and sales orders; everything else is shared."""

    name: str
    id: str
    partner: str
    delivery: str
    id_prefix: str
    statuses: tuple[str, ...]
    active: tuple[str, ...]
    moves_stock: tuple[str, ...]
    material_type: str
    movement: str

    @property
    def bronze_columns(self) -> tuple[str, ...]:
        return (self.id, "order_date", self.partner, "material_id", "quantity", self.delivery, "status")


PURCHASE = OrderKind(
    name="purchase",
    id="purchase_order_id",
    partner="supplier_id",
    delivery="expected_delivery_date",
    id_prefix="PO",
    statuses=PURCHASE_STATUSES,
    active=ACTIVE_PURCHASE_STATUSES,
    moves_stock=("DELIVERED",),
    material_type=RAW_MATERIAL,
    movement=GOODS_RECEIPT,
)
SALES = OrderKind(
    name="sales",
    id="sales_order_id",
    partner="customer_id",
    delivery="requested_delivery_date",
    id_prefix="SO",
    statuses=SALES_STATUSES,
    active=ACTIVE_SALES_STATUSES,
    moves_stock=("SHIPPED", "DELIVERED"),
    material_type=FINISHED_GOOD,
    movement=SALES_SHIPMENT,
)

_SHORT = {
    "string": StringType(),
    "long": LongType(),
    "double": DoubleType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "price": DecimalType(18, 4),
}


def _table(**columns: str) -> StructType:
    return StructType([StructField(name, _SHORT[kind], True) for name, kind in columns.items()])


def _texts(*names: str) -> StructType:
    return _table(**dict.fromkeys(names, "string"))


MATERIALS = _texts("material_id", "material_name", "material_type")
SUPPLIERS = _texts("supplier_id", "supplier_name", "country")
CUSTOMERS = _texts("customer_id", "customer_name", "country")
PLANTS = _texts("plant_id", "plant_name", "country")
WAREHOUSES = _texts("warehouse_id", "warehouse_name", "plant_id")

RAW_PURCHASE_ORDERS = _texts(*PURCHASE.bronze_columns)
RAW_SALES_ORDERS = _texts(*SALES.bronze_columns)
BRONZE_PURCHASE_ORDERS = StructType([StructField("bronze_row_id", LongType(), True), *RAW_PURCHASE_ORDERS.fields])
BRONZE_SALES_ORDERS = StructType([StructField("bronze_row_id", LongType(), True), *RAW_SALES_ORDERS.fields])


def _silver(kind: OrderKind) -> StructType:
    typed = {"order_date": "date", kind.delivery: "date", "quantity": "long"}
    columns = _table(bronze_row_id="long", **{c: typed.get(c, "string") for c in kind.bronze_columns})
    return StructType([*columns.fields, StructField("dq_flags", ArrayType(StringType()), True)])


SILVER_PURCHASE_ORDERS = _silver(PURCHASE)
SILVER_SALES_ORDERS = _silver(SALES)

INVENTORY_TRANSACTIONS = _table(
    transaction_id="string",
    transaction_date="string",
    warehouse_id="string",
    material_id="string",
    transaction_type="string",
    quantity="long",
    reference_id="string",
)
INVENTORY = _table(warehouse_id="string", material_id="string", quantity="long")

# Tables that exist as schema documents only; scans of them are declared, nothing computes them.
PRODUCTION_ORDERS = _table(
    production_order_id="string",
    plant_id="string",
    material_id="string",
    planned_quantity="long",
    actual_quantity="long",
    start_date="timestamp",
    end_date="timestamp",
    status="string",
)
PRODUCTION_OUTPUT = _table(
    production_output_id="string",
    production_order_id="string",
    input_material_id="string",
    input_quantity="long",
    output_material_id="string",
    output_quantity="long",
)
MACHINE_DOWNTIME = _table(
    downtime_id="string",
    plant_id="string",
    machine_name="string",
    start_time="timestamp",
    end_time="timestamp",
    reason="string",
)
SUPPLIER_DELIVERIES = _table(
    delivery_id="string",
    purchase_order_id="string",
    supplier_id="string",
    delivery_date="date",
    status="string",
)
SUPPLIER_PERFORMANCE = _table(
    supplier_id="string",
    evaluation_date="date",
    on_time_delivery_rate="double",
    average_delay_days="double",
    quality_score="double",
)
DAILY_SALES = _table(sale_date="date", customer_id="string", material_id="string", quantity="long")
RESIN_PRICES = _table(price_date="date", material_id="string", price_per_kg="price")
HOLIDAYS = _table(holiday_date="date", holiday_name="string", country="string")

TABLES: dict[str, StructType] = {
    "materials": MATERIALS,
    "suppliers": SUPPLIERS,
    "customers": CUSTOMERS,
    "plants": PLANTS,
    "warehouses": WAREHOUSES,
    "purchase_orders": BRONZE_PURCHASE_ORDERS,
    "sales_orders": BRONZE_SALES_ORDERS,
    "silver_purchase_orders": SILVER_PURCHASE_ORDERS,
    "silver_sales_orders": SILVER_SALES_ORDERS,
    "silver_materials": MATERIALS,
    "silver_suppliers": SUPPLIERS,
    "silver_customers": CUSTOMERS,
    "inventory_transactions": INVENTORY_TRANSACTIONS,
    "inventory": INVENTORY,
    "production_orders": PRODUCTION_ORDERS,
    "production_output": PRODUCTION_OUTPUT,
    "machine_downtime": MACHINE_DOWNTIME,
    "supplier_deliveries": SUPPLIER_DELIVERIES,
    "supplier_performance": SUPPLIER_PERFORMANCE,
    "daily_sales": DAILY_SALES,
    "resin_prices": RESIN_PRICES,
    "holidays": HOLIDAYS,
}

# Business keys of the master tables: unique, never NULL.
MASTER_KEYS = {
    "materials": "material_id",
    "suppliers": "supplier_id",
    "customers": "customer_id",
    "plants": "plant_id",
    "warehouses": "warehouse_id",
}
