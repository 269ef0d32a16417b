"""Supply-chain tables as SQL over the given parquet tables.

The text is the same for Spark and for the checking database. Odd order lines are purchase
lines, even ones sales lines; every fifth part is a raw material. (order, line) repeats with
conflicting values, which makes the choice of a copy matter. Typed orders have no defects,
bronze orders are text and about 9% of them have one.

``bronze_row_id`` folds every column a bronze row is made of into 62 bits: rows that share it
are equal in all columns, so it orders copies without ranking them, and no window has to
gather the copies of a line.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SOURCES = ("nation", "customer", "supplier", "part", "orders", "lineitem")


def _fold(prime: int, factor: int) -> str:
    """Polynomial over the columns of a row, modulo a prime below 2^31; no step leaves BIGINT."""
    small = "cast(l_quantity AS bigint) * 65536 + ascii(l_returnflag) * 256 + ascii(l_linestatus)"
    value = f"(l_orderkey * 10 + l_linenumber) % {prime}"
    for column in ("l_partkey", "l_suppkey", small):
        value = f"(({value}) * {factor} + {column}) % {prime}"
    return value


ROW_ID = f"(({_fold(2147483647, 1103515245)}) * 2147483648 + {_fold(2147483629, 1812433253)})"
DEFECT = (
    "CASE WHEN (l_orderkey * 7 + l_linenumber * 13 + l_partkey) % 100 < 9 "
    "THEN (l_orderkey * 7 + l_linenumber * 13 + l_partkey) % 100 ELSE -1 END"
)


def padded(prefix: str, number: str, digits: int) -> str:
    """Business id as SQL: prefix and number, zero-padded to at least so many digits."""
    text = f"cast({number} AS string)"
    return f"concat({prefix}, lpad({text}, cast(greatest({digits}, length({text})) AS int), '0'))"


def _literal(text: str) -> str:
    return f"'{text}'"


SUPPLIERS = f"""
SELECT {padded(_literal("SUP"), "s_suppkey", 3)} AS supplier_id, s_name AS supplier_name, n_name AS country
FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey"""

CUSTOMERS = f"""
SELECT {padded(_literal("CUS"), "c_custkey", 3)} AS customer_id, c_name AS customer_name, n_name AS country
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey"""

MATERIALS = f"""
SELECT {padded("CASE WHEN p_partkey % 5 = 0 THEN 'RM' ELSE 'FG' END", "p_partkey", 4)} AS material_id,
       p_name AS material_name,
       CASE WHEN p_partkey % 5 = 0 THEN 'RAW_MATERIAL' ELSE 'FINISHED_GOOD' END AS material_type
FROM {{part}}"""

# Warehouses 004, 014 and 024 hold raw materials, the other 22 finished goods.
WAREHOUSES = f"""
SELECT {padded(_literal("WH"), "n_nationkey + 1", 3)} AS warehouse_id,
       CASE WHEN n_nationkey = 8 THEN NULL
            WHEN n_nationkey % 10 = 3 THEN concat(n_name, ' RAW Materials Store')
            ELSE concat(n_name, ' Distribution Center') END AS warehouse_name,
       {padded(_literal("PL"), "n_regionkey + 1", 3)} AS plant_id
FROM {{nation}}"""

PURCHASE_STATUS = """CASE WHEN concat(l_returnflag, l_linestatus) = 'NO' THEN 'CREATED'
            WHEN concat(l_returnflag, l_linestatus) = 'NF' THEN 'CONFIRMED'
            WHEN concat(l_returnflag, l_linestatus) = 'RO' THEN 'CANCELLED'
            ELSE 'DELIVERED' END"""

SALES_STATUS = """CASE WHEN o_orderpriority = '1-URGENT' THEN 'DELIVERED'
            WHEN o_orderpriority = '2-HIGH' THEN 'SHIPPED'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'CONFIRMED'
            WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'CREATED'
            ELSE 'CANCELLED' END"""

PURCHASE_ORDERS = f"""
SELECT bronze_row_id,
       {padded(_literal("PO"), "k", 6)} AS purchase_order_id,
       CASE WHEN defect = 2 AND l_orderkey % 3 = 1 THEN NULL
            WHEN defect = 7 THEN CASE l_orderkey % 5 WHEN 0 THEN '15/06/2025' WHEN 1 THEN '2025-06-15T00:00:00'
                 WHEN 2 THEN '15-Jun-2025' WHEN 3 THEN 'invalid-date' ELSE '' END
            ELSE cast(od AS string) END AS order_date,
       CASE WHEN defect = 0 THEN concat('SUP99999', cast(l_orderkey % 10 AS string))
            WHEN defect = 2 AND l_orderkey % 3 = 0 THEN NULL
            WHEN defect = 6 THEN concat(' ', sup, ' ') ELSE sup END AS supplier_id,
       CASE WHEN defect = 1 THEN NULL
            WHEN defect = 8 THEN CASE l_orderkey % 4 WHEN 0 THEN 'RM999999' WHEN 1 THEN 'FG0001'
                 WHEN 2 THEN ' RM0005 ' ELSE '' END
            ELSE {padded(_literal("RM"), "rm", 4)} END AS material_id,
       CASE WHEN defect = 2 AND l_orderkey % 3 = 2 THEN NULL
            WHEN defect = 5 THEN CASE l_orderkey % 4 WHEN 0 THEN '0' WHEN 1 THEN '-1' WHEN 2 THEN '-50'
                 ELSE '9999999' END
            ELSE cast(cast(l_quantity AS bigint) AS string) END AS quantity,
       CASE WHEN defect = 3 THEN cast(od - cast(1 + l_partkey % 13 AS int) AS string)
            ELSE cast(od + cast(3 + l_partkey % 19 AS int) AS string) END AS expected_delivery_date,
       CASE WHEN defect = 4 THEN CASE l_orderkey % 6 WHEN 0 THEN 'DELIVERD' WHEN 1 THEN 'CONFIRMED '
                 WHEN 2 THEN 'confirmed' WHEN 3 THEN 'PENDING' WHEN 4 THEN 'SHIPPED' ELSE '' END
            ELSE {PURCHASE_STATUS} END AS status
FROM (
  SELECT l_orderkey, l_returnflag, l_linestatus, l_partkey, l_quantity,
         cast(o_orderdate AS date) AS od, l_orderkey * 10 + l_linenumber AS k,
         {DEFECT} AS defect, {ROW_ID} AS bronze_row_id,
         {padded(_literal("SUP"), "l_suppkey", 3)} AS sup, l_partkey - l_partkey % 5 AS rm
  FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
  WHERE l_linenumber % 2 = 1
) lines"""

SALES_ORDERS = f"""
SELECT bronze_row_id,
       {padded(_literal("SO"), "k", 6)} AS sales_order_id,
       CASE WHEN defect = 2 AND l_orderkey % 3 = 1 THEN NULL
            WHEN defect = 7 THEN CASE l_orderkey % 5 WHEN 0 THEN '15/06/2025' WHEN 1 THEN '2025-06-15T00:00:00'
                 WHEN 2 THEN '15-Jun-2025' WHEN 3 THEN 'invalid-date' ELSE '' END
            ELSE cast(od AS string) END AS order_date,
       CASE WHEN defect = 0 THEN concat('CUS99999', cast(l_orderkey % 10 AS string))
            WHEN defect = 2 AND l_orderkey % 3 = 0 THEN NULL
            WHEN defect = 6 THEN concat(' ', cus, ' ') ELSE cus END AS customer_id,
       CASE WHEN defect = 1 THEN NULL
            WHEN defect = 8 THEN CASE l_orderkey % 4 WHEN 0 THEN 'FG999999' WHEN 1 THEN 'RM0005'
                 WHEN 2 THEN ' FG0001 ' ELSE '' END
            ELSE {padded(_literal("FG"), "fg", 4)} END AS material_id,
       CASE WHEN defect = 2 AND l_orderkey % 3 = 2 THEN NULL
            WHEN defect = 5 THEN CASE l_orderkey % 4 WHEN 0 THEN '0' WHEN 1 THEN '-1' WHEN 2 THEN '-25'
                 ELSE '9999999' END
            ELSE cast(cast(l_quantity AS bigint) AS string) END AS quantity,
       CASE WHEN defect = 3 THEN cast(od - cast(1 + l_partkey % 13 AS int) AS string)
            ELSE cast(od + cast(5 + l_partkey % 26 AS int) AS string) END AS requested_delivery_date,
       CASE WHEN defect = 4 THEN CASE l_orderkey % 6 WHEN 0 THEN 'DELIVERD' WHEN 1 THEN 'Shipped'
                 WHEN 2 THEN 'CONFIRMED ' WHEN 3 THEN 'pending' WHEN 4 THEN 'INVOICED' ELSE '' END
            ELSE {SALES_STATUS} END AS status
FROM (
  SELECT l_orderkey, l_partkey, l_quantity, o_orderpriority,
         cast(o_orderdate AS date) AS od, l_orderkey * 10 + l_linenumber AS k,
         {DEFECT} AS defect, {ROW_ID} AS bronze_row_id,
         {padded(_literal("CUS"), "o_custkey", 3)} AS cus,
         CASE WHEN l_partkey % 5 = 0 THEN l_partkey + 1 ELSE l_partkey END AS fg
  FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
  WHERE l_linenumber % 2 = 0
) lines"""

TYPED_PURCHASE_ORDERS = f"""
SELECT {padded(_literal("PO"), "l_orderkey * 10 + l_linenumber", 6)} AS purchase_order_id,
       cast(o_orderdate AS date) AS order_date,
       {padded(_literal("SUP"), "l_suppkey", 3)} AS supplier_id,
       {padded(_literal("RM"), "l_partkey - l_partkey % 5", 4)} AS material_id,
       cast(l_quantity AS bigint) AS quantity,
       cast(o_orderdate AS date) + cast(3 + l_partkey % 19 AS int) AS expected_delivery_date,
       {PURCHASE_STATUS} AS status
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
WHERE l_linenumber % 2 = 1"""

TYPED_SALES_ORDERS = f"""
SELECT {padded(_literal("SO"), "l_orderkey * 10 + l_linenumber", 6)} AS sales_order_id,
       cast(o_orderdate AS date) AS order_date,
       {padded(_literal("CUS"), "o_custkey", 3)} AS customer_id,
       {padded(_literal("FG"), "CASE WHEN l_partkey % 5 = 0 THEN l_partkey + 1 ELSE l_partkey END", 4)} AS material_id,
       cast(l_quantity AS bigint) AS quantity,
       cast(o_orderdate AS date) + cast(5 + l_partkey % 26 AS int) AS requested_delivery_date,
       {SALES_STATUS} AS status
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
WHERE l_linenumber % 2 = 0"""

# One delivery per purchase line, on the day the line was shipped.
SUPPLIER_DELIVERIES = f"""
SELECT {padded(_literal("DL"), ROW_ID, 6)} AS delivery_id,
       {padded(_literal("PO"), "l_orderkey * 10 + l_linenumber", 6)} AS purchase_order_id,
       {padded(_literal("SUP"), "l_suppkey", 3)} AS supplier_id,
       cast(l_shipdate AS date) AS delivery_date
FROM {{lineitem}}
WHERE l_linenumber % 2 = 1"""

# One production run per sales line: the part's raw material in, the finished good out.
PRODUCTION_OUTPUT = f"""
SELECT {padded(_literal("PR"), ROW_ID, 6)} AS production_output_id,
       {padded(_literal("MO"), "l_orderkey * 10 + l_linenumber", 6)} AS production_order_id,
       {padded(_literal("RM"), "l_partkey - l_partkey % 5", 4)} AS input_material_id,
       cast(l_quantity AS bigint) AS input_quantity,
       {padded(_literal("FG"), "CASE WHEN l_partkey % 5 = 0 THEN l_partkey + 1 ELSE l_partkey END", 4)}
         AS output_material_id,
       2 * cast(l_quantity AS bigint) AS output_quantity,
       cast(l_shipdate AS date) AS output_date
FROM {{lineitem}}
WHERE l_linenumber % 2 = 0"""

TABLES = {
    "suppliers": SUPPLIERS,
    "customers": CUSTOMERS,
    "materials": MATERIALS,
    "warehouses": WAREHOUSES,
    "purchase_orders": PURCHASE_ORDERS,
    "sales_orders": SALES_ORDERS,
    "typed_purchase_orders": TYPED_PURCHASE_ORDERS,
    "typed_sales_orders": TYPED_SALES_ORDERS,
    "supplier_deliveries": SUPPLIER_DELIVERIES,
    "production_output": PRODUCTION_OUTPUT,
}


def table_sql(name: str) -> str:
    """SQL of a table over plainly named source tables."""
    text = TABLES[name]
    for source in SOURCES:
        text = text.replace("{" + source + "}", source)
    return text


@cache
def _schema(spark: SparkSession, path: str) -> StructType:
    """Schema of a source file, looked up once per session."""
    return spark.read.parquet(path).schema


class Bridge:
    """The supply-chain tables of one data folder as DataFrames, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def source(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        return self.spark.read.schema(_schema(self.spark, path)).parquet(path)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        text = TABLES[name]
        used = {source: self.source(source) for source in SOURCES if "{" + source + "}" in text}
        return self.spark.sql(text, **used)
