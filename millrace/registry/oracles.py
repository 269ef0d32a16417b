"""The same results as plain SQL for the checking database, written apart from the engine."""

from __future__ import annotations

from millrace.registry.bridge import table_sql

# What differs between the two order tables in the SQL below.
_PO = {
    "table": "purchase_orders",
    "id": "purchase_order_id",
    "partner": "supplier_id",
    "partners": "suppliers",
    "delivery": "expected_delivery_date",
    "statuses": "'CREATED', 'CONFIRMED', 'DELIVERED', 'CANCELLED'",
    "active": "'CREATED', 'CONFIRMED', 'DELIVERED'",
    "moves": "'DELIVERED'",
    "type": "'RAW_MATERIAL'",
}
_SO = {
    "table": "sales_orders",
    "id": "sales_order_id",
    "partner": "customer_id",
    "partners": "customers",
    "delivery": "requested_delivery_date",
    "statuses": "'CREATED', 'CONFIRMED', 'SHIPPED', 'DELIVERED', 'CANCELLED'",
    "active": "'CREATED', 'CONFIRMED', 'SHIPPED', 'DELIVERED'",
    "moves": "'SHIPPED', 'DELIVERED'",
    "type": "'FINISHED_GOOD'",
}


def _with(ctes: dict[str, str], body: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items()) + "\n" + body


def _tables(*names: str) -> dict[str, str]:
    return {name: table_sql(name) for name in names}


def _rate(part: str, whole: str, digits: int = 4) -> str:
    """Half-up rounding in integers; doubles round ties differently in the two engines."""
    scale = 10**digits
    return (
        f"CASE WHEN {whole} = 0 THEN NULL ELSE sign(({part})) * sign(({whole})) * "
        f"((2 * abs(({part})) * {scale} + abs(({whole}))) // (2 * abs(({whole})))) / {scale}.0 END::DOUBLE"
    )


# Typed orders: without defects, or through silver.


def _typed(o: dict[str, str]) -> dict[str, str]:
    return _tables(f"typed_{o['table']}")


_NUMBER = r"'^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$'"


def _long(text: str) -> str:
    return f"CASE WHEN regexp_matches({text}, {_NUMBER}) THEN trunc(TRY_CAST(trim({text}) AS DOUBLE))::BIGINT END"


def _day(text: str) -> str:
    return (
        f"CASE WHEN regexp_matches({text}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN TRY_CAST({text} AS DATE) END"
    )


def _flags(o: dict[str, str]) -> str:
    conditions = {
        "UNKNOWN_PARTNER": f"nullif(trim({o['partner']}), '') IS NOT NULL AND trim({o['partner']}) NOT IN "
        f"(SELECT {o['partner']} FROM {o['partners']})",
        "MISSING_MATERIAL": "NOT material_ok",
        "MISSING_PARTNER": f"nullif(trim({o['partner']}), '') IS NULL",
        "MISSING_ORDER_DATE": "nullif(trim(order_date), '') IS NULL",
        "MISSING_QUANTITY": "nullif(trim(quantity), '') IS NULL",
        "DELIVERY_BEFORE_ORDER": f"{_day(o['delivery'])} < {_day('order_date')}",
        "INVALID_STATUS": f"status IS NULL OR status NOT IN ({o['statuses']})",
        "NON_POSITIVE_QUANTITY": f"{_long('quantity')} <= 0",
        "QUANTITY_OUTLIER": f"{_long('quantity')} > 50000",
        "UNREADABLE_QUANTITY": f"nullif(trim(quantity), '') IS NOT NULL AND {_long('quantity')} IS NULL",
        "PADDED_PARTNER": f"{o['partner']} <> trim({o['partner']})",
        "BAD_ORDER_DATE": f"order_date IS NOT NULL AND {_day('order_date')} IS NULL",
        "DUPLICATE_ID": "copies > 1",
        "INVALID_MATERIAL": "nullif(trim(material_id), '') IS NOT NULL AND NOT material_ok",
        "MISSING_ID": f"coalesce({o['id']}, '') = ''",
        "MISSING_DELIVERY_DATE": f"coalesce({o['delivery']}, '') = ''",
        "PADDED_MATERIAL": "material_id <> trim(material_id)",
    }
    return "concat_ws('|', " + ", ".join(f"CASE WHEN {c} THEN '{f}' END" for f, c in conditions.items()) + ")"


def _flagged(o: dict[str, str]) -> dict[str, str]:
    """Every bronze row with its flags, number among the copies and copy count."""
    t = o["table"]
    return {
        **_tables(t, o["partners"], "materials"),
        f"counted_{t}": f"""
SELECT *, row_number() OVER (PARTITION BY {o["id"]} ORDER BY bronze_row_id DESC) AS copy,
       count(*) OVER (PARTITION BY {o["id"]}) AS copies,
       coalesce(trim(material_id) IN (SELECT material_id FROM materials WHERE material_type = {o["type"]}), false)
         AS material_ok
FROM {t}""",
        f"flagged_{t}": f"SELECT *, {_flags(o)} AS dq_flags FROM counted_{t}",
    }


def _silver(o: dict[str, str]) -> dict[str, str]:
    t = o["table"]
    return {
        **_flagged(o),
        f"typed_{t}": f"""
SELECT bronze_row_id, {o["id"]}, {_day("order_date")} AS order_date,
       nullif(trim({o["partner"]}), '') AS {o["partner"]},
       CASE WHEN material_ok THEN trim(material_id) END AS material_id,
       {_long("quantity")} AS quantity, {_day(o["delivery"])} AS {o["delivery"]}, status, dq_flags
FROM flagged_{t} WHERE copy = 1""",
    }


# Gold bodies over typed_purchase_orders and typed_sales_orders.

_SUPPLIER_PERFORMANCE = f"""
SELECT *, {_rate("delivered_orders", "total_orders")} AS delivery_rate,
       {_rate("cancelled_orders", "total_orders")} AS cancellation_rate,
       {_rate("delivered_quantity", "total_quantity")} AS fulfillment_rate
FROM (
  SELECT supplier_id, supplier_name, country, count(purchase_order_id) AS total_orders,
         sum(quantity)::BIGINT AS total_quantity,
         sum(CASE WHEN status = 'DELIVERED' THEN 1 ELSE 0 END)::BIGINT AS delivered_orders,
         sum(CASE WHEN status = 'CONFIRMED' THEN 1 ELSE 0 END)::BIGINT AS confirmed_orders,
         sum(CASE WHEN status = 'CREATED' THEN 1 ELSE 0 END)::BIGINT AS created_orders,
         sum(CASE WHEN status = 'CANCELLED' THEN 1 ELSE 0 END)::BIGINT AS cancelled_orders,
         sum(CASE WHEN status = 'DELIVERED' THEN quantity ELSE 0 END)::BIGINT AS delivered_quantity
  FROM typed_purchase_orders JOIN suppliers USING (supplier_id)
  GROUP BY supplier_id, supplier_name, country
) totals"""

_CUSTOMER_SALES_SUMMARY = f"""
SELECT * EXCLUDE (quantities), {_rate("total_quantity", "quantities", 2)} AS avg_order_quantity,
       {_rate("delivered_orders", "total_orders")} AS delivery_rate
FROM (
  SELECT customer_id, customer_name, country, count(sales_order_id) AS total_orders,
         sum(quantity)::BIGINT AS total_quantity, count(quantity) AS quantities,
         sum(CASE WHEN status = 'DELIVERED' THEN 1 ELSE 0 END)::BIGINT AS delivered_orders,
         sum(CASE WHEN status = 'SHIPPED' THEN 1 ELSE 0 END)::BIGINT AS shipped_orders,
         sum(CASE WHEN status = 'CONFIRMED' THEN 1 ELSE 0 END)::BIGINT AS confirmed_orders,
         sum(CASE WHEN status = 'CREATED' THEN 1 ELSE 0 END)::BIGINT AS created_orders,
         sum(CASE WHEN status = 'CANCELLED' THEN 1 ELSE 0 END)::BIGINT AS cancelled_orders,
         sum(CASE WHEN status = 'DELIVERED' THEN quantity ELSE 0 END)::BIGINT AS delivered_quantity
  FROM typed_sales_orders JOIN customers USING (customer_id)
  GROUP BY customer_id, customer_name, country
) totals"""

_MATERIAL_DEMAND = f"""
SELECT material_id, material_name, material_type,
       coalesce(procurement_orders, 0) AS procurement_orders,
       coalesce(procurement_quantity, 0) AS procurement_quantity,
       coalesce(sales_orders, 0) AS sales_orders,
       coalesce(sales_quantity, 0) AS sales_quantity,
       coalesce(procurement_quantity, 0) + coalesce(sales_quantity, 0) AS total_demand_quantity,
       coalesce(procurement_orders, 0) + coalesce(sales_orders, 0) AS total_orders
FROM materials
LEFT JOIN (SELECT material_id, count(purchase_order_id) AS procurement_orders,
                  sum(quantity)::BIGINT AS procurement_quantity
           FROM typed_purchase_orders WHERE status IN ({_PO["active"]}) GROUP BY material_id) p USING (material_id)
LEFT JOIN (SELECT material_id, count(sales_order_id) AS sales_orders, sum(quantity)::BIGINT AS sales_quantity
           FROM typed_sales_orders WHERE status IN ({_SO["active"]}) GROUP BY material_id) s USING (material_id)"""

_TOP_MOVING_MATERIALS = f"""
SELECT * FROM (
  SELECT *, cast(row_number() OVER (ORDER BY total_demand_quantity DESC, material_id) AS INTEGER) AS movement_rank
  FROM ({_MATERIAL_DEMAND}) demand WHERE total_demand_quantity > 0
) ranked WHERE movement_rank <= 20"""

_PROCUREMENT_VS_SALES = f"""
SELECT coalesce(p.order_month, s.order_month) AS order_month,
       coalesce(procurement_orders, 0) AS procurement_orders,
       coalesce(procurement_quantity, 0) AS procurement_quantity,
       coalesce(sales_orders, 0) AS sales_orders, coalesce(sales_quantity, 0) AS sales_quantity,
       coalesce(procurement_quantity, 0) - coalesce(sales_quantity, 0) AS quantity_gap
FROM (SELECT date_trunc('month', order_date)::DATE AS order_month, count(purchase_order_id) AS procurement_orders,
             sum(quantity)::BIGINT AS procurement_quantity
      FROM typed_purchase_orders WHERE status IN ({_PO["active"]}) GROUP BY 1) p
FULL JOIN (SELECT date_trunc('month', order_date)::DATE AS order_month, count(sales_order_id) AS sales_orders,
                  sum(quantity)::BIGINT AS sales_quantity
           FROM typed_sales_orders WHERE status IN ({_SO["active"]}) GROUP BY 1) s
ON p.order_month = s.order_month"""


def _trend(o: dict[str, str]) -> str:
    return f"""
SELECT *, {_rate("delivered_quantity", "total_quantity")} AS delivered_share
FROM (
  SELECT date_trunc('month', order_date)::DATE AS order_month, count({o["id"]}) AS order_count,
         sum(quantity)::BIGINT AS total_quantity,
         sum(CASE WHEN status = 'DELIVERED' THEN quantity ELSE 0 END)::BIGINT AS delivered_quantity,
         sum(CASE WHEN status = 'CANCELLED' THEN 1 ELSE 0 END)::BIGINT AS cancelled_orders
  FROM typed_{o["table"]} GROUP BY 1
) months"""


def _country(o: dict[str, str], partner_count: str) -> str:
    return f"""
SELECT country, count({o["id"]}) AS order_count, sum(quantity)::BIGINT AS total_quantity,
       count(DISTINCT {o["partner"]}) AS {partner_count}
FROM typed_{o["table"]} JOIN {o["partners"]} USING ({o["partner"]})
WHERE status IN ({o["active"]})
GROUP BY country"""


_GOLD = {
    "gold_supplier_performance": ((_PO,), ("suppliers",), _SUPPLIER_PERFORMANCE),
    "gold_material_demand": ((_PO, _SO), ("materials",), _MATERIAL_DEMAND),
    "gold_customer_sales_summary": ((_SO,), ("customers",), _CUSTOMER_SALES_SUMMARY),
    "gold_procurement_vs_sales": ((_PO, _SO), (), _PROCUREMENT_VS_SALES),
    "gold_monthly_procurement_trend": ((_PO,), (), _trend(_PO)),
    "gold_monthly_sales_trend": ((_SO,), (), _trend(_SO)),
    "gold_country_wise_procurement": ((_PO,), ("suppliers",), _country(_PO, "supplier_count")),
    "gold_country_wise_sales": ((_SO,), ("customers",), _country(_SO, "customer_count")),
    "gold_top_moving_materials": ((_PO, _SO), ("materials",), _TOP_MOVING_MATERIALS),
}


def _gold_sql(name: str, source) -> str:
    orders, masters, body = _GOLD[name]
    ctes = _tables(*masters)
    for o in orders:
        ctes |= source(o)
    return _with(ctes, body)


# Columns of the written tables in their alphabetical order; those with a mark are rates and means.
_GOLD_COLUMNS = {
    "gold_supplier_performance": "*cancellation_rate cancelled_orders confirmed_orders country created_orders delivered_orders delivered_quantity "
    "*delivery_rate *fulfillment_rate supplier_id supplier_name total_orders total_quantity",
    "gold_material_demand": "material_id material_name material_type procurement_orders procurement_quantity sales_orders sales_quantity "
    "total_demand_quantity total_orders",
    "gold_customer_sales_summary": "*avg_order_quantity cancelled_orders confirmed_orders country created_orders customer_id customer_name "
    "delivered_orders delivered_quantity *delivery_rate shipped_orders total_orders total_quantity",
    "gold_procurement_vs_sales": "order_month procurement_orders procurement_quantity quantity_gap sales_orders sales_quantity",
    "gold_monthly_procurement_trend": "cancelled_orders delivered_quantity *delivered_share order_count order_month total_quantity",
    "gold_monthly_sales_trend": "cancelled_orders delivered_quantity *delivered_share order_count order_month total_quantity",
    "gold_country_wise_procurement": "country order_count supplier_count total_quantity",
    "gold_country_wise_sales": "country customer_count order_count total_quantity",
    "gold_top_moving_materials": "material_id material_name material_type movement_rank procurement_orders procurement_quantity sales_orders "
    "sales_quantity total_demand_quantity total_orders",
}


def _row_text(columns: str) -> str:
    values = [f"round({c[1:]} * 10000)::BIGINT" if c[0] == "*" else c for c in columns.split()]
    return "concat_ws('|', " + ", ".join(f"coalesce(({v})::VARCHAR, 'NULL')" for v in values) + ")"


def _gold_written() -> str:
    ctes = _tables("suppliers", "customers", "materials") | _typed(_PO) | _typed(_SO)
    counts = [
        f"SELECT '{name}' AS table_name, count(*) AS row_count, "
        f"coalesce(sum(('0x' || substr(md5({_row_text(_GOLD_COLUMNS[name])}), 1, 8))::BIGINT), 0)::BIGINT AS digest FROM ({body}) t"
        for name, (_, _, body) in _GOLD.items()
    ]
    return _with(ctes, " UNION ALL ".join(counts))


# Ledger.


def _latest(o: dict[str, str], rows: str | None = None, name: str | None = None) -> dict[str, str]:
    """Latest copies that move stock."""
    return {
        name or f"latest_{o['table']}": f"""
SELECT * EXCLUDE (copy) FROM (
  SELECT *, row_number() OVER (PARTITION BY {o["id"]} ORDER BY bronze_row_id DESC) AS copy
  FROM {rows or o["table"]}) c
WHERE copy = 1 AND status IN ({o["moves"]})"""
    }


_SPLIT_WAREHOUSES = {
    "split_warehouses": """
SELECT *, coalesce(contains(lower(warehouse_name), 'raw materials'), false) AS is_raw FROM warehouses""",
    "routes": """
SELECT warehouse_id, row_number() OVER (ORDER BY warehouse_id) - 1 AS route, count(*) OVER () AS size
FROM split_warehouses WHERE NOT is_raw""",
}


def _md5_modulo(text: str, size: str) -> str:
    remainder = "0::HUGEINT"
    for start in (1, 9, 17, 25):
        remainder = f"((({remainder}) * 4294967296 + ('0x' || substr(md5({text}), {start}, 8))::BIGINT) % ({size}))"
    return f"({remainder})::BIGINT"


def _lines(o: dict[str, str], latest: str, warehouse: str, movement: str) -> str:
    return f"""
SELECT bronze_row_id, {o["delivery"]} AS transaction_date, {warehouse} AS warehouse_id, material_id,
       '{movement}' AS transaction_type, {_long("quantity")} AS quantity, {o["id"]} AS reference_id
FROM {latest}
WHERE {o["id"]} <> '' AND material_id <> '' AND {o["delivery"]} <> '' AND {_long("quantity")} > 0
  AND material_id IN (SELECT material_id FROM materials WHERE material_type = {o["type"]})"""


def _receipt_lines(latest: str = "latest_purchase_orders") -> str:
    raw = "(SELECT min(warehouse_id) FROM split_warehouses WHERE is_raw)"
    return _lines(_PO, latest, raw, "GOODS_RECEIPT")


def _shipment_lines() -> str:
    route = _md5_modulo("sales_order_id", "(SELECT max(size) FROM routes)")
    routed = f"(SELECT l.*, r.warehouse_id AS wh FROM (SELECT *, {route} AS route FROM latest_sales_orders) l JOIN routes r USING (route))"
    return _lines(_SO, routed, "wh", "SALES_SHIPMENT")


_ORDERS_AND_WAREHOUSES = (
    _tables("purchase_orders", "sales_orders", "materials", "warehouses")
    | _SPLIT_WAREHOUSES
    | _latest(_PO)
    | _latest(_SO)
    | {"receipts": _receipt_lines(), "shipments": _shipment_lines()}
)
_LEDGER = _ORDERS_AND_WAREHOUSES | {"lines": "SELECT * FROM receipts UNION ALL SELECT * FROM shipments"}


def _numbered(rows: str, order: str, start: str = "0") -> str:
    return f"""
SELECT 'IT' || CASE WHEN n < 1000000 THEN lpad(n::VARCHAR, 6, '0') ELSE n::VARCHAR END AS transaction_id,
       transaction_date, warehouse_id, material_id, transaction_type, quantity, reference_id
FROM (SELECT *, row_number() OVER (ORDER BY {order}) + {start} AS n FROM {rows}) numbered"""


_BALANCES = """
SELECT warehouse_id, material_id,
       sum(CASE WHEN transaction_type IN ('GOODS_RECEIPT', 'PRODUCTION_RECEIPT') THEN quantity ELSE -quantity END)::BIGINT
         AS quantity
FROM {rows} GROUP BY warehouse_id, material_id"""

_PRODUCTION = """
SELECT output_date::VARCHAR AS transaction_date, (SELECT min(warehouse_id) FROM split_warehouses WHERE is_raw)
         AS warehouse_id, input_material_id AS material_id, 'PRODUCTION_CONSUMPTION' AS transaction_type,
       input_quantity AS quantity
FROM production_output
UNION ALL
SELECT output_date::VARCHAR, r.warehouse_id, output_material_id, 'PRODUCTION_RECEIPT', output_quantity
FROM production_output p JOIN routes r ON r.route = """ + _md5_modulo(
    "production_order_id", "(SELECT max(size) FROM routes)"
)

_BOOKED = _ORDERS_AND_WAREHOUSES | {
    "earlier": "SELECT * FROM purchase_orders WHERE order_date < '1998-06-01'",
    **_latest(_PO, "earlier", "latest_earlier"),
    "booked_lines": _receipt_lines("latest_earlier"),
    "fresh_lines": "SELECT * FROM receipts WHERE reference_id NOT IN (SELECT reference_id FROM booked_lines)",
}

def _reconcile(o: dict[str, str], statuses: str, lines: str) -> str:
    return f"""
SELECT naive_quantity, latest_quantity, incomplete_quantity, wrong_material_quantity, non_positive_quantity,
       clean_quantity, not_delivered_quantity, ledger_quantity,
       naive_quantity - latest_quantity AS superseded_quantity, clean_quantity - ledger_quantity AS unexplained
FROM (
  SELECT (SELECT coalesce(sum({_long("quantity")}), 0)::BIGINT FROM {o["table"]} WHERE status IN ({statuses}))
           AS naive_quantity,
         coalesce(sum(q) FILTER (delivered), 0)::BIGINT AS latest_quantity,
         coalesce(sum(q) FILTER (delivered AND NOT complete), 0)::BIGINT AS incomplete_quantity,
         coalesce(sum(q) FILTER (delivered AND complete AND NOT known), 0)::BIGINT AS wrong_material_quantity,
         coalesce(sum(q) FILTER (delivered AND complete AND known AND q <= 0), 0)::BIGINT AS non_positive_quantity,
         coalesce(sum(q) FILTER (delivered AND complete AND known AND q > 0), 0)::BIGINT AS clean_quantity,
         coalesce(sum(q) FILTER (NOT delivered), 0)::BIGINT AS not_delivered_quantity,
         (SELECT coalesce(sum(quantity), 0)::BIGINT FROM {lines}) AS ledger_quantity
  FROM (
    SELECT {_long("quantity")} AS q, coalesce(status IN ({statuses}), false) AS delivered,
           coalesce({o["id"]} <> '' AND {o["delivery"]} <> '', false) AS complete,
           coalesce(material_id IN (SELECT material_id FROM materials WHERE material_type = {o["type"]}), false)
             AS known,
           row_number() OVER (PARTITION BY {o["id"]} ORDER BY bronze_row_id DESC) AS copy
    FROM {o["table"]}) c
  WHERE copy = 1
) totals"""

_DELIVERIES = _tables("purchase_orders", "supplier_deliveries") | {
    "due": f"""
SELECT purchase_order_id, {_day("expected_delivery_date")} AS expected_date FROM (
  SELECT *, row_number() OVER (PARTITION BY purchase_order_id ORDER BY bronze_row_id DESC) AS copy
  FROM purchase_orders) c WHERE copy = 1""",
    "dated": """
SELECT delivery_id, purchase_order_id, supplier_id, delivery_date, expected_date,
       CASE WHEN expected_date IS NOT NULL THEN greatest(delivery_date - expected_date, 0)::INTEGER END AS delay_days,
       CASE WHEN delivery_date <= expected_date THEN 'ON_TIME' WHEN delivery_date > expected_date THEN 'DELAYED' END
         AS status
FROM supplier_deliveries LEFT JOIN due USING (purchase_order_id)""",
}


def _raw(o: dict[str, str]) -> str:
    return f"{o['id']}, order_date, {o['partner']}, material_id, quantity, {o['delivery']}, status"


def _read_from_csv(o: dict[str, str]) -> str:
    """Empty text does not survive a CSV file: it comes back as NULL."""
    return ", ".join(f"nullif({c}, '') AS {c}" for c in _raw(o).split(", "))


def _profile(o: dict[str, str], name: str) -> str:
    flags = (
        "UNKNOWN_PARTNER MISSING_MATERIAL MISSING_PARTNER MISSING_ORDER_DATE MISSING_QUANTITY DELIVERY_BEFORE_ORDER "
        "INVALID_STATUS NON_POSITIVE_QUANTITY QUANTITY_OUTLIER UNREADABLE_QUANTITY PADDED_PARTNER BAD_ORDER_DATE "
        "DUPLICATE_ID INVALID_MATERIAL MISSING_ID MISSING_DELIVERY_DATE PADDED_MATERIAL"
    ).split()
    return " UNION ALL ".join(
        f"SELECT '{name}' AS orders, '{flag}' AS flag, total_rows, flagged_rows, "
        f"{_rate('flagged_rows', 'total_rows')} AS share FROM (SELECT count(*) AS total_rows, "
        f"count(*) FILTER (list_contains(string_split(dq_flags, '|'), '{flag}')) AS flagged_rows "
        f"FROM flagged_{o['table']}) t"
        for flag in flags
    )


def _next(o: dict[str, str], prefix: str, name: str) -> str:
    number = f"TRY_CAST(regexp_extract(trim({o['id']}), '^{prefix}([0-9]+)$', 1) AS BIGINT)"
    return f"SELECT '{name}' AS orders, coalesce(max({number}), 0) + 1 AS next_number FROM {o['table']}"


_BLOCKED = " OR ".join(
    f"list_contains(string_split(dq_flags, '|'), '{flag}')"
    for flag in (
        "MISSING_MATERIAL",
        "MISSING_QUANTITY",
        "INVALID_STATUS",
        "NON_POSITIVE_QUANTITY",
        "UNREADABLE_QUANTITY",
        "MISSING_ID",
        "MISSING_DELIVERY_DATE",
        "PADDED_MATERIAL",
    )
)

def _impact(o: dict[str, str], lines: str) -> str:
    return f"""
SELECT flag, count(*) AS orders, count(*) FILTER (moved) AS moved_orders, count(*) FILTER (NOT moved) AS held_back_orders
FROM (
  SELECT unnest(string_split(CASE WHEN dq_flags = '' THEN 'CLEAN' ELSE dq_flags END, '|')) AS flag,
         coalesce({o["id"]} IN (SELECT reference_id FROM {lines}), false) AS moved
  FROM typed_{o["table"]}) f
GROUP BY flag"""

_MASTER = """
SELECT coalesce(n.material_id, o.material_id) AS material_id,
       CASE WHEN n.material_id IS NOT NULL THEN n.material_name ELSE o.material_name END AS material_name,
       CASE WHEN n.material_id IS NOT NULL THEN n.material_type ELSE o.material_type END AS material_type,
       CASE WHEN o.material_id IS NOT NULL THEN '2025-01-01' ELSE '2025-02-01' END AS created_at,
       CASE WHEN n.material_id IS NOT NULL THEN '2025-02-01' ELSE '2025-01-01' END AS updated_at
FROM (SELECT 'MT' || p_partkey AS material_id, p_name AS material_name, p_type AS material_type
      FROM part WHERE p_size <= 40) o
FULL JOIN (SELECT 'MT' || p_partkey AS material_id, p_name || ' ' || p_brand AS material_name,
                  p_type AS material_type FROM part WHERE p_size >= 25) n ON o.material_id = n.material_id"""

_SALES_NUMBER = "TRY_CAST(regexp_extract(trim(sales_order_id), '^SO([0-9]+)$', 1) AS BIGINT)"

ORACLES: dict[str, str] = {
    **{name: _gold_sql(name, _typed) for name in _GOLD},
    **{f"{name}_on_silver": _gold_sql(name, _silver) for name in _GOLD},
    "gold_written": _gold_written(),
    "bronze_conform": _with(
        _typed(_PO),
        "SELECT "
        + ", ".join(f"cast({c} AS string) AS {c}" for c in _raw(_PO).split(", "))
        + ", true AS above_the_floor FROM typed_purchase_orders",
    ),
    "silver_purchase_orders": _with(_silver(_PO), "SELECT * FROM typed_purchase_orders"),
    "silver_sales_orders": _with(_silver(_SO), "SELECT * FROM typed_sales_orders"),
    "dedupe_keep_last": _with(
        _tables("purchase_orders"),
        """SELECT * EXCLUDE (copy) FROM (
  SELECT *, row_number() OVER (PARTITION BY purchase_order_id ORDER BY bronze_row_id DESC) AS copy
  FROM purchase_orders) c WHERE copy = 1""",
    ),
    "fk_nullify": _with(
        _tables("sales_orders", "materials"),
        """SELECT * REPLACE (CASE WHEN trim(material_id) IN
  (SELECT material_id FROM materials WHERE material_type = 'FINISHED_GOOD') THEN trim(material_id) END AS material_id)
FROM sales_orders""",
    ),
    "dq_flags_purchase": _with(
        _flagged(_PO), f"SELECT bronze_row_id, {_raw(_PO)}, dq_flags FROM flagged_purchase_orders"
    ),
    "dq_flags_sales": _with(_flagged(_SO), f"SELECT bronze_row_id, {_raw(_SO)}, dq_flags FROM flagged_sales_orders"),
    "dq_profile": _with(
        _flagged(_PO) | _flagged(_SO), _profile(_PO, "purchase") + " UNION ALL " + _profile(_SO, "sales")
    ),
    "dq_quarantine": _with(
        _flagged(_PO), f"SELECT bronze_row_id, {_raw(_PO)}, dq_flags FROM flagged_purchase_orders WHERE {_BLOCKED}"
    ),
    "dq_impact": _with(_ORDERS_AND_WAREHOUSES | _silver(_PO), _impact(_PO, "receipts")),
    "dq_impact_sales": _with(_ORDERS_AND_WAREHOUSES | _silver(_SO), _impact(_SO, "shipments")),
    "text_checks": _with(
        _tables("sales_orders"),
        f"""SELECT bronze_row_id, {_SALES_NUMBER} AS order_number, nullif(trim(customer_id), '') AS customer,
  {_day("order_date")} AS strict_date, {_day("substr(order_date, 1, 10)")} AS lenient_date,
  coalesce(regexp_matches(quantity, '^-?[0-9]+(\\.[0-9]+)?$'), false) AS numeric_quantity,
  ({_day("requested_delivery_date")} - {_day("order_date")})::INTEGER AS lead_days
FROM sales_orders""",
    ),
    "clean_delivered_po": _with(
        _tables("purchase_orders") | _latest(_PO), "SELECT * FROM latest_purchase_orders"
    ),
    "clean_shipped_so": _with(_tables("sales_orders") | _latest(_SO), "SELECT * FROM latest_sales_orders"),
    "goods_receipts": _with(_ORDERS_AND_WAREHOUSES, _numbered("receipts", "bronze_row_id")),
    "sales_shipments": _with(_ORDERS_AND_WAREHOUSES, _numbered("shipments", "bronze_row_id")),
    "inventory_transactions": _with(_LEDGER, _numbered("lines", "transaction_type, bronze_row_id")),
    "transaction_counts": _with(
        _LEDGER, "SELECT transaction_type, count(*) AS transactions FROM lines GROUP BY transaction_type"
    ),
    "inventory_snapshot": _with(_LEDGER, f"SELECT * FROM ({_BALANCES.format(rows='lines')}) b WHERE quantity > 0"),
    "inventory_with_production": _with(
        _LEDGER
        | _tables("production_output")
        | {
            "production": _PRODUCTION,
            "moves": """
SELECT warehouse_id, material_id, transaction_type, quantity FROM lines
UNION ALL SELECT warehouse_id, material_id, transaction_type, quantity FROM production""",
        },
        _BALANCES.format(rows="moves"),
    ),
    "receipt_references": _with(_ORDERS_AND_WAREHOUSES, "SELECT DISTINCT reference_id AS purchase_order_id FROM receipts"),
    "incremental_receipts": _with(
        _BOOKED, _numbered("fresh_lines", "bronze_row_id", "(SELECT count(*) FROM booked_lines)")
    ),
    "reconcile_po_receipts": _with(_ORDERS_AND_WAREHOUSES, _reconcile(_PO, "'DELIVERED'", "receipts")),
    "reconcile_so_shipments": _with(_ORDERS_AND_WAREHOUSES, _reconcile(_SO, "'SHIPPED', 'DELIVERED'", "shipments")),
    "next_id": _with(
        _tables("purchase_orders", "sales_orders"),
        _next(_PO, "PO", "purchase") + " UNION ALL " + _next(_SO, "SO", "sales"),
    ),
    "hash_routing": _with(
        _tables("sales_orders", "warehouses") | _SPLIT_WAREHOUSES,
        f"""SELECT bronze_row_id, sales_order_id, warehouse_id, of_2, of_1000003 FROM (
  SELECT *, {_md5_modulo("sales_order_id", "(SELECT max(size) FROM routes)")} AS route,
         {_md5_modulo("sales_order_id", "2")} AS of_2, {_md5_modulo("sales_order_id", "1000003")} AS of_1000003
  FROM sales_orders) o JOIN routes USING (route)""",
    ),
    "dense_ids": _with(
        _tables("purchase_orders"),
        "SELECT bronze_row_id, purchase_order_id, row_number() OVER (ORDER BY bronze_row_id) AS row_number "
        "FROM purchase_orders",
    ),
    "warehouse_split": _with(_tables("warehouses") | _SPLIT_WAREHOUSES, "SELECT * FROM split_warehouses"),
    "month_filter": _with(
        _typed(_PO),
        "SELECT * FROM typed_purchase_orders WHERE order_date >= DATE '1998-02-01' AND order_date < DATE '1998-03-01'",
    ),
    "lead_times": _with(
        _silver(_PO),
        """SELECT supplier_id, count(d) AS dated_orders, min(d)::INTEGER AS shortest, max(d)::INTEGER AS longest,
       sum(d)::BIGINT AS total_days
FROM (SELECT supplier_id, expected_delivery_date - order_date AS d FROM typed_purchase_orders) t
GROUP BY supplier_id""",
    ),
    "materials_by_type": _with(_tables("materials"), "SELECT * FROM materials"),
    "upsert_master": _MASTER,
    "csv_roundtrip": _with(_tables("purchase_orders"), f"SELECT {_raw(_PO)} FROM purchase_orders"),
    "csv_import": _with(
        _tables("purchase_orders"),
        f"""SELECT {_read_from_csv(_PO)} FROM (
  SELECT *, row_number() OVER (PARTITION BY purchase_order_id ORDER BY bronze_row_id DESC) AS copy
  FROM purchase_orders) c WHERE copy = 1""",
    ),
    "delivery_status": _with(_DELIVERIES, "SELECT * FROM dated"),
    "supplier_evaluation": _with(
        _DELIVERIES,
        f"""SELECT supplier_id, DATE '2002-01-01' AS evaluation_date,
       {_rate("on_time * 100", "deliveries", 2)} AS on_time_delivery_rate,
       {_rate("days", "deliveries", 2)} AS average_delay_days
FROM (SELECT supplier_id, count(*) AS deliveries, count(*) FILTER (status = 'ON_TIME') AS on_time,
             sum(delay_days)::BIGINT AS days
      FROM dated WHERE status IS NOT NULL GROUP BY supplier_id) t""",
    ),
    "stream_ingest": _with(_tables("sales_orders"), f"SELECT {_read_from_csv(_SO)} FROM sales_orders"),
    "stream_receipts": _with(
        _BOOKED,
        """SELECT transaction_date, warehouse_id, material_id, transaction_type, quantity, reference_id FROM booked_lines
UNION ALL
SELECT transaction_date, warehouse_id, material_id, transaction_type, quantity, reference_id FROM fresh_lines""",
    ),
    "stream_masters": _with(
        _tables("suppliers") | {"numbered": "SELECT *, substr(supplier_id, 4)::INTEGER AS number FROM suppliers"},
        """SELECT supplier_id, supplier_name || CASE WHEN number % 3 = 0 THEN ' Ltd' ELSE '' END AS supplier_name, country,
  CASE WHEN number % 3 = 0 THEN 3 ELSE 1 END AS change, true AS audited FROM numbered""",
    ),
}

ORACLES |= {
    "append_then_repair": ORACLES["fk_nullify"],
    "snapshot_replace": ORACLES["inventory_snapshot"],
    "silver_by_month": ORACLES["silver_purchase_orders"],
    "stream_ingest_two_sources": _with(
        _tables("sales_orders"), f"SELECT {_read_from_csv(_SO)}, true AS complete FROM sales_orders"
    ),
    "mixed_loads": ORACLES["csv_import"],
    "stream_receipts_restarted": ORACLES["stream_receipts"],
    "stream_stock": _with(
        _BOOKED
        | {
            "both_lines": """SELECT warehouse_id, material_id, transaction_type, quantity FROM booked_lines
UNION ALL SELECT warehouse_id, material_id, transaction_type, quantity FROM fresh_lines"""
        },
        f"SELECT * FROM ({_BALANCES.format(rows='both_lines')}) b WHERE quantity > 0",
    ),
}


def _by_year(o: dict[str, str], name: str) -> str:
    return f"""
SELECT '{name}' AS orders, country, year(order_date)::INTEGER AS order_year, count(DISTINCT {o["partner"]}) AS partners
FROM typed_{o["table"]} JOIN {o["partners"]} USING ({o["partner"]}) WHERE status IN ({o["active"]}) GROUP BY country, year(order_date)"""


ORACLES |= {
    **{
        name.replace("gold_", "refreshed_", 1): ORACLES[f"{name}_on_silver"]
        for name in _GOLD
        if name != "gold_top_moving_materials"
    },
    "partners_by_year": _with(_silver(_PO) | _silver(_SO), _by_year(_PO, "purchase") + " UNION ALL " + _by_year(_SO, "sales")),
    "gold_of_a_year": _with(
        _silver(_PO) | {"typed_of_year": "SELECT * FROM typed_purchase_orders WHERE year(order_date) = 1996"},
        _country(_PO | {"table": "of_year"}, "supplier_count"),
    ),
    "orders_of_changed_months": _with(
        _silver(_PO),
        """SELECT * FROM typed_purchase_orders WHERE coalesce(date_trunc('month', order_date)::DATE, DATE '0001-01-01') IN (
  SELECT coalesce(date_trunc('month', order_date)::DATE, DATE '0001-01-01') FROM typed_purchase_orders
  WHERE supplier_id IS NULL AND quantity > 30)""",
    ),
}

_LINE = " || ',' || ".join(f"coalesce({c}, '')" for c in _raw(_SO).split(", "))
ORACLES["stream_ingest_rescued"] = _with(
    _tables("sales_orders"),
    f"""SELECT {_read_from_csv(_SO)} REPLACED, NULL AS note, false AS rescued, NULL AS reason, NULL AS raw
FROM sales_orders WHERE bronze_row_id % 4 IN (0, 2)
UNION ALL
SELECT {_read_from_csv(_SO).replace("nullif(status, '')", "NULL")}, 'n' || bronze_row_id, true, NULL, NULL
FROM sales_orders WHERE bronze_row_id % 4 = 1
UNION ALL
SELECT {", ".join(["NULL"] * 7)}, NULL, true,
  CASE (bronze_row_id // 4) % 3 WHEN 0 THEN 'more fields than the header' WHEN 1 THEN 'fewer fields than the header' ELSE 'quotes that do not close' END,
  CASE (bronze_row_id // 4) % 3 WHEN 0 THEN {_LINE} || ',surplus' WHEN 1 THEN sales_order_id ELSE '"' || {_LINE} END
FROM sales_orders WHERE bronze_row_id % 4 = 3""".replace(" REPLACED", ""),
)
ORACLES["stream_latest"] = ORACLES["dedupe_keep_last"]


def _traced(o: dict[str, str], statuses: str, lines: str) -> str:
    """Copies of a moving status with their flag and outcome."""
    q = _long("quantity")
    return f"""
SELECT bronze_row_id, {o["id"]} AS order_id, q AS quantity,
       CASE WHEN own <> 'CLEAN' THEN own WHEN copy = 1 THEN 'CLEAN' WHEN booked THEN 'DUPLICATE_ID' ELSE last_cause END AS flag,
       CASE WHEN own <> 'CLEAN' THEN 'SUPPRESSED' WHEN copy = 1 THEN 'BOOKED' WHEN booked THEN 'DELAYED' ELSE 'SUPPRESSED' END AS outcome
FROM (
  SELECT *, first_value(CASE WHEN coalesce(status IN ({statuses}), false) THEN own
                             WHEN coalesce(status IN ({o["statuses"]}), false) THEN 'NOT_DELIVERED' ELSE 'INVALID_STATUS' END) OVER w AS last_cause,
         coalesce({o["id"]} IN (SELECT reference_id FROM {lines}), false) AS booked, row_number() OVER w AS copy
  FROM (
    SELECT *, {q} AS q,
      CASE WHEN coalesce({o["id"]}, '') = '' THEN 'MISSING_ID' WHEN coalesce({o["delivery"]}, '') = '' THEN 'MISSING_DELIVERY_DATE'
           WHEN coalesce(material_id, '') = '' THEN 'MISSING_MATERIAL'
           WHEN material_id NOT IN (SELECT material_id FROM materials WHERE material_type = {o["type"]}) THEN 'INVALID_MATERIAL'
           WHEN nullif(trim(quantity), '') IS NULL THEN 'MISSING_QUANTITY' WHEN {q} IS NULL THEN 'UNREADABLE_QUANTITY'
           WHEN {q} <= 0 THEN 'NON_POSITIVE_QUANTITY' ELSE 'CLEAN' END AS own
    FROM {o["table"]}) c
  WINDOW w AS (PARTITION BY {o["id"]} ORDER BY bronze_row_id DESC)) l
WHERE status IN ({statuses})"""


ORACLES |= {
    "dq_lineage": _with(
        _ORDERS_AND_WAREHOUSES,
        f"""SELECT flag, outcome, count(*) AS copies, coalesce(sum(quantity), 0)::BIGINT AS quantity
FROM ({_traced(_PO, "'DELIVERED'", "receipts")}) t GROUP BY flag, outcome""",
    ),
    "dq_lineage_sales": _with(_ORDERS_AND_WAREHOUSES, _traced(_SO, "'SHIPPED', 'DELIVERED'", "shipments")),
    "catalog_scan": _with(_tables("suppliers"), "SELECT * FROM suppliers"),
    "rows_written": _with(
        _tables("sales_orders", "materials", "customers", "warehouses", "typed_purchase_orders"),
        " UNION ALL ".join(
            f"SELECT '{write}' AS write, count(*) AS written FROM {t}"
            for write, t in (("append", "sales_orders"), ("replace", "materials"), ("upsert", "customers"), ("csv", "warehouses"), ("silver", "typed_purchase_orders"))
        ),
    ),
    "gold_shown": _with(
        _tables("materials") | _typed(_PO) | _typed(_SO),
        f"SELECT total_demand_quantity FROM ({_MATERIAL_DEMAND}) d WHERE total_demand_quantity > 0 ORDER BY 1 DESC LIMIT 50",
    ),
}
