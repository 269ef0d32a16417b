"""Ingest of files whose headers and records differ: everything comes out somewhere."""

from __future__ import annotations

import os

import pytest

from millrace.model import RAW_PURCHASE_ORDERS
from millrace.session import scratch_path
from millrace.streaming.rescue import ingest_rescued

HEADER = "purchase_order_id,order_date,supplier_id,material_id,quantity,expected_delivery_date,status"
FILES = {
    "a.csv": f"{HEADER}\r\nPO1,2025-01-01,S,M,1,2025-01-02,CREATED\r\n\r\nPO2,,,,,,\r\n",
    "b.csv": 'status,extra,purchase_order_id\nDELIVERED,"new, ""quoted""",PO3\nCANCELLED,,PO4\n',
    "c.csv": f"{HEADER}\nPO5,1\nPO6,1,2,3,4,5,6,7,8\n\"PO7,1,2,3,4,5,6\nPO8,1,2,\"x\"y,4,5,6\nPO9,1,2,\"x,y\",4,5,6\n",
    "d.csv": f"{HEADER}\n",
    "e.csv": "",
    "f.csv": "purchase_order_id,status,status\nPO10,old,new\n",
    "g.csv": "﻿purchase_order_id,,_line\nPO11,nameless,7\n",
}


def landing(spark):
    base = scratch_path(spark, "landing").removeprefix("file:")
    os.makedirs(f"{base}/files")
    for name, text in FILES.items():
        with open(f"{base}/files/{name}", "w", encoding="utf-8", newline="") as file:
            file.write(text)
    return base


def run(spark, base, per_batch=None, state="state"):
    ingest_rescued(spark, f"{base}/files", RAW_PURCHASE_ORDERS, f"{base}/bronze", f"{base}/held", f"{base}/{state}", per_batch).awaitTermination()
    return {r.purchase_order_id: r for r in spark.read.parquet(f"{base}/bronze").collect()}, spark.read.parquet(f"{base}/held").collect()


@pytest.mark.parametrize("per_batch", [None, 1])
def test_every_record_is_a_row_or_held(spark, per_batch):
    base = landing(spark)
    rows, held = run(spark, base, per_batch)
    assert set(rows) == {f"PO{n}" for n in (1, 2, 3, 4, 9, 10, 11)}
    assert rows["PO1"].status == "CREATED" and rows["PO1"]._rescued is None
    assert rows["PO2"].status is None and rows["PO2"]._rescued is None
    assert rows["PO3"].status == "DELIVERED" and rows["PO3"].quantity is None
    assert rows["PO3"]._rescued["extra"] == 'new, "quoted"' and rows["PO3"]._rescued["_line"] == "2"
    assert rows["PO3"]._rescued["_raw"].startswith("DELIVERED,") and rows["PO3"]._rescued["_file"].endswith("b.csv")
    assert rows["PO4"]._rescued is None
    assert rows["PO9"].material_id == "x,y"
    assert rows["PO10"].status == "new" and rows["PO10"]._rescued["_raw"] == "PO10,old,new"
    assert rows["PO11"]._rescued[""] == "nameless" and rows["PO11"]._rescued["_line"] == "2"
    assert len({r.bronze_row_id for r in rows.values()}) == 7
    assert {(r._line, r._raw[:4].strip('"'), r.reason) for r in held} == {
        (2, "PO5,", "fewer fields than the header"),
        (3, "PO6,", "more fields than the header"),
        (4, "PO7", "quotes that do not close"),
        (5, "PO8,", "quotes that do not close"),
    }
    assert all(r._file.endswith("c.csv") for r in held)


def test_a_second_run_adds_new_files_only(spark):
    base = landing(spark)
    run(spark, base)
    again = run(spark, base)
    assert (len(again[0]), len(again[1])) == (7, 4)
    with open(f"{base}/files/new.csv", "w") as file:
        file.write(f"{HEADER}\nPO12,,,,,,\nPO13\n")
    rows, held = run(spark, base)
    assert (len(rows), len(held)) == (8, 5)
    assert rows["PO12"].bronze_row_id > max(r.bronze_row_id for k, r in rows.items() if k != "PO12")
