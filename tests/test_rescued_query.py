"""The rescued ingest's query keeps damaged records as they stand."""

from __future__ import annotations

from millrace.registry.queries import _write_lines
from millrace.session import scratch_path


def test_records_keep_the_blanks_at_their_ends(spark):
    path = scratch_path(spark, "lines")
    lines = ['"SO1,2025-01-01,CONFIRMED ', "  SO2", "SO3\t", "SO4,"]
    _write_lines(spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1), "sales_order_id,status", path)
    assert [r.value for r in spark.read.text(path).collect()] == ["sales_order_id,status", *lines]
