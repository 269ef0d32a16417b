import hashlib
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import blank_to_null, format_id, hash_bucket, is_numeric_text, iso_date, parse_id, rate, tolerant_long


def column(spark, values, expression, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("x"))).collect()]


def test_tolerant_long(spark):
    cases = {
        "12.7": 12, "-12.7": -12, " 12 ": 12, "1e3": 1000, "+5": 5, ".9": 0, "7.": 7, "1_000": 1000, "0": 0, "-50": -50,
        "inf": None, "nan": None, "1d": None, "1f": None, "": None, " ": None, "abc": None, "1__0": None, "_1": None,
        "1e300": None, "0x10": None, None: None, "9999999": 9999999,
    }
    assert column(spark, list(cases), tolerant_long) == list(cases.values())


def test_tolerant_long_agrees_with_python_on_random_text(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("0123456789+-._e ") for _ in range(rng.randint(0, 6))) for _ in range(3000)]

    def plain(text):
        try:
            value = float(text)
        except ValueError:
            return None
        return int(value) if abs(value) < 2**63 else None

    assert column(spark, texts, tolerant_long) == [plain(t) for t in texts]


def test_iso_date(spark):
    texts = ["15/06/2025", "2025-06-15T00:00:00", "15-Jun-2025", "invalid-date", "", None, "2025", "2025-6-5",
             "2025-02-30", "0000-01-01", " 2025-06-15", "2025-06-15", "2024-02-29"]
    strict = [str(d) if d else None for d in column(spark, texts, iso_date)]
    assert strict == [None] * 11 + ["2025-06-15", "2024-02-29"]
    lenient = column(spark, texts, lambda x: iso_date(x, lenient=True))
    assert str(lenient[1]) == "2025-06-15" and lenient[2] is None


def test_numeric_text_and_blank(spark):
    assert column(spark, ["1", "-1.5", "+1", "1.", "", None], is_numeric_text) == [True, True, False, False, False, False]
    assert column(spark, [" a ", "  ", "", None], blank_to_null) == ["a", None, None, None]


def test_ids_keep_long_numbers(spark):
    assert column(spark, [7, 999999, 1234567], lambda x: format_id("PO", x, 6), "long") == [
        "PO000007", "PO999999", "PO1234567",
    ]
    assert column(spark, [" PO000012 ", "\tPO3\n", "PO7x", "XX1", None, "PO", "PO99999999999999999999"], lambda x: parse_id(x, "PO")) == [
        12, 3, None, None, None, None, None,
    ]


@pytest.mark.parametrize("buckets", [2, 3, 7, 1000, 2**31 - 1])
def test_hash_bucket_is_the_whole_md5_modulo(spark, buckets):
    texts = [f"SO{n:06d}" for n in range(500)] + ["", "ü", " x "]
    wanted = [int(hashlib.md5(t.encode()).hexdigest(), 16) % buckets for t in texts]
    assert column(spark, texts, lambda x: hash_bucket(x, buckets)) == wanted


def test_rate_is_half_up_and_null_on_zero(spark):
    frame = spark.createDataFrame([(113, 800), (1, 3), (5, 0), (None, 4), (0, 4)], "a long, b long")
    assert [r[0] for r in frame.select(rate(F.col("a"), F.col("b"))).collect()] == [0.1413, 0.3333, None, None, 0.0]
