"""Whitening against numpy on whole small tables and odd rows."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from millrace.llm import queries
from millrace.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<float>, component int, whitened string, n string"


def brute(rows, weights="count", shown=8):
    """Counter of (vec_id, n, deviation), matrix of the rows kept, eigenvalues, whitened rows."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in kept], dtype=object)
    fitted = x if weights == "count" else np.array(sorted(set(map(tuple, x))), dtype=object)
    n, sums = len(fitted), fitted.sum(axis=0)
    centred = (n * fitted - sums).astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    white = ((n * x - sums).astype(float) / n) @ vectors[:, :shown] / np.sqrt(values[:shown])
    return kept, n, deviation.tolist(), values, white


def check(rows, found, weights="count", shown=8):
    kept, n, deviation, values, white = brute(rows, weights, shown)
    assert Counter((r.vec_id, r.component, r.n, r.deviation) for r in found) == Counter(
        (i, c + 1, n, d) for (i, _), d in zip(kept, deviation, strict=True) for c in range(shown)
    )
    for component in range(1, shown + 1):
        mine = sorted((-1 if r.vec_id is None else r.vec_id, r.deviation, r.whitened) for r in found if r.component == component)
        other = [(-1 if i is None else i, d, w) for (i, _), d, w in zip(kept, deviation, white[:, component - 1], strict=True)]
        # either sign, the same for all rows
        ways = [sorted((i, d, sign * w) for i, d, w in other) for sign in (1, -1)]
        assert any(np.allclose([m[2] for m in mine], [w[2] for w in way], rtol=1e-7, atol=1e-7) for way in ways)
        share = values[component - 1] / values.sum()
        assert all(abs(r.explained - share) <= 1e-9 * share for r in found if r.component == component)
    errors = {r.identity_error for r in found}
    assert len(errors) == 1 and errors.pop() < 1e-8


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    check(rows, queries.op11_whiten(spark, "/root/testdata/sf0.001").collect())


def odd_rows():
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=5) * [1, 2, 3, 4, 5]]) for i in range(60)]
    common = rows[0][1]
    rows += [(100 + i, common) for i in range(40)] + [(None, common), (None, rows[1][1]), (7, rows[2][1]), (7, rows[2][1])]
    return rows + [(200, None), (201, [1.0, None, 1.0, 1.0, 1.0]), (202, [math.nan] * 5), (203, [math.inf, 0.0, 0.0, 0.0, 0.0])]


@pytest.mark.parametrize("weights", ["count", "one"])
def test_odd_rows(spark, weights):
    rows = odd_rows()
    frame = spark.createDataFrame([(i, v, 5, "w", "n") for i, v in rows], SCHEMA).repartition(3)
    found = whiten(frame, weights=weights).collect()
    if weights == "one":  # the fit is over distinct vectors; the error regards them
        check(rows, found, weights, 5)
    else:
        check(rows, found, shown=5)


def test_vectors_of_another_width_are_left_out(spark):
    rows = odd_rows()
    frame = spark.createDataFrame(rows + [(300, [1.0, 2.0]), (301, []), (302, [1.0] * 6)], "vec_id long, embedding array<float>")
    check(rows, whiten(frame).collect(), shown=5)


def test_no_rows_and_no_variance(spark):
    kind = "vec_id string, embedding array<double>"
    empty = whiten(spark.createDataFrame([("a", None), ("b", [])], kind))
    assert empty.collect() == [] and dict(empty.dtypes)["vec_id"] == "string"
    one = whiten(spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0, 2.0])], kind)).collect()
    assert Counter((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one) == Counter(
        (i, c, 2, 0, None, None, None) for i in "ab" for c in (1, 2)
    )
    line = whiten(spark.createDataFrame([("a", [1.0, 2.0]), ("b", [2.0, 4.0])], kind)).collect()
    assert {(r.component, r.whitened is None) for r in line} == {(1, False), (2, True)}
    assert {round(abs(r.whitened), 9) for r in line if r.component == 1} == {1.0}


def test_very_large_numbers_stay_exact(spark):
    rows = [(1, [2.0**50, 0.0]), (2, [-(2.0**50), 1.0]), (3, [0.0, 5.0])]
    found = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.deviation for r in found if r.vec_id == 1} == {None}
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x, strict=True)]
    third = sum((3 * a - s) ** 2 for a, s in zip(x[2], sums, strict=True))
    assert {r.deviation for r in found if r.vec_id == 3} == {third}
