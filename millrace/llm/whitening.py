"""Whitens embeddings by their covariance.

Vectors are cut to whole numbers, and equal ones are put together with their number as weight. Sums and
products are taken once for each distinct vector: every task centres its vectors, multiplies them as one
matrix and gives a partial product, and these are added up. The eigenvectors of the covariance come from
one matrix that is as large as the vectors are wide, whatever the number of rows. Each distinct vector is
projected once, and the rows then look theirs up. A vector that a third of all rows share is counted before
the shuffle, and cut into pieces when the rows look it up.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.shared import map_arrow, spread_join, stored

#: A whole number is ``floor(SCALE * entry) + SHIFT``.
SCALE, SHIFT = 1024, 100_000
#: Components that are returned.
COMPONENTS = 8
#: A component whose eigenvalue is below this share of the largest, for each dimension, has no variance.
NOTHING = float(np.finfo(np.float64).eps)

WHITE = "key struct<a:long,b:long>, weight long, copies long, deviation long, whitened array<double>"
RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"
_SAFE = float(1 << 62)


def whole_numbers(vector: Column) -> Column:
    """The vector in whole numbers, or null if it is null or has an entry that is null or not finite."""
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    numbers = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)
    return F.when(vector.isNotNull() & ~odd, numbers)


class Fit(NamedTuple):
    """Number of vectors, exact sums by dimension, eigenvalues and unit eigenvectors (columns) by falling value."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def live(self) -> int:
        """Components with any variance."""
        if not len(self.values) or self.values[0] <= 0:
            return 0
        return int(np.sum(self.values > self.values[0] * NOTHING * len(self.values)))


def distinct_vectors(vectors: DataFrame, vector: str, weights: str = "count") -> DataFrame:
    """Distinct ``x`` with ``weight``, its number of rows or one, and ``key``, its digest of 128 bits."""
    if weights not in ("count", "one"):
        raise ValueError("weights are 'count' or 'one'")
    groups = vectors.groupBy(F.col(vector).alias("x")).agg(F.count("*").alias("copies"))
    weight = F.col("copies") if weights == "count" else F.lit(1).cast("long")
    return groups.select(digest(F.col("x")).alias("key"), F.size("x").alias("width"), "copies", weight.alias("weight"), "x")


def digest(x: Column) -> Column:
    return F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(SHIFT), x).alias("b"))


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _summing(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * width
        for batch in batches:
            x, weight = _matrix(batch, width), batch.column(0).to_numpy()
            # int64 unless a sum could pass it
            exact = float(np.abs(x.astype(np.float64)).max(initial=0)) * float(weight.sum()) < _SAFE
            parts = weight @ x if exact else weight.astype(object) @ x.astype(object)
            total = [a + int(b) for a, b in zip(total, parts, strict=True)]
            n += int(weight.sum())
        rows = [pa.array([-1, *range(width)], pa.int32()), pa.array([str(v) for v in (n, *total)])]
        yield pa.RecordBatch.from_arrays(rows, ["dim", "sum"])

    return run


def _centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, bool]:
    """``n * x - sums``, in int64 if no number can pass it, otherwise as Python integers."""
    largest = float(np.abs(x.astype(np.float64)).max(initial=0)) * n + max((abs(s) for s in sums), default=0)
    if largest < _SAFE:
        return n * x - np.array(sums, np.int64), True
    return n * x.astype(object) - np.array(sums, object), False


def _products(width: int, n: int, sums: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            d = _centred(_matrix(batch, width), n, sums)[0].astype(np.float64) / n
            total += (d * batch.column(0).to_numpy()[:, None]).T @ d
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "v"])

    return run


def fit(distinct: DataFrame, width: int) -> Fit:
    """Weighted mean and covariance of distinct vectors of one width, divisor the sum of weights.

    The first pass adds exact integers, the second products of centred vectors. The driver sees one number
    for each pair of dimensions.
    """
    rows = distinct.select("weight", "x")
    parts = map_arrow(rows, _summing(width), "dim int, sum string")
    sums = {r.dim: int(r.sum) for r in parts.groupBy("dim").agg(F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")).collect()}
    n, sums = sums[-1], [sums[i] for i in range(width)]
    covariance = np.zeros((width, width))
    for r in map_arrow(rows, _products(width, n, sums), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        covariance[r.i, r.j] = covariance[r.j, r.i] = r.v / n
    values, vectors = np.linalg.eigh(covariance)
    return Fit(n, sums, float(np.trace(covariance)), np.maximum(values[::-1], 0.0), vectors[:, ::-1])


def _projecting(fitted: Fit, components: int):
    width, live = len(fitted.sums), min(fitted.live, components)
    projection = fitted.vectors[:, :live] / np.sqrt(fitted.values[:live])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, exact = _centred(_matrix(batch, width), fitted.n, fitted.sums)
            if exact and float((d.astype(np.float64) ** 2).sum(axis=1).max(initial=0)) < _SAFE:
                deviation = (d * d).sum(axis=1).tolist()
            else:
                deviation = [v if v < 1 << 63 else None for v in (d.astype(object) ** 2).sum(axis=1).tolist()]
            white = np.full((len(d), components), np.nan)
            white[:, :live] = (d.astype(np.float64) / fitted.n) @ projection
            flat = pa.array(white.ravel(), mask=np.isnan(white.ravel()))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(d) + 1) * components, pa.int32()), flat)
            names = ["key", "weight", "copies", "deviation", "whitened"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(deviation, pa.int64()), lists], names)

    return run


def identity_error(white: DataFrame, live: int) -> float | None:
    """The largest absolute entry of the weighted covariance of the first ``live`` components minus the identity."""
    if not live:
        return None
    weight, at = F.col("weight"), lambda k: F.col("whitened")[k]
    means = white.agg(F.sum(weight), *[F.sum(weight * at(k)) for k in range(live)]).first()
    n, means = means[0], [m / means[0] for m in means[1:]]
    pairs = [(i, j) for i in range(live) for j in range(i, live)]
    sums = white.agg(*[F.sum(weight * (at(i) - means[i]) * (at(j) - means[j])) for i, j in pairs]).first()
    return max(abs(s / n - (i == j)) for (i, j), s in zip(pairs, sums, strict=True))


def whiten(embeddings: DataFrame, components: int = COMPONENTS, weights: str = "count", vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, or has an entry that is null or not finite, are left out, and so are those of
    another width than most have (of two widths as frequent the larger is taken). ``weights`` says whether a
    vector counts as often as it occurs, or once. A null or repeated id is a row like any other, and other
    columns aren't read. There are as many components as dimensions, ``components`` at most. One without
    variance, as all are when one vector is left, has a null ``whitened``; ``explained`` is null if nothing
    varies, and so is ``identity_error``, which regards components with variance only. A ``deviation`` beyond
    64 bits is null. Entries beyond the range of 64-bit integers end there. No rows give no rows.
    """
    rows = embeddings.select(F.col(vec_id).alias("vec_id"), whole_numbers(F.col(vector)).alias("x")).filter("x IS NOT NULL")
    groups = stored(distinct_vectors(rows, "x", weights), "distinct-vectors")
    widths = groups.filter("width > 0").groupBy("width").agg(F.sum("copies").alias("rows")).orderBy(F.desc("rows"), F.desc("width"))
    usual = widths.first()
    if usual is None:
        kinds = T.StructType([rows.schema["vec_id"], *T.StructType.fromDDL(RESULT).fields])
        return embeddings.sparkSession.createDataFrame([], kinds)
    width, total = usual
    kept = groups.filter(F.col("width") == width)
    fitted = fit(kept, width)
    shown = min(components, width)
    white = stored(map_arrow(kept.select("key", "weight", "copies", "x"), _projecting(fitted, shown), WHITE), "whitened")
    error = identity_error(white, min(fitted.live, shown))

    narrow = rows.filter(F.size("x") == width).select("vec_id", digest(F.col("x")).alias("key"), F.monotonically_increasing_id().alias("_place"))
    found = spread_join(narrow, white.drop("weight"), "key", "copies", F.col("_place"), total)
    explained = [float(v / fitted.trace) if fitted.trace > 0 else None for v in fitted.values[:shown]]
    shares = F.array(*[F.lit(x).cast("double") for x in explained])
    return found.select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened")).select(
        "vec_id",
        (F.col("_at") + 1).cast("int").alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("_at")].alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
