"""Whitening of embeddings with an exact integer scatter from bit planes.

1. Entries become whole numbers, floor(scale * c). The distinct vectors are the
   fit list.
2. A map takes the fit list in blocks of rows. Each dimension is shifted to begin
   at 0 and cut into bit planes, and each plane is packed across the rows into
   64-bit words. The popcount of the AND of two planes, weighted by their powers
   of two, adds up to the cross-product of their dimensions, exactly; one more
   plane of ones gives the sums and the number of rows. The shift is taken back in
   whole numbers, and a task sends one row for each pair of dimensions and limb.
3. The driver adds the limbs up to whole numbers, n times the cross-products less
   the products of sums, so nothing is rounded before the covariance itself, and
   decomposes that matrix of dimensions squared.
4. All rows are projected by a map; the covariance of the whitened fit list shows
   what rounding left.

Vectors of different lengths are different spaces: each length has a fit list,
and components, of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .scratch import Scratch

SCALE = 256
#: Rows of a block of bit planes.
BLOCK_ROWS = 8192
#: Words of intermediate results of a step.
_STEP = 1 << 19
#: Whole numbers travel as limbs of so many bits, so that limbs of millions of tasks add up in 64 bits.
LIMB = 40
_SAFE = 1 << 62


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * c) of every entry, or null if the vector or an entry is null or an entry is not finite.

    Beyond 64 bits the nearest long stands.
    """
    finite = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    return F.when(finite, F.transform(vector, lambda c: F.floor(c.cast("double") * float(scale))))


def _planes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of the columns of x, packed across rows, with their column and weight, and the columns' shifts.

    A last column of ones is added.
    """
    rows, d = x.shape
    low = x.min(axis=0)
    shifted = np.ones((rows, d + 1), dtype=np.uint64)
    shifted[:, :d] = x.view(np.uint64) - low.view(np.uint64)
    top = shifted.max(axis=0)
    words = -(-rows // 64)
    planes, columns, weights = [], [], []
    for bit in range(64):
        used = np.flatnonzero(top >> np.uint64(bit))
        if not len(used):
            break
        packed = np.zeros((len(used), words * 8), dtype=np.uint8)
        set_bits = ((shifted[:, used] >> np.uint64(bit)) & np.uint64(1)).astype(bool)
        packed[:, : -(-rows // 8)] = np.packbits(set_bits.T, axis=1)
        planes.append(packed.view(np.uint64))
        columns.append(used)
        weights.append(np.full(len(used), bit))
    columns = np.concatenate(columns)
    order = np.argsort(columns, kind="stable")
    return np.concatenate(planes)[order], columns[order], np.concatenate(weights)[order], np.append(low, 0)


def scatter(x: np.ndarray) -> np.ndarray:
    """Cross-products of all pairs of columns of x and a column of ones, exact (64-bit if that is enough, else Python ints).

    Entry [i, j] sums x[:, i] * x[:, j], [i, -1] sums x[:, i], and [-1, -1] is the number of rows.
    """
    rows, d = x.shape
    planes, columns, weights, low = _planes(x)
    bound = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))), 1)
    # the products of shifted columns and of shifts must fit as well
    exact = np.int64 if 16 * rows * bound * bound < _SAFE else object
    # columns whose entries are all equal have no plane
    there, first = np.unique(columns, return_index=True)
    products = np.zeros((d + 1, d + 1), dtype=exact)
    factors = np.array([1 << int(w) for w in weights], dtype=exact)
    step = max(1, _STEP // (len(planes) * planes.shape[1]))
    counts = np.empty((len(planes), len(planes)), dtype=np.int64)
    for lo in range(0, len(planes), step):
        part = np.bitwise_count(planes[lo : lo + step, None, :] & planes[None, lo:, :]).sum(axis=-1, dtype=np.int64)
        counts[lo : lo + step, lo:] = part
        counts[lo:, lo : lo + step] = part.T
    weighted = counts.astype(exact) * factors[:, None] * factors
    products[np.ix_(there, there)] = np.add.reduceat(np.add.reduceat(weighted, first, axis=0), first, axis=1)
    low = low.astype(exact)
    sums = products[:, -1]
    return products + low[:, None] * sums + sums[:, None] * low + rows * low[:, None] * low


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length, the places of its vectors and the vectors as rows."""
    sizes = np.diff(column.offsets.to_numpy(zero_copy_only=False))
    entries = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for d in np.unique(sizes[sizes > 0]).tolist():
        where = np.flatnonzero(sizes == d)
        yield where, entries[starts[where][:, None] + np.arange(d)]


def _limbs(fit: DataFrame) -> DataFrame:
    """(d, i, j, limb, value): for each length d and pair of columns i <= j its cross-product, a row for each limb that is not 0."""

    def run(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                for _, x in _vectors(batch.column(0).slice(lo, BLOCK_ROWS)):
                    found, d = scatter(x), x.shape[1]
                    if d in totals:
                        large = max(abs(int(found.max())), abs(int(found.min()))) + max(abs(int(totals[d].max())), abs(int(totals[d].min())))
                        if large >= _SAFE:
                            found = found.astype(object)
                        found = totals[d] + found
                    totals[d] = found
        for d, total in totals.items():
            i, j = np.triu_indices(d + 1)
            for lo in range(0, len(i), 1 << 16):
                a, b = i[lo : lo + (1 << 16)], j[lo : lo + (1 << 16)]
                rest, limb = total[a, b], 0
                while rest.any():
                    # the sign stays with the highest limb
                    last = bool((abs(rest) < 1 << LIMB).all())
                    value = rest if last else rest & ((1 << LIMB) - 1)
                    some = np.flatnonzero(value)
                    columns = [np.full(len(some), d), a[some], b[some], np.full(len(some), limb), value[some].astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["d", "i", "j", "limb", "value"])
                    rest, limb = (rest - value) >> LIMB, limb + 1

    return fit.mapInArrow(run, "d long, i long, j long, limb long, value long").groupBy("d", "i", "j", "limb").agg(F.sum("value").alias("value"))


class Space:
    """Components of the vectors of one length: n rows with integer sums, unit eigenvectors and eigenvalues, falling."""

    def __init__(self, n: int, sums: list[int], cross: list[list[int]], components: int):
        self.n, self.sums = n, sums
        d = len(sums)
        covariance = np.array([[(n * cross[i][j] - sums[i] * sums[j]) / (n * n) for j in range(d)] for i in range(d)])
        values, vectors = np.linalg.eigh(covariance)
        trace = sum(n * cross[i][i] - sums[i] * sums[i] for i in range(d)) / (n * n)
        order = np.argsort(values)[::-1][:components]
        self.values, self.vectors = values[order], vectors[:, order]
        #: Components without variance, up to rounding, have no whitened coordinate.
        self.open = self.values > max(values.max(), 0.0) * d * np.finfo(float).eps
        self.explained = np.maximum(self.values, 0.0) / trace if trace else np.full(len(order), np.nan)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x less the sums, as whole numbers."""
        bound = self.n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + max(map(abs, self.sums))
        kind = np.int64 if bound < _SAFE else object
        return x.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def deviations(self, centred: np.ndarray) -> list[int | None]:
        """Sums of squares of rows of whole numbers; null beyond 64 bits."""
        top = max(abs(int(centred.min(initial=0))), abs(int(centred.max(initial=0))))
        if top * top * centred.shape[1] < _SAFE:
            return (centred * centred).sum(axis=1).tolist()
        return [s if s < 1 << 63 else None for s in (sum(int(v) * int(v) for v in row) for row in centred)]

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        """Coordinates of rows on the components, over the root of their variance; NaN without variance."""
        scale = np.where(self.open, np.sqrt(np.maximum(self.values, 0.0)), np.nan)
        return ((centred / self.n).astype(np.float64) @ self.vectors) / scale


def spaces(fit: DataFrame, components: int) -> dict[int, Space]:
    """The components of each length of the distinct whole vectors fit (x); the driver holds a matrix of d * d for each."""
    whole: dict[int, dict[tuple[int, int], int]] = {}
    for d, i, j, limb, value in zip(*(c.to_pylist() for c in _limbs(fit).toArrow().columns)):
        entry = whole.setdefault(d, {})
        entry[i, j] = entry.get((i, j), 0) + (value << (LIMB * limb))
    return {
        d: Space(entry[d, d], [entry.get((i, d), 0) for i in range(d)], [[entry.get((min(i, j), max(i, j)), 0) for j in range(d)] for i in range(d)], components)
        for d, entry in whole.items()
    }


def _projected(spark: SparkSession, rows: DataFrame, found: dict[int, Space]) -> DataFrame:
    """rows (row, x) with n, deviation, whitened and explained."""
    sent = spark.sparkContext.broadcast(found)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(lo, BLOCK_ROWS)
                for where, x in _vectors(part.column(1)):
                    space = sent.value[x.shape[1]]
                    centred = space.centred(x)
                    white, k = space.whitened(centred), len(space.values)
                    bounds = pa.array(np.arange(0, len(where) * k + 1, k, dtype=np.int32))
                    lists = [pa.array(np.ravel(v), from_pandas=True) for v in (white, np.broadcast_to(space.explained, white.shape))]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(where)), pa.array(np.full(len(where), space.n)), pa.array(space.deviations(centred), pa.int64()),
                         *[pa.ListArray.from_arrays(bounds, v) for v in lists]],
                        ["row", "n", "deviation", "whitened", "explained"],
                    )

    schema = StructType([StructField("row", rows.schema["row"].dataType), *StructType.fromDDL("n long, deviation long, whitened array<double>, explained array<double>").fields])
    return rows.select("row", "x").mapInArrow(run, schema)


def whiten(spark: SparkSession, embeddings: DataFrame, vector: str = "embedding", components: int = 4, scale: int = SCALE) -> DataFrame:
    """row (all columns as a struct), n, deviation, whitened, explained, identity_error of every row with a finite vector.

    n is the number of distinct whole vectors x of the row's length; deviation the
    sum of squares of n * x less the sums (null beyond 64 bits); whitened the
    coordinates on the first components, and explained their share of the variance;
    identity_error the largest entry of the whitened fit list's covariance less the
    identity. Rows whose vector is null, empty, or holds null or non-finite entries
    are left out; repeated vectors count once in the fit and are all returned.
    A component without variance has a null coordinate, and explained is null if no
    component has any. No rows give no rows; columns of any name are carried in row.
    A sign is arbitrary, and the same for all rows.
    """
    rows = embeddings.select(F.struct(*[F.col(f"`{c}`") for c in embeddings.columns]).alias("row"), quantised(F.col(f"`{vector}`"), scale).alias("x")).where("size(x) > 0")
    # copies collapse in each task before the shuffle
    fit = Scratch(spark, "whitening").keep(rows.select("x").distinct())
    found = spaces(fit, components)
    white = _projected(spark, fit.select(F.struct(F.size("x").alias("d")).alias("row"), "x"), found)
    pairs = [(a, b) for a in range(components) for b in range(a, components)]
    apart = [F.abs(F.covar_pop(F.get("whitened", F.lit(a)), F.get("whitened", F.lit(b))) - float(a == b)).alias(f"p{a}_{b}") for a, b in pairs]
    left = white.groupBy(F.col("row.d").alias("d")).agg(*apart).select("d", F.array_max(F.array(*[f"p{a}_{b}" for a, b in pairs])).alias("e"))
    errors = {r.d: r.e for r in left.collect()}
    error = F.lit(None).cast("double")
    for d, e in errors.items():
        error = F.when(F.col("d") == d, F.lit(e)).otherwise(error)
    projected = _projected(spark, rows, found).withColumn("d", F.size(F.col("row").getField(vector)))
    return projected.withColumn("identity_error", error).drop("d")
