"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Entries become integers x = floor(1024 c) + 100000. Their sums S over all rows are exact; each row is centred as
(x - S div n) - (S mod n) / n, which loses nothing to cancellation, and the scatter matrix is the sum of the centred rows'
products, added up per task and then row of the matrix by row of the matrix. The matrix itself, of the size of one
vector's length squared, is factored in one task: Cholesky takes the largest remaining diagonal entry first and stops at
the numerical rank, and Jacobi rotations from the right make the triangular factor's columns orthogonal. Their squared
norms are the eigenvalues of the scatter and the columns over their norms its unit eigenvectors, so no product of the
factor with itself is ever formed. A component's largest entry is positive.

Rows whose vector is null or holds null, infinite or undefined entries take no part. Vectors of different lengths are
lists of their own, each with its own n, sums and components; empty vectors have no components and give no rows. There
are `COMPONENTS` components at most, and only as many as the scatter has rank: one row, or equal rows, give none.
Products beyond the longs (entries beyond 2**52 / 1024 in size are taken as that) are still exact in `deviation` as long
as the result fits, else it is null. Null and repeated ids are rows like any others. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfpulse.llm.common import materialize, new_folder, table

COMPONENTS = 8
SCALE, SHIFT, MOST = 1024, 100_000, 2**52
SWEEPS = 60
GROUP = 1 << 16


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 c) + 100000 of each entry."""
    return np.clip(np.floor(vectors.astype(np.float64) * SCALE), -MOST, MOST).astype(np.int64) + SHIFT


def valid(embeddings: DataFrame) -> DataFrame:
    """vec_id, vector (doubles) and dim of the rows that take part."""
    rows = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(finite & (F.size("vector") > 0)).withColumn("dim", F.size("vector"))


def _blocks(batch: pa.RecordBatch, limit: int = 1 << 17) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, row numbers, whole numbers) of the vectors of each length, at most about `limit` entries at once."""
    dims = batch.column("dim").to_numpy()
    column = batch.column("vector")
    flat, starts = column.values.to_numpy(), column.offsets.to_numpy()
    for dim in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == dim)
        for part in np.array_split(rows, max(1, -(-len(rows) * dim // limit))):
            if len(part):
                yield dim, part, whole_numbers(flat[starts[part][:, None] + np.arange(dim)])


def sums(vectors: DataFrame) -> DataFrame:
    """dim, n and total (exact sums of whole numbers, as decimals) of the vectors of each length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, rows, whole in _blocks(batch):
                # high and low parts, so that no sum of a block leaves the longs
                high, low = whole >> 26, whole & ((1 << 26) - 1)
                own = high.sum(0).astype(object) * (1 << 26) + low.sum(0).astype(object)
                counts[dim] = counts.get(dim, 0) + len(rows)
                totals[dim] = totals[dim] + own if dim in totals else own
        for dim, count in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(dim, dim), pa.int32()), pa.array(np.arange(dim), pa.int32()),
                 pa.array(np.full(dim, count), pa.int64()), pa.array([str(value) for value in totals[dim].tolist()], pa.string())],
                names=["dim", "place", "n", "total"])

    parts = vectors.select("vector", "dim").mapInArrow(run, "dim int, place int, n long, total string")
    added = parts.groupBy("dim", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    return added.groupBy("dim").agg(
        F.first("n").alias("n"), F.transform(F.sort_array(F.collect_list(F.struct("place", "total"))), lambda t: t["total"]).alias("total"))


@dataclass(frozen=True)
class Centre:
    """Number of vectors of one length, and their sums over it: whole part and remainder."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    @staticmethod
    def of(n: int, total: list) -> Centre:
        whole = [int(t) // n for t in total]
        return Centre(n, np.array(whole, np.int64), np.array([int(t) - n * q for t, q in zip(total, whole, strict=True)], np.int64))

    def centred(self, whole: np.ndarray) -> np.ndarray:
        return (whole - self.whole) - self.rest / self.n


def scatter(vectors: DataFrame, centres: dict[int, Centre]) -> DataFrame:
    """dim, row and the entries of that row of the centred scatter matrix of each length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, whole in _blocks(batch):
                centred = centres[dim].centred(whole)
                own = centred.T @ centred
                found[dim] = found[dim] + own if dim in found else own
        for dim, matrix in found.items():
            for start in range(0, dim, 64):
                part = matrix[start: start + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), dim), pa.int32()), pa.array(np.arange(start, start + len(part)), pa.int32()),
                     pa.array(list(part), pa.list_(pa.float64()))], names=["dim", "row", "entries"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted; only one row of the matrix is held at a time."""
        at, held = None, None
        for batch in batches:
            out: list[tuple] = []
            for dim, row, entries in zip(*(batch.column(n).to_pylist() for n in ("dim", "row", "entries")), strict=True):
                if at != (dim, row):
                    if at is not None:
                        out.append((*at, held))
                    at, held = (dim, row), np.zeros(dim)
                held = held + np.array(entries)
            yield told(out)
        if at is not None:
            yield told([(*at, held)])

    def told(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int32()),
             pa.array([r[2] for r in out], pa.list_(pa.float64()))], names=["dim", "row", "entries"])

    schema = "dim int, row int, entries array<double>"
    parts = vectors.select("vector", "dim").mapInArrow(run, schema)
    return parts.repartition("dim", "row").sortWithinPartitions("dim", "row").mapInArrow(add, schema)


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L (triangular, as many columns as the numerical rank) and the pivots' order, with matrix[order][:, order] = L L^T."""
    left = matrix.astype(np.float64).copy()
    size = len(left)
    order, factor = np.arange(size), np.zeros((size, size))
    least = size * np.finfo(float).eps * max(left.diagonal().max(initial=0), 0)
    for k in range(size):
        pivot = k + int(left.diagonal()[k:].argmax())
        if left[pivot, pivot] <= least:
            return factor[:, :k], order
        for held in (left, left.T, factor):
            held[[k, pivot]] = held[[pivot, k]]
        order[[k, pivot]] = order[[pivot, k]]
        factor[k:, k] = left[k:, k] / np.sqrt(left[k, k])
        left[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return factor, order


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """The factor after rotations of its columns that make them orthogonal; rounds of disjoint pairs, rotated at once."""
    held = factor.copy()
    count = held.shape[1]
    if count < 2:
        return held
    ring = list(range(count + count % 2))
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(len(ring) - 1):
            pairs = np.array([(min(a, b), max(a, b)) for a, b in zip(ring[: len(ring) // 2], reversed(ring[len(ring) // 2:]), strict=True)
                              if max(a, b) < count])
            one, two = held[:, pairs[:, 0]], held[:, pairs[:, 1]]
            a, b, c = (one * one).sum(0), (two * two).sum(0), (one * two).sum(0)
            near = np.abs(c) / np.maximum(np.sqrt(a * b), np.finfo(float).tiny)
            worst = max(worst, float(near.max()))
            turn = near > 1e-16
            zeta = np.where(turn, (b - a) / np.where(turn, 2 * c, 1), 0)
            tangent = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta)), 0)
            cosine = 1 / np.sqrt(1 + tangent * tangent)
            sine = cosine * tangent
            held[:, pairs[:, 0]], held[:, pairs[:, 1]] = cosine * one - sine * two, sine * one + cosine * two
            ring = [ring[0], ring[-1], *ring[1:-1]]
        if worst < count * np.finfo(float).eps:
            break
    return held


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a scatter matrix, up to its rank."""
    factor, order = pivoted_cholesky(matrix)
    turned = one_sided_jacobi(factor)
    values = (turned * turned).sum(0)
    by_value = np.argsort(-values, kind="stable")
    values, turned = values[by_value], turned[:, by_value]
    vectors = np.empty_like(turned)
    vectors[order] = turned / np.sqrt(values)
    largest = np.abs(vectors).argmax(0) if vectors.size else np.zeros(0, int)
    return values, vectors * np.where(vectors[largest, np.arange(len(values))] < 0, -1.0, 1.0)


def components(matrices: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """dim, values (of the scatter), shares (of its trace) and axes (unit vectors) of each length."""
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        matrix = np.stack(rows.sort_values("row")["entries"].to_list())
        values, axes = eigen((matrix + matrix.T) / 2)
        return pd.DataFrame({
            "dim": [int(rows["dim"].iloc[0])], "values": [values[:most].tolist()],
            "shares": [(values[:most] / np.trace(matrix)).tolist()], "axes": [axes[:, :most].T.tolist()]})

    return matrices.groupBy("dim").applyInPandas(fit, "dim int, values array<double>, shares array<double>, axes array<array<double>>")


def deviations(whole: np.ndarray, centre: Centre) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2 of each row, exact; null beyond a long."""
    n, moved = centre.n, whole - centre.whole
    if whole.shape[1] * (n * int(np.abs(moved).max()) + n) ** 2 < 2**63:
        return ((n * moved - centre.rest) ** 2).sum(1).tolist()
    about = ((n * moved.astype(float) - centre.rest) ** 2).sum(1)
    out: list[int | None] = [None] * len(whole)
    for row in np.flatnonzero(about < 2.0**64):
        exact = sum((n * x - r) ** 2 for x, r in zip(moved[row].tolist(), centre.rest.tolist(), strict=True))
        out[row] = exact if exact < 2**63 else None
    return out


def whitened(vectors: DataFrame, centres: dict[int, Centre], axes: dict[int, np.ndarray]) -> DataFrame:
    """vec_id, dim, n, deviation and white (the row on each axis; an axis has the length of one over its deviation)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows, whole in _blocks(batch):
                if dim not in axes:
                    continue
                centre = centres[dim]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(rows)), pa.array(np.full(len(rows), dim), pa.int32()),
                     pa.array(np.full(len(rows), centre.n), pa.int64()), pa.array(deviations(whole, centre), pa.int64()),
                     pa.array(list(centre.centred(whole) @ axes[dim].T), pa.list_(pa.float64()))],
                    names=["vec_id", "dim", "n", "deviation", "white"])

    schema = T.StructType([vectors.schema["vec_id"], *T.StructType.fromDDL("dim int, n long, deviation long, white array<double>").fields])
    return vectors.mapInArrow(run, schema)


def identity_errors(rows: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """dim and the largest entry, in size, of the whitened rows' covariance less the identity."""
    part = [F.get("white", i) for i in range(most)]
    entries = [F.abs(F.covar_pop(part[i], part[j]) - F.lit(float(i == j))) for i in range(most) for j in range(i, most)]
    return rows.groupBy("dim").agg(F.array_max(F.array(*entries)).alias("identity_error"))


def _groups(dims: list[int], limit: int) -> list[list[int]]:
    """Lengths in groups of at most `limit` entries (or one length), for models of bounded size."""
    out: list[list[int]] = []
    for dim in sorted(dims):
        if out and sum(out[-1]) + dim <= limit:
            out[-1].append(dim)
        else:
            out.append([dim])
    return out


def whitening(embeddings: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """A row for each vector and component: whitened value, exact deviation, explained share and error of the whole.

    Means and axes go to the tasks with the code: `GROUP` entries of each at most, several groups of lengths are several
    passes."""
    spark = embeddings.sparkSession
    folder = new_folder(spark, "whitening")
    vectors = valid(embeddings)
    totals = materialize(sums(vectors), "sums", folder)
    parts = [_whitened_group(vectors.where(F.col("dim").isin(group)), totals.where(F.col("dim").isin(group)), most, f"{folder}/{number}")
             for number, group in enumerate(_groups([row["dim"] for row in totals.select("dim").collect()], GROUP))]
    schema = T.StructType([vectors.schema["vec_id"], *T.StructType.fromDDL(
        "component int, n long, deviation long, whitened double, explained double, identity_error double, dim int").fields])
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def _whitened_group(vectors: DataFrame, totals: DataFrame, most: int, folder: str) -> DataFrame:
    centres = {row["dim"]: Centre.of(row["n"], row["total"]) for row in totals.collect()}
    model = materialize(components(scatter(vectors, centres), most), "model", folder)
    axes = {row["dim"]: np.array(row["axes"]) / np.sqrt(np.array(row["values"]) / centres[row["dim"]].n)[:, None]
            for row in model.collect() if row["values"]}
    rows = materialize(whitened(vectors, centres, axes), "rows", folder)
    error = materialize(identity_errors(rows, most), "error", folder)
    shares = model.select("dim", "shares").join(error, "dim")
    return rows.join(shares, "dim").select("vec_id", "n", "deviation", "identity_error", "dim", F.posexplode(
        F.arrays_zip(F.col("white").alias("whitened"), F.col("shares").alias("explained")))).select(
        "vec_id", (F.col("pos") + 1).alias("component"), "n", "deviation", "col.whitened", "col.explained", "identity_error", "dim")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every embedding."""
    return whitening(table(spark, sf_dir, "embeddings")).drop("dim")
