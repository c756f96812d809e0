"""Embedding whitening by incremental eigendecomposition.

Entries are counted in steps of 1 / ``SCALE``, so a vector is one of whole numbers and sums over vectors are exact. The fit list holds each distinct vector once.

1. *Rank-one updates.* Each partition of the fit list keeps the spectrum (eigenvalues, eigenvectors) of the scatter of its vectors around their mean. A vector changes
   a scatter by one rank-one term, and a changed mean by another. The new eigenvalues are the roots of the secular equation, all bisected at once between the
   old ones; entries that do not take part and equal eigenvalues are deflated first, and the update vector is computed again from the roots, which keeps the
   eigenvectors orthogonal. ``ROWS`` vectors at a time are first rotated into their triangular factor, which has the same scatter in as many rows as the vectors
   have entries, so the updates a partition makes do not grow with every vector.
2. *Combination.* Spectra are merged in groups of ``FAN``, level by level in tasks: the eigenvectors of one are rank-one updates of the other, and
   the difference of their means is one more. One spectrum reaches the driver.
3. *Refinement.* Rayleigh-Ritz: the covariance within the basis is summed over the partitions of the fit list, and its eigenvectors turn the basis, until
   nothing is left beside its diagonal. The basis is complete, so the result is exact to double precision.

Every row, repeated or not, is then projected by the components. Nulls and edges: vectors that are null or empty, hold a null or non-finite entry, or are not of the most
frequent length (the larger of equals) take no part; null ids and repeated rows are rows like others; entries beyond 64 bits stop at their ends; a component
without variance (as with one distinct vector) gives a null; a deviation beyond 64 bits is null; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.plans.session import written

SCALE = 256
ROWS = 4096
FAN = 16
ROUNDS = 4
EPS = np.finfo(np.float64).eps


def roots(values: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(values) + rho z z', and the matrix of (old value - root).

    ``values`` rise strictly and z has no zeros. Root i lies between values i and i + 1; it is sought as an offset from the closer one.
    """
    weights = rho * z * z
    last = values[-1] + weights.sum()
    above = np.append(values[1:], last)
    half = (above - values) / 2
    middle = 1 + (weights[:, None] / (values[:, None] - (values + half))).sum(axis=0)
    left = middle > 0
    left[-1] = True
    origin = np.where(left, values, above)
    apart = values[:, None] - origin
    low = np.where(left, 0.0, -half)
    high = np.where(left, half, 0.0)
    high[-1] = last - values[-1]
    for _ in range(60):
        at = (low + high) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            positive = 1 + (weights[:, None] / (apart - at)).sum(axis=0) > 0
        low, high = np.where(positive, low, at), np.where(positive, at, high)
    at = np.where(left, high, low)  # the end that is not the pole
    return origin + at, apart - at


def rank_one(values: np.ndarray, vectors: np.ndarray, rho: float, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spectrum of vectors diag(values) vectors' + rho u u', values rising."""
    z = vectors.T @ u
    norm = np.linalg.norm(z)
    if not rho * norm * norm > 0:
        return values, vectors
    rho, z = rho * norm * norm, z / norm
    least = 8 * EPS * max(abs(values[-1]), rho)
    # Deflation: within equal values the eigenvectors are free, so a reflection gives one of them all of z.
    starts = np.flatnonzero(np.append(True, np.diff(values) > least))
    if len(starts) < len(values):
        vectors = vectors.copy()
        for a, b in zip(starts, np.append(starts[1:], len(values))):
            if b - a < 2 or not (length := np.linalg.norm(z[a:b])):
                continue
            mirror = z[a:b].copy()
            mirror[-1] += length if mirror[-1] >= 0 else -length
            end = -length if z[b - 1] >= 0 else length
            vectors[:, a:b] -= np.outer(vectors[:, a:b] @ mirror, mirror) * (2 / (mirror @ mirror))
            z[a:b], z[b - 1] = 0.0, end
    taking = np.flatnonzero(rho * np.abs(z) > least)
    if not len(taking):
        return values, vectors
    old = values[taking]
    new, apart = roots(old, z[taking], rho)
    # The z that has exactly these roots.
    ratio = -apart / (old - old[:, None] + np.eye(len(old)))
    exact = np.copysign(np.sqrt(np.abs(ratio.prod(axis=1)) / rho), z[taking])
    turn = exact[:, None] / apart
    turn /= np.linalg.norm(turn, axis=0)
    values, vectors = values.copy(), vectors.copy()
    values[taking], vectors[:, taking] = new, vectors[:, taking] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Of the scatter of ``n`` vectors around their mean; ``sums`` are exact."""

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> Spectrum:
        """Of a slice of vectors, as whole numbers: one update a row of their triangular factor."""
        sums = [(int(h) << 32) + int(l) for h, l in zip((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))]
        mean = np.array([s / len(x) for s in sums])
        centred = x - mean
        rows = np.linalg.qr(centred, mode="r") if len(x) > x.shape[1] else centred
        values, vectors = np.zeros(x.shape[1]), np.eye(x.shape[1])
        for row in rows:
            values, vectors = rank_one(values, vectors, 1.0, row)
        return cls(len(x), sums, mean, values, vectors)

    def joined(self, other: Spectrum) -> Spectrum:
        values, vectors, n = self.values, self.vectors, self.n + other.n
        for value, vector in zip(other.values, other.vectors.T):
            values, vectors = rank_one(values, vectors, max(value, 0.0), vector)
        values, vectors = rank_one(values, vectors, self.n * other.n / n, other.mean - self.mean)
        sums = [a + b for a, b in zip(self.sums, other.sums)]
        return Spectrum(n, sums, np.array([s / n for s in sums]), values, vectors)

    SCHEMA = "slot long, n long, sums array<string>, values array<double>, vectors array<double>"

    def row(self, slot: int) -> pa.RecordBatch:
        cells = {"slot": slot, "n": self.n, "sums": list(map(str, self.sums)), "values": self.values, "vectors": self.vectors.ravel()}
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in cells.values()], names=list(cells))

    @classmethod
    def read(cls, row: dict) -> Spectrum:
        sums, n = [int(s) for s in row["sums"]], row["n"]
        values = np.array(row["values"])
        return cls(n, sums, np.array([s / n for s in sums]), values, np.array(row["vectors"]).reshape(len(values), -1))


def matrices(batches: Iterator[pa.RecordBatch], width: int, column: str = "x") -> Iterator[np.ndarray]:
    """The vectors of the batches, ROWS at a time."""
    held = np.empty((0, width), np.int64)
    for batch in batches:
        new = batch.column(column).flatten().to_numpy().reshape(-1, width)
        for start in range(0, len(new), ROWS):
            held = np.concatenate([held, new[start : start + ROWS]])
            if len(held) >= ROWS:
                yield held[:ROWS]
                held = held[ROWS:]
    if len(held):
        yield held


def combined(parts: DataFrame, schema: str, merge: Callable[[list[dict], int], pa.RecordBatch], label: str) -> dict:
    """The one row that is left after merging rows of neighbouring slots, FAN at a time."""

    def group(table: pa.Table) -> pa.Table:
        rows = table.sort_by("slot").to_pylist()
        return pa.Table.from_batches([merge(rows, rows[0]["slot"] // FAN)])

    parts = written(parts, label)
    while parts.agg(F.max("slot")).first()[0] > 0:
        parts = written(parts.groupBy(F.expr(f"slot div {FAN}")).applyInArrow(group, schema), label)
    return parts.first().asDict()


def merged_spectra(rows: list[dict], slot: int) -> pa.RecordBatch:
    found = Spectrum.read(rows[0])
    for row in rows[1:]:
        found = found.joined(Spectrum.read(row))
    return found.row(slot)


def spectrum(fit: DataFrame, width: int) -> Spectrum:
    """Of the fit list (x): partitions by updates, then merged."""

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for x in matrices(batches, width):
            found = Spectrum.of(x) if found is None else found.joined(Spectrum.of(x))
        if found is not None:
            yield found.row(TaskContext.get().partitionId())

    return Spectrum.read(combined(fit.mapInArrow(of_partition, Spectrum.SCHEMA), Spectrum.SCHEMA, merged_spectra, "spectra"))


SUMS = "slot long, sums array<double>"


def sum_row(slot: int, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([slot]), pa.array([sums.ravel()])], names=["slot", "sums"])


def merged_sums(rows: list[dict], slot: int) -> pa.RecordBatch:
    return sum_row(slot, np.sum([r["sums"] for r in rows], axis=0))


def covariance(fit: DataFrame, width: int, n: int, centre: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Of the fit list within a basis (width x k), centred before multiplying."""
    k = basis.shape[1]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for x in matrices(batches, width):
            y = (x - centre) @ basis
            total[:k] += y.T @ y
            total[k] += y.sum(axis=0)
        yield sum_row(TaskContext.get().partitionId(), total)

    total = np.array(combined(fit.mapInArrow(products, SUMS), SUMS, merged_sums, "products")["sums"]).reshape(k + 1, k)
    rest = total[k] / n  # what rounding of the centre left
    return total[:k] / n - np.outer(rest, rest)


@dataclass
class Whitening:
    """Components as columns by falling variance, of ``n`` distinct vectors with exact sums."""

    n: int
    sums: list[int]
    centre: np.ndarray
    variances: np.ndarray
    components: np.ndarray
    total: float
    identity_error: float

    def weights(self) -> np.ndarray:
        """Components that map a centred vector to unit variances; not a number where there is no variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.variances > 0, self.components / np.sqrt(self.variances), np.nan)


def whole_vectors(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """Rows (id, x) of the vectors that take part."""
    entries = F.transform(vector_column, lambda c: c.cast("double"))
    usable = F.size(vector_column) > 0
    usable &= F.forall(entries, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    steps = F.transform(entries, lambda c: F.floor(c * SCALE) + F.lit(0).cast("long"))
    rows = written(table.select(F.col(id_column).alias("id"), steps.alias("x"), usable.alias("usable")).where("usable").drop("usable"), "vectors")
    widths = rows.groupBy(F.size("x").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    width = widths.agg(F.max(F.struct("n", "width")).alias("top")).first().top
    return rows.where(F.size("x") == (width.width if width else 0))


def fit(vectors: DataFrame, count: int) -> Whitening | None:
    """The first ``count`` components of the distinct vectors of rows (x); None without any."""
    first = vectors.select("x").first()
    if first is None:
        return None
    width = len(first.x)
    distinct = written(vectors.select("x").distinct(), "fit-list")
    start = spectrum(distinct, width)
    n, centre, basis = start.n, start.mean, np.linalg.qr(start.vectors)[0]
    for _ in range(ROUNDS):
        within = covariance(distinct, width, n, centre, basis)
        values, turn = np.linalg.eigh((within + within.T) / 2)
        beside = np.abs(within - np.diag(np.diag(within))).max(initial=0.0)
        basis = np.linalg.qr(basis @ turn[:, ::-1])[0]
        if beside <= 1e-13 * np.trace(within):
            break
    total = float(np.trace(within))
    count = min(count, width)
    variances = np.where(values[::-1] > 16 * width * EPS * total, values[::-1], 0.0)[:count]
    found = Whitening(n, start.sums, centre, variances, basis[:, :count], total, 0.0)
    real = variances > 0
    if real.any():
        white = covariance(distinct, width, n, centre, found.weights()[:, real])
        found.identity_error = float(np.abs(white - np.eye(len(white))).max())
    return found


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n x - S)^2 over the dimensions."""
    largest = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums))
    if largest * largest * x.shape[1] < 1 << 63:
        apart = n * x - np.array(sums, np.int64)
        return (apart * apart).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [d if d < 1 << 63 else None for d in exact]


def whitened(table: DataFrame, count: int = 4, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Per row and component: id, component, n, deviation, whitened, explained, identity_error."""
    id_type = table.schema[id_column].dataType.simpleString()
    schema = f"id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = whole_vectors(table, id_column, vector_column)
    model = fit(rows, count)
    if model is None:
        return table.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_column)
    width, weights, k = len(model.sums), model.weights(), len(model.variances)
    explained = model.variances / model.total if model.total else np.zeros(k)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                x = part.column("x").flatten().to_numpy().reshape(-1, width)
                white = ((x - model.centre) @ weights).ravel()
                twice = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(twice), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, model.n)),
                     pa.array(deviations(x, model.n, model.sums), pa.int64()).take(twice), pa.array(white, mask=np.isnan(white)),
                     pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, model.identity_error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(project, schema).withColumnRenamed("id", id_column)
