"""Whitening of vectors: shifted CholeskyQR over distributed Gram passes, then an SVD of R."""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatline.llm.common import BATCH_ROWS, map_rows, short_batches, stored

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
LEAST_PASSES, MOST_PASSES = 3, 8
#: A Gram matrix whose smallest pivot is below this share of its largest is shifted again.
PIVOT = 1e-8
#: Axes with less than this share of the largest variance are rounding noise of constant combinations.
NOISE = 1e-13
LARGEST = float(1 << 56)
UNIT = np.finfo(np.float64).eps / 2


class Whitening(NamedTuple):
    """A fit: `n` distinct vectors with integer `sums`, and per component axis, variance and share."""
    n: int
    sums: list[int]
    largest: int
    axes: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float


def integers(vectors: DataFrame, row_id="vec_id", vector="embedding") -> DataFrame:
    """(vec_id, x) of the rows that have a vector of finite entries, x = floor(64 * c) + 1000000.

    An entry whose x would leave the range of a long (2 ** 56 or more) counts as not finite.
    """
    x = F.transform("vec", lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(OFFSET).cast("long"))
    return (vectors.select(F.col(row_id).alias("vec_id"), F.col(vector).alias("vec"))
            .where(F.col("vec").isNotNull() & (F.size("vec") > 0) & F.forall(
                "vec", lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < LARGEST), F.lit(False))))
            .select("vec_id", x.alias("x")))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def deviations(x: np.ndarray, n: int, sums: list[int], largest: int) -> np.ndarray:
    """n * x - S without rounding: as long where that cannot overflow, else as Python integers."""
    if 2 * n * max(largest, 1) < 1 << 62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def solve(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Y with Y R = rows for an upper triangular R, column by column over all rows."""
    y = np.empty_like(rows)
    for j in range(r.shape[0]):
        y[:, j] = (rows[:, j] - y[:, :j] @ r[:j, j]) / r[j, j]
    return y


def centred_sums(distinct: DataFrame) -> tuple[int, list[int], int]:
    """Number of vectors, exact sum and largest magnitude per dimension; a row per dimension comes back."""
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("x"))
                part = np.stack([(x & 0xFFFFFFFF).sum(axis=0), (x >> 32).sum(axis=0), np.full(x.shape[1], len(x)), np.abs(x).max(axis=0)])
                if total is None:
                    total = part
                else:
                    total[:3] += part[:3]
                    total[3] = np.maximum(total[3], part[3])
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.shape[1]), pa.int32()), *map(pa.array, total)],
                                             names=["dim", "low", "high", "n", "most"])

    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("low", "high", "n")]
    got = (short_batches(distinct).mapInArrow(run, "dim int, low long, high long, n long, most long")
           .groupBy("dim").agg(*exact, F.max("most").alias("most")).orderBy("dim").collect())
    if not got:
        return 0, [], 0
    return int(got[0].n), [(int(r.high) << 32) + int(r.low) for r in got], max(r.most for r in got)


def gram(distinct: DataFrame, n: int, sums: list[int], largest: int, factors: list[np.ndarray], axes=None) -> np.ndarray:
    """Sum of outer products of the centred rows after the triangular solves, or of their projections.

    Every task adds up its rows; Spark adds up the entries. What reaches the driver is one number per
    pair of dimensions, however many rows there are.
    """
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                rows = (deviations(matrix(batch.column("x")), n, sums, largest) / n).astype(np.float64)
                for r in factors:
                    rows = solve(rows, r)
                rows = rows if axes is None else rows @ axes
                total = rows.T @ rows if total is None else total + rows.T @ rows
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "g"])

    got = (short_batches(distinct).mapInArrow(run, "i int, j int, g double")
           .groupBy("i", "j").agg(F.sum("g").alias("g")).collect())
    size = len(sums) if axes is None else axes.shape[1]
    full = np.zeros((size, size))
    for row in got:
        full[row.i, row.j] = full[row.j, row.i] = row.g
    return full


def triangular(total: np.ndarray, first: bool) -> np.ndarray:
    """Upper R with R'R = the Gram matrix, plus a shift on the first pass or where it is singular."""
    d, norm = len(total), float(np.linalg.eigvalsh(total)[-1])
    if not first:
        try:
            r = np.linalg.cholesky(total).T
            if np.diag(r).min() ** 2 > PIVOT * np.diag(r).max() ** 2:
                return r
        except np.linalg.LinAlgError:
            pass
    # The first shift covers what sums over batches round off, a later one only the factorisation.
    shift = 11 * (d * BATCH_ROWS + d * (d + 1)) * UNIT * norm if first else 16 * d * UNIT * norm
    return np.linalg.cholesky(total + shift * np.eye(d)).T


def fit(rows: DataFrame, components=COMPONENTS) -> Whitening:
    """Principal axes of the distinct x vectors of `rows` (from `integers`), each taken once.

    Every pass solves the centred rows by the factors so far and adds up their Gram matrix, whose
    Cholesky factor joins them, until the rows are orthonormal; R is the product of the factors. Its
    singular values and right vectors are those of the centred rows, without the loss of digits that
    the covariance alone would bring. Constant combinations of dimensions have no component.

    Vectors that are not as long as most (of two lengths equally common, the longer) take no part.
    """
    width = (rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect())
    d = width[0].d if width else 0
    distinct = stored(rows.where(F.size("x") == d).select("x").distinct(), "vectors")
    n, sums, largest = centred_sums(distinct)
    factors: list[np.ndarray] = []
    for k in range(MOST_PASSES if n else 0):
        total = gram(distinct, n, sums, largest, factors)
        if not total.any():
            break
        factors.append(triangular(total, k == 0))
        spread = np.linalg.eigvalsh(total)
        if k + 1 >= LEAST_PASSES and np.minimum(np.abs(spread), np.abs(spread - 1)).max() < 1e-10:
            break
    if not factors:
        return Whitening(n, sums, largest, np.zeros((d, 0)), np.zeros(0), np.zeros(0), 0.0)
    whole = factors[0]
    for r in factors[1:]:
        whole = r @ whole
    _, singular, right = np.linalg.svd(whole)
    variances = singular ** 2 / n
    real = np.flatnonzero(variances > NOISE * variances[0])[:components]
    axes = right[real].T
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(len(real))] < 0, -1.0, 1.0)
    scaled = axes / np.sqrt(variances[real])
    error = np.abs(gram(distinct, n, sums, largest, [], scaled) / n - np.eye(len(real))).max()
    return Whitening(n, sums, largest, axes, variances[real], variances[real] / variances.sum(), float(error))


def apply(rows: DataFrame, model: Whitening) -> DataFrame:
    """One row per vector of `rows` and component: projection, scaled to variance one."""
    k, d = len(model.variances), len(model.sums)
    scaled = model.axes / np.sqrt(model.variances)

    def run(batch: pa.RecordBatch) -> dict:
        far = deviations(matrix(batch.column("x")), model.n, model.sums, model.largest)
        rows = (far / model.n).astype(np.float64)
        if (rows * rows).sum(axis=1).max() * float(model.n) ** 2 < 2.0 ** 62:
            deviation = pa.array((far * far).sum(axis=1).astype(np.int64), pa.int64())
        else:
            exact = [sum(int(v) * int(v) for v in row) for row in far]
            deviation = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
        again = pa.array(np.repeat(np.arange(batch.num_rows), k))
        size = batch.num_rows * k
        return {"vec_id": batch.column("vec_id").take(again), "component": pa.array(np.tile(np.arange(1, k + 1), batch.num_rows), pa.int32()),
                "n": pa.array(np.full(size, model.n, np.int64)), "deviation": deviation.take(again),
                "whitened": pa.array((rows @ scaled).ravel()), "explained": pa.array(np.tile(model.explained, batch.num_rows)),
                "identity_error": pa.array(np.full(size, model.identity_error))}

    kind = dict(rows.dtypes)["vec_id"]
    fitting = rows.where(F.size("x") == d)
    return map_rows(fitting, run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(vectors: DataFrame, row_id="vec_id", vector="embedding", components=COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable row.

    Rows whose vector is NULL, empty, or holds a NULL or non-finite entry go; so do those of another
    length than most. A NULL id stays NULL, a repeated row is returned as often as it comes and counts
    once in the fit. There are as many components as there are dimensions that vary, `components` at
    most; where no vector differs from another there is none, and the result is empty, as it is for an
    empty table. A `deviation` beyond a long is NULL. Components of equal variance are any basis of
    their space. Other columns are ignored.
    """
    rows = integers(vectors, row_id, vector)
    return apply(rows, fit(rows, components))
