"""Embedding whitening: leading principal components by matrix-free block subspace iteration.

Entries become integers floor(SCALE * entry) + OFFSET. Counts and sums are exact integers. A pass over the written vectors centres each row
(the integer part of the mean is taken off as an integer, so that no digits are lost) and sums X'(XQ) for a block Q of columns; the
covariance matrix itself is never made. The driver, which holds length * block doubles and no row, orthogonalises the result by QR, solves
the small Rayleigh-Ritz problem, and stops when the residual |Vz - ez| of every wanted component is at rounding error (TOLERANCE times the
largest eigenvalue, more for sums of many rows). A block starts a quarter wider than the components wanted. Where the residuals shrink so
slowly that PATIENCE more passes would not do, which is a flat spectrum, the block doubles; one as wide as the vectors has nothing left
out, so what its residual still shows is rounding.

Then a pass sums the whitened rows' products, whose covariance gives `identity_error`, and the last one emits the rows.
Sums of tasks are added in groups (sums.summed), so that no task or driver holds more than a few of them.

Vectors that are null or hold null, NaN or infinite entries are dropped, and so are those of another length than the commonest (of equally
common ones the largest). Scaled entries are held within +-MOST. Null and repeated ids are rows like others; equal vectors get
equal values. Components are min(wanted, length); of equal eigenvalues any basis. One without variance (an eigenvalue below ZERO
times the largest, as with one row or only equal rows) has explained 0 and a null whitened value, and is left out of identity_error. A
deviation that no long holds is null. An empty table gives no rows. Texts and other columns are not read, whatever
their length or names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.llm.arrow import map_arrow
from weft.llm.sums import pack, summed, unpack
from weft.llm.vectors import integer_vectors, matrix
from weft.workspace import Workspace

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
MOST = (1 << 31) - 1
TOLERANCE = 512 * 2.0**-52
PATIENCE = 8
PASSES = 200
ZERO = 1e-12
SEED = 11


@dataclass
class Centre:
    """What centring needs: rows, sums of the scaled entries, the means' floors and what is left of the sums below those."""

    n: int
    sums: np.ndarray
    floor: np.ndarray
    rest: np.ndarray

    @staticmethod
    def of(n: int, sums: np.ndarray) -> Centre:
        floor = sums // max(n, 1)
        return Centre(n, sums, floor, sums - n * floor)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over entries of (n * entry - sum) ** 2: exact integers, None beyond a long."""
        z = x - self.floor
        most = int(np.abs(z).max(initial=0)) + 1
        if (self.n * most) ** 2 * x.shape[1] < 2**63:
            d = self.n * z - self.rest
            return (d * d).sum(1).tolist()
        d = self.n * z.astype(object) - self.rest.astype(object)
        return [v if v < 2**63 else None for v in (d * d).sum(1).tolist()]


def over_rows(rows: DataFrame, length: int, kind: type, add: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum over all rows of what `add` makes of a block of them; None without rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                own = add(matrix(batch.column("x"), length).astype(np.int64))
                total = own if total is None else total + own
        if total is not None:
            yield pa.record_batch([pa.array([0], pa.int32()), pa.array([pack(total)], pa.binary())], names=["key", "values"])

    parts = rows.select("x").transform(map_arrow, run, "key int, values binary")
    found = summed(parts, kind).collect()
    return unpack(found[0]["values"], kind) if found else None


def products(rows: DataFrame, centre: Centre, q: np.ndarray) -> tuple[np.ndarray, float]:
    """V Q of the covariance V of all rows, and V's trace, by one pass."""
    length, block = q.shape

    def add(x: np.ndarray) -> np.ndarray:
        c = centre.centred(x)
        return np.append((c.T @ (c @ q)).reshape(-1), (c * c).sum())

    total = over_rows(rows, length, np.float64, add) / centre.n
    return total[:-1].reshape(length, block), float(total[-1])


def components(multiply: Callable[[np.ndarray], tuple[np.ndarray, float]], length: int, wanted: int, tolerance: float) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Eigenvectors (length, wanted) and eigenvalues by falling size, the trace, and the passes taken.

    `multiply` gives the product of the matrix with a block of columns, and its trace.
    """
    rng = np.random.default_rng(SEED)
    block = min(length, wanted + max(8, wanted // 4))
    q = np.linalg.qr(rng.standard_normal((length, block)))[0]
    last, whole = None, 0
    for passes in range(1, PASSES + 1):
        y, trace = multiply(q)
        t = q.T @ y
        values, u = np.linalg.eigh((t + t.T) / 2)
        values, u = values[::-1], u[:, ::-1]
        ritz, image = q @ u, y @ u
        left = float(np.linalg.norm(image[:, :wanted] - ritz[:, :wanted] * values[:wanted], axis=0).max())
        goal = tolerance * max(float(values[0]), 0.0)
        whole += block == length
        if left <= goal or whole > 1:
            break
        slow = last is not None and (left >= last or np.log(goal / left) < PATIENCE * np.log(left / last))
        last = None if slow else left
        fresh = rng.standard_normal((length, min(block, length - block) if slow else 0))
        q = np.linalg.qr(np.concatenate([image, fresh], axis=1))[0]
        block = q.shape[1]
    else:
        raise ArithmeticError(f"residual {left:.3g} after {PASSES} passes, wanted {goal:.3g}")
    z = ritz[:, :wanted]
    z = z / np.linalg.norm(z, axis=0)
    sign = np.where(z[np.abs(z).argmax(0), np.arange(z.shape[1])] < 0, -1.0, 1.0)
    return z * sign, np.maximum(values[:wanted], 0.0), trace, passes


def whiten(rows: DataFrame, work: Workspace, *, vec_id: Column, vector: Column, wanted: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every vector that is kept."""
    kept, length = integer_vectors(rows, work, "vectors", vector, SCALE, MOST, vec_id=vec_id)
    kind = kept.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not length:
        return rows.sparkSession.createDataFrame([], schema)
    # the offset is the same in an entry and in the mean: it cancels in every centred number
    counted = over_rows(kept, length, np.int64, lambda x: np.append(x.sum(0), len(x)))
    centre = Centre.of(int(counted[-1]), counted[:-1])
    tolerance = max(TOLERANCE, 8 * 2.0**-52 * centre.n**0.5)
    z, values, trace, _ = components(lambda q: products(kept, centre, q), length, min(wanted, length), tolerance)
    varied = (values > ZERO * values[0]) & (values > 0)
    basis = z[:, varied] / np.sqrt(values[varied])
    k = basis.shape[1]
    identity = 0.0
    if k:

        def add(x: np.ndarray) -> np.ndarray:
            w = centre.centred(x) @ basis
            return np.append((w.T @ w).reshape(-1), w.sum(0))

        total = over_rows(kept, length, np.float64, add) / centre.n
        mean = total[k * k :]
        identity = float(np.abs(total[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())
    explained = np.where(varied, values / trace if trace > 0 else 0.0, 0.0)
    width = len(values)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), length).astype(np.int64)
            rows_ = len(x)
            each = np.repeat(np.arange(rows_), width)
            whitened = np.zeros((rows_, width))
            whitened[:, varied] = centre.centred(x) @ basis
            yield pa.record_batch(
                [
                    batch.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), rows_)),
                    pa.array(np.full(rows_ * width, centre.n, np.int64)),
                    pa.array(centre.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(whitened.reshape(-1), mask=np.tile(~varied, rows_)),
                    pa.array(np.tile(explained, rows_)),
                    pa.array(np.full(rows_ * width, identity)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return kept.transform(map_arrow, emit, schema)
