"""Whitening of embeddings by a bidiagonal qd solver.

Rows of the fit list are centred and reduced block by block to one upper triangular factor R (QR of a block stacked under
the factor so far, then of factors in groups): R'R is n times the covariance. Householder reflections turn R into an upper
bidiagonal matrix, the differential qd algorithm with shifts (dqds) finds its singular values to high relative accuracy,
and twisted factorisations give a right singular vector for each. The vectors, divided by their standard deviations,
whiten.

Spark distributes what grows with the rows: the distinct list, exact sums, blocks of R, the check of the result, and the
projection of every row. Only R (dimensions squared) reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import staged

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
# Rows reduced at once, and factors reduced by one task.
BLOCK_ROWS, FAN_IN = 4096, 32
LARGEST = 1e17
EPS = np.finfo(float).eps


# -- bidiagonal solver -----------------------------------------------------------------------------------------------


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder reflections from both sides: diagonal and superdiagonal of B, and the orthogonal V of R = U B V'."""
    a = np.array(r, float)
    n = a.shape[1]
    v = np.eye(n)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        size = np.linalg.norm(x)
        h = x.copy()
        if size == 0:
            return h, 0.0
        h[0] += size if x[0] >= 0 else -size
        return h, 2.0 / (h @ h)

    for k in range(n):
        h, factor = reflector(a[k:, k])
        a[k:, k:] -= factor * np.outer(h, h @ a[k:, k:])
        if k < n - 2:
            h, factor = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= factor * np.outer(a[k:, k + 1 :] @ h, h)
            v[:, k + 1 :] -= factor * np.outer(v[:, k + 1 :] @ h, h)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), v


def _dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential qd transform with a shift, and its smallest pivot; None where the shift exceeds the smallest
    squared singular value."""
    out_q, out_e = [0.0] * len(q), [0.0] * len(e)
    d = q[0] - shift
    least = d
    for i in range(len(e)):
        if d < 0:
            return None
        out_q[i] = d + e[i]
        if out_q[i] == 0:
            out_e[i], d = 0.0, q[i + 1] - shift
        else:
            ratio = q[i + 1] / out_q[i]
            out_e[i] = e[i] * ratio
            d = d * ratio - shift
        least = min(least, d)
    if d < 0:
        return None
    out_q[-1] = d
    return out_q, out_e, least


def dqds(diagonal: np.ndarray, super_: np.ndarray) -> np.ndarray:
    """Singular values of an upper bidiagonal matrix, falling. Every transform keeps high relative accuracy; a shift that
    is too large shows as a negative pivot and is taken back, and a zero shift always succeeds."""
    found: list[float] = []
    blocks = [(list(map(float, diagonal**2)), list(map(float, super_**2)), 0.0)]
    while blocks:
        q, e, shifted = blocks.pop()
        guess = 0.0
        while q:
            if len(q) == 1:
                found.append(q.pop() + shifted)
                break
            # Couplings that no longer matter split the block or set its last value free.
            small = [i for i in range(len(e)) if e[i] <= EPS**2 * (q[i] + shifted) or e[i] <= EPS**2 * shifted]
            if small and small[-1] == len(e) - 1:
                found.append(q.pop() + shifted)
                e.pop()
                guess = 0.0
                continue
            if small:
                at = small[-1]
                blocks.append((q[: at + 1], e[:at], shifted))
                q, e, guess = q[at + 1 :], e[at + 1 :], 0.0
                continue
            if 1.5 * q[0] < q[-1]:  # small values converge at the end
                q, e = q[::-1], e[::-1]
            step = None
            for factor in (1 - 1e-3, 0.75, 0.25):
                step = _dqds_step(q, e, factor * guess) if guess > 0 else None
                if step is not None:
                    shifted += factor * guess
                    break
            if step is None:
                step = _dqds_step(q, e, 0.0)
            q, e, guess = step
            guess = max(0.0, guess)
    return np.sqrt(np.maximum(np.sort(found)[::-1], 0.0))


def _twisted(d: np.ndarray, low: np.ndarray, lam: float) -> np.ndarray:
    """Eigenvector of L D L' for ``lam`` from the stationary factorisation from the top and the progressive one from the
    bottom, twisted where they meet with the smallest remainder."""
    n = len(d)
    tiny = np.finfo(float).tiny / EPS
    up_l, down_u = np.zeros(n - 1), np.zeros(n - 1)
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -lam
    for i in range(n - 1):
        pivot = s[i] + d[i]
        if pivot == 0:
            pivot = -tiny
        up_l[i] = d[i] * low[i] / pivot
        s[i + 1] = up_l[i] * low[i] * s[i] - lam
    p[n - 1] = d[n - 1] - lam
    for i in range(n - 2, -1, -1):
        pivot = p[i + 1] + d[i] * low[i] ** 2
        if pivot == 0:
            pivot = -tiny
        down_u[i] = low[i] * d[i] / pivot
        p[i] = p[i + 1] * (d[i] / pivot) - lam
    k = int(np.argmin(np.abs(s + p + lam)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -up_l[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -down_u[i] * z[i]
    return z / np.linalg.norm(z)


def _tridiagonal_solve(diag: np.ndarray, off: np.ndarray, lam: float, rhs: np.ndarray) -> np.ndarray:
    """(T - lam) x = rhs by elimination with row exchanges; rhs has one column per vector."""
    n = len(diag)
    a, b, c = np.zeros(n), np.zeros(n), np.zeros(n)  # the row's entries at i, i + 1, i + 2
    a[:], b[: n - 1] = diag - lam, off
    x = rhs.copy()
    floor = EPS * max(np.abs(diag).max(), np.abs(off).max(initial=0.0))
    for i in range(n - 1):
        under, next_b = off[i], b[i + 1]
        if abs(under) > abs(a[i]):
            factor = a[i] / under
            a[i], b[i], c[i], old_b = under, a[i + 1], next_b, b[i]
            a[i + 1], b[i + 1] = old_b - factor * b[i], -factor * c[i]
            x[[i, i + 1]] = x[[i + 1, i]]
        else:
            factor = under / (a[i] if a[i] else floor)
            a[i + 1] -= factor * b[i]
        x[i + 1] -= factor * x[i]
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            x[i] -= b[i] * x[i + 1]
        if i + 2 < n:
            x[i] -= c[i] * x[i + 2]
        x[i] /= a[i] if abs(a[i]) > floor else floor
    return x


def right_vectors(diagonal: np.ndarray, super_: np.ndarray, sigma: np.ndarray, count: int) -> np.ndarray:
    """Right singular vectors (columns) of the bidiagonal matrix for its ``count`` largest singular values.

    A value set apart from its neighbours gets its vector from one twisted factorisation. Values that agree to ten digits
    have no vectors of their own: their space comes from inverse iteration with a common shift, made orthogonal.
    """
    n = len(diagonal)
    lam = sigma**2
    diag = diagonal**2 + np.concatenate([[0.0], super_**2])
    off = diagonal[:-1] * super_
    top = max(np.abs(diag).max(), np.abs(off).max(initial=0.0))
    out = np.zeros((n, 0))
    random = np.random.Generator(np.random.PCG64(1))
    start = 0
    while start < count:
        end = start + 1
        while end < n and lam[end - 1] - lam[end] <= 1e-10 * lam[end - 1]:
            end += 1
        if end == start + 1 and np.all(diagonal != 0):
            vectors = _twisted(diagonal**2, super_ / diagonal[:-1], lam[start])[:, None]
            residual = np.linalg.norm(diag * vectors[:, 0] + _beside(off, vectors[:, 0]) - lam[start] * vectors[:, 0])
            good = residual <= 1e3 * n * EPS * max(lam[0], np.finfo(float).tiny)
        else:
            good = False
        if not good:
            vectors = random.standard_normal((n, end - start))
            for _ in range(3 if top > 0 else 0):
                vectors = _tridiagonal_solve(diag / top, off / top, lam[start] / top, np.linalg.qr(vectors)[0])
                vectors /= np.abs(vectors).max(axis=0)
                vectors -= out @ (out.T @ vectors)
            vectors -= out @ (out.T @ vectors)
            vectors = np.linalg.qr(vectors)[0]
        # Neighbours that are close, but not equal, lose what they have in common.
        vectors -= out @ (out.T @ vectors)
        out = np.hstack([out, vectors / np.linalg.norm(vectors, axis=0)])
        start = end
    return out[:, :count]


def _beside(off: np.ndarray, z: np.ndarray) -> np.ndarray:
    out = np.zeros_like(z)
    out[:-1] += off * z[1:]
    out[1:] += off * z[:-1]
    return out


# -- distributed part ------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors with per-dimension sums ``sums``; ``components`` (dimension x component) and
    ``eigenvalues`` of their covariance, ``trace`` of it."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n of whole-number rows, from exact numerators."""
        return _numerators(x, self.n, self.sums).astype(float) / max(1, self.n)

    def usable(self) -> np.ndarray:
        """Components that have any variance beyond rounding."""
        least = self.trace * (EPS * max(1, len(self.sums))) ** 2
        return self.eigenvalues > least

    def project(self, x: np.ndarray) -> np.ndarray:
        scale = np.sqrt(np.where(self.usable(), self.eigenvalues, np.nan))
        return self.centred(x) @ self.components / scale


def _numerators(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - S, exactly: in 64 bits where these suffice, else in Python integers."""
    widest = max((abs(int(x.min())), abs(int(x.max()))), default=0) if x.size else 0
    if n * widest + max(map(abs, sums), default=0) < 2**63:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _deviation(numerators: np.ndarray) -> list[int]:
    """Sum of squares per row, exactly: in 64 bits, in two halves of 24 bits whose sums fit, or in Python integers."""
    widest = max(abs(int(numerators.min())), abs(int(numerators.max()))) if numerators.size else 0
    if numerators.dtype != object and numerators.shape[1] * widest**2 < 2**63:
        return (numerators**2).sum(axis=1).tolist()
    if numerators.dtype != object and widest < 2**48 and numerators.shape[1] < 2**14:
        high, low = np.divmod(np.abs(numerators), 1 << 24)
        sums = (part.sum(axis=1).tolist() for part in (high**2, high * low, low**2))
        return [(a << 48) + (b << 25) + c for a, b, c in zip(*sums)]
    return (numerators.astype(object) ** 2).sum(axis=1).tolist()


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimensions)


def whole_numbers(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the rows that have a vector without null or non-finite entries; x is floor(64 c) + 1,000,000."""
    entry = F.transform(F.col(column), lambda c: c.cast("double"))
    # Also without the few finite numbers that have no 64-bit whole form.
    finite = F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST)))
    x = F.transform(entry, lambda c: F.floor(c * F.lit(float(SCALE))).cast("long") + F.lit(SHIFT).cast("long"))
    rows = embeddings.where(F.col(column).isNotNull() & (F.size(column) > 0)).where(finite)
    return rows.select("vec_id", x.alias("x"))


def _factor(rows: DataFrame, centre: Whitening, dimensions: int) -> np.ndarray:
    """R of all centred rows. Each task reduces its blocks to one factor; factors are reduced in groups."""

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, key = np.zeros((0, dimensions)), None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                x = _matrix(batch.column(0).slice(at, BLOCK_ROWS), dimensions)
                key = int(abs(x).sum() % (1 << 31)) if key is None else key
                r = np.linalg.qr(np.vstack([r, centre.centred(x)]), mode="r")
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([r.tobytes()])], ["key", "r"])

    def reduce_factors(table: pa.Table) -> pa.Table:
        r = np.zeros((0, dimensions))
        for part in table.column("r"):
            r = np.linalg.qr(np.vstack([r, np.frombuffer(part.as_py()).reshape(-1, dimensions)]), mode="r")
        return pa.table({"key": [table.column("key")[0].as_py() // FAN_IN], "r": [r.tobytes()]})

    schema = "key long, r binary"
    factors = staged(rows.select("x").mapInArrow(reduce_rows, schema), "factors")
    left = factors.count()
    while left > FAN_IN:
        groups = -(-left // FAN_IN)
        # A factor's own digest deals it to its group, so that a repeated task deals it the same.
        dealt = factors.withColumn("key", F.pmod(F.xxhash64("key", "r"), F.lit(groups)))
        factors = staged(dealt.groupBy("key").applyInArrow(reduce_factors, schema), "factors")
        left = factors.count()
    r = np.zeros((0, dimensions))
    for part in factors.orderBy("key", "r").collect():  # at most FAN_IN factors
        r = np.linalg.qr(np.vstack([r, np.frombuffer(part["r"]).reshape(-1, dimensions)]), mode="r")
    return np.vstack([r, np.zeros((max(0, dimensions - len(r)), dimensions))])


def fit_whitening(fit_list: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the distinct vectors ``fit_list.x`` (all of one length); None without any."""
    indexed = fit_list.select(F.posexplode("x").alias("dimension", "value"))
    sums = (
        indexed.groupBy("dimension")
        .agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total"), F.count(F.lit(1)).alias("n"))
        .orderBy("dimension")
        .collect()  # one row per dimension
    )
    if not sums:
        return None
    n, totals = sums[0]["n"], tuple(int(row["total"]) for row in sums)
    size = len(totals)
    centre = Whitening(n, totals, np.zeros((size, 0)), np.zeros(0), 0.0)
    r = _factor(fit_list, centre, size)
    diagonal, super_, v = bidiagonalise(r)
    sigma = dqds(diagonal, super_)
    count = min(components, size)
    vectors = v @ right_vectors(diagonal, super_, sigma, count)
    eigenvalues = sigma**2 / n
    return Whitening(n, totals, vectors, eigenvalues[:count], float(eigenvalues.sum()))


def identity_error(fit_list: DataFrame, whitening: Whitening) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, measured on all its rows; None
    where no component has any variance."""
    usable = np.flatnonzero(whitening.usable())
    count, size = len(usable), len(whitening.sums)
    if not count:
        return None

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count + 1, count))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                w = whitening.project(_matrix(batch.column(0).slice(at, BLOCK_ROWS), size))[:, usable]
                total[:count] += w.T @ w
                total[count] += w.sum(axis=0)
        entry = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array(entry), pa.array(total.ravel())], ["entry", "value"])

    sums = fit_list.select("x").mapInArrow(products, "entry long, value double").groupBy("entry").agg(F.sum("value"))
    total = np.zeros((count + 1) * count)
    for entry, value in sums.collect():  # one row per pair of components
        total[entry] = value
    total = total.reshape(count + 1, count) / whitening.n
    covariance = total[:count] - np.outer(total[count], total[count])
    return float(np.abs(covariance - np.eye(count)).max())


def whiten(embeddings: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: one row per remaining row of
    ``embeddings`` and component.

    Rows whose vector is null, empty or holds null or non-finite entries are dropped; so are rows of another length than
    the commonest (of equally common ones the longest). The fit list holds each distinct vector of whole numbers once; n
    is its size. ``deviation`` (decimal) is the exact sum over dimensions of (n x - S)^2, ``whitened`` the centred vector
    on the component, divided by its standard deviation. Components beyond the rank of the data have ``whitened`` null.
    Repeated rows and rows without vec_id are returned as they come; other columns are ignored. An empty table gives an
    empty result. A finite entry of 10^17 or more has no 64-bit whole form, so its row is dropped as well.
    """
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    rows = whole_numbers(embeddings, column).withColumn("vec_id", F.col("vec_id").cast("long"))
    lengths = rows.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    commonest = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    if commonest is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    size = commonest["size"]
    rows = rows.where(F.size("x") == size)
    fit_list = staged(rows.select("x").distinct(), "fit-list")
    model = fit_whitening(fit_list, components)
    error = identity_error(fit_list, model)
    explained = model.eigenvalues / model.trace if model.trace > 0 else np.full(len(model.eigenvalues), np.nan)
    count, n = len(model.eigenvalues), model.n

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = _matrix(part.column(1), size)
                deviations = _deviation(_numerators(x, n, model.sums))
                each = np.repeat(np.arange(len(x)), count)
                columns = [
                    part.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), n, np.int64)),
                    pa.array(deviations, pa.decimal128(38, 0)).take(pa.array(each)),
                    pa.array(model.project(x).ravel(), from_pandas=True),
                    pa.array(np.tile(explained, len(x)), from_pandas=True),
                    pa.array([error] * len(each), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [name.split()[0] for name in schema.split(", ")])

    return rows.mapInArrow(project, schema)
