"""Embedding whitening by FEAST contour integration.

The covariance of a table of vectors is summed where the rows lie (one d x d matrix for each
task, added up in a shuffle); only that matrix, whose size does not depend on the rows, comes to
the driver.  Its leading eigenpairs are found interval by interval:

1. ``inertia``: the signs of the pivots of V - s I, factored symmetrically, count the eigenvalues
   above s.  Counts bisect the spectrum into intervals of a few eigenvalues each.
2. ``feast``: for each interval, as a task of its own, a Gauss-Legendre quadrature around the circle
   over the interval of solutions of (z I - V) Y = X, with complex shifts z, projects X onto the
   interval's eigenvectors; Rayleigh-Ritz in that space gives the next X, until residuals are at
   rounding.
3. A last Rayleigh-Ritz over all intervals' vectors parts what lies on both sides of a boundary, and
   the number of pairs must be the inertia count: none is missed, or the search is done anew with
   more columns.

Each entry c becomes the long x = floor(64 c) + 1000000; sums of x are exact.

Defined results: a row whose vector is null, or holds null, NaN, infinite entries or entries of
2**40 or more in size (their x has no place in the sums), is dropped; so is a row whose number of
entries is not that of most rows (the longer of two equally frequent).  Repeated rows count each
time; null vec_id stays null.  Components whose eigenvalue is zero to rounding have no rows, so
equal vectors give none.  An empty table has no rows.  ``deviation`` is exact; where it passes 64
bits the query's long is null.  Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Entries from here on count as not finite.
LARGEST = float(1 << 40)
#: Eigenvalues sought in one interval, quadrature nodes on the upper half circle, rounds of a search.
PER_INTERVAL, NODES, ROUNDS = 8, 8, 12
#: Eigenvalues below this share of the matrix's norm count as zero.
ZERO = 1e-11
#: Rows whose vectors are held as one matrix.
BLOCK = 4096


def vectors(rows: DataFrame, column: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, v: array of double) of the rows that stay, and their number of entries."""
    v = rows[column].cast("array<double>")
    good = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)))
    kept = rows.select(rows["vec_id"].cast("long").alias("vec_id"), v.alias("v")).where(good)
    most = kept.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = most["d"] if most else 0
    return kept.where(F.size("v") == d), d


def _blocks(batches, d: int):
    """vec_id column and the matrix of x (as exact integers) of some rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            own = batch.slice(at, BLOCK)
            c = own.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            yield own.column("vec_id"), np.floor(SCALE * c).astype(np.int64) + SHIFT


def _added(rows: DataFrame, per_task, d: int) -> np.ndarray | None:
    """The sum over tasks of the matrices that ``per_task`` makes of its blocks, one row of each
    at a time, added in a shuffle; at most d rows reach the driver."""

    def part(batches):
        total = None
        for _, x in _blocks(batches, d):
            m = per_task(x)
            total = m if total is None else total + m
        if total is not None:
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(len(total)), pa.int32()),
                                              "m": pa.array(list(total), pa.list_(pa.float64()))})

    summed = (rows.mapInArrow(part, "i int, m array<double>").select("i", F.posexplode("m").alias("j", "s"))
              .groupBy("i", "j").agg(F.sum("s").alias("s")))
    got = summed.toArrow()
    if not got.num_rows:
        return None
    i, j = got.column("i").to_numpy(), got.column("j").to_numpy()
    out = np.zeros((i.max() + 1, j.max() + 1))
    out[i, j] = got.column("s").to_numpy()
    return out


def sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of x in each dimension."""

    def part(batches):
        n, total = 0, np.zeros(d, object)
        for _, x in _blocks(batches, d):
            n += len(x)
            total += x.sum(axis=0).astype(object)
        if n:
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(d + 1), pa.int32()), "s": pa.array([*map(str, total), str(n)])})

    got = rows.mapInArrow(part, "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    by = {r["i"]: int(r["s"]) for r in got}
    return by.get(d, 0), [by.get(k, 0) for k in range(d)]


def centred(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """x - S/n, the whole part taken off as an integer."""
    whole = np.array([a // n for a in s], np.int64)
    return (x - whole) - np.array([(a % n) / n for a in s])


def covariance(rows: DataFrame, n: int, s: list[int]) -> np.ndarray:
    total = _added(rows, lambda x: (y := centred(x, n, s)).T @ y, len(s))
    return (total + total.T) / (2 * n)


def inertia(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric v lie above the shift: the positive pivots of a
    symmetric factorisation of v - shift I with pivots of one or two rows."""
    a = v - shift * np.eye(len(v))
    small = np.abs(v).max(initial=0.0) * np.finfo(float).eps * len(v) + np.finfo(float).tiny
    alpha = (1 + np.sqrt(17)) / 8
    above = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        off = np.abs(a - np.diag(np.diag(a)))
        p = int(diagonal.argmax())
        largest = off.max(initial=0.0)
        if diagonal[p] >= alpha * largest:
            if diagonal[p] <= small:
                return above  # what is left is zero: at the shift, not above it
            above += int(a[p, p] > 0)
            keep = np.delete(np.arange(len(a)), p)
            w = a[keep, p]
            a = a[np.ix_(keep, keep)] - np.outer(w, w / a[p, p])
        else:  # a pivot of two rows with a dominant off-diagonal entry has one eigenvalue of each sign
            r, q = np.unravel_index(int(off.argmax()), off.shape)
            pair = [r, q]
            above += 1
            keep = np.delete(np.arange(len(a)), pair)
            w = a[np.ix_(keep, pair)]
            a = a[np.ix_(keep, keep)] - w @ np.linalg.solve(a[np.ix_(pair, pair)], w.T)
        a = (a + a.T) / 2
    return above


def intervals(v: np.ndarray, wanted: int, most: int = PER_INTERVAL) -> tuple[list[tuple[float, float, int]], int]:
    """(low, high, count) from the top down, of at most ``most`` eigenvalues each unless they are
    equal to rounding, and how many eigenvalues they hold: the ``wanted`` largest at least."""
    top = float(np.abs(v).sum(axis=1).max(initial=0.0) * (1 + 1e-6) + np.finfo(float).tiny)
    fine = 1e-13 * top
    floor = float(-fine * len(v))
    parts, above, todo = [], 0, [(floor, top, inertia(v, floor))]
    while todo and above < wanted:
        low, high, count = todo.pop()  # the highest part is always last
        if not count:
            continue
        if count <= most or high - low <= fine:
            parts.append((low, high, count))
            above += count
            continue
        middle = (low + high) / 2
        upper = inertia(v, middle) - above
        todo += [(low, middle, count - upper), (middle, high, upper)]
    return parts, above


def filtered(v: np.ndarray, low: float, high: float, x: np.ndarray) -> np.ndarray:
    """The quadrature of the resolvent around [low, high], applied to the columns of x."""
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    middle, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(x)
    eye = np.eye(len(v))
    for t, w in zip(nodes, weights):
        turn = np.exp(1j * np.pi * (t + 1) / 2)  # the upper half; the lower one is its conjugate
        out += (w / 2) * (radius * turn * np.linalg.solve((middle + radius * turn) * eye - v, x)).real
    return out


def feast(v: np.ndarray, low: float, high: float, count: int, extra: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues in (low, high] and their vectors (columns); too few if some were missed."""
    scale = np.abs(v).sum(axis=1).max(initial=0.0)
    pad = max((high - low) * 0.05, 1e-9 * scale)
    size = min(len(v), count + max(6, count // 2) + extra)
    x = np.random.default_rng(len(v) * 31 + count).standard_normal((len(v), size))
    last = np.inf
    for _ in range(ROUNDS):
        q, _ = np.linalg.qr(filtered(v, low - pad, high + pad, x))
        e, u = np.linalg.eigh(q.T @ v @ q)
        x = q @ u
        inside = (e > low - pad / 2) & (e <= high + pad / 2)
        residual = np.abs(v @ x[:, inside] - x[:, inside] * e[inside]).max(initial=0.0)
        if inside.sum() >= count and (residual <= 4e-15 * scale or residual >= last / 2):
            break
        last = residual if inside.sum() >= count else np.inf
    return e[inside], x[:, inside]


def components(spark: SparkSession, v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of v that are not zero to rounding, falling, and their
    unit vectors as columns; the intervals are searched as tasks."""
    d = len(v)
    scale = np.abs(v).sum(axis=1).max(initial=0.0)
    rounding = scale * np.finfo(float).eps * d
    wanted = min(wanted, d, inertia(v, ZERO * scale))
    if not wanted:
        return np.zeros(0), np.zeros((d, 0))
    parts, _ = intervals(v, wanted)
    sent = spark.sparkContext.broadcast(v)
    for extra in (0, 8, d):

        def search(batches, extra=extra):
            for batch in batches:
                for low, high, count in zip(*(batch.column(c).to_pylist() for c in ("low", "high", "count"))):
                    e, x = feast(sent.value, low, high, count, extra)
                    yield pa.RecordBatch.from_pydict({"e": pa.array(e, pa.float64()), "x": pa.array(list(x.T), pa.list_(pa.float64()))})

        rows = (spark.createDataFrame(parts, "low double, high double, count int").repartition(len(parts))
                .mapInArrow(search, "e double, x array<double>").collect())
        if not rows:
            continue
        basis, size, _ = np.linalg.svd(np.array([row["x"] for row in rows]).T, full_matrices=False)
        basis = basis[:, size > 1e-3]  # a vector found from both sides of a boundary is there once
        e, u = np.linalg.eigh(basis.T @ v @ basis)
        e, x = e[::-1], (basis @ u)[:, ::-1]
        if len(e) < wanted:
            continue
        e, x = e[:wanted], x[:, :wanted]
        bad = np.abs(v @ x - x * e).max(initial=0.0) > 64 * rounding
        # none missed: as many eigenvalues as found lie above just below the last one
        if not bad and inertia(v, e[-1] + 64 * rounding) <= wanted <= inertia(v, e[-1] - 64 * rounding):
            sent.destroy()
            return e, x
    raise ArithmeticError("the intervals do not hold the counted eigenvalues")


def _identity_error(rows: DataFrame, n: int, s: list[int], project: np.ndarray) -> float:
    k = project.shape[1]

    def moments(x):
        w = centred(x, n, s) @ project
        return np.vstack((w.T @ w, w.sum(axis=0)))

    m = _added(rows, moments, len(s))
    mean = m[k] / n
    return float(np.abs(m[:k] / n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def deviations(x: np.ndarray, n: int, s: list[int]) -> list[int]:
    """The sum over dimensions of (n x - S)^2 of each row, exact."""
    s = np.array(s, object)
    # as Python integers only where 64 bits might not do
    span = max(abs(n * int(x.max(initial=0)) - int(s.min())), abs(n * int(x.min(initial=0)) - int(s.max())))
    if span * span * len(s) < 1 << 63:
        y = n * x - s.astype(np.int64)
        return (y * y).sum(axis=1).tolist()
    y = n * x.astype(object) - s
    return (y * y).sum(axis=1).tolist()


def whiten(rows: DataFrame, column: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """One row for each row that stays and component: vec_id, component, n, deviation
    (decimal), whitened, explained, identity_error."""
    spark = rows.sparkSession
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    kept, d = vectors(rows, column)
    n, s = sums(kept, d) if d else (0, [])
    if not n:
        return spark.createDataFrame([], schema)
    v = covariance(kept, n, s)
    e, x = components(spark, v, wanted)
    k = len(e)
    if not k:
        return spark.createDataFrame([], schema)
    project, explained = x / np.sqrt(e), e / np.trace(v)
    error = _identity_error(kept, n, s, project)

    def out(batches):
        for ids, m in _blocks(batches, d):
            white = centred(m, n, s) @ project
            repeated = pa.array(np.repeat(np.arange(len(m)), k))
            yield pa.RecordBatch.from_pydict({
                "vec_id": ids.take(repeated),
                "component": pa.array(np.tile(np.arange(1, k + 1), len(m)), pa.int32()),
                "n": pa.array(np.full(len(m) * k, n), pa.int64()),
                "deviation": pa.array([str(x) for x in deviations(m, n, s)], pa.string()).take(repeated),
                "whitened": pa.array(white.ravel()),
                "explained": pa.array(np.tile(explained, len(m))),
                "identity_error": pa.array(np.full(len(m) * k, error))})

    text = schema.replace("decimal(38,0)", "string")
    return kept.mapInArrow(out, text).withColumn("deviation", F.col("deviation").try_cast("decimal(38,0)"))
