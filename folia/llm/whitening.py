"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

With X the centred vectors (rows) over sqrt(n), the alternating products
u = Xv and v = X'u, each made orthogonal to all earlier vectors of its side,
give X V = U B with a small upper bidiagonal B. The singular values and right
vectors of B give those of X: the deviations and components of the covariance.

The long side stays distributed and is never stored: u_j = X z_j for a short
vector z_j that the driver keeps, so a task rebuilds its rows of U from its
rows of X. One pass over the vectors per step returns X'p, U'p and p'p for the
new direction p, summed by Spark: as many numbers as a vector has entries, three
times over, whatever the number of rows. A second pass follows only when the first
orthogonalisation took away more than half of p. Lost executors lose nothing: all state is in the
written vectors and the short factors on the driver.

Sums and centring are exact: entries are integers, and n * x - S is formed in
64 bits before it becomes a double.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_value, documents, session, written

#: Entries become floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Up to this dimension the bidiagonalisation runs to its end; beyond, until the components have converged.
COMPLETE = 256
#: A step shorter than this share of the longest ends its chain; a deviation below it counts as none.
TINY = 1e-10
by_value(__name__)


def _matrix(column, dim: int) -> np.ndarray:
    """Arrow lists of equal length as an integer matrix."""
    return np.asarray(column.flatten()).reshape(-1, dim)


def _centred(column, dim: int, n: int, sums: np.ndarray) -> np.ndarray:
    return (_matrix(column, dim) * n - sums) / n


def _summed(frame: DataFrame, run, size: int, kind: str) -> np.ndarray:
    """Element-wise sum of the arrays that ``run`` yields for each task."""
    parts = frame.mapInArrow(run, f"v array<{kind}>")
    rows = parts.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()  # size rows
    out = np.zeros(size, np.int64 if kind == "long" else np.float64)
    for r in rows:
        out[r["i"]] = r["x"]
    return out


def _one(v: np.ndarray):
    return pa.RecordBatch.from_arrays([pa.array([v.tolist()], pa.list_(pa.int64() if v.dtype == np.int64 else pa.float64()))], names=["v"])


def _column_sums(dim: int):
    def run(batches):
        s = np.zeros(dim, np.int64)
        for b in batches:
            s += _matrix(b.column(0), dim).sum(axis=0)
        yield _one(s)
    return run


def _products(dim, n, sums, direction, basis):
    """X'p, U'p and p'p for p = X direction and U = X basis, without the 1 / sqrt(n)s."""
    def run(batches):
        out = np.zeros(dim + basis.shape[1] + 1)
        for b in batches:
            x = _centred(b.column(0), dim, n, sums)
            p = x @ direction
            out[:dim] += x.T @ p
            out[dim:-1] += (x @ basis).T @ p
            out[-1] += p @ p
        yield _one(out)
    return run


class Whitening:
    """Components (columns), eigenvalues and trace of the covariance of integer vectors."""

    def __init__(self, n: int, sums: np.ndarray, components: np.ndarray, values: np.ndarray, trace: float):
        self.n, self.sums, self.components, self.values, self.trace = n, sums, components, values, trace


def _off(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """``v`` orthogonal to ``basis``; twice is enough."""
    if basis:
        q = np.array(basis)
        for _ in range(2):
            v = v - q.T @ (q @ v)
    return v


def bidiagonalise(x: DataFrame, n: int, sums: np.ndarray, wanted: int = COMPONENTS, seed: int = 1):
    """(V, B) of the written vectors ``x`` (one column, equal lengths): columns
    of V orthonormal, B upper bidiagonal with X V = U B."""
    dim = len(sums)
    rng = np.random.default_rng(seed)
    limit = dim if dim <= COMPLETE else min(dim, n)
    vs: list[np.ndarray] = []          # short side
    zs = np.zeros((dim, 0))            # u_j = X z_j
    xtu = np.zeros((dim, 0))           # X'u_j
    alphas, betas = [], []             # diagonal and superdiagonal of B
    top = 0.0

    def fresh():
        v = _off(rng.standard_normal(dim), vs)
        return v / np.linalg.norm(v)

    v, beta = fresh(), 0.0
    while True:
        step = v - (beta * zs[:, -1] if beta else 0.0)
        for again in (False, True):
            s = _summed(x, _products(dim, n, sums, step, zs), dim + zs.shape[1] + 1, "double") / n
            xtp, h, pp = s[:dim], s[dim:-1], s[-1]
            step, xtp, left = step - zs @ h, xtp - xtu @ h, pp - h @ h
            # what remains is known well enough unless most of p has gone
            if again or left > 0.5 * pp or left <= 0 or pp <= (TINY * top) ** 2:
                break
        alpha = float(np.sqrt(max(left, 0.0)))
        top = max(top, alpha)
        vs.append(v)
        alive = alpha > TINY * top
        alphas.append(alpha if alive else 0.0)
        betas.append(beta)
        zs = np.column_stack([zs, step / alpha if alive else np.zeros(dim)])
        xtu = np.column_stack([xtu, xtp / alpha if alive else np.zeros(dim)])
        if len(vs) == limit or top == 0.0:
            break
        r = _off(xtu[:, -1] - alphas[-1] * v, vs)
        beta = float(np.linalg.norm(r))
        if dim > COMPLETE and len(vs) >= 2 * wanted and _converged(alphas, betas, beta, wanted):
            break
        if beta > TINY * top:
            v = r / beta
        else:  # the chain has found an invariant part: go on outside of it
            v, beta = fresh(), 0.0
    return np.column_stack(vs), np.diag(alphas) + np.diag(betas[1:], 1)


def _converged(alphas, betas, beta, wanted) -> bool:
    left, values, _ = np.linalg.svd(np.diag(alphas) + np.diag(betas[1:], 1))
    return bool(np.all(beta * np.abs(left[-1, :wanted]) <= 1e-13 * values[0]))


def fit(x: DataFrame, n: int, dim: int, wanted: int = COMPONENTS) -> Whitening:
    """Components of the written integer vectors ``x`` (one column)."""
    sums = _summed(x, _column_sums(dim), dim, "long")
    trace = float(_summed(x, _squares(dim, n, sums), 1, "double")[0]) / n
    if not trace:
        return Whitening(n, sums, np.zeros((dim, 0)), np.zeros(0), 0.0)
    v, b = bidiagonalise(x, n, sums, wanted)
    _, deviations, right = np.linalg.svd(b)
    known = deviations[:wanted] > 1e-7 * deviations[0]
    components = (v @ right.T)[:, :wanted][:, known]
    # one sign for all rows: the largest entry is positive
    components = components * np.sign(components[np.abs(components).argmax(axis=0), np.arange(components.shape[1])])
    return Whitening(n, sums, components, deviations[:wanted][known] ** 2, trace)


def _squares(dim, n, sums):
    def run(batches):
        yield _one(np.array([sum(float((_centred(b.column(0), dim, n, sums) ** 2).sum()) for b in batches)]))
    return run


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2, exact; null beyond 64 bits."""
    d = x * n - sums
    if not d.size or float(np.abs(d).max()) ** 2 * d.shape[1] < 2.0**62:
        return (d * d).sum(axis=1).tolist()
    exact = [sum(int(a) * int(a) for a in row) for row in d]
    return [v if v < 1 << 63 else None for v in exact]


def _projection(w: Whitening):
    return w.components / np.sqrt(w.values)


def _second_moment(w: Whitening, mean: np.ndarray | None):
    """Sums of the whitened rows; with their mean, of the products of the centred ones."""
    dim, to = len(w.sums), _projection(w)

    def run(batches):
        k = to.shape[1]
        out = np.zeros(k if mean is None else k * k)
        for b in batches:
            y = _centred(b.column(0), dim, w.n, w.sums) @ to
            out += y.sum(axis=0) if mean is None else ((y - mean).T @ (y - mean)).ravel()
        yield _one(out)
    return run


def identity_error(x: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k = w.components.shape[1]
    if not k:
        return 0.0
    mean = _summed(x, _second_moment(w, None), k, "double") / w.n
    cov = _summed(x, _second_moment(w, mean), k * k, "double").reshape(k, k) / w.n
    return float(np.abs(cov - np.eye(k)).max())


def _whitened(w: Whitening, error: float):
    dim, to, k = len(w.sums), _projection(w), w.components.shape[1]
    share = w.values / w.trace

    def run(batches):
        for b in batches:
            y = _centred(b.column(1), dim, w.n, w.sums) @ to
            m = b.num_rows
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.n, np.int64)),
                 pa.array(_deviation(_matrix(b.column(1), dim), w.n, w.sums), pa.int64()).take(each), pa.array(y.ravel()),
                 pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def integers(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int, int]:
    """(vec_id, x), written, with the number of its rows and their dimension."""
    v = vectors.select(F.col(id_col).alias("vec_id"), F.transform(F.col(vector_col), lambda c: c.cast("double")).alias("v"))
    sound = v.where((F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    x = written(sound.select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE) + OFFSET).alias("x")))
    lengths = x.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if lengths is None:
        return x, 0, 0
    return x.where(F.size("x") == lengths["dim"]), lengths["count"], lengths["dim"]


def whiten(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component, components by falling
    eigenvalue: (vec_id, component, n, deviation, whitened, explained, identity_error).

    Vectors that are null or empty, or hold null or non-finite entries, are
    left out; so are those whose length isn't the most frequent one (the
    longer of equally frequent ones). Repeated rows and ids count and return
    each time; a null id stays null. Components with no variance to speak of
    (a deviation below 1e-7 of the largest) are left out, so equal vectors, a
    single one or none give no rows. Equal eigenvalues are numbered as found,
    the same for all rows. A deviation beyond 64 bits is null. An entry whose
    64-fold doesn't fit 64 bits is an error. Other columns are not read.
    """
    spark = vectors.sparkSession
    x, n, dim = integers(vectors, id_col, vector_col)
    kind = x.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not n:
        return spark.createDataFrame([], schema)
    w = fit(x.select("x"), n, dim, components)
    if not len(w.values):
        return spark.createDataFrame([], schema)
    return x.mapInArrow(_whitened(w, identity_error(x.select("x"), w)), schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector of ``embeddings`` on the first 32 components."""
    return whiten(documents(spark, sf_dir, "embeddings"))
