"""Embedding whitening by spectrum slicing.

Spark gathers the covariance; what is left is a matrix of the vectors'
dimension, whatever the number of rows:

1. ``integers``: rows whose vector is null or holds null or non-finite entries
   go; an entry c becomes floor(256 c). The distinct vectors are the fit list,
   written once.
2. Sums per dimension are exact (decimals). A second pass centres every vector
   and adds up products of the upper triangle; each task gives one row an
   entry, Spark adds the tasks' rows.
3. ``leading`` finds the leading eigenvalues on the driver. The inertia of
   V - t I, read off the signs of the pivots of its LDLᵀ factorisation (blocks
   of one and two, Bunch and Kaufman's choice), is the number of eigenvalues
   above t. Bisection on that count isolates the k-th eigenvalue; Rayleigh
   quotient iteration then converges to its vector, cubically; counts on both
   sides of the result certify that it is the k-th. A quotient that leaves the
   slice or fails the certificate goes back to bisection. Eigenvalues closer
   than the arithmetic can part are one slice: their vectors are made orthogonal.
4. A last pass projects each row; one more over the fit list measures
   ``identity_error``, the covariance of what was whitened, itself.

Defined results: repeated rows are each returned, and count once in the fit;
vectors of another length than the table's most frequent one (of equally
frequent ones the longer) go like null ones; an empty vector too. Components
whose eigenvalue is not above the rounding error of the trace (a constant
dimension, fewer distinct vectors than components, a single vector) have no
whitened value and no row; an empty table gives no rows. Entries beyond the
range of a long become its ends. A deviation beyond the range of a long is null. Extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, stage_table

SCALE = 256
COMPONENTS = 4
_ALPHA = (1 + 17 ** 0.5) / 8


def integers(frame: DataFrame, row_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x): usable vectors as array<bigint>."""
    v = F.col(f"`{vector}`").cast("array<double>")
    low, high = F.lit(-float(1 << 63)), F.lit(float(1 << 63))
    usable = frame.select(F.col(f"`{row_id}`").alias("vec_id"), v.alias("v")).filter(
        F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda c: F.coalesce(c.isNotNull() & ~F.isnan(c) & (
            F.abs(c) < F.lit(float("inf"))), F.lit(False))))

    def whole(c):
        t = F.lit(float(SCALE)) * c
        return F.when(t >= high, F.lit((1 << 63) - 1)).when(t <= low, F.lit(-(1 << 63))).otherwise(F.floor(t)).cast("bigint")
    return usable.select("vec_id", F.transform("v", whole).alias("x"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0), np.int64)


def sums(fit: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """Number of vectors and their exact sums per dimension."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                x = _matrix(f["x"])
                high = x >> 32                    # both halves of a batch's sums fit a long
                yield pd.DataFrame({"i": np.arange(dimension), "n": np.full(dimension, len(x)), "high": high.sum(axis=0),
                                    "low": (x - (high << 32)).sum(axis=0)})
    parts = fit.select("x").mapInPandas(run, "i int, n bigint, high bigint, low bigint")
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"),
                                  F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).collect()       # one a dimension
    total = {r.i: (int(r.high) << 32) + int(r.low) for r in rows}
    return (rows[0].n if rows else 0), [total.get(i, 0) for i in range(dimension)]


def products(fit: DataFrame, centre: np.ndarray, onto: np.ndarray | None = None) -> np.ndarray:
    """Sum over the fit list of y yᵀ, y being the centred vector (times ``onto``)."""
    size = len(centre) if onto is None else onto.shape[1]
    upper = np.triu_indices(size)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size))
        for f in frames:
            if len(f):
                y = _matrix(f["x"]) - centre
                y = y if onto is None else y @ onto
                total += y.T @ y
        yield pd.DataFrame({"i": upper[0], "j": upper[1], "s": total[upper]})
    # the tasks' rows are added by Spark; one row for each entry of the matrix comes back
    parts = fit.select("x").mapInPandas(run, "i int, j int, s double")
    out = np.zeros((size, size))
    for r in parts.groupBy("i", "j").agg(F.sum("s").alias("s")).toLocalIterator():
        out[r.i, r.j] = out[r.j, r.i] = r.s
    return out


def inertia(a: np.ndarray) -> tuple[int, int, int]:
    """(positive, zero, negative) eigenvalues of a symmetric matrix by the
    signs of the pivots of LDLᵀ with symmetric exchanges."""
    a = a.copy()
    n, at = len(a), 0
    positive = zero = 0

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
    while at < n:
        below = np.abs(a[at + 1:, at])
        r = at + 1 + int(below.argmax()) if len(below) else at
        most = abs(a[r, at]) if r != at else 0.0
        one = abs(a[at, at])
        two = False
        if max(one, most) == 0.0:
            zero, at = zero + 1, at + 1
            continue
        if one < _ALPHA * most:
            beside = np.abs(a[at:, r])
            beside[r - at] = 0.0
            widest = beside.max()
            if one * widest >= _ALPHA * most * most:
                pass
            elif abs(a[r, r]) >= _ALPHA * widest:
                swap(at, r)
            else:
                swap(at + 1, r)
                two = True
        if two:
            p, q, s = a[at, at], a[at + 1, at], a[at + 1, at + 1]
            det = p * s - q * q                   # negative by the choice of pivots: one of each sign
            positive += 1 if det < 0 else 2 if p + s > 0 else 0
            c = a[at + 2:, at:at + 2]
            a[at + 2:, at + 2:] -= c @ np.array([[s, -q], [-q, p]]) @ c.T / det
            at += 2
        else:
            d = a[at, at]
            positive += d > 0
            c = a[at + 1:, at]
            a[at + 1:, at + 1:] -= np.outer(c, c) / d
            at += 1
    return int(positive), zero, n - int(positive) - zero


def above(v: np.ndarray, t: float) -> int:
    """How many eigenvalues of ``v`` exceed ``t`` (those that equal it, as far
    as the pivots tell, not counted)."""
    return inertia(v - t * np.eye(len(v)))[0]


def leading(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues that exceed rounding, falling, and unit
    eigenvectors as columns."""
    n = len(v)
    size = float(np.abs(v).sum(axis=1).max()) if n else 0.0          # Gershgorin: no eigenvalue is beyond it
    tiny = n * np.finfo(float).eps * size
    values: list[float] = []
    vectors = np.zeros((n, 0))
    rng = np.random.default_rng(11)
    while len(values) < min(k, n) and size > 0:
        number = len(values) + 1
        low, high = 4 * tiny, size * (1 + 1e-12) + tiny               # above(high) < number <= above(low)
        if above(v, low) < number:
            break
        x, found = None, None
        while found is None:
            # slice until the eigenvalue is alone, or can't be parted from its neighbour
            while high - low > tiny:
                alone = above(v, low) == number and above(v, high) == number - 1
                if alone and high - low < 0.25 * low:
                    break
                middle = (low + high) / 2
                low, high = (middle, high) if above(v, middle) >= number else (low, middle)
            # Rayleigh quotient iteration from the slice's middle, kept orthogonal to the vectors before
            mu, x = (low + high) / 2, rng.standard_normal(n)
            for step in range(60):
                x -= vectors @ (vectors.T @ x)
                x /= np.linalg.norm(x)
                if step:
                    mu = float(x @ v @ x)
                    if not low - tiny <= mu <= high + tiny:           # left the slice
                        break
                    if np.linalg.norm(v @ x - mu * x) <= 8 * tiny:
                        break
                try:
                    x = np.linalg.solve(v - mu * np.eye(n), x)
                except np.linalg.LinAlgError:                         # the shift is an eigenvalue to the last bit
                    x = np.linalg.solve(v - (mu + tiny) * np.eye(n), x)
            x -= vectors @ (vectors.T @ x)
            x /= np.linalg.norm(x)
            mu = float(x @ v @ x)
            margin = 32 * tiny
            # certificate: at least ``number`` eigenvalues from just below, fewer than that from just above
            if above(v, mu - margin) >= number > above(v, mu + margin) and np.linalg.norm(v @ x - mu * x) <= margin:
                found = mu
            elif high - low <= tiny:
                found = mu                                            # a slice as narrow as rounding: its vector is its own proof
            else:
                middle = (low + high) / 2
                low, high = (middle, high) if above(v, middle) >= number else (low, middle)
        values.append(found)
        vectors = np.column_stack([vectors, x])
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], vectors[:, order]


def whiten(frame: DataFrame, components: int = COMPONENTS, row_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error."""
    schema = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double")
    rows = stage_table(integers(frame, row_id, vector), "whitening-rows")
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return frame.sparkSession.createDataFrame([], schema)
    dimension = lengths[0].d
    rows = rows.filter(F.size("x") == dimension)
    fit = stage_table(rows.select("x").distinct(), "whitening-fit")
    n, total = sums(fit, dimension)
    centre = np.array([t / n for t in total])
    covariance = products(fit, centre) / n
    values, vectors = leading(covariance, components)
    if not len(values):
        return frame.sparkSession.createDataFrame([], schema)
    onto = vectors / np.sqrt(values)
    explained = values / np.trace(covariance)
    error = float(np.abs(products(fit, centre, onto) / n - np.eye(len(values))).max())
    k = len(values)
    exact = np.array(total, dtype=object)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not len(f):
                continue
            x = _matrix(f["x"])
            white = (x - centre) @ onto
            # n x - S and its squares in longs where they surely fit, else in Python's integers
            reach = n * float(np.abs(x).max(initial=0)) + max(abs(t) for t in total)
            if dimension * reach * reach < 2.0 ** 62:
                y = n * x - exact.astype(np.int64)
                deviation = pd.array((y * y).sum(axis=1), dtype="Int64")
            else:
                big = [sum((n * int(c) - t) ** 2 for c, t in zip(row, total)) for row in x]
                deviation = pd.array([b if b < 1 << 63 else None for b in big], dtype="Int64")
            yield pd.DataFrame({
                "vec_id": f["vec_id"].repeat(k).to_numpy(), "component": np.tile(np.arange(1, k + 1), len(f)),
                "n": n, "deviation": deviation.repeat(k), "whitened": white.ravel(),
                "explained": np.tile(explained, len(f)), "identity_error": error})
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "x").mapInPandas(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op11: every usable embedding on the four leading components."""
    return whiten(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
