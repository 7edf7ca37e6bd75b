"""Whitening of embeddings: principal components by mixed-precision refinement.

Entries c become whole numbers x = floor(1024 * c) + 100000. Tasks add up the sums of each dimension, then, about the
mean, a d x d matrix of products each; only these sums come to the driver, which solves a d x d problem. Eigenvectors
start in single precision; Ogita and Aishima's iteration refines all of them at once by matrix products in extended
precision: from R = I - X'X and S = X'VX follow approximate eigenvalues and a correction X := X + XE that converges
quadratically where eigenvalues are apart. Eigenvalues too near to each other for the error at hand are a cluster:
inside one the iteration only restores orthogonality, and a sub-solve of X_c'VX_c, shifted by the cluster's mean so that
its small differences keep their digits, turns its vectors before the next step.

Defined results: rows whose vector is null, or has null or non-finite entries, or entries whose x isn't exact in a
double (beyond 2**53), are left out, and so are vectors of another length than the most frequent one (of equally
frequent ones the shortest); repeated rows count each time; components whose variance is within rounding of zero have
no whitened form and are left out, so constant columns do no harm; a table without usable rows gives an empty result;
vec_id may be null; only vec_id and the vector are read. A deviation that doesn't fit a long is an error, never wrong.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.llm.common import small_batches, table

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Refinement ends when a step changes no entry by more than this, or after so many steps.
SETTLED, STEPS = 1e-17, 12
OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def vectors(batch: pa.RecordBatch, d: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of the batch that are usable, their x as whole numbers)."""
    column = batch["v"]
    values = column.flatten().cast(pa.float64())
    size = np.diff(column.offsets.to_numpy())
    row = np.repeat(np.arange(len(size)), size)
    c = values.to_numpy(zero_copy_only=False)  # nulls are NaN
    bad = np.zeros(len(size), bool)
    bad[row[~(np.abs(c) < 2.0**43 - SHIFT)]] = True
    keep = (size == d) & ~bad & ~column.is_null().to_numpy(zero_copy_only=False)
    return np.flatnonzero(keep), (np.floor(SCALE * c[keep[row]]) + SHIFT).astype(np.int64).reshape(-1, d)


def summed(rows: DataFrame, f, kind: str) -> list:
    """The sums over all tasks of the arrays that f gives for batches: one row a place, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            own = f(batch)
            total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "s"])

    return [r["s"] for r in rows.mapInArrow(run, f"at long, s {kind}").groupBy("at").agg(F.sum("s").alias("s")).orderBy("at").collect()]


def covariance(rows: DataFrame, d: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, exact sums of x, V)."""

    def sums(batch: pa.RecordBatch) -> np.ndarray:
        x = vectors(batch, d)[1]
        return np.append(x.sum(0), len(x))

    found = summed(rows, sums, "long")
    n = int(found[-1]) if found else 0
    if not n:
        return 0, np.zeros(d, np.int64), np.zeros((d, d))
    s = np.array(found[:-1], np.int64)
    mean = s / n

    def products(batch: pa.RecordBatch) -> np.ndarray:
        z = vectors(batch, d)[1] - mean
        return (z.T @ z).reshape(-1)

    v = np.array(summed(rows, products, "double")).reshape(d, d) / n
    return n, s, (v + v.T) / 2


def clusters_of(e: np.ndarray, apart: float) -> list[tuple[int, int]]:
    """Ranges of falling eigenvalues in which neighbours are no further than ``apart``."""
    cut = np.flatnonzero(np.abs(np.diff(e)) > apart) + 1
    return list(zip([0, *cut.tolist()], [*cut.tolist(), len(e)]))


def step(v: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(corrected vectors, eigenvalues, correction, distance under which eigenvalues are one cluster) of one iteration."""
    r = np.eye(len(v), dtype=v.dtype) - x.T @ x
    s = x.T @ (v @ x)
    s = (s + s.T) / 2  # a rounding error on one side only, over a small gap, would spoil orthogonality
    e = np.diag(s) / (1 - np.diag(r))
    norm = lambda m: float(np.sqrt((m * m).sum()))
    apart = 2 * (norm(s - np.diag(e)) + norm(v) * norm(r))
    gap = e[None, :] - e[:, None]
    far = np.abs(gap) > apart
    change = np.where(far, (s + e[None, :] * r) / np.where(far, gap, 1), r / 2)
    return x + x @ change, e, change, apart


def eigen(v: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors (columns) of a symmetric matrix, to double precision."""
    d = len(v)
    size = np.abs(v).max(initial=0.0)
    if size == 0:
        return np.zeros(d), np.eye(d)
    a = (v / size).astype(np.longdouble)
    x = np.linalg.eigh((v / size).astype(np.float32))[1][:, ::-1].astype(np.longdouble)
    e = np.diag(x.T @ a @ x)
    for _ in range(steps):
        x, e, change, apart = step(a, x)
        order = np.argsort(-e, kind="stable")
        x, e = x[:, order], e[order]
        solved = False
        for i, j in clusters_of(e, apart):
            if j - i > 1:
                own = x[:, i:j]
                mean = e[i:j].mean()
                inner = own.T @ (a @ own - mean * own)
                turn = np.linalg.eigh(((inner + inner.T) / 2 / max(np.abs(inner).max(), np.finfo(float).tiny)).astype(float))[1][:, ::-1]
                solved |= bool(np.abs(np.abs(turn) - np.eye(j - i)).max() > 1e-12)
                x[:, i:j] = own @ turn.astype(np.longdouble)
        if not solved and np.abs(change).max() <= SETTLED:
            break
    x = x / np.sqrt((x * x).sum(0))
    e = (x * (a @ x)).sum(0)
    order = np.argsort(-e, kind="stable")
    return (e[order] * size).astype(float), x[:, order].astype(float)


def whiten(embeddings: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """The id, component, n, deviation, whitened, explained and identity_error of every usable row and component."""
    rows = embeddings.select(F.col(id_column).alias("id"), F.col(vector).alias("v"))
    most = rows.where("size(v) > 0").groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    kind = rows.schema["id"].dataType.simpleString()
    empty = rows.sparkSession.createDataFrame([], f"{id_column} {kind}, {OUT}")
    if most is None:
        return empty
    d = most["d"]
    n, s, v = covariance(rows.select("v"), d)
    if not n:
        return empty
    e, x = eigen(v)
    k = int((e[:components] > max(e[0], 0) * d * 1e-12).sum())
    if not k:
        return empty
    mean, turn, share = s / n, x[:, :k] / np.sqrt(e[:k]), e[:k] / np.trace(v)

    def products(batch: pa.RecordBatch) -> np.ndarray:
        w = (vectors(batch, d)[1] - mean) @ turn
        return (w.T @ w).reshape(-1)

    error = float(np.abs(np.array(summed(rows.select("v"), products, "double")).reshape(k, k) / n - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, own = vectors(batch, d)
            if not len(keep):
                continue
            if n * float(np.abs(own - mean).max()) < (2.0**62 / d) ** 0.5:
                deviation = ((n * own - s) ** 2).sum(1)
            else:  # Python's whole numbers; too large for a long is an error
                deviation = np.array([sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in own], object)
            w = (own - mean) @ turn
            repeat = pa.array(np.repeat(keep, k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"].take(repeat), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(keep))), pa.array(np.full(len(keep) * k, n)), pa.array(np.repeat(deviation, k), pa.int64()),
                    pa.array(w.reshape(-1)), pa.array(np.tile(share, len(keep))), pa.array(np.full(len(keep) * k, error)),
                ], [id_column, *(c.split()[0] for c in OUT.split(", "))],
            )

    return rows.mapInArrow(run, f"{id_column} {kind}, {OUT}")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(small_batches(spark), sf_dir, "embeddings"))
