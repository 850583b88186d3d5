"""Whitening of embeddings by an incremental eigendecomposition of their covariance.

A task carries the spectrum of the centred scatter it has seen. A further vector changes the scatter
by one centred rank-one term; the new eigenvalues are the roots of the secular equation and the new
eigenvectors follow from them, after eigenpairs that the term does not touch were set aside
(deflation). The spectra of tasks are combined in groups, and groups of groups, by the same rank-one
updates: one for each eigenpair of the other and one for the shift between the means. Rayleigh-Ritz
steps over all rows then bring the eigenvectors to double precision. Only spectra and sums of squares,
whose size is that of a covariance matrix, leave a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.llm.rows import written


COMPONENTS = 16

# Entries become whole numbers by this scale and offset, so that equal vectors are found exactly.
SCALE, OFFSET = 64, 1_000_000

# Spectra that are combined in one group.
GROUP = 8

# Rayleigh-Ritz steps; one makes the error quadratic in that of the spectra, another rests on rounding only.
REFINEMENTS = 2

_EPS = float(np.finfo(np.float64).eps)


# ---------------------------------------------------------------------------------------------
# rank-one updates


def _secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum z2 / (d - x) = 0 for ascending ``d``, each as (number of the nearer pole, offset from it).

    Root i lies between d[i] and d[i + 1], the last one below d[-1] + sum(z2). Offsets from the nearer
    pole keep the small differences that eigenvectors are made of. The function rises between poles, so
    bisection brackets each root, and steps that fit the two neighbouring poles make it fast.
    """
    n = len(d)
    upper = np.append(d[1:], d[-1] + z2.sum())
    middle = 0.5 * (upper - d)
    value = 1.0 + (z2 / (d[None, :] - d[:, None] - middle[:, None])).sum(1)
    pole = np.arange(n)
    right = (value < 0.0) & (pole < n - 1)
    pole = pole + right
    gaps = d[None, :] - d[pole][:, None]  # d[k] - origin of root i
    low = np.where(right, -middle, np.where(value < 0.0, middle, 0.0))
    high = np.where(right, 0.0, np.where(value < 0.0, upper - d, middle))
    x = 0.5 * (low + high)
    last = np.arange(n) == n - 1
    left_gap = d - d[pole]
    right_gap = np.append(d[1:], d[-1] + 1.0) - d[pole]  # the last root has no pole on its right
    below = (np.arange(n)[None, :] <= np.arange(n)[:, None]).astype(np.float64)
    least = _EPS * (d[-1] - d[0] + z2.sum()) + 1e-300
    for _ in range(60):
        away = gaps - x[:, None]
        away[away == 0.0] = least
        inverse = 1.0 / away
        value = 1.0 + inverse @ z2
        low, high = np.where(value < 0.0, x, low), np.where(value < 0.0, high, x)
        size = 1.0 + np.abs(inverse) @ z2
        done = (np.abs(value) <= 4.0 * _EPS * size) | (high - low <= 2.0 * _EPS * np.maximum(np.abs(low), np.abs(high)))
        if done.all():
            break
        inverse *= inverse
        left_slope = (inverse * below) @ z2
        right_slope = np.where(last, 0.0, inverse @ z2 - left_slope)
        # Each side's sum is matched in value and slope at its pole: c + s / (dl - e) + t / (dr - e) = 0.
        dl, dr = left_gap - x, right_gap - x
        s, t = left_slope * dl * dl, right_slope * dr * dr
        c = value - left_slope * dl - right_slope * dr
        b = -(c * (dl + dr) + s + t)
        g = c * dl * dr + s * dr + t * dl
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(b * b - 4.0 * c * g, 0.0))
            q = -0.5 * (b + np.copysign(root, b))
            one, two = x + q / c, x + g / q
            moved = np.where((one > low) & (one < high), one, two)
            moved = np.where(last, x + dl + s / c, moved)
            good = (moved > low) & (moved < high)
        # Halving in the geometric sense reaches roots that lie very close to their pole.
        same = (low >= 0.0) & (high > 0.0) | (high <= 0.0) & (low < 0.0)
        small = np.minimum(np.abs(low), np.abs(high))
        large = np.maximum(np.abs(low), np.abs(high))
        mean = np.where(small > 0.0, np.sqrt(small * large), large * 1e-3)
        cut = np.where(same, np.where(high > 0.0, mean, -mean), 0.5 * (low + high))
        x = np.where(done, x, np.where(good, moved, cut))
    return pole, x


class Spectrum(NamedTuple):
    """``n`` vectors with ``mean`` whose centred scatter is ``vectors`` · diag(``values``) · ``vectors`` transposed, values ascending."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray


def empty_spectrum(dims: int) -> Spectrum:
    return Spectrum(0, np.zeros(dims), np.zeros(dims), np.eye(dims))


def rank_one(values: np.ndarray, vectors: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of ``vectors`` · diag(``values``) · ``vectors`` transposed + u · u transposed; values ascending."""
    z = vectors.T @ u
    norm2 = float(z @ z)
    if norm2 == 0.0:
        return values, vectors
    tolerance = 8.0 * _EPS * max(values[-1], norm2)
    # Equal eigenvalues: a reflection within their space leaves one entry of z, the others are done.
    starts = np.flatnonzero(np.r_[True, np.diff(values) > tolerance])
    ends = np.r_[starts[1:], len(values)]
    if len(starts) < len(values):
        values, vectors, z = values.copy(), vectors.copy(), z.copy()
        for a, b in zip(starts, ends):
            if b - a > 1 and np.any(z[a : b - 1]):
                v = z[a:b].copy()
                length = np.linalg.norm(v)
                v[-1] += np.copysign(length, v[-1])
                v /= np.linalg.norm(v)
                vectors[:, a:b] -= 2.0 * np.outer(vectors[:, a:b] @ v, v)
                z[a:b] = vectors[:, a:b].T @ u
                z[a : b - 1] = 0.0
    active = np.flatnonzero(np.abs(z) * np.sqrt(norm2) > tolerance)
    if not len(active):
        return values, vectors
    d, za = values[active], z[active]
    pole, offset = _secular_roots(d, za * za)
    moved = d[pole] + offset
    # away[k, i] = d[k] - root i, exact to the last digits through the offsets.
    away = (d[:, None] - d[pole][None, :]) - offset[None, :]
    # The vector for which these roots are exact; with it the eigenvectors are orthogonal to rounding.
    with np.errstate(all="ignore"):
        ratio = -away / np.where(np.eye(len(d), dtype=bool), 1.0, d[None, :] - d[:, None])
    exact = np.copysign(np.sqrt(np.maximum(np.prod(ratio, axis=1), 0.0)), za)
    small = exact[:, None] / away
    small /= np.linalg.norm(small, axis=0)
    new_vectors = vectors.copy() if vectors.base is None else np.array(vectors)
    new_values = values.copy()
    new_vectors[:, active] = vectors[:, active] @ small
    new_values[active] = moved
    order = np.argsort(new_values, kind="stable")
    return new_values[order], new_vectors[:, order]


def with_vector(s: Spectrum, x: np.ndarray) -> Spectrum:
    """The spectrum after one more vector."""
    shift = x - s.mean
    if s.n == 0:
        return Spectrum(1, x.copy(), s.values, s.vectors)
    values, vectors = rank_one(s.values, s.vectors, shift * np.sqrt(s.n / (s.n + 1.0)))
    return Spectrum(s.n + 1, s.mean + shift / (s.n + 1.0), values, vectors)


def combined(a: Spectrum, b: Spectrum) -> Spectrum:
    """The spectrum of two sets of vectors together."""
    if a.n < b.n:
        a, b = b, a
    if b.n == 0:
        return a
    values, vectors = a.values, a.vectors
    for value, column in zip(b.values, b.vectors.T):
        if value > 0.0:
            values, vectors = rank_one(values, vectors, column * np.sqrt(value))
    n, shift = a.n + b.n, b.mean - a.mean
    values, vectors = rank_one(values, vectors, shift * np.sqrt(a.n * b.n / n))
    return Spectrum(n, a.mean + shift * (b.n / n), values, vectors)


# ---------------------------------------------------------------------------------------------
# over the rows


def whole_entries(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long") + offset)


def _is_whole(vector: Column) -> Column:
    """A vector of at least one entry, all of them numbers; entries beyond 10^15 are none that a long can hold with room."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) > 1e15))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _reduced(rows: DataFrame, add: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> pd.DataFrame:
    """One row from many, by groups of ``GROUP`` rows, then groups of groups; each level is written and read again."""
    n, level = rows.count(), rows
    while n > 1:
        numbered = level.withColumn("_group", F.expr(f"part div {GROUP}"))
        level = numbered.groupBy("_group").applyInPandas(lambda key, own: add(own.sort_values("part")).assign(part=key[0]), schema)
        level = written(level, "whitening-level")
        n = -(-n // GROUP)
        if n > 1:
            n = level.count()
    return level.toPandas()


def _numbered(parts: DataFrame, schema: str) -> DataFrame:
    """Rows of tasks, written, with numbers from 0 that leave no gap beyond the tasks that had no row."""
    return written(parts.withColumn("part", F.spark_partition_id().cast("long")).selectExpr(*[c.split()[0] for c in schema.split(", ")]), "whitening-parts")


_SPECTRUM = "part long, n long, mean array<double>, values array<double>, vectors array<double>"


def _spectrum_row(s: Spectrum) -> pd.DataFrame:
    return pd.DataFrame([{"part": 0, "n": s.n, "mean": s.mean, "values": s.values, "vectors": s.vectors.ravel()}])


def _spectrum_of(row) -> Spectrum:
    dims = len(row["mean"])
    return Spectrum(int(row["n"]), np.array(row["mean"]), np.array(row["values"]), np.array(row["vectors"]).reshape(dims, dims))


def _spectrum(fit: DataFrame, dims: int, around: np.ndarray) -> Spectrum:
    """Spectrum of all rows, centred near ``around`` for exact differences."""

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = empty_spectrum(dims)
        for batch in batches:
            for x in _matrix(batch.column("x"), dims) - around:
                s = with_vector(s, x.astype(np.float64))
        if s.n:
            row = _spectrum_row(s).drop(columns="part")
            yield pa.RecordBatch.from_pandas(row, preserve_index=False)

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = None
        for _, row in rows.iterrows():
            own = _spectrum_of(row)
            total = own if total is None else combined(total, own)
        return _spectrum_row(total)

    own = fit.mapInArrow(update, _SPECTRUM.removeprefix("part long, "))
    return _spectrum_of(_reduced(_numbered(own, _SPECTRUM), add, _SPECTRUM).iloc[0])


_SQUARES = "part long, squares array<double>"


def _squares(fit: DataFrame, dims: int, n: int, total: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Covariance of the rows centred by the exact mean and projected on the columns of ``basis``."""
    width = basis.shape[1]

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares, seen = np.zeros((width, width)), False
        for batch in batches:
            seen = seen or batch.num_rows > 0
            y = centred(_matrix(batch.column("x"), dims), n, total) @ basis
            squares += y.T @ y
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([squares.ravel()], pa.list_(pa.float64()))], ["squares"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"part": 0, "squares": np.sum(np.stack(list(rows["squares"])), axis=0)}])

    own = fit.mapInArrow(update, "squares array<double>")
    return np.array(_reduced(_numbered(own, _SQUARES), add, _SQUARES).iloc[0]["squares"]).reshape(width, width) / n


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """x - total / n without cancellation: whole parts are subtracted as whole numbers."""
    whole, rest = np.divmod(total, n)
    return (x - whole).astype(np.float64) - rest / n


class Whitening(NamedTuple):
    """``n`` and the sums of the fit list, the leading eigenpairs (values falling), the trace and the error of the identity."""

    n: int
    total: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS, refinements: int = REFINEMENTS) -> Whitening | None:
    """Fit on the distinct vectors of column ``x`` (array of long, all of one length); None where there are none."""
    # Copies are reduced in the task that reads them, before they are moved.
    fit = written(vectors.select("x").distinct(), "whitening-fit")
    dims = fit.select(F.size("x").alias("d")).first()
    if dims is None:
        return None
    dims = dims["d"]
    entries = fit.select(F.posexplode("x").alias("at", "value"))
    sums = entries.groupBy("at").agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("n")).toPandas().sort_values("at")
    n, total = int(sums["n"].iloc[0]), sums["total"].to_numpy(np.int64)
    spectrum = _spectrum(fit, dims, total // n)
    basis, values = np.linalg.qr(spectrum.vectors[:, ::-1])[0], None
    for _ in range(refinements):
        # Rayleigh-Ritz: the covariance within the space of the vectors found, and its eigenvectors.
        inside = _squares(fit, dims, n, total, basis)
        trace = float(np.trace(inside))
        values, turn = np.linalg.eigh(0.5 * (inside + inside.T))
        basis = np.linalg.qr(basis @ turn[:, ::-1])[0]
    values, basis = values[::-1][:components].copy(), basis[:, :components]
    values[values <= dims * _EPS * max(trace, 0.0)] = 0.0
    known = values > 0.0
    error = 0.0
    if known.any():
        white = _squares(fit, dims, n, total, basis[:, known] / np.sqrt(values[known]))
        error = float(np.abs(white - np.eye(int(known.sum()))).max())
    return Whitening(n, total, values, basis, trace, error)


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each row and component.

    Rows are dropped whose vector is null, empty, or holds a null, NaN or infinite entry (or one beyond
    10^15). Vectors of several lengths are an error. Null and repeated ids are rows of their own; a
    vector counts once in the fit, however often it comes. A component without variance, as all are
    where the fit has one vector, has null ``whitened``; without any variance ``explained`` is null too. ``deviation`` is
    exact, or an error where it exceeds a long. An empty table gives no rows; other columns are not read.
    """
    spark = df.sparkSession
    own = df.select(F.col(f"`{key}`").alias("vec_id"), F.col(f"`{vector}`").alias("v")).where(_is_whole(F.col("v")))
    rows = own.select("vec_id", whole_entries(F.col("v")).alias("x"))
    lengths = rows.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    if lengths["least"] != lengths["most"]:
        raise ValueError(f"vectors have {lengths['least']} to {lengths['most']} entries")
    fit = fit_whitening(rows, components)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fit is None:
        return spark.createDataFrame([], schema)
    n, total, values, basis, trace, error = fit
    dims = len(total)
    known = values > 0.0
    scaled = np.where(known, basis / np.sqrt(np.where(known, values, 1.0)), np.nan)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            white = centred(_matrix(batch.column("x"), dims), n, total) @ scaled
            flat = pa.array(white.ravel(), mask=np.isnan(white.ravel()))
            offsets = pa.array(np.arange(0, white.size + 1, scaled.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("x"), pa.ListArray.from_arrays(offsets, flat)], ["vec_id", "x", "white"]
            )

    projected = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(project, "vec_id long, x array<long>, white array<double>")
    sums = F.array(*[F.lit(int(t)).cast("long") for t in total])
    off = F.zip_with("x", sums, lambda x, s: x * F.lit(n).cast("long") - s)
    deviation = F.aggregate(off, F.lit(0).cast("long"), lambda t, d: t + d * d)
    shares = [float(v / trace) if trace > 0.0 else None for v in values]
    explained = F.array(*[F.lit(s).cast("double") for s in shares])
    opened = projected.select("vec_id", deviation.alias("deviation"), F.posexplode("white").alias("at", "whitened"))
    return opened.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
