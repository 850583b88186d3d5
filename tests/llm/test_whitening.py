"""Rank-one updates and whitening against dense eigendecompositions."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

import __spark_entry__ as entry_points
from skyweave.llm import whitening

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("x", T.StringType()),
    T.StructField("component", T.IntegerType()), T.StructField("n", T.IntegerType()),
])


def spectrum_of(rows):
    s = whitening.empty_spectrum(rows.shape[1])
    for x in rows:
        s = whitening.with_vector(s, x)
    return s


def cases():
    rng = np.random.default_rng(3)
    for d in (1, 2, 5, 24):
        plain = rng.integers(-30, 30, (60, d)).astype(float)
        yield plain
        yield plain[:3]
        yield np.repeat(plain[:20], 3, axis=0)
        yield plain * np.logspace(0, 8, d)
        yield np.eye(d)[rng.integers(0, d, 50)] * 1e6
        yield plain[:, :1] @ np.ones((1, d)) + 1e-9 * plain
        yield np.hstack([plain, np.zeros((60, 2)), plain])


@pytest.mark.parametrize("rows", list(cases()))
def test_rank_one_updates(rows):
    """Equal, zero, repeated and very different eigenvalues: spectra stay exact to rounding, alone and combined."""
    centred = rows - rows.mean(0)
    scatter = centred.T @ centred
    third = len(rows) // 3
    parts = [spectrum_of(p) for p in (rows[:third], rows[third : 2 * third], rows[2 * third :])]
    for s in (spectrum_of(rows), whitening.combined(whitening.combined(parts[0], parts[1]), parts[2])):
        assert s.n == len(rows) and np.allclose(s.mean, rows.mean(0), rtol=1e-12, atol=1e-12)
        assert np.all(np.diff(s.values) >= 0)
        assert np.abs(s.vectors.T @ s.vectors - np.eye(rows.shape[1])).max() < 1e-12
        assert np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - scatter).max() <= 1e-12 * max(np.abs(scatter).max(), 1e-300)


def expected(rows, most=16):
    own = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in own], np.int64)
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(0)
    centre = lambda a: (n * a - total) / n
    cov = centre(fit).T @ centre(fit) / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    deviation = [int(sum(int(d) ** 2 for d in n * row - total)) for row in x]
    return [i for i, _ in own], n, deviation, centre(x) @ vectors, values, float(np.trace(cov))


def check(frame, rows, dims):
    shown = whitening.whiten(frame)
    assert shown.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = shown.collect()
    ids, n, deviation, projected, values, trace = expected(rows)
    assert len(got) == len(ids) * min(16, dims)
    assert {r.n for r in got} == {n} and max(r.identity_error for r in got) <= 1e-4
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {}).setdefault(r.component, []).append((r.deviation, r.whitened, r.explained))
    gaps = np.abs(np.subtract.outer(values, values)) + np.eye(len(values)) * trace
    for k, value in enumerate(values):
        seen = [sorted(by[i][k + 1], key=repr) for i in ids]
        assert all(e == pytest.approx(value / trace, rel=1e-4) for s in seen for _, _, e in s)
        if gaps[k].min() < 1e-6 * trace:
            continue
        white = projected[:, k] / math.sqrt(value)
        at = int(np.argmax(np.abs(white)))
        sign = 1.0 if (seen[at][0][1] > 0) == (white[at] > 0) else -1.0
        for i, s, w, d in zip(ids, seen, white, deviation):
            if len(s) == 1:
                assert s[0][0] == d and s[0][1] == pytest.approx(sign * w, abs=1e-8)


def test_whitening(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(0, 0.2, 20) * np.linspace(0.5, 2, 20)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]  # a third of all rows is one vector
    rows += [(2000, None), (2001, [0.1] * 19 + [None]), (2002, [float("nan")] + [0.1] * 19), (2003, [float("inf")] * 20), (2004, []), (None, rows[3][1])]
    frame = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], SCHEMA).repartition(7)
    check(frame, rows, 20)


def test_few_dimensions_and_rows(spark):
    frame = lambda rows: spark.createDataFrame([(i, v, None, None, None) for i, v in rows], SCHEMA)
    rows = [(1, [0.0, 1.0, 2.0]), (2, [1.0, 0.5, -2.0]), (2, [1.0, 0.5, -2.0]), (3, [0.25, 0.0, 0.0]), (4, [3.0, 1.0, 1.0]), (5, [-1.0, 7.0, 2.0])]
    check(frame(rows), rows, 3)
    assert whitening.whiten(frame([])).collect() == []
    assert whitening.whiten(frame([(1, None)])).collect() == []
    alone = whitening.whiten(frame([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(1, 0, None, None, 0.0)] * 4
    flat = whitening.whiten(frame([(1, [1.0, 2.0]), (2, [2.0, 2.0])])).collect()
    assert {(r.component, r.explained, abs(r.whitened) if r.whitened else None) for r in flat} == {(1, 1.0, 1.0), (2, 0.0, None)}
    with pytest.raises(ValueError, match="entries"):
        whitening.whiten(frame([(1, [1.0]), (2, [1.0, 2.0])]))


def test_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = entry_points.queries()["op13_embedding_whitening"](spark, sf_dir).collect()
    ids, n, deviation, projected, values, trace = expected(rows)
    by = {(r.vec_id, r.component): r for r in got}
    assert len(by) == len(got) == 16 * len(ids) and got[0].identity_error <= 1e-4
    for k in range(16):
        white = projected[:, k] / math.sqrt(values[k])
        sign = math.copysign(1.0, white[0] * by[ids[0], k + 1].whitened)
        for i, w, d in zip(ids, white, deviation):
            r = by[i, k + 1]
            assert (r.n, r.deviation) == (n, d) and r.whitened == pytest.approx(sign * w, abs=1e-7)
            assert r.explained == pytest.approx(values[k] / trace, rel=1e-9)
