"""Whitened coordinates against numpy, and the rows that take no part."""

import math

import numpy as np
import pytest

from tickloom.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, part int, index long, n string, x string"


def frame(spark, rows):
    """Rows of (vec_id, vector) with extra columns whose names the operator uses."""
    return spark.createDataFrame([(i, v, 0, 1, "a", "b") for i, v in rows], SCHEMA)


def naive(ids, vectors, components):
    x = np.floor(64 * np.asarray(vectors, np.float32).astype(float)).astype(int) + 1_000_000
    n, total = len(x), x.sum(0)
    c = (x * n - total) / n
    values, vecs = np.linalg.eigh(c.T @ c / n)
    values, vecs = values[::-1][:components], vecs[:, ::-1][:, :components]
    return n, ((n * x - total) ** 2).sum(1), c @ vecs / np.sqrt(values), values / (c * c).sum() * n


def check(out, ids, vectors, components):
    n, deviation, points, explained = naive(ids, vectors, components)
    assert len(out) == len(ids) * components and set(out.n) == {n}
    out = out.sort_values(["vec_id", "component"], kind="stable")
    order = np.argsort(ids, kind="stable")
    ours = out.whitened.to_numpy().reshape(len(ids), components)
    assert (out.deviation.to_numpy().reshape(len(ids), components) == deviation[order][:, None]).all()
    signs = np.sign((ours * points[order]).sum(0))
    assert np.abs(ours - points[order] * signs).max() < 1e-7
    assert np.abs(out.explained.to_numpy().reshape(-1, components) - explained).max() < 1e-9
    assert out.identity_error.nunique() == 1 and out.identity_error.iloc[0] < 1e-9


def test_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    out = queries.op12_whitening(spark, sf_dir)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(out.toPandas(), table.vec_id.to_numpy(), table.embedding.tolist(), 32)


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 3)
    monkeypatch.setattr(whitening, "MEETING", 2)
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(90, 8)) @ rng.normal(size=(8, 8))
    ids = rng.permutation(90)
    out = whitening.whitened(frame(spark, [(int(i), v.tolist()) for i, v in zip(ids, vectors)]).repartition(5), 8)
    check(out.toPandas(), ids, vectors, 8)


def test_rows_that_take_no_part(spark):
    rng = np.random.default_rng(6)
    good = [(i, rng.normal(size=3).tolist()) for i in range(40)]
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [math.nan, 1.0, 1.0]), (94, [math.inf, 0.0, 0.0]),
           (95, [1.0, 2.0]), (96, [3e38, 0.0, 0.0])]
    out = whitening.whitened(frame(spark, good + bad)).toPandas()
    check(out, np.arange(40), [v for _, v in good], 3)


def test_repeated_and_null_ids(spark):
    rng = np.random.default_rng(7)
    rows = [(int(i) % 4 if i % 3 else None, v.tolist()) for i, v in enumerate(rng.normal(size=(30, 2)))]
    out = whitening.whitened(frame(spark, rows + rows)).toPandas()
    assert len(out) == 120 and out.vec_id.isna().sum() == 40 and set(out.n) == {60}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])]])
def test_nothing_to_fit(spark, rows):
    assert whitening.whitened(frame(spark, rows)).count() == 0


def test_no_variance(spark):
    out = whitening.whitened(frame(spark, [(i, [1.0, float(i), 2.0]) for i in range(9)])).toPandas()
    flat = out[out.component > 1]
    assert (flat.whitened == 0).all() and (flat.explained.abs() < 1e-12).all() and out.identity_error.max() < 1e-9
    alone = whitening.whitened(frame(spark, [(1, [1.0, 2.0])])).toPandas()
    assert (alone.whitened == 0).all() and (alone.deviation == 0).all()
