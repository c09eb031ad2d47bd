"""Whitening against numpy's eigenvalues and exact integers."""

import math

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from shelfpulse.llm import whitening
from shelfpulse.llm.common import table

MIDDLE = "/root/testdata/sf0.01"


def expected(vectors, most=8):
    """n, deviations, whitened values (up to sign) and explained shares of vectors of one length, in plain numpy."""
    x = np.floor(np.asarray(vectors, float) * 1024).astype(np.int64) + 100_000
    n, total = len(x), x.sum(0)
    exact = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, total)) for row in x]
    centred = x - total / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    rank = int((values > values[0] * 1e-10).sum())
    keep = min(most, rank)
    return n, exact, centred @ axes[:, :keep] / np.sqrt(values[:keep]), values[:keep] / values.sum()


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_given_tables(spark, folder):
    source = {r["vec_id"]: r["embedding"] for r in table(spark, folder, "embeddings").collect()}
    n, exact, white, shares = expected(list(source.values()))
    rows = whitening.op13_embedding_whitening(spark, folder).collect()
    assert len(rows) == 8 * len(source)
    place = {vec: i for i, vec in enumerate(source)}
    found = np.zeros((len(source), 8))
    for r in rows:
        i = place[r["vec_id"]]
        assert (r["n"], r["deviation"]) == (n, exact[i])
        assert math.isclose(r["explained"], shares[r["component"] - 1], rel_tol=1e-9)
        assert r["identity_error"] < 1e-9
        found[i, r["component"] - 1] = r["whitened"]
    signs = np.sign((found * white).sum(0))
    assert np.abs(found - white * signs).max() < 1e-8
    assert np.abs(np.cov(found.T, bias=True) - np.eye(8)).max() < 1e-9


@pytest.mark.parametrize("size", [1, 2, 3, 7, 40])
def test_eigen(size):
    rng = np.random.default_rng(size)
    for rank in {1, max(1, size // 2), size}:
        half = rng.normal(size=(size, rank)) * 10.0 ** rng.integers(-3, 4, rank)
        values, axes = whitening.eigen(half @ half.T)
        want = np.linalg.eigvalsh(half @ half.T)[::-1]
        assert len(values) <= size and np.allclose(values, want[: len(values)], rtol=1e-9, atol=want[0] * 1e-13)
        assert (want[len(values):] < want[0] * 1e-11).all()
        assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-12
        assert np.abs((half @ half.T) @ axes - axes * values).max() < want[0] * 1e-12
    factor, order = whitening.pivoted_cholesky(half @ half.T)
    assert np.allclose(np.triu(factor, 1), 0)
    assert np.allclose(factor @ factor.T, (half @ half.T)[order][:, order])


def test_edges(spark):
    rng = np.random.default_rng(3)
    three = [(i, [float(v) for v in rng.normal(size=3)]) for i in range(20)]
    odd = [(50, None), (51, [1.0, None, 2.0]), (52, [1.0, float("nan"), 2.0]), (53, [1.0, float("inf"), 0.0]), (54, []),
           (60, [1.0, 2.0]), (61, [1.0, 2.0]), (70, [0.5])]
    rows = [*three, three[0], (None, three[1][1]), *odd]
    frame = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<double>, dim int, n long, component int")
    found = whitening.whitening(frame).collect()
    n, exact, white, _ = expected([v for _, v in [*three, three[0], (None, three[1][1])]])
    assert n == 22 and len(found) == 22 * 3  # a single vector and two equal ones have no variance
    assert sorted(r["deviation"] for r in found) == sorted(exact * 3)
    assert {r["component"] for r in found} == {1, 2, 3} and sum(r["vec_id"] is None for r in found) == 3
    assert sorted(abs(round(r["whitened"], 7)) for r in found) == sorted(np.abs(white).round(7).ravel().tolist())
    assert whitening.whitening(frame.where("1 = 0")).collect() == []
    assert whitening.whitening(frame.where("vec_id >= 50")).collect() == []


def test_lengths_are_lists_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(whitening, "GROUP", 5)  # several passes
    rng = np.random.default_rng(4)
    lists = {dim: [[float(v) for v in rng.normal(size=dim)] for _ in range(15)] for dim in (2, 3, 4)}
    rows = [(dim * 100 + i, v) for dim, own in lists.items() for i, v in enumerate(own)]
    found = whitening.whitening(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), most=2)
    for dim, own in lists.items():
        _, exact, white, _ = expected(np.float32(own), 2)
        mine = found.where(F.col("dim") == dim).orderBy("vec_id", "component").collect()
        assert [r["deviation"] for r in mine[::2]] == exact
        assert np.allclose(np.abs([r["whitened"] for r in mine]), np.abs(white).ravel(), atol=1e-9)


def test_entries_of_any_size(spark):
    rows = [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 3.0]), (4, [1e9, -4.0])]
    found = whitening.whitening(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(found) == 4 and all(math.isfinite(r["whitened"]) for r in found)  # beside these the second axis is noise
    assert all(r["deviation"] is None for r in found)
    centre = whitening.Centre.of(3, [10, 11])
    whole = np.array([[3, 4], [2**31, 7]])
    exact = [sum((3 * x - s) ** 2 for x, s in zip(row, (10, 11))) for row in whole.tolist()]
    assert whitening.deviations(whole, centre) == [e if e < 2**63 else None for e in exact]
