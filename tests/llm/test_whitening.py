from __future__ import annotations

import numpy as np
import pytest

from replenish.llm import whitening
from replenish.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<double>, n string, component int"


def naive(vectors: list[list[float]]) -> tuple[np.ndarray, np.ndarray, float]:
    """Centred x, eigenvectors as columns by falling eigenvalue, eigenvalues and trace by numpy."""
    x = np.floor(np.array(vectors, dtype=float) * 1024) + 100_000
    centred = x - x.mean(axis=0)
    values, columns = np.linalg.eigh(centred.T @ centred / len(x))
    return centred, columns[:, ::-1], values[::-1]


def against(rows, vectors: dict[int, list[float]], components: int = 8) -> None:
    ids = sorted(vectors)
    centred, columns, values = naive([vectors[i] for i in ids])
    got = np.zeros((len(ids), components))
    for r in rows:
        got[ids.index(r.vec_id), r.component - 1] = r.whitened
        assert r.n == len(ids) and abs(r.identity_error) < 1e-9
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-10)
    wanted = centred @ columns[:, :components] / np.sqrt(values[:components])
    sign = np.sign((got * wanted).sum(axis=0))
    assert np.abs(got * sign - wanted).max() < 1e-8
    x = [[int(v) + 100_000 for v in np.floor(np.array(vectors[i], dtype=float) * 1024)] for i in ids]
    sums = [sum(c) for c in zip(*x)]
    exact = {i: sum((len(ids) * v - s) ** 2 for v, s in zip(row, sums)) for i, row in zip(ids, x)}
    assert all(r.deviation == exact[r.vec_id] for r in rows)


def test_query_equals_numpy(spark):
    path = "/root/testdata/sf0.01"
    vectors = {
        r.vec_id: r.embedding for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()
    }
    rows = QUERIES["op11_whitening"](spark, path).collect()
    assert len(rows) == 8 * len(vectors)
    against(rows, vectors)


def test_bad_vectors_go_and_clashing_columns_do_not_matter(spark):
    random = np.random.default_rng(5)
    good = {i: random.normal(size=4).tolist() for i in range(30)}
    bad = [
        (50, None), (51, []), (52, [1.0, None, 2.0, 3.0]), (53, [1.0, float("nan"), 0.0, 0.0]),
        (54, [float("inf"), 0.0, 0.0, 0.0]), (55, [0.0] * 5), (56, [1e30, 0.0, 0.0, 0.0]), (None, None),
    ]
    rows = [(i, v, "x", 9) for i, v in [*good.items(), *bad]]
    found = whitening.whitened(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert len(found) == 30 * 4
    against(found, good, components=4)


def test_large_entries_stay_exact(spark):
    vectors = {i: [float((i * 37 % 11) * 2.0**38), float(i % 5), float(i * i)] for i in range(20)}
    rows = [(i, v, None, 0) for i, v in vectors.items()]
    found = whitening.whitened(spark.createDataFrame(rows, SCHEMA), components=2).collect()
    x = [[int(v * 1024) + 100_000 for v in vectors[i]] for i in range(20)]
    sums = [sum(c) for c in zip(*x)]
    for r in found:
        exact = sum((20 * v - s) ** 2 for v, s in zip(x[r.vec_id], sums))
        assert r.deviation == (exact if exact < 1 << 63 else None)


@pytest.mark.parametrize(
    "vectors", [[], [[1.0, 2.0]], [[3.0, 4.0]] * 5, [[]] * 3, [None, None]], ids=range(5)
)
def test_without_variance_there_is_no_component(spark, vectors):
    rows = [(7, v, "", 1) for v in vectors]
    assert whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_repeated_rows_count_and_rank_bounds_the_components(spark):
    rows = [(1, [0.0, 0.0, 1.0], "", 1)] * 3 + [(None, [1.0, 2.0, 1.0], "", 1)]
    found = whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 4 and {r.component for r in found} == {1} and {r.n for r in found} == {4}
    assert found[0].explained == pytest.approx(1.0)
    assert sorted(round(abs(r.whitened), 6) for r in found) == [0.57735] * 3 + [1.732051]


def test_exact_product_and_factor():
    random = np.random.default_rng(3)
    big = random.integers(-(1 << 60), 1 << 60, size=(50, 3))
    wanted = big.astype(object).T @ big.astype(object)
    assert (whitening.exact_product(big) == wanted).all()
    for rank, size in ((3, 7), (7, 7), (1, 4)):
        half = random.normal(size=(size, rank))
        factor = whitening.pivoted_cholesky(half @ half.T)
        assert factor.shape == (size, rank)
        assert np.allclose(factor @ factor.T, half @ half.T, atol=1e-12)
        # Triangular: with its rows in the order of the pivots, nothing stands above the diagonal.
        order = np.argsort([(np.flatnonzero(r)[-1]) for r in factor], kind="stable")
        assert all(not row[i + 1 :].any() for i, row in enumerate(factor[order][:rank]))
        rotated = whitening.jacobi_columns(factor)
        gram = rotated.T @ rotated
        assert np.allclose(gram, np.diag(np.diag(gram)), atol=1e-12)
        assert np.allclose(rotated @ rotated.T, half @ half.T, atol=1e-12)
