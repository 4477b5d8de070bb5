"""Whitening against a plain eigendecomposition."""

from __future__ import annotations

import math

import numpy as np
import pytest

from silverlode.llm import whitening
from silverlode.llm.common import ship_package
from silverlode.llm.queries import QUERIES
from tests.compare import DATA

SCHEMA = "vec_id long, embedding array<float>, key string, n int"


def plain(rows, components=32):
    """Per usable row: id, exact deviation and whitened coordinates up to sign; the eigenvalues; the trace."""
    good = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and math.isfinite(c) and abs(c) < 2**50 for c in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for _, v in good]
    n, width = len(x), len(x[0])
    sums = [sum(r[d] for r in x) for d in range(width)]
    exact = [[n * c - s for c, s in zip(r, sums)] for r in x]
    deviations = [sum(c * c for c in r) for r in exact]
    centred = np.array(exact, dtype=np.float64) / n
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1], q[:, ::-1]
    m = min(components, int((e > 1e-13 * e[0]).sum()))
    return [i for i, _ in good], deviations, centred @ q[:, :m] / np.sqrt(e[:m]), e, deviations and sum(deviations) / n**3


def run(spark, rows, block=whitening.BLOCK, components=32):
    ship_package(spark)
    wide = spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA).repartition(3)
    return whitening.whiten(wide, "vec_id", "embedding", components, block).collect()


def check(got, rows, components=32, tolerance=1e-9):
    ids, deviations, z, e, trace = plain(rows, components)
    table = {}
    for r in got:
        table.setdefault(r.key, {})[r.component] = r
    assert sorted(table) == sorted(ids)
    m = z.shape[1]
    mine = np.array([[table[i][c].whitened for c in range(1, m + 1)] for i in ids])
    assert all(len(v) == m for v in table.values())
    for c in range(m):
        sign = np.sign(mine[:, c] @ z[:, c])
        assert np.abs(mine[:, c] * sign - z[:, c]).max() < tolerance
    for i, deviation in zip(ids, deviations):
        row = table[i][1]
        assert row.deviation == (deviation if deviation < 2**63 else None) and row.n == len(ids)
        assert row.identity_error < 1e-9
    for c in range(m):
        assert abs(table[ids[0]][c + 1].explained / (e[c] / trace) - 1) < 1e-9


def vectors(n, width, seed=1):
    rng = np.random.default_rng(seed)
    mixing = rng.standard_normal((width, width)) * np.linspace(1, 0.1, width)
    return [(i, [float(np.float32(c)) for c in rng.standard_normal(width) @ mixing + 3]) for i in range(n)]


@pytest.mark.parametrize("block", [1, 3, 8, 100])
def test_equals_a_plain_decomposition(spark, block):
    rows = vectors(300, 20)
    check(run(spark, rows, block), rows)
    check(run(spark, rows, block, 5), rows, 5)


def test_rows_that_take_no_part(spark):
    good = vectors(60, 6)
    bad = [(100, None), (101, []), (102, [None] * 6), (103, [1.0, 2.0, float("nan"), 1.0, 1.0, 1.0]), (104, [float("inf")] * 6),
           (105, [float("-inf")] + [0.0] * 5), (106, [1e30] * 6)]
    check(run(spark, bad + good), good)
    # Another length than most.
    check(run(spark, good + [(107, [1.0, 2.0])]), good)


def test_directions_without_deviation_have_no_component(spark):
    rows = [(i, [*v, 5.0, v[0], 0.0]) for i, v in vectors(80, 4)]
    got = run(spark, rows)
    assert {r.component for r in got} == {1, 2, 3, 4}
    check(got, rows)
    assert run(spark, [(1, [1.0, 2.0])]) == []
    assert run(spark, [(i, [1.0, 2.0]) for i in range(5)]) == []
    assert run(spark, []) == []


def test_large_and_small_deviations(spark):
    rng = np.random.default_rng(3)
    sizes = np.array([1e4, 1e3, 100, 1, 0.3])
    rows = [(i, [float(np.float32(c)) for c in rng.standard_normal(5) * sizes]) for i in range(200)]
    check(run(spark, rows, 2), rows, tolerance=1e-5)


def test_equal_deviations_are_all_found(spark):
    """Corners of a cube: all directions are alike, more of them than a block holds."""
    corners = [[1.0 if i >> d & 1 else -1.0 for d in range(6)] for i in range(64)]
    got = run(spark, list(enumerate(corners)), 2)
    assert {r.component for r in got} == set(range(1, 7))
    assert max(r.identity_error for r in got) < 1e-12
    assert {round(r.explained, 12) for r in got} == {round(1 / 6, 12)}


def test_null_and_repeated_ids_are_kept(spark):
    rows = vectors(20, 3)
    again = [(None, rows[0][1]), (None, rows[0][1]), (4, rows[4][1])]
    got = run(spark, rows + again)
    assert len(got) == 23 * 3
    same = [r for r in got if r.key in (None, 0) and r.component == 1]
    assert len(same) == 3 and len({r.whitened for r in same}) == 1


def test_sums_beyond_a_long_give_null(spark):
    got = run(spark, [(i, [float(i % 7) * 2.0**40, float(i)]) for i in range(50)])
    assert {r.deviation for r in got} == {None}


def test_matrix_is_bidiagonal_and_early_stop_is_right():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 60)) * 0.5 ** np.arange(60)
    for block in (1, 4):
        products = lambda y: ((x @ y).T @ (x @ y), x.T @ (x @ y))
        axes, values, band, passes = whitening.bidiagonalise(products, 60, 3, block)
        assert passes < 60 // block + 5
        s, q = np.linalg.svd(x)[1:]
        assert np.abs(values[:3] / s[:3] - 1).max() < 1e-12
        assert np.abs(np.abs((axes[:, :3] * q[:3].T).sum(0)) - 1).max() < 1e-12
        rows, columns = np.indices(band.shape)
        outside = (columns // block < rows // block) | (columns // block > rows // block + 1)
        assert np.abs(band[outside]).max() < 1e-12 * s[0]


def test_query_on_the_whole_table(spark):
    folder = f"{DATA}/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = QUERIES["op11_embedding_whitening"](spark, folder).withColumnRenamed("vec_id", "key").collect()
    check(got, rows)
