"""Whitening against exact fractions and a plain numpy version."""

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, n long, x string"


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = {r.vec_id: [math.floor(256 * float(c)) for c in r.embedding] for r in rows}
    fit = np.array(sorted(set(map(tuple, x.values()))), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    centred = (fit * n - s).astype(np.float64) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    got = queries.QUERIES["op13_whitening"](spark, SF)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = got.collect()
    assert len(got) == 4 * len(rows)
    signs = {}
    for r in got:
        e, u = values[-r.component], vectors[:, -r.component]
        far = [n * a - int(b) for a, b in zip(x[r.vec_id], s)]
        want = float(np.array(far, dtype=np.float64) / n @ u / np.sqrt(e))
        assert (r.n, r.deviation) == (n, sum(a * a for a in far))
        assert abs(abs(r.whitened) - abs(want)) < 1e-8 and r.explained == pytest.approx(e / values.sum(), rel=1e-9) and r.identity_error < 1e-9
        if abs(want) > 1e-6:
            assert signs.setdefault(r.component, np.sign(r.whitened * want)) == np.sign(r.whitened * want)


def test_odd_rows(spark):
    """Nulls, NaN, infinities, another width, repeated rows and ids, clashing columns."""
    good = [(i, [float(i % 5), float(i * i % 7), 0.25 * i]) for i in range(12)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, math.nan, 2.0]), (103, [math.inf, 0.0, 0.0]), (104, []), (105, [1.0, 2.0])]
    rows = [*good, *bad, good[3], (None, good[4][1]), (3, good[5][1])]
    d = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA).repartition(3)
    got = whitening.whiten(d).collect()
    assert len(got) == 3 * (len(good) + 3) and {r.n for r in got} == {12} and {r.component for r in got} == {1, 2, 3}
    assert sum(r.vec_id is None for r in got) == 3 and sum(r.vec_id == 3 for r in got) == 9


def test_no_variance_and_no_rows(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert {tuple(r)[1:] for r in whitening.whiten(same).collect()} == {(1, 1, 0, None, 0.0, 0.0), (2, 1, 0, None, 0.0, 0.0)}
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], "vec_id long, embedding array<double>")
    got = whitening.whiten(line).collect()
    assert {r.whitened for r in got if r.component == 2} == {None} and {r.explained for r in got} == {1.0, 0.0}
    assert whitening.whiten(same.where("vec_id > 5")).collect() == []


def test_ends_of_a_long(spark):
    d = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [3.0, 5.0]), (4, [-7.0, 4.0])], "vec_id long, embedding array<double>")
    x = [(2**63 - 1, 0), (-(2**63), 256), (768, 1280), (-1792, 1024)]
    s = [sum(c) for c in zip(*x)]
    deviation = [sum((4 * a - b) ** 2 for a, b in zip(r, s)) for r in x]
    got = whitening.whiten(d).where("component = 2").orderBy("vec_id").collect()
    assert [r.deviation for r in got] == [k if k < 2**63 else None for k in deviation] and got[2].deviation is not None
    assert all(r.identity_error < 1e-4 for r in got)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=6))
def test_limbs_and_digits(values):
    x = np.array([values], dtype=np.int64)
    parts = whitening.limbs(x)
    assert [sum(int(p[0, i]) << (whitening.LIMB * k) for k, p in enumerate(parts)) for i in range(len(values))] == values
    assert all(abs(p).max() <= 1 << (whitening.LIMB - 1) for p in parts)
    big = sum(v**3 for v in values)
    assert sum(d << (32 * k) for k, d in whitening.digits(big)) == big
    a = np.array([values], dtype=object)
    assert (whitening.exact_product(a.T, a) == a.T.dot(a)).all()


@pytest.mark.parametrize("scales", [(1, 1, 1, 1, 1), (10**15, 3, 3, 3, 3), (10**9, 10**5, 100, 1, 1)])
def test_eigenvectors_of_graded_matrices(scales):
    r = np.random.default_rng(1)
    x = ((r.normal(size=(40, 5)) * 50).astype(np.int64) * np.array(scales)).astype(object)
    n, s = len(x), x.sum(axis=0)
    v = n * x.T.dot(x) - np.outer(s, s)
    values, shares, unit = whitening.eigen(v, n)
    for e, share, u in zip(values, shares, unit):
        u = [Fraction(c) for c in u]
        image = [sum(int(v[i, j]) * u[j] for j in range(5)) for i in range(5)]
        assert float(sum(a * b for a, b in zip(u, image)) / n**2 / Fraction(e)) == pytest.approx(1, rel=1e-9)
        assert share == pytest.approx(e / float(Fraction(sum(int(c) for c in v.diagonal()), n**2)), rel=1e-9)
    assert abs(unit @ unit.T - np.eye(4)).max() < 1e-12
