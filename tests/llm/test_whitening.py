"""Whitening over distinct vectors."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from claimflow.llm import whitening

SHAPE = "vec_id long, embedding array<float>, n string, h int, x string, copies int, weight string, component int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "a", 1, "b", 2, "c", 3) for r in rows], SHAPE)


def brute(rows, width, components, by_copies=False):
    """Distinct vectors by a dictionary, covariance by numpy over exact sums."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    keys = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) + (1_000_000,) * (width - len(v))) for i, v in good]
    copies = Counter(x for _, x in keys)
    weight = {x: c if by_copies else 1 for x, c in copies.items()}
    n = sum(weight.values())
    sums = [sum(x[d] * w for x, w in weight.items()) for d in range(width)]
    # n * x - S is exact before the one division
    centred = {x: np.array([(n * a - s) / n for a, s in zip(x, sums, strict=True)]) for x in copies}
    cov = sum(weight[x] * np.outer(y, y) for x, y in centred.items()) / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = {}
    for i, x in keys:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        out[i] = (n, deviation, np.abs(centred[x] @ vectors) / np.sqrt(values), values / np.trace(cov))
    return out


@pytest.mark.parametrize("by_copies", [False, True])
def test_like_brute_force(spark, by_copies):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) * (d + 1) for d in range(7)]) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(400)]  # one vector holds over half of all rows
    rows += [(1500, rows[4][1][:3]), (1501, []), (1600, None), (1601, [None] * 7), (1602, [float("nan")] * 7), (1603, [float("-inf")] * 7)]
    want = brute(rows, 7, 5, by_copies)
    got = whitening.whiten(table(spark, rows).repartition(5), 5, by_copies).collect()
    assert len(got) == 5 * len(want) == 5 * 702
    signs = {}
    for r in got:
        n, deviation, white, explained = want[r["vec_id"]]
        c = r["component"] - 1
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(abs(r["whitened"]) - white[c]) < 1e-9
        assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
        assert r["identity_error"] < 1e-10
        signs.setdefault((r["vec_id"], c), r["whitened"])
    same = {signs[i, 0] for i in [3, *range(1000, 1400)]}
    assert len(same) == 1  # copies have one result


def test_covariance_of_the_result_is_the_identity(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(400, 4)) @ rng.normal(size=(4, 4)) * 3
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    got = whitening.whiten(table(spark, rows), 4).collect()
    z = np.zeros((400, 4))
    for r in got:
        z[r["vec_id"], r["component"] - 1] = r["whitened"]
    assert np.abs(np.cov(z.T, bias=True) - np.eye(4)).max() < 1e-9


def test_no_variance_and_no_rows(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    one = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert len(one) == 4
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one} == {(1, 0, None, None, None)}
    flat = whitening.whiten(table(spark, [(i, [float(i), 7.0]) for i in range(50)])).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in flat)
    assert all(r["identity_error"] < 1e-12 for r in flat)


def test_large_entries(spark):
    rows = [(i, [float(i) * 1e30, float(i % 7)]) for i in range(20)]
    got = whitening.whiten(table(spark, rows), 2).collect()
    assert len(got) == 40
    # entries are held within 2^40: one vector is at 0, and nineteen at the limit
    assert {r["deviation"] for r in got if r["vec_id"] == 0} == {None}
