import math
from fractions import Fraction

import numpy as np
import pytest

from scorefold.llm import topk


def brute(rows, k=20):
    vectors = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
               if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in vectors:
        if q % 20 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, kind="float"):
    df = spark.createDataFrame([(i, v, 1, "r", 2) for i, v in rows], f"vec_id long, embedding array<{kind}>, label int, row string, band int").repartition(3)
    return sorted(map(tuple, topk.top_inner_products(df).collect()))


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_against_all_pairs(spark, monkeypatch, spread):
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    monkeypatch.setattr(topk, "SEED_ROWS", 32)
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(700, 12)) * np.exp(spread * rnd.normal(size=(700, 1))) * np.linspace(2, 0.1, 12)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    assert run(spark, rows) == brute(rows)


def test_ties_and_odd_vectors(spark):
    v = [0.5, -0.25, 1.0]
    rows = [(i, v) for i in range(45)] + [(100, None), (101, [1.0, None, 0.0]), (102, [float("nan"), 0.0, 0.0]), (103, [float("inf"), 0.0, 0.0]), (None, v),
            (104, []), (105, [3.0]), (120, [0.0, 0.0, 0.0]), (140, [-1.0, -1.0, -1.0, -1.0])]
    assert run(spark, rows, "double") == brute(rows)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**30 + i), float(-(2**29)), 3.0]) for i in range(25)]
    got = run(spark, rows, "double")
    top = 2**63 - 1
    expected = [(q, r, i, min(top, s)) for q, r, i, s in brute(rows)]
    assert [x[3] for x in got] == [x[3] for x in expected]


def test_empty_and_few(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(0, [1.0]), (3, [2.0])]) == [(0, 1, 3, 64 * 128)]
    assert run(spark, [(1, [1.0]), (3, [2.0])]) == []


@pytest.mark.parametrize("sizes", [(1e150,), (1e200,), (1e307, 1.7e308), (1e-200, 1.0, 1e10, 1e200, 1e307)])
def test_components_of_any_size(spark, sizes):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.choice([-1.0, 0.0, 0.5, 1.0], 6) * rng.choice(sizes, 6) * rng.random(6)]) for i in range(130)]
    rows += [(200 + i, [sizes[-1], -sizes[-1], float(i), 0.0, 0.0, 0.0]) for i in range(30)]  # large terms that cancel
    rows += [(400, [1.0, 1.0, 2.0, 0.0, 0.0, 0.0]), (420, [0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_inner_products(df).collect()}
    top = 2**63 - 1
    whole = {i: [math.floor(Fraction(c) * 64) for c in v] for i, v in rows}
    wanted = {}
    for q in (i for i, _ in rows if i % 20 == 0):
        scores = sorted((-max(-top - 1, min(top, sum(a * b for a, b in zip(whole[q], x)))), i) for i, x in whole.items() if i != q)
        wanted |= {(q, rank): (i, -s) for rank, (s, i) in enumerate(scores[:20], 1)}
    assert got == wanted
