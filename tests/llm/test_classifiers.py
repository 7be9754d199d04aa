import random

import numpy as np
import pytest
from cases import make, remainder

from scorefold.llm import quality, toxicity
from scorefold.llm.training import logistic, training_sample


def auc(scores, labels):
    s, y = np.array(scores), np.array(labels)
    return np.mean([(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]])


@pytest.fixture(scope="module")
def labelled():
    import duckdb

    return {t: duckdb.sql(f"select * from '/root/testdata/sf0.01/{t}.parquet'").df() for t in ("documents", "labels")}


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_held_out_rows(spark, labelled, kind):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    f = quality.document_quality if kind == "quality" else toxicity.document_toxicity
    out = f(docs, labels).toPandas()
    assert len(out) == len(labelled["documents"]) and out["score"].between(0, 1).all()
    divisor, held = (3, 1) if kind == "quality" else (4, 2)
    assert (out["held_out"] == [remainder(i, divisor) == held for i in out["doc_id"]]).all()
    m = out.merge(labelled["labels"], on="doc_id")
    m = m[m["held_out"]]
    assert auc(m["score"], m[kind]) > (0.97 if kind == "quality" else 0.75)
    assert (m["predicted"] == m[kind]).mean() > (0.97 if kind == "quality" else 0.9)
    # labels of held-out rows change nothing
    flipped = labels.selectExpr("doc_id", *[f"if(crc32(cast(doc_id as string)) % {divisor} = {held}, 1 - {c}, {c}) as {c}" for c in ("quality", "toxic")])
    again = f(docs, flipped).toPandas().sort_values("doc_id")
    assert np.allclose(again["score"], out.sort_values("doc_id")["score"])


@pytest.mark.parametrize("f", [quality.document_quality, toxicity.document_toxicity])
def test_odd_rows_and_labels(spark, f):
    docs = make(spark)
    schema = "doc_id long, quality int, toxic int, text string"
    for labels in ([], [(1, 1, 1, "x")], [(1, 1, 1, "x"), (7, 0, 0, "x"), (7, 0, 0, "y"), (None, 1, 0, "z"), (8, None, None, "z"), (14, 0, 1, "z"), (10, 1, 0, "z")]):
        out = f(docs, spark.createDataFrame(labels, schema)).collect()
        assert len(out) == docs.count() and all(r.score is not None and 0 <= r.score <= 1 for r in out)
        assert len({r.score for r in out if r.doc_id == 8}) == 1
        assert not any(r.held_out for r in out if r.doc_id is None)
    assert f(make(spark, []), spark.createDataFrame(labels, schema)).count() == 0


def brute_segments(scores):
    """Maximal scoring segments by definition: the best segment, then the same left and right of it."""
    if not scores:
        return []
    sums, best = np.concatenate([[0.0], np.cumsum(scores)]), None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            s = sums[j] - sums[i]
            if s > 1e-9 and (best is None or s > best[0] + 1e-9 or (abs(s - best[0]) <= 1e-9 and j - i < best[2] - best[1])):
                best = (s, i, j)
    if best is None:
        return []
    s, i, j = best
    return [*brute_segments(scores[:i]), (i, j, s), *[(i2 + j, j2 + j, s2) for i2, j2, s2 in brute_segments(scores[j:])]]


def test_segments_are_all_maximal():
    rnd = random.Random(3)
    for _ in range(300):
        n = rnd.randrange(1, 25)
        hits = {i: rnd.uniform(0.1, 2) for i in range(n) if rnd.random() < 0.4}
        drift = rnd.choice([0.07, 0.33, 0.9])
        got = toxicity.segments(sorted(hits.items()), drift)
        expected = brute_segments([hits.get(i, -drift) for i in range(n)])
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in expected]
        assert np.allclose([s for *_, s in got], [s for *_, s in expected])


class Counted(float):
    """A number that counts its comparisons."""

    steps = 0

    def __add__(self, other):
        return Counted(float(self) + other)

    __radd__ = __add__

    def __sub__(self, other):
        return Counted(float(self) - other)

    def __ge__(self, other):
        Counted.steps += 1
        return float(self) >= other


def test_segments_take_linear_steps():
    """Isolated hits that the drift outweighs: each starts lower than all before it."""
    Counted.steps = 0
    got = toxicity.segments([(40 * i, Counted(1.0)) for i in range(2000)], 0.05)
    assert len(got) == 2000 and 0 < Counted.steps <= 10_000


def test_sample_has_one_row_of_an_id(spark):
    """An id with most of the rows counts once, always with the same text."""
    rows = [(1, f"text {i}", *[None] * 9) for i in range(500)] + [(i, f"own {i}", *[None] * 9) for i in range(2, 40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, quality int")
    docs = make(spark, rows)
    got = [training_sample(x, labels, "quality", 3, 1, 100)[0].collect() for x in (docs, docs.repartition(7))]
    assert len(got[0]) == len({r.doc_id for r in got[0]}) and {r.doc_id for r in got[0]} == {i for i in range(1, 40) if remainder(i, 3) != 1}
    assert {(r.doc_id, r.text, r.label) for r in got[0]} == {(r.doc_id, r.text, r.label) for r in got[1]}


def test_rate_solves_its_equation():
    s, p = np.array([0.0, 2.0, 3.5]), np.array([0.995, 0.003, 0.002])
    rate = toxicity.extreme_rate(s, p)
    assert abs(p @ np.exp(rate * (s - toxicity.DRIFT)) - 1) < 1e-6 and rate > 0


def test_passages(spark):
    lexicon = toxicity.Lexicon({"bad*": 3.0}, 1.0, 0.01, [0.0] * 5, 0.1)
    docs = spark.createDataFrame([(1, "fine words BADLY, badness here"), (2, None), (3, "good")], "doc_id long, text string")
    assert [(r.doc_id, r.first_word, r.words) for r in toxicity.passages(docs, lexicon).collect()] == [(1, 2, 2)]


def test_ranking_prefers_the_better():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(400, quality.FEATURES))
    y = (x[:, 0] - x[:, 1] + 0.1 * rnd.normal(size=400) > 0).astype(int)
    r = quality.fit(x, y, {0: int((y == 0).sum()), 1: int((y == 1).sum())})
    z = (x - r.centre) / r.scale @ np.array(r.weights) - r.threshold
    assert ((z >= 0) == (y == 1)).mean() > 0.95
    assert np.allclose(logistic(np.zeros((0, 2)), np.zeros(0), np.zeros(0), 1.0), 0)


def test_ranking_learns_from_all_labels(spark):
    """More labels of each class than a sample would hold: the ranking is that of all rows."""
    rnd = random.Random(11)
    rows = [(i, " ".join(rnd.choice(["ab", "Cd", "e!", "f.", "#", "long" * rnd.randrange(1, 4)]) for _ in range(rnd.randrange(1, 12)))) for i in range(36_000)]
    labels = [(i, int(t.count("#") + t.count("!") + rnd.random() < 2.2)) for i, t in rows]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    own = [(quality.features(t), y) for (i, t), (_, y) in zip(rows, labels, strict=True) if remainder(i, 3) != 1]
    y = np.array([y for _, y in own])
    assert min((y == 0).sum(), (y == 1).sum()) > 11_000
    expected = quality.fit(np.array([x for x, _ in own]), y, {0: int((y == 0).sum()), 1: int((y == 1).sum())})
    for shape in (docs, docs.repartition(7)):
        got = quality.fit_ranking(shape, marks)
        assert all(np.allclose(a, b, rtol=1e-6, atol=1e-9) for a, b in zip(got[:3], expected[:3], strict=True))
        assert abs(got.threshold - expected.threshold) < 2e-3


@pytest.mark.parametrize("few", [0, 10_000])
def test_threshold_is_the_weighted_quantile(spark, few):
    rnd = np.random.default_rng(2)
    for bad, good, sizes in ((40, 60, {0: 41, 1: 67}), (3, 50, {0: 300, 1: 53}), (50, 2, {0: 53, 1: 9}), (1, 1, {0: 1, 1: 1})):
        for s in (rnd.normal(size=bad + good), rnd.integers(0, 4, bad + good).astype(float)):
            label = np.r_[np.zeros(bad, int), np.ones(good, int)]
            order = sorted(range(len(s)), key=lambda i: (s[i], label[i]))
            share = sizes[0] / (sizes[0] + sizes[1])
            below = np.cumsum([(1 - share) / good if label[i] else share / bad for i in order])
            at = min(int(np.searchsorted(below, share)), len(s) - 2)
            table = spark.createDataFrame([(int(y), float(v)) for y, v in zip(label, s, strict=True)], "label int, strength double")
            assert quality.threshold(table, sizes, good, bad, few) == (s[order[at]] + s[order[at + 1]]) / 2


@pytest.mark.parametrize("good, bad", [(7, 3), (3, 7), (5, 5), (1, 6)])
def test_pairs_are_those_of_the_plain_fit(spark, good, bad):
    rows = [(y, i, [100.0 * y + i, *[0.0] * (quality.FEATURES - 1)]) for y, n in ((1, good), (0, bad)) for i in range(n)]
    got = quality.drawn_pairs(spark.createDataFrame(rows, "label int, at long, z array<double>"), good, bad).collect()
    n = max(good, bad)
    expected = [100.0 + i % good - (i + k * 7919 % n) % bad for i in range(n) for k in range(quality.PAIRS)]
    assert sorted(r.difference[0] for r in got) == sorted(expected)
