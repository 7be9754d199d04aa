import base64
import math
from collections import Counter
from functools import cache

import numpy as np
import pytest
from cases import make, remainder, words

from scorefold.llm import lattice

VOCAB = [b" ", b"a", b"b", b"ab", b" a", b"ba", b"aba", b" ab"]


def pieces(seed=1):
    w = np.random.default_rng(seed).dirichlet(np.ones(len(VOCAB) + 1))
    return lattice.Pieces(VOCAB, np.log(w)), w


def spelled(data, w):
    @cache
    def total(at):
        return 1.0 if at == len(data) else sum(w[i] * total(at + len(p)) for i, p in enumerate(VOCAB) if data.startswith(p, at))

    return total(0)


@pytest.mark.parametrize("word", [b"a", b"ab", b"abab", b"babab" * 3, b"ab" * 40])
def test_sum_over_all_segmentations(word):
    model, w = pieces()
    assert math.isclose(model.word(word), math.log(spelled(b" " + word, w)), rel_tol=1e-9)
    assert model.word(b"c") == -math.inf


def test_expected_counts():
    model, w = pieces()
    data, got = b" abab", {}
    model.expect(b"abab", got)

    def paths(at):
        if at == len(data):
            yield ()
        for i, p in enumerate(VOCAB):
            if data.startswith(p, at):
                yield from ((i, *rest) for rest in paths(at + len(p)))

    mass = {p: math.prod(w[i] for i in p) for p in paths(0)}
    expected = Counter()
    for p, m in mass.items():
        for i in p:
            expected[i] += m / sum(mass.values())
    assert got.keys() == expected.keys() and all(math.isclose(got[i], expected[i], rel_tol=1e-9) for i in got)


@pytest.mark.parametrize("word", [b"ab" * 40, b"babba" * 9])
def test_expected_counts_of_long_words(word):
    model, w = pieces()
    data, got, expected = b" " + word, {}, Counter()
    for i in range(len(data)):
        for k, p in enumerate(VOCAB):
            if data.startswith(p, i):
                expected[k] += spelled(data[:i], w) * w[k] * spelled(data[i + len(p) :], w) / spelled(data, w)
    model.expect(word, got)
    assert all(math.isclose(got.get(k, 0.0), n, rel_tol=1e-9) for k, n in expected.items() if n > 0)


def test_weights_come_from_all_words_in_every_round(spark):
    random = np.random.default_rng(4)
    some = sorted({bytes(random.choice([97, 98], random.integers(14, 23), p=[0.6, 0.4]).astype("u1")) for _ in range(30_000)})
    assert len(some) > 20_000
    weights = None
    for _ in range(5):
        got, guess = {}, lattice.Pieces(VOCAB, weights)
        for word in some:
            guess.expect(word, got)
        weights = lattice.weights_of(np.array([*[got.get(i, 0.0) for i in range(len(VOCAB))], 1.0]), lattice.PIECE_PRIOR)
    counts = spark.createDataFrame([(bytearray(w), 1) for w in some], "word binary, c long")
    assert np.allclose(lattice.piece_weights(counts, VOCAB), weights, rtol=0, atol=1e-9)


def vocabulary(tmp_path):
    path = tmp_path / "pieces"
    path.write_bytes(b"\n".join(base64.b64encode(bytes([b])) + b" %d" % b for b in range(256)) + b"\n" + base64.b64encode(b"th") + b" 256\n")
    return str(path)


@pytest.mark.parametrize("head", [0, 3, 10_000])
def test_scores(spark, tmp_path, head):
    docs = make(spark)
    rows = lattice.likelihood(docs, path=vocabulary(tmp_path), head_words=head).collect()
    data = [(r.doc_id, r.text) for r in docs.collect()]
    counts, ends = Counter(), 0
    for i, t in data:
        if remainder(i, 5) != 1:
            counts.update(words(t))
            ends += 1
    total, distinct = sum(counts.values()) + ends, len(counts) + 1
    base = lambda c: math.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))
    assert len(rows) == len(data)
    text = dict(data)
    for r in rows:
        if r.doc_id is None:
            continue
        w = words(text[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w) + 1, sum(x in counts for x in w) + 1, total)
        assert math.isclose(r.base_score, sum(base(counts[x]) for x in w) + base(ends), rel_tol=1e-9)
        assert r.held_out == (remainder(r.doc_id, 5) == 1)
        assert r.score < 0 and math.isfinite(r.score) and r.lattice_score < 0
    again = {r.doc_id: r.score for r in lattice.likelihood(docs, path=vocabulary(tmp_path), head_words=2).collect()}
    assert all(math.isclose(again[r.doc_id], r.score, rel_tol=1e-9) for r in rows if r.doc_id is not None)


def test_head_has_no_long_words(spark):
    counts = spark.createDataFrame([(bytearray(b"x" * n), 9) for n in (1, 64, 65, 100_000)], "word binary, c long")
    assert sorted(map(len, lattice.head_of(counts, 10))) == [1, 64]


def test_mixture_is_a_distribution():
    """Over all words the mixture sums to one less what longer words have."""
    model, w = pieces(2)
    counts = {b"a": 5, b"abab": 2, b"b": 1}
    total, distinct, ends = 11, 4, 3
    m = lattice.Model(model, total, distinct, 0.5)
    level, mass = [b""], 10 ** m.mixed(ends, model.end)
    for _ in range(9):
        level = [x + y for x in level for y in (b"a", b"b")]
        mass += sum(10 ** m.mixed(counts.get(x, 0), model.word(x)) for x in level)
    assert 0.5 < mass <= 1 + 1e-9


def test_empty(spark):
    assert lattice.likelihood(make(spark, [])).count() == 0
    only_held = [i for i in range(50) if remainder(i, 5) == 1][:2]
    rows = lattice.likelihood(make(spark, [(i, "a b", *[None] * 9) for i in only_held])).collect()
    assert all((r.train_tokens, r.n_known, r.held_out) == (0, 0, True) and math.isfinite(r.score) for r in rows)
