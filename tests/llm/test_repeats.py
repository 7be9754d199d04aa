import random
from collections import defaultdict

import numpy as np
import pytest
from cases import make, words

from scorefold.llm import repeats


def covered(rows, n):
    """doc id -> set of words that lie in n consecutive words which another document has too."""
    where, out = defaultdict(set), defaultdict(set)
    for i, t in rows:
        w = words(t)
        for s in range(len(w) - n + 1):
            where[tuple(w[s : s + n])].add(i)
    for i, t in rows:
        w = words(t)
        for s in range(len(w) - n + 1):
            if len(where[tuple(w[s : s + n])]) > 1:
                out[i].update(range(s, s + n))
    return dict(out)


def found(df, **options):
    out, seen = defaultdict(set), []
    for r in repeats.shared_passages(df, **options).collect():
        span = set(range(r.first_word, r.first_word + r.words))
        assert not span & out[r.doc_id] and r.other_doc_id != r.doc_id
        out[r.doc_id] |= span
        seen.append(r)
    return dict(out), seen


def test_odd_documents(spark):
    docs = make(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None]
    got, seen = found(docs)
    assert got == covered(rows, 50) and {10, 11, 7, 15} <= set(got) and 14 not in got
    assert {r.doc_id: r.other_doc_id for r in seen if r.doc_id in (7, 15)} == {7: 15, 15: 7}


@pytest.mark.parametrize("n, seed", [(8, 3), (8, 8), (8, 1), (20, 6)])
def test_edited_copies(spark, n, seed):
    """Passages cut, edited and joined at random: the words found are those of the definition."""
    rnd = random.Random(n * seed)
    stock = [[f"v{rnd.randrange(40)}" for _ in range(120)] for _ in range(6)] + [["x"] * 60, ["y", "z"] * 30]
    docs = []
    for i in range(160):
        w = []
        for _ in range(rnd.randrange(4)):
            s = rnd.choice(stock)
            a = rnd.randrange(len(s))
            w += s[a : a + rnd.randrange(3 * n)] + [f"own{rnd.randrange(10**6)}" for _ in range(rnd.randrange(4))]
        for _ in range(rnd.randrange(4)):
            if w:
                w[rnd.randrange(len(w))] = f"edit{rnd.randrange(10**6)}"
        docs.append((i, " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(df, min_words=n, seed=seed)[0] == covered(docs, n)


def test_hot_passage(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    docs = [(i, f"a{i} b{i} " + (passage if i % 3 == 0 else f"c{i}") + f" d{i}") for i in range(900)]
    got, _ = found(spark.createDataFrame(docs, "doc_id long, text string"))
    assert got == {i: set(range(2, 57)) for i in range(0, 900, 3)}


def test_minimisers_depend_on_the_window_only():
    x = np.random.default_rng(0).integers(0, 5, 400).astype("u8")
    got = repeats.minimisers(x, 391, 10)
    assert all(got[s] == s + int(np.argmin(x[s : s + 10])) for s in range(391))


def test_hashes_tell_words_apart():
    h = repeats.word_hashes([b"a", b"b", b"ab", b"ba", b"a\x00", b"a", b"abc"])
    assert h[0] == h[5] and len(set(h.tolist())) == 6


def test_empty(spark):
    assert repeats.shared_passages(make(spark, [])).count() == 0
