import numpy as np
import pytest
import xxhash
from cases import make, words

from scorefold.llm import components, simhash


def brute_fingerprint(text):
    w = words(text)
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, budget=3):
    """doc id -> smallest id reachable, by all pairs."""
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    values = np.array([f for _, f in prints], "u8")
    for a in range(len(values)):
        for b in np.flatnonzero(np.bitwise_count(values[a + 1 :] ^ values[a]) <= budget) + a + 1:
            root[find(int(b))] = find(a)
    least = {}
    for k, (i, _) in enumerate(prints):
        least[find(k)] = min(least.get(find(k), i), i)
    return {i: least[find(k)] for k, (i, _) in enumerate(prints)}


def test_fingerprints_and_components(spark):
    docs = make(spark)
    rows = simhash.near_copies(docs).collect()
    data = [(r.doc_id, r.text) for r in docs.collect()]
    prints = {i: f"{brute_fingerprint(t):016x}" for i, t in data}
    assert len(rows) == len(data)
    assert all(r.fingerprint == prints[r.doc_id] for r in rows if r.doc_id is not None)
    expected = brute_components([(10**9 if i is None else i, t) for i, t in data])
    assert all(r.component_id == expected[r.doc_id] for r in rows if r.doc_id is not None)
    assert sum(r.first for r in rows) == len({r.component_id for r in rows})
    assert simhash.one_of_each(docs).columns == docs.columns


@pytest.mark.parametrize("spread", [2, 6, 64])
@pytest.mark.parametrize("block", [16, 100_000])
def test_trie_join_finds_all_links(spark, spread, block):
    random = np.random.default_rng(spread)
    centres = random.integers(0, 2**64, 12, "u8")
    flips = np.array([sum(1 << int(b) for b in random.integers(0, 64, random.integers(0, spread))) & (2**64 - 1) for _ in range(500)], "u8")
    values = np.unique(centres[random.integers(0, 12, 500)] ^ flips)
    df = spark.createDataFrame([(int(v),) for v in values.view("i8")], "fp long")
    got = {r.node: r.root for r in simhash.near_components(df, len(values), block=block).collect()}
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(values)):
        for b in np.flatnonzero(np.bitwise_count(values ^ values[a]) <= 3):
            root[find(int(b))] = find(a)
    signed = values.view("i8").tolist()
    groups = {}
    for k in range(len(values)):
        groups.setdefault(find(k), []).append(signed[k])
    expected = {v: min(g) for g in groups.values() if len(g) > 1 for v in g}
    assert got == expected


def test_forest_is_small():
    values = np.unique(np.array([a << 8 | b for a in range(40) for b in range(256)], "u8"))
    one, two = simhash.near_links(values, None, 3)
    assert len(one) <= len(values) - 1


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(300)] + [(500, 500), (70, 71), (71, 70)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {100 + i: 100 for i in range(300)} | {70: 70, 71: 70}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty(spark):
    assert simhash.near_copies(make(spark, [])).count() == 0
