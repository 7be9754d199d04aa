import numpy as np
from cases import make, words

import corpus_pipeline
from scorefold.llm import resemblance


def brute_shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute_stays(rows):
    """The smallest id of each group, by all pairs."""
    sets, root = [brute_shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if similarity(sets[a], sets[b]) >= 0.8:
                root[find(a)] = find(b)
    return sorted({find(k): min(rows[j][0] for j in range(len(rows)) if find(j) == find(k)) for k in range(len(rows))}.values())


def planted():
    """Texts of 40 to 400 words, each with a copy that shares 0.7 to 0.97 of its shingles, and a chain of copies of copies."""
    random, rows = np.random.default_rng(5), []
    for i in range(60):
        text = [f"v{x}" for x in random.integers(0, 5000, random.integers(40, 400))]
        share = random.uniform(0.7, 0.97)
        cut = round(len(text) * (1 - share))
        copy = text[: len(text) - cut] if i % 2 else [*text[: len(text) - cut // 2], *[f"n{i}x{x}" for x in range(cut // 2)]]
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(copy))]
    text = [f"c{x}" for x in range(200)]
    rows += [(1000 + k, " ".join([*text[15 * k :], *[f"d{x}" for x in range(15 * k)]])) for k in range(8)]
    return rows


def test_stage_drops_copies_of_similarity_080(spark, sf_dir):
    rows = planted()
    docs = make(spark, [(i, t, *[None] * 9) for i, t in rows])
    got = sorted(r.doc_id for r in corpus_pipeline.without_near_copies(spark, docs, sf_dir).collect())
    assert got == brute_stays(rows) and 40 < len(got) < 100


def test_blocks_and_groups(spark):
    """A large group around one text, not all of it near each other, in small blocks."""
    random = np.random.default_rng(7)
    text = [f"w{x}" for x in range(120)]
    rows = []
    for i in range(150):
        t = list(text)
        for at in random.integers(0, 120, random.integers(0, 4)):
            t[at] = f"x{i}"
        rows.append((i, " ".join(t)))
    sets = {i: resemblance.shingles(t) for i, t in rows}
    signed = [(i, resemblance.signature(s)) for i, s in sets.items()]
    values = spark.createDataFrame(
        [(i, resemblance.bands(s).view("i8").tolist(), bytearray(s.astype("<u2").tobytes())) for i, s in signed], "key long, bands array<long>, places binary"
    )
    whole = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in sets.items()], "key long, values binary")
    found = {r.node: r.root for r in resemblance.near_components(values, lambda keys: whole.join(keys, "key"), block=16).collect()}
    assert sorted({found.get(i, i) for i, _ in rows}) == brute_stays(rows)


def test_odd_rows(spark):
    docs = make(spark)
    out = resemblance.one_of_each(docs)
    assert out.columns == docs.columns
    got = [r.doc_id for r in out.collect()]
    rows = [(10**9 if r.doc_id is None else r.doc_id, r.text) for r in docs.collect()]
    assert sorted(10**9 if x is None else x for x in got) == brute_stays(rows)
    assert resemblance.one_of_each(make(spark, [])).count() == 0


def test_simhash_links_are_candidates(spark):
    """Near copies that fingerprints bring together are found without any equal band; what only fingerprints link is not dropped."""
    text = [f"w{x}" for x in range(3000)]
    rows = [(0, " ".join(text)), (1, " ".join([*text[:2990], *[f"x{x}" for x in range(10)]])), (2, " ".join(f"y{x}" for x in range(3000)))]
    fps = [resemblance.fingerprint(resemblance.shingles(t)) & (2**64 - 1) for _, t in rows]
    assert (fps[0] ^ fps[1]).bit_count() <= 3 < (fps[0] ^ fps[2]).bit_count()
    for i, t in rows:
        hashes = [int(x) for x in resemblance._mixed(resemblance.shingles(t))]
        assert fps[i] == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    values = spark.createDataFrame([(i, f - 2**64 if f >= 2**63 else f) for i, f in enumerate(fps)] + [(3, 5), (4, 5)], "key long, fp long")
    assert sorted(map(tuple, resemblance.simhash_centres(values).collect())) == [(0, 1), (3, 4)]
    # every value has bands of its own, and the last two are no copies of each other
    table = spark.createDataFrame([(i, [100 * i + b for b in range(25)], bytearray(2 * resemblance.PLACES)) for i in range(5)], "key long, bands array<long>, places binary")
    sets = {i: resemblance.shingles(t) for i, t in rows} | {3: resemblance.shingles("one two"), 4: resemblance.shingles("three")}
    whole = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in sets.items()], "key long, values binary")
    found = resemblance.near_components(table, lambda keys: whole.join(keys, "key"), centres=resemblance.simhash_centres(values))
    assert {r.node: r.root for r in found.collect()} == {0: 0, 1: 0}
    assert sorted(r.doc_id for r in resemblance.one_of_each(docs).collect()) == [0, 2]
