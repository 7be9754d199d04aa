import hashlib
import math

import numpy as np
import pytest

from scorefold.llm import codes


def brute(rows, parts=16, entries=64, rounds=2):
    """vec_id, code, error, label_error, digest by whole numbers of any size."""
    kept = [(i, x, l) for i, x, l in rows if x is not None and all(c is not None and math.isfinite(c) for c in x)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    size = max(1, -(-max(len(x) for _, x, _ in kept) // parts))
    whole = []
    for i, x, l in kept:
        v = [math.floor(256 * c) if abs(c) < 1e300 else 256 * int(c) for c in x]
        whole.append((i, v + [0] * (size * parts - len(v)), l))
    cut = lambda v, p: v[p * size : (p + 1) * size]
    books = [[cut(v, p) for _, v, _ in whole[:entries]] for p in range(parts)]

    def assign():
        out = []
        for _, v, _ in whole:
            d = [[sum((a - b) ** 2 for a, b in zip(cut(v, p), e)) for e in books[p]] for p in range(parts)]
            out.append([(min(x), x.index(min(x))) for x in d])
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(v, p) for (_, v, _), f in zip(whole, found) if f[p][1] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    found = assign()
    errors = [sum(d for d, _ in f) for f in found]
    labels = {}
    for (_, _, l), e in zip(whole, errors):
        labels[l] = labels.get(l, 0) + min(e, 2**63 - 1)
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(i, "".join(f"{e:02x}" for _, e in f), min(x, 2**63 - 1), min(labels[l], 2**63 - 1), digest) for (i, _, l), f, x in zip(whole, found, errors)]


def run(spark, rows, kind="float", **more):
    schema = f"vec_id long, embedding array<{kind}>, label int, near string, low int, v string, code int, error string, own int"
    df = spark.createDataFrame([(i, x, l, "n", 1, "v", 2, "e", 3) for i, x, l in rows], schema).repartition(3)
    return [tuple(r) for r in codes.vector_codes(df, **more).collect()]


def same(a, b):
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(a, key=key) == sorted(b, key=key)


def vectors(n, width, seed=3, spread=0.2):
    random = np.random.default_rng(seed)
    return [(i, [float(np.float32(c)) for c in random.normal(size=width) * spread + (i % 7) * 0.1], None if i % 5 == 0 else i % 4) for i in range(n)]


def test_against_all_entries(spark):
    rows = vectors(600, 32)
    same(run(spark, rows), brute(rows))


def test_bounds_over_many_rounds(spark, monkeypatch):
    """Small chunks, so bounds of different lengths are read together."""
    monkeypatch.setattr(codes, "CHUNK", 50)
    rows = vectors(400, 8, spread=2.0)
    same(run(spark, rows, parts=4, entries=24, rounds=6), brute(rows, 4, 24, 6))


def test_bounds_save_work():
    """After a small move nearly all parts keep their entry unmeasured, and b shrinks."""
    random = np.random.default_rng(1)
    v = np.floor(random.normal(size=(2000, 8)) * 256) / 256
    whole = [[[int(c * 256) for c in x[4 * p : 4 * p + 4]] for x in v[:64]] for p in range(2)]
    old = codes.codebooks(whole, 8.0)
    new = codes.codebooks([[[c + (e % 2) for c in x] for e, x in enumerate(b)] for b in whole], 8.0)
    kept, bounds = codes._Assign(old, 8, 1e-3).batch(v, None)
    move = codes._moves(old, new)
    part = codes._Part(v[:, :4], 0, new)
    again, _, need = codes._moved(part, kept[:, 0], bounds[:, 0], move[0])
    assert (need == 1).mean() > 0.8 and (need == 64).mean() < 0.05
    assert (again[:, 0] == ((v[:, None, :4] - new.near[0][None]) ** 2).sum(2).argmin(1)).all()
    assert codes._Assign(new, 8, 1e-3, move).batch(v, (kept, bounds))[0].shape[2] < 16


def test_odd_rows_ties_and_copies(spark):
    v = [0.5, -0.25, 1.0, 0.125] * 4
    rows = [(i, v, 1) for i in range(90)] + [(i, [-0.001 * i] * 16, None) for i in range(90, 130)]
    rows += [(200, None, 1), (201, [1.0, None], 1), (202, [float("nan")] * 16, 2), (203, [float("inf")] * 16, 2), (None, v, 2), (None, [2.0], 2), (204, [], None),
             (5, v, 1), (205, [3.0] * 5, 3)]
    same(run(spark, rows, "double"), brute(rows))


@pytest.mark.parametrize("size", [2.0**20, 2.0**30, 1e150, 1e200, 1e307])
def test_large_components(spark, size):
    random = np.random.default_rng(9)
    rows = [(i, [float(c) for c in random.normal(size=16) * (size if i % 3 else 1.0)], i % 2) for i in range(120)]
    rows += [(1000 + i, rows[3][1], 7) for i in range(3)]
    same(run(spark, rows, "double", entries=16), brute(rows, entries=16))


def test_few_and_none(spark):
    assert run(spark, []) == [] and run(spark, [(1, None, 2)]) == []
    same(run(spark, [(3, [0.1] * 16, 1)]), brute([(3, [float(np.float32(0.1))] * 16, 1)]))
    with pytest.raises(ValueError):
        run(spark, [], entries=257)
