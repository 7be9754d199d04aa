import math
from collections import defaultdict

import pytest
from cases import make, size

from scorefold.llm import mixing


def plain_targets(sizes):
    """Water-filling by hand: cap, share out again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(3 * sizes[s] for s in capped)
        level = rest / sum(weight[s] for s in free) if free else 0
        above = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not above:
            return {s: 3 * sizes[s] if s in capped else level * weight[s] for s in order}
        capped |= above


@pytest.mark.parametrize("block", [1, 7, 256])
def test_targets_and_taken(spark, block):
    docs = make(spark)
    rows = mixing.taken(mixing.mix(docs, block_words=block)).collect()
    text = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    assert len(rows) == docs.count()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    mixed = {(r.doc_id, r.size): r for r in rows}
    for r in docs.collect():
        sizes[r.source] += size(r.text)
        target[r.source] = mixed[r.doc_id, size(r.text)].target
    by_uid = mixing.mix(docs, block_words=block)
    source = {r.uid: r.source for r in by_uid.documents.collect()}
    for r in by_uid.schedule.collect():
        taken[source[r.uid]] += r.length
        assert 1 <= r.length <= block
    expected = plain_targets(sizes)
    for s in sizes:
        assert math.isclose(target[s], expected[s], rel_tol=1e-9, abs_tol=1e-9)
        assert abs(taken[s] - expected[s]) <= 0.5 + 1e-6
    assert all(r.taken <= 3 * r.size for r in rows)
    assert all(r.size == size(text[r.doc_id]) for r in rows if r.doc_id is not None)


def test_schedule_is_spread_and_repeats(spark):
    docs = spark.createDataFrame([(i, "a b c d " * 8, "s" + str(i % 4)) for i in range(400)], "doc_id long, text string, source string")
    first = sorted(map(tuple, mixing.mix(docs, block_words=16).schedule.collect()))
    again = sorted(map(tuple, mixing.mix(docs.repartition(7), block_words=16).schedule.drop("uid").collect()))
    assert [(a, b, *c) for a, b, _, *c in first] == [tuple(x) for x in again]
    slots = sorted({(r[0], r[1]) for r in first})
    share, n = defaultdict(int), len(slots)
    for _, s in slots:
        share[s] += 1
    # any stretch of the schedule holds about each source's share
    for length in (40, 100, 300):
        for start in range(0, n - length, 37):
            for s in share:
                seen = sum(1 for _, x in slots[start : start + length] if x == s)
                assert abs(seen - length * share[s] / n) <= 2 * math.log2(n)


def test_reversed_bits(spark):
    rows = spark.range(64).select("id", mixing.reversed_bits(mixing.F.col("id"), mixing.F.lit(6)).alias("r")).collect()
    assert [r.r for r in rows] == [int(f"{r.id:06b}"[::-1], 2) for r in rows]


def test_mixed_documents_cut_at_words(spark):
    docs = spark.createDataFrame([(1, " a  b\nc d ", "x", 9), (2, "e f g h i j k l m n o p", "y", 23)], "doc_id long, text string, source string, n_chars long")
    out = mixing.mixed_documents(docs, block_words=3).collect()
    targets = plain_targets({"x": 4, "y": 12})
    for s, i in (("x", 1), ("y", 2)):
        assert abs(sum(size(r.text) for r in out if r.doc_id == i) - targets[s]) <= 0.5
        whole = [r.text for r in docs.collect() if r.doc_id == i][0]
        assert all(whole.startswith(r.text) for r in out if r.doc_id == i)


def test_empty(spark):
    docs = make(spark, [])
    assert mixing.taken(mixing.mix(docs)).count() == 0
    assert mixing.mixed_documents(docs).count() == 0
    blank = make(spark, [(1, " ", "e", "s", 1, *[None] * 6), (2, None, "e", None, 1, *[None] * 6)])
    assert [(r.size, r.target, r.taken) for r in mixing.taken(mixing.mix(blank)).collect()] == [(0, 0.0, 0)] * 2
