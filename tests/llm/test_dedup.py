import hashlib
from collections import Counter, defaultdict

import numpy as np
from cases import make, own
from hypothesis import given
from hypothesis import strategies as st

from scorefold.llm import dedup


@given(st.lists(st.lists(st.sampled_from([0, 1, 2**32, 2**32 + 1, 2**63, 2**64 - 1, 12345]), max_size=20), min_size=1, max_size=5))
def test_filters_merge_without_loss(parts):
    filters = []
    for part in parts:
        values, counts = np.unique(np.array(part, "u8"), return_counts=True)
        filters.append(dedup.filter_of(values, counts.astype("i8")))
    values, counts = dedup.entries_of(dedup.merged(filters))
    assert dict(zip(values.tolist(), counts.tolist())) == dict(Counter(x for p in parts for x in p))
    assert (np.diff(values.astype(object)) > 0).all()


@given(st.lists(st.tuples(st.integers(0, 2**54 - 1), st.sampled_from([1, 2, 3, 4, 5, 1000, 2**40, 2**62])), max_size=60), st.sampled_from([0, 3, 10]))
def test_filters_keep_any_counts(entries, prefix_bits):
    top = 5 % (1 << prefix_bits) << (64 - prefix_bits)
    held = {top | x >> prefix_bits: n for x, n in entries}
    values = np.array(sorted(held), "u8")
    counts = np.array([held[int(v)] for v in values], "i8")
    got = dedup.entries_of(dedup.filter_of(values, counts, prefix_bits))
    assert got[0].tolist() == values.tolist() and got[1].tolist() == counts.tolist()


def test_filters_of_many(spark):
    """Crowded quotients, runs beyond the last slot, and less than half the bytes of plain entries."""
    rnd = np.random.default_rng(5)
    for values in (rnd.integers(0, 2**64 - 1, 200_000, "u8"), np.arange(2**64 - 3000, 2**64 - 1, dtype="u8"), np.arange(100_000, dtype="u8") << np.uint64(3)):
        values = np.unique(values)
        counts = rnd.integers(1, 4, len(values))
        data = dedup.filter_of(values, counts)
        got = dedup.entries_of(data)
        assert (got[0] == values).all() and (got[1] == counts).all()
    plain = np.unique(rnd.integers(0, 2**64 - 1, 100_000, "u8"))
    assert len(dedup.filter_of(plain, np.ones(len(plain), "i8"))) < 10 * len(plain)


def test_groups(spark):
    docs = make(spark)
    rows = dedup.exact_groups(docs).collect()
    data, groups = docs.collect(), defaultdict(list)
    for r in data:
        groups[own(r.text)].append(r)
    assert len(rows) == len(data) and len({r.uid for r in rows}) == len(data)
    kept = Counter(r.text_sha256 for r in rows if r.kept)
    assert all(n == 1 for n in kept.values()) and len(kept) == len(groups)
    by = {hashlib.sha256(k.encode()).hexdigest(): g for k, g in groups.items()}
    for r in rows:
        g = by[r.text_sha256]
        best = min(g, key=lambda x: (-len(x.text or ""), x.doc_id is None, x.doc_id or 0))
        assert (r.keep_id, r.group_size) == (best.doc_id, len(g))
        assert not r.kept or r.doc_id == r.keep_id


def test_hot_group_and_colliding_filters(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same text', concat('text ', id % 1500)) as text")
    rows = dedup.exact_groups(docs).collect()
    assert sum(r.kept for r in rows) == len({"same" if i % 3 == 0 else i % 1500 for i in range(3000)})
    assert {r.group_size for r in rows if r.doc_id % 3 == 0} == {1000}


def test_without_copies_keeps_columns(spark):
    docs = make(spark)
    out = dedup.without_copies(docs)
    assert out.columns == docs.columns
    assert out.count() == len({own(r.text) for r in docs.collect()})
    assert dedup.exact_groups(make(spark, [])).count() == 0
