"""Job matching against all pairs."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from scorefold.operators import matching


def bag(text):
    return Counter(re.findall(r"[^\W_]+[+#]*", (text or "").lower()))


def brute(seekers, postings, k, least):
    bags = [(i, bag(t)) for i, t in postings]
    df = Counter(t for _, b in bags for t in b)
    idf = {t: math.log((1 + len(postings)) / (1 + n)) + 1 for t, n in df.items()}

    def vector(b):
        w = {t: n * idf[t] for t, n in b.items() if t in idf}
        length = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / length for t, x in w.items()}

    jobs, out = [(i, vector(b)) for i, b in bags], []
    for s, text in seekers:
        own = vector(bag(text))
        found = [(-round(sum(x * v.get(t, 0) for t, x in own.items()), 6), i is None, i) for i, v in jobs]
        best = sorted(((c, n, i or 0) for c, n, i in found if -c >= least))[:k]
        out += [(s, r + 1, None if n else i, -c) for r, (c, n, i) in enumerate(best)]
    return sorted(out, key=str)


def run(spark, seekers, postings, **more):
    a = spark.createDataFrame(seekers, "ma_sv int, skills string").repartition(3)
    b = spark.createDataFrame([(i, t, "x", 1) for i, t in postings], "posting int, text string, bag string, n int").repartition(3)
    return sorted(map(tuple, matching.match_jobs(a, b, **more).collect()), key=str)


@pytest.mark.parametrize("least", [0.01, 0.1, 0.3, 0.7, 1.0])
def test_against_all_pairs(spark, least):
    """Frequencies as in real texts: a few terms in nearly all postings, most in few."""
    random = np.random.default_rng(3)
    words = [f"w{i}" for i in range(200)]
    draw = lambda n: " ".join(random.choice(words, n, p=(p := 1 / np.arange(1, 201)) / p.sum()))
    postings = [(i, draw(random.integers(1, 12))) for i in range(400)]
    seekers = [(i, draw(random.integers(1, 8))) for i in range(60)]
    assert run(spark, seekers, postings, k=7, min_cosine=least, block=16) == brute(seekers, postings, 7, least)


def test_repeated_texts_ties_and_nulls(spark):
    postings = [(i, "Java, C++ and SQL") for i in range(40)] + [(100, "c# java"), (101, None), (102, ""), (103, "SQL sql java"), (None, "java"), (104, "sql and C++, java")]
    seekers = [(1, "java, c++"), (1, "java, c++"), (2, None), (3, "cobol"), (None, "sql"), (4, "C#")]
    got = run(spark, seekers, postings, k=12)
    assert got == brute(seekers, postings, 12, 0.1)
    assert [r[2] for r in sorted(got, key=lambda r: (str(r[0]), r[1])) if r[0] == 1][:4] == [0, 0, 1, 1]
    assert run(spark, [], postings) == [] and run(spark, seekers, []) == []
    with pytest.raises(ValueError):
        run(spark, seekers, postings, min_cosine=0.0)


def test_common_terms_do_not_make_pairs(spark):
    """A term of all postings begins none of them: what meets is a fraction of all pairs."""
    postings = [(i, f"teamwork english rare{i % 500} other{i % 300}") for i in range(2000)]
    seekers = spark.createDataFrame([(i, f"teamwork rare{i}") for i in range(100)], "ma_sv int, skills string")
    jobs = spark.createDataFrame(postings, "posting int, text string")
    found = matching.match_jobs(seekers, jobs, k=3, min_cosine=0.6)
    assert found.count() == 300
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
