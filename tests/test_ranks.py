"""Medians and numbered labels without a task that holds them all."""

import math
import random
import re
import statistics

import pytest

from scorefold.operators import ranks

ODD = [0.0, -0.0, 5e-324, -5e-324, 1e-310, 2.2250738585072014e-308, 1e-300, 1.0, math.nextafter(1.0, 0), math.nextafter(1.0, 2), 2.0, math.nextafter(2.0, 0),
       1e308, 1.7976931348623157e308, -1.7976931348623157e308, 0.1, 0.3, 2.0**-1000, math.nextafter(2.0**-1000, 0), 4096.5, 1023.9999999999999, 1024.0]


def test_ranges_order_as_values_do(spark):
    rng = random.Random(5)
    values = ODD + [rng.uniform(-10, 10) for _ in range(500)] + [rng.choice((-1, 1)) * 2 ** rng.uniform(-1070, 1020) for _ in range(1500)]
    values += [math.nextafter(2.0**k, d) for k in range(-990, 1000, 7) for d in (0, math.inf)]
    df = spark.createDataFrame([(v,) for v in values], "x double").coalesce(1)
    got = sorted((r.x, r.r) for r in df.select("x", ranks.range_of(df["x"]).alias("r")).collect())
    assert all(a[1] <= b[1] for a, b in zip(got, got[1:]) if a[0] < b[0])
    assert len({r for _, r in got}) > 1500 and all(abs(r) < 2 ** 24 for _, r in got)


def brute(rows):
    found = {}
    for k, x, n in rows:
        if x is not None and x == x and n and n > 0:
            found.setdefault(k, []).extend([x] * n)
    return {k: statistics.median_low(v) * 0.5 + statistics.median_high(v) * 0.5 for k, v in found.items()}


@pytest.mark.parametrize("draw", ["marks", "continuous", "close", "wide"])
def test_medians(spark, draw):
    rng = random.Random(draw)
    value = {
        "marks": lambda: rng.randrange(0, 101) / 10, "continuous": lambda: rng.gauss(6, 2), "close": lambda: 9 + rng.random() * 1e-9,
        "wide": lambda: rng.choice((-1, 1)) * 2 ** rng.uniform(-1070, 1020),
    }[draw]
    rows = [(rng.choice((1, 1, 1, 2, 3)), value(), rng.choice((1, 1, 2, 5))) for _ in range(3000)]
    rows += [(4, value(), 1), (5, value(), 2), (6, 1.0, 1), (6, 2.0, 1), (7, None, 3), (7, float("nan"), 2), (8, 1.0, 0), (None, 1.0, 1), (None, 1.0001, 1), (None, 1.00010001, 3)]
    df = spark.createDataFrame(rows, "k int, x double, n int").repartition(5)
    got = {r.k: r.median for r in ranks.medians(df, ["k"], "x", "n").collect()}
    assert got == brute(rows)


def test_a_hot_key_is_spread_and_nothing_is_buffered(spark):
    df = spark.range(200_000).selectExpr("if(id % 10 < 3, 0, id % 500) as k", "rand(7) * 10 as x", "1 as n")
    found = ranks.medians(df, ["k"], "x", "n")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("percentile|collect_|Cartesian|NestedLoop", plan)
    rows = {r.k: r.m for r in df.groupBy("k").agg({"x": "median"}).withColumnRenamed("median(x)", "m").collect()}
    got = {r.k: r.median for r in found.collect()}
    assert got.keys() == rows.keys() and all(abs(got[k] - rows[k]) < 1e-12 for k in got)
    # the running counts read the hot key as at most one row per range, then a few values
    assert df.where("k = 0").select(ranks.range_of(df["x"]).alias("r")).groupBy("r").count().agg({"count": "max"}).first()[0] < 60


def test_label_index(spark):
    labels = ["b"] * 3 + ["a"] * 3 + ["c"] * 5 + [None] * 2 + ["d"]
    df = spark.createDataFrame([(i, x, "n") for i, x in enumerate(labels)], "i int, label string, n string").repartition(3)
    got = ranks.label_index(df, "label")
    assert got.columns == ["i", "label", "n", "ml_label"]
    want = {"c": 0.0, "a": 1.0, "b": 2.0, "d": 3.0, None: None}
    assert sorted((r.i, r.ml_label) for r in got.collect()) == [(i, want[x]) for i, x in enumerate(labels)]
    assert ranks.label_index(df.limit(0), "label").collect() == []


def test_a_label_for_nearly_every_row(spark):
    df = spark.range(300_000).selectExpr("concat('l', id % 200000) as label")
    found = ranks.label_index(df, "label").distinct()
    facts = found.selectExpr("count(*)", "min(ml_label)", "max(ml_label)", "count(distinct ml_label)").first()
    assert tuple(facts) == (200_000, 0.0, 199_999.0, 200_000)
