"""All numbers of centres in one pass, against separate fits and Spark's evaluator."""

import random

import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator

from scorefold.operators import kselect
from scorefold.operators.clustering import VECTOR, assemble
from scorefold.operators.joint_kmeans import fit_together

XYZ = ["x", "y", "z z"]


@pytest.fixture(scope="module")
def groups(spark):
    rng = random.Random(5)
    middles = [(0, 0, 0), (9, 0, 2), (0, 8, 1), (12, 11, -3), (-7, 5, 6)]
    rows = [tuple(rng.gauss(m, 0.6) for m in rng.choice(middles)) for _ in range(1500)]
    rows += [(9.0, 0.0, 2.0)] * 700  # one row makes up a third of all
    return spark.createDataFrame(rows, "x double, y double, `z z` double").repartition(6).persist()


def test_as_good_as_separate_fits(groups):
    vectors = assemble(groups, ["x", "y"]).select(VECTOR).persist()
    fits = fit_together(groups, ["x", "y"], [2, 3, 4, 5])
    for k, fit in fits.items():
        best = min(KMeans(k=k, seed=s, featuresCol=VECTOR).fit(vectors).summary.trainingCost for s in range(3))
        assert fit.cost <= 1.01 * best
    assert all(a.cost >= b.cost for a, b in zip(list(fits.values()), list(fits.values())[1:]))


def test_silhouette_as_the_evaluator(groups):
    fits = fit_together(groups, XYZ, [2, 5])
    vectors = assemble(groups.withColumnRenamed("z z", "z"), ["x", "y", "z"])
    for k, fit in fits.items():
        model = KMeans(k=k, seed=3, featuresCol=VECTOR).fit(vectors)
        if abs(model.summary.trainingCost - fit.cost) < 1e-3 * fit.cost:  # the same optimum
            found = ClusteringEvaluator(featuresCol=VECTOR).evaluate(model.transform(vectors))
            assert fit.silhouette == pytest.approx(found, abs=1e-3)
    assert fits[5].silhouette > 0.9


def test_jobs_do_not_grow_with_the_number_of_k(spark, groups):
    def jobs(k_max):
        name = f"sweep-{k_max}"
        spark.sparkContext.setJobGroup(name, name)
        try:
            kselect.k_sweep(groups, ["x", "y"], 2, k_max)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    assert jobs(12) <= 60  # a round is at most two jobs, and there are at most 20, whatever k_max is


def test_odd_tables(spark):
    same = spark.createDataFrame([(1.0, 2.0)] * 20 + [(5.0, 5.0)], "x double, y double")
    assert [tuple(r) for r in kselect.k_sweep(same, ["x", "y"], 2, 6).collect()] == [(2, 0.0, pytest.approx(20 / 21))]
    holes = spark.createDataFrame([(None, "a"), (3.0, "4"), (float("nan"), "7")], "x double, y string")
    assert kselect.k_sweep(holes, ["x", "y"], 2, 9).count() == 2
    assert kselect.k_sweep(same.limit(0), ["x", "y"], 2, 4).count() == 0
    scaled = spark.createDataFrame([(float(i % 2), 1000.0 * (i // 50), 7.0) for i in range(100)], "x double, y double, c double")
    assert kselect.k_sweep(scaled, ["x", "y", "c"], 4, 4, scale=True).first()["wcss"] == pytest.approx(0, abs=1e-6)
