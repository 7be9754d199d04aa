"""Clusters: guards, invariants, fixed centres against brute force, choice of k."""

import random

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import functions as F

from scorefold import labels
from scorefold.operators import clustering, importance, kselect
from scorefold.plans import career, inputs, students
from scorefold.plans import subjects as subject_plans
from scorefold.plans import training
from scorefold.session import durable, scratch_path
from scorefold.sources import models

XY = ["x", "y"]


@pytest.fixture(scope="module")
def blobs(spark):
    """Three groups, one of them with two thirds of all rows."""
    rng = random.Random(5)
    middles, sizes = [(0, 0), (10, 0), (0, 10)], [400, 100, 100]
    data = [(f"{j}-{i}", j, rng.gauss(mx, 0.5), rng.gauss(my, 0.5))
            for j, ((mx, my), n) in enumerate(zip(middles, sizes)) for i in range(n)]
    return data, spark.createDataFrame(data, "id string, blob int, x double, y double").repartition(5)


def test_fit_finds_blobs(blobs):
    _, df = blobs
    model = clustering.fit_clusters(df, XY, 3, 42)
    out = clustering.apply_clusters(model, df)
    assert out.columns == [*df.columns, "prediction"]
    assert out.groupBy("blob").agg(F.count_distinct("prediction").alias("n")).filter("n > 1").count() == 0
    _, report = clustering.evaluate_model(model, df)
    assert report.first()["band"] == "RẤT TỐT"


def test_scaled_model_scales_when_scoring(blobs, spark):
    _, df = blobs
    stretched = df.withColumn("y", F.col("y") * 1000)
    model = clustering.fit_clusters(stretched, XY, 3, 42, scale=True)
    one = clustering.apply_clusters(model, stretched.filter("id = '1-0'")).first()["prediction"]
    every = clustering.apply_clusters(model, stretched).filter("blob = 1")
    assert {r["prediction"] for r in every.collect()} == {one}


def test_guards(spark):
    few = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0)] * 10, "x double, y double")
    model = clustering.fit_clusters(few, XY, 8, 42)
    assert len(clustering.model_centres(model)) == 3
    with pytest.raises(ValueError):
        clustering.fit_clusters(few.limit(1), XY, 2, 42)
    with pytest.raises(ValueError):
        clustering.check_feature_count(model, ["x", "y", "z"])
    holes = spark.createDataFrame([(None, 1.0), (2.0, None), (float(3), 3.0)], "x double, y double")
    kept = clustering.apply_clusters(clustering.fit_clusters(holes, XY, 2, 1), holes).collect()
    assert sorted(map(str, ((r["x"], r["y"]) for r in kept))) == ["(2.0, None)", "(3.0, 3.0)", "(None, 1.0)"]
    assert kselect.k_sweep(few, XY, 2, 8).count() == 2


def test_distinct_up_to(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("v"))
    assert clustering.distinct_up_to(df, 5) == 5
    assert clustering.distinct_up_to(df, 50) == 7
    tail = spark.range(1000).select(F.when(F.col("id") > 900, F.col("id")).otherwise(0).alias("v")).coalesce(1)
    assert clustering.distinct_up_to(tail, 50) == 50


def test_fixed_centres_against_numpy(blobs):
    data, df = blobs
    centres = [[0.0, 0.0], [9.0, 1.0], [1.0, 9.0], [50.0, 50.0]]
    assigned = clustering.assign_fixed_centres(df, centres, XY)
    points = {r[0]: np.array(r[2:]) for r in data}
    got = {r["id"]: r for r in assigned.collect()}
    for key, p in points.items():
        d = [float(((p - np.array(c)) ** 2).sum()) for c in centres]
        assert got[key]["cluster"] == int(np.argmin(d))
        assert got[key]["sq_dist"] == pytest.approx(min(d))
    total = sum(r["sq_dist"] for r in got.values())
    assert sum(r["wcss"] for r in clustering.wcss(assigned).collect()) == pytest.approx(total)
    # cluster 3 stays empty and must not disturb the others
    values = {r["id"]: r["silhouette"] for r in clustering.silhouette(assigned, 4, XY).collect()}
    groups = {c: [k for k, r in got.items() if r["cluster"] == c] for c in range(3)}
    for key in list(points)[::37]:
        mean = {c: np.mean([((points[key] - points[o]) ** 2).sum() for o in members]) for c, members in groups.items()}
        own = got[key]["cluster"]
        a = mean[own] * len(groups[own]) / (len(groups[own]) - 1)
        b = min(v for c, v in mean.items() if c != own)
        assert values[key] == pytest.approx((b - a) / max(a, b), abs=1e-9)


def test_silhouette_equals_evaluator(blobs):
    _, df = blobs
    model = clustering.fit_clusters(df, XY, 4, 7)
    centres = clustering.model_centres(model)
    ours = clustering.silhouette(clustering.assign_fixed_centres(df, centres, XY), len(centres), XY).agg(F.avg("silhouette")).first()[0]
    theirs = ClusteringEvaluator().evaluate(model.transform(df))
    assert ours == pytest.approx(theirs, abs=1e-9)


def test_silhouette_of_single_rows(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (9.0, 9.0)], "x double, y double")
    assigned = clustering.assign_fixed_centres(df, [[0.0, 0.0], [9.0, 9.0]], XY)
    got = {(r["x"], r["y"]): r["silhouette"] for r in clustering.silhouette(assigned, 2, XY).collect()}
    assert got[(9.0, 9.0)] == 0.0 and got[(0.0, 0.0)] > 0.9


def test_rank_labels(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (3,), (9,), (None,)], "cluster int")
    centres = [[1.0, 5.0], [3.0, 0.0], [2.0, 0.0], [1.0, 9.0]]
    out = clustering.rank_labels(df, centres, XY, labels.READINESS_LABELS, "label")
    got = {r["cluster"]: (r["rank"], r["label"]) for r in out.collect()}
    high, mid, low = labels.READINESS_LABELS
    assert got[1] == (0, high) and got[2] == (1, mid) and got[3] == (2, low) and got[0] == (3, low)
    assert got[9] == (None, labels.UNKNOWN_LABEL) and got[None] == (None, labels.UNKNOWN_LABEL)
    beyond = clustering.rank_labels(df, centres, XY, ["only"], "label", beyond="rest")
    assert {r["cluster"]: r["label"] for r in beyond.collect()}[2] == "rest"


def metrics(spark, *rows):
    return spark.createDataFrame(rows, kselect.METRICS_SCHEMA)


def test_choose_k(spark):
    # brute force over the definition
    def expected(rows):
        ks, w, s = zip(*rows)
        by_silhouette = ks[s.index(max(s))]
        drops = [w[i - 1] - w[i] for i in range(1, len(w))]
        bends = [drops[i - 1] - drops[i] for i in range(1, len(drops))]
        elbow = ks[bends.index(max(bends)) + 1] if bends else ks[len(ks) // 2]
        span = max(w) - min(w)
        score = [0.7 * x * 100 + 0.3 * ((max(w) - y) / span * 100 if span else 0) for x, y in zip(s, w)]
        combined = ks[score.index(max(score))]
        return by_silhouette, elbow, combined, combined if combined in (by_silhouette, elbow) else by_silhouette

    rng = random.Random(11)
    tables = [
        [(2, 100.0, 0.5), (3, 40.0, 0.8), (4, 35.0, 0.6), (5, 33.0, 0.4)],
        [(2, 100.0, 0.50), (3, 50.0, 0.49), (4, 10.0, 0.48), (5, 9.0, 0.2)],
        [(2, 5.0, 0.3), (3, 5.0, 0.3), (4, 5.0, 0.3)],
        [(2, 9.0, 0.1), (3, 4.0, 0.2)],
        [(4, 9.0, 0.1)],
    ]
    tables += [[(k, round(rng.uniform(0, 100), 1), round(rng.uniform(0, 1), 2)) for k in range(2, 9)] for _ in range(6)]
    for rows in tables:
        shuffled = rows[:]
        rng.shuffle(shuffled)
        table = metrics(spark, *shuffled)
        assert tuple(kselect.choose_k(table).first()) == expected(rows), rows
        assert kselect.default_k(table).first()[0] == rows[len(rows) // 2][0]


def test_sweep_invariants(blobs):
    _, df = blobs
    rows = kselect.k_sweep(df, XY, 2, 5).orderBy("k").collect()
    assert [r["k"] for r in rows] == [2, 3, 4, 5]
    assert all(a["wcss"] >= b["wcss"] * 0.9 for a, b in zip(rows, rows[1:]))
    assert all(-1 <= r["silhouette"] <= 1 for r in rows)
    assert kselect.suggest_k(df, XY, 2, 5)[0] == 3
    assert kselect.suggest_k(df, XY, 2, 5, auto_select=False)[0] == 4


def test_save_and_load(spark, blobs):
    _, df = blobs
    model = clustering.fit_clusters(df, XY, 3, 42, scale=True)
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    models.save_model(model, path)
    loaded = models.load_or(path)
    a = {r["id"]: r["prediction"] for r in clustering.apply_clusters(model, df).collect()}
    b = {r["id"]: r["prediction"] for r in clustering.apply_clusters(loaded, df).collect()}
    assert a == b
    absent = scratch_path(spark, "absent")
    assert models.load_or(absent, "passthrough") is None
    assert models.load_or(absent, "fit", lambda: model) is model
    with pytest.raises(RuntimeError):
        models.load_or(absent)
    with pytest.raises(ValueError):
        models.load_or(absent, "shrug")


def test_importance(spark):
    rng = random.Random(2)
    data = [(float(rng.randrange(5)), float(rng.randrange(5)), 0.0) for _ in range(300)]
    df = spark.createDataFrame([(a, b, c, "hi" if a > 2 else "lo") for a, b, c in data],
                               "`_17426_4` double, `_17434_4` double, `_const_4` double, nhom_san_sang string")
    rows = importance.feature_importance(df).collect()
    assert rows[0]["subject"] == "17426" and rows[0]["percent"] > 50
    assert "const" not in {r["subject"] for r in rows}
    assert importance.feature_importance(df.drop("nhom_san_sang")).count() == 0
    assert importance.feature_importance(df.select("nhom_san_sang")).count() == 0
    assert importance.feature_importance(df.filter("nhom_san_sang = 'hi'")).count() == 0


def test_risk_pipeline(spark, sf_dir):
    wide = durable(inputs.cohort(spark, sf_dir))
    model, clusters, report = students.train_risk(wide, k=4)
    assert clusters.count() == wide.count() and -1 <= report.first()["silhouette"] <= 1
    scored = students.score_risk(wide, model)
    assert scored.columns == students.RISK_COLUMNS
    means = {r["prediction"]: r["g"] for r in scored.groupBy("prediction").agg(F.avg("gpa").alias("g")).collect()}
    # profiles 2, 0, 3, 1 are the risk positions 0..3
    assert means[2] < means[0] < means[3] < means[1]
    assert scored.first()["prediction"] == 2
    assert students.score_risk(wide, None) is wide
    for k in (2, 3, 6):
        assert students.train_risk(wide, k=k)[1].count() == wide.count()
    with pytest.raises(ValueError):
        students.risk_features(wide, "guess")


def test_career_pipeline(spark, sf_dir):
    wide = durable(inputs.cohort(spark, sf_dir))
    model, sweep = career.train_readiness(wide)
    assert sweep.count() == 5
    every = career.analyze_students(wide, inputs.market(spark, sf_dir), model=model)
    some = career.analyze_students(wide, inputs.market(spark, sf_dir), keyword="0007", model=model)
    groups = {r["ma_sv"]: r["nhom_san_sang"] for r in every.collect()}
    found = some.collect()
    assert 0 < len(found) < len(groups)
    # a search never changes a student's group
    assert all(groups[r["ma_sv"]] == r["nhom_san_sang"] for r in found)
    nobody = career.analyze_students(wide, None, keyword="no such student", model=model)
    assert nobody.count() == 0 and "top_matched_jobs" in nobody.columns
    share, lines = career.readiness_summary(every)
    assert share.agg(F.sum("percent")).first()[0] == pytest.approx(100) and lines.count() == 20


def test_subject_pipeline(spark, sf_dir):
    stats = durable(inputs.stats(spark, sf_dir))
    model, sweep = subject_plans.train_subject_quality(stats, sweep=True, k_max=4)
    assert sweep.count() == 3
    everything = subject_plans.analyze_subjects(stats, model=model)
    assert set(r[0] for r in everything.select("ChatLuong").distinct().collect()) <= set(labels.SUBJECT_CLUSTER_LABELS)
    means = {r["ChatLuong"]: r["tb"] for r in everything.groupBy("ChatLuong").agg(F.avg("TB").alias("tb")).collect()}
    ranked = [means[c] for c in labels.SUBJECT_CLUSTER_LABELS if c in means]
    assert ranked == sorted(ranked, reverse=True)
    chosen = subject_plans.analyze_subjects(stats, codes=["1", "2", "nope"], model=model, quality="collapsed")
    assert chosen.count() == 2
    with pytest.raises(ValueError):
        subject_plans.analyze_subjects(stats, quality="best")


def test_training_by_kind(spark, sf_dir):
    wide = durable(inputs.cohort(spark, sf_dir))
    stats = durable(inputs.stats(spark, sf_dir))
    path = scratch_path(spark, "trained")
    model = training.train("student", wide, 4, path)
    assert clustering.model_centres(models.load_or(path)) == clustering.model_centres(model)
    assert training.train("readiness", wide, 3).stages[-1].getPredictionCol() == "cluster"
    assert len(training.train("subject", stats, 4).stages) == 3
    assert training.evaluate_k("subject", stats, 2, 3).count() == 2
    with pytest.raises(ValueError):
        training.train("student_analysis", wide, 4)


def test_lowered_k_is_logged(spark, caplog):
    few = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0)], "x double, y double")
    clustering.fit_clusters(few, XY, 5, 1)
    assert "k lowered from 5 to the 2" in caplog.text


def test_repeated_students_train_once(spark):
    wide = spark.createDataFrame([("a", "n", 10.0, 4.0), ("a", "n", 2.0, None), ("b", "m", 7.0, 7.0)], "ma_sv string, ho_ten string, `1` double, `2` double")
    got = {r["ma_sv"]: r for r in students.risk_features(wide).collect()}
    assert len(got) == 2 and got["a"]["gpa"] == (4 + 1 + 0 + 0) / 4 and got["a"]["failed_subjects"] == 2
    from scorefold.operators import scores

    long = {r["ma_sv"]: r for r in scores.student_features(scores.unpivot_scores(wide)).collect()}
    for k, r in got.items():
        assert [r[c] for c in labels.STUDENT_FEATURES] == pytest.approx([long[k][c] for c in labels.STUDENT_FEATURES])

