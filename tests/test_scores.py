"""Score tables: wide and long agree, nulls and odd columns."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from scorefold import labels
from scorefold.operators import scores

CODES = [c for codes in labels.CAREER_FIELDS.values() for c in codes]


def py_scale(x):
    if x is None or x > 10:
        return 0.0
    return next((v for floor, v in labels.SCALE4_STEPS if x >= floor), 0.0)


@pytest.fixture(scope="module")
def cohort(spark):
    rng = random.Random(7)
    data = []
    for i in range(120):
        marks = [None if rng.random() < 0.15 else round(rng.uniform(0, 10.4), 1) for _ in CODES]
        data.append((f"SV{i}", f"n{i}", *marks, 500))
    schema = "ma_sv string, ho_ten string, " + ", ".join(f"`{c}` double" for c in CODES) + ", TOEIC int"
    return data, spark.createDataFrame(data, schema)


def by_student(df):
    return {r["ma_sv"]: r for r in df.collect()}


def test_unpivot_keeps_nulls_and_pivot_restores(spark, cohort):
    data, wide = cohort
    long = scores.unpivot_scores(wide, non_score_cols=("ho_ten", "TOEIC"))
    assert long.count() == len(data) * len(CODES)
    back = by_student(scores.pivot_scores(long, CODES))
    for row in data:
        assert tuple(back[row[0]][c] for c in CODES) == row[2:-1]


def test_unpivot_mixed_types(spark):
    wide = spark.createDataFrame([("a", 7, 6.5, "x")], "ma_sv string, `1` int, `2` double, `3` string")
    assert sorted((r["ma_mon"], r["diem"]) for r in scores.unpivot_scores(wide).collect()) == [
        ("1", 7.0), ("2", 6.5), ("3", None)]


@pytest.mark.parametrize("variant", ["rowwise", "wide", "long"])
def test_features_against_python(cohort, variant):
    data, wide = cohort
    if variant == "rowwise":
        got = by_student(scores.student_features_rowwise(wide))
    elif variant == "wide":
        got = by_student(scores.student_features_wide(wide))
    else:
        got = by_student(scores.student_features(scores.unpivot_scores(wide, non_score_cols=("ho_ten", "TOEIC"))))
    for row in data:
        marks = row[2:-1]
        h = [py_scale(x) for x in marks]
        r = got[row[0]]
        assert r["gpa"] == pytest.approx(sum(h) / len(h), abs=1e-12)
        if variant == "rowwise":
            assert r["std_score"] == pytest.approx(statistics.pstdev(h), abs=1e-9)
            assert r["failed_subjects"] == sum(x is not None and x < 4 for x in marks)
            assert r["excellent_subjects"] == sum(x is not None and x >= 8 for x in marks)
        else:
            assert r["std_score"] == pytest.approx(statistics.stdev(h), abs=1e-9)
            assert r["failed_subjects"] == sum(x < 1 for x in h)
            assert r["excellent_subjects"] == sum(x >= 3.5 for x in h)


def test_single_score_and_no_score(spark):
    long = spark.createDataFrame([("a", "1", 7.0), ("b", "1", None), ("b", "2", None)], "ma_sv string, ma_mon string, diem double")
    got = by_student(scores.student_features(long))
    assert got["a"]["std_score"] == 0.0 and got["a"]["gpa"] == 3.0
    assert (got["b"]["gpa"], got["b"]["failed_subjects"]) == (0.0, 2)
    assert by_student(scores.student_features(long, fill_std=None))["a"]["std_score"] is None
    one = spark.createDataFrame([("a", 7.0)], "ma_sv string, `1` double")
    assert by_student(scores.student_features_wide(one))["a"]["std_score"] == 0.0
    assert by_student(scores.student_features_wide(one, fill_std=None))["a"]["std_score"] is None


def test_train_and_score_variants_differ_above_ten(spark):
    wide = spark.createDataFrame([("a", 10.1, None)], "ma_sv string, `1` double, `2` double")
    trained = scores.student_features_wide(wide).first()
    scored = scores.student_features_rowwise(wide).first()
    assert (trained["failed_subjects"], trained["excellent_subjects"]) == (2, 0)
    assert (scored["failed_subjects"], scored["excellent_subjects"]) == (0, 1)


def test_field_gpa_wide_equals_long(cohort):
    data, wide = cohort
    long = scores.unpivot_scores(wide, non_score_cols=("ho_ten", "TOEIC"))
    a, b = by_student(scores.field_gpa(wide)), by_student(scores.field_gpa_long(long, subjects=CODES))
    columns = [*[scores.gpa_column(f) for f in labels.CAREER_FIELDS], "gpa_tong"]
    for student, row in a.items():
        assert [row[c] for c in columns] == [b[student][c] for c in columns]


def test_field_gpa_missing_and_shared_subjects(spark):
    wide = spark.createDataFrame([("a", 9.0, 6.0)], "ma_sv string, `p.1` double, q double")
    row = scores.field_gpa(wide, {"X / Y": ["p.1", "q"], "Z": ["absent"], "W": ["q"]}).first()
    assert (row["gpa_X___Y"], row["gpa_Z"], row["gpa_W"]) == (3.0, 0.0, 2.0)
    assert row["gpa_tong"] == round((4 + 2 + 2) / 3, 2)
    assert row["_p.1_4"] == 4.0
    long = scores.unpivot_scores(wide)
    same = scores.field_gpa_long(long, {"X / Y": ["p.1", "q"], "Z": ["absent"], "W": ["q"]}, subjects=["p.1", "q"]).first()
    assert (same["gpa_X___Y"], same["gpa_Z"], same["gpa_W"], same["gpa_tong"]) == (3.0, 0.0, 2.0, row["gpa_tong"])


def test_wide_features_do_not_shuffle(cohort):
    _, wide = cohort
    for df in (scores.student_features_rowwise(wide), scores.student_features_wide(wide), scores.field_gpa(wide)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_hundreds_of_subjects(spark):
    codes = [f"s{i}" for i in range(300)]
    wide = spark.range(50).select(
        F.col("id").cast("string").alias("ma_sv"), *[((F.col("id") * 7 + i) % 11).cast("double").alias(c) for i, c in enumerate(codes)]
    )
    wide_features = by_student(scores.student_features_wide(wide))
    long_features = by_student(scores.student_features(scores.unpivot_scores(wide)))
    for student, r in wide_features.items():
        assert r["gpa"] == long_features[student]["gpa"]
        assert r["failed_subjects"] == long_features[student]["failed_subjects"]


def test_java_patterns(spark):
    from scorefold.operators import search

    df = spark.createDataFrame([("abc",), ("a1",)], "t string")
    assert [r.t for r in search.search_any(df, r"^\p{L}+$").collect()] == ["abc"]
    for broken in ("(?P<x>a)", "(", "[a"):
        with pytest.raises(ValueError):
            search.search_any(df, broken)
