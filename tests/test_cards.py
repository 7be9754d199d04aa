"""Student cards, shares and short reports."""

from pyspark.sql import functions as F

from scorefold import labels
from scorefold.operators import cards

SCORED = "ma_sv string, ho_ten string, gpa string, std_score string, failed_subjects string, excellent_subjects string, prediction string"


def test_card_of_dirty_rows(spark):
    df = spark.createDataFrame(
        [("1", "An", "3.4", "0.25", "0", "20", "1"), ("2", "Bo", "x", None, "2.9", "", "9"), ("3", "Ca", "1.5", "2.0", "50", "1", None)], SCORED)
    got = {r["ma_sv"]: r for r in cards.student_card(df, 37).collect()}
    a, b, c = got["1"], got["2"], got["3"]
    assert (a["gpa_text"], a["gpa_label"], a["stability_label"], a["label"]) == (
        "3.40", "Giỏi", "Rất ổn định", "Xuất Sắc – Tiếp Tục Phát Huy")
    assert a["excellent_label"] == "54% tổng số môn" and a["excellent_fraction"] == 20 / 37
    assert (b["gpa"], b["std_score"], b["failed_subjects"], b["excellent_subjects"]) == (0.0, 0.0, 2, 0)
    assert b["label"] == c["label"] == "Xuất Sắc – Tiếp Tục Phát Huy"
    assert c["stability_fraction"] == 0.0 and c["failed_fraction"] == 0.0
    assert len(a["reasons"]) == 4 and len(a["suggestions"]) == 3


def test_total_from_a_column(spark):
    df = spark.createDataFrame([("1", "An", "3.4", "0.2", "0", "5", "1", 10), ("2", "B", "1", "1", "0", "5", "1", 0)], SCORED + ", n int")
    got = {r["ma_sv"]: r for r in cards.student_card(df, "n").collect()}
    assert got["1"]["excellent_label"] == "50% tổng số môn" and got["1"]["excellent_fraction"] == 0.5
    assert got["2"]["excellent_label"] == "0% tổng số môn" and got["2"]["excellent_fraction"] == 1.0


def test_profiles_are_complete(spark):
    assert {p.cluster for p in labels.CLUSTER_PROFILES} == set(labels.RISK_ORDER) == set(labels.CLUSTER_TAGS)
    assert cards.profiles(spark).count() == 4


def test_group_share_and_first_n(spark):
    df = spark.range(100).select(F.when(F.col("id") < 75, "a").otherwise("b").alias("g"), "id")
    assert [tuple(r) for r in cards.group_share(df, "g").collect()] == [("a", 75, 75.0), ("b", 25, 25.0)]
    top = cards.first_n(df, 3, [F.desc("id")])
    assert [(r["idx"], r["id"]) for r in top.collect()] == [(1, 99), (2, 98), (3, 97)]
    assert cards.group_share(df.limit(0), "g").count() == 0


def test_readiness_lines(spark):
    df = spark.createDataFrame([("2", "B", 2.5, 500.0, "Đang phát triển"), ("1", "A", 3.0, 700.0, "Sẵn sàng cao")],
                               "ma_sv string, ho_ten string, gpa_tong double, TOEIC double, nhom_san_sang string")
    got = [r["text"] for r in cards.readiness_lines(df).collect()]
    assert got[0] == "[1] 1 - A\n    GPA: 3.0 | TOEIC: 700.0 | Nhóm: Sẵn sàng cao\n    Phân tích: \n\n"
