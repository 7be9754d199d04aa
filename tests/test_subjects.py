"""Subject statistics, lists and reports on small fixtures."""

import random
import statistics

import pytest

from scorefold import labels
from scorefold.operators import search, subjects
from scorefold.plans import subjects as plans

ANALYSED = "MaMH string, TenMH string, DoKho string, ChatLuong string, XuHuong string, TB double, `F%` double"


@pytest.fixture
def analysed(spark):
    return spark.createDataFrame(
        [
            ("1", "Toán", "Khó", "Tiêu cực - Kém", "Tiêu cực", 4.0, 30.0),
            ("2", "Lý", "Dễ", "Xuất sắc - Tốt", "Tích cực", 8.5, 0.0),
            ("3", "Hóa", "Trung bình", "Ổn định", "Bình thường", 7.0, 5.25),
            ("4", None, "Khó", "Không ổn định", "Bình thường", None, 12.0),
            ("5", "Anh", "Khó", None, "Bình thường", 6.0, None),
        ],
        ANALYSED,
    )


def test_stats_with_a_hot_subject(spark):
    """One subject holds most rows; every figure equals brute force over the single scores."""
    rng = random.Random(3)
    data = [("hot", rng.randrange(0, 101) / 10) for _ in range(3000)]
    data += [(f"s{i % 40}", rng.randrange(0, 101) / 10) for i in range(1000)] + [("lone", 7.0), ("s1", None)]
    got = {r["MaMH"]: r for r in subjects.subject_stats(
        spark.createDataFrame(data, "ma_mon string, diem double").repartition(7)).collect()}
    for code in {c for c, _ in data}:
        marks = [x for c, x in data if c == code and x is not None]
        lost = sum(c == code and x is None for c, x in data)
        r = got[code]
        assert r["TB"] == pytest.approx(statistics.mean(marks))
        assert r["TV"] == pytest.approx(statistics.median(marks))
        if len(marks) > 1:
            assert r["SD"] == pytest.approx(statistics.stdev(marks), abs=1e-9)
        else:
            assert r["SD"] is None
        assert r["A+%"] == pytest.approx(100 * sum(x >= 9 for x in marks) / len(marks))
        assert r["F%"] == pytest.approx(100 * sum(x < 4 for x in marks) / len(marks))
        assert sum(r[c] for c in ("A+%", "A%", "B%", "C%", "D%", "F%")) == pytest.approx(100)
        assert r["MTC%"] == pytest.approx(100 * lost / (lost + len(marks)))


def test_stats_weighted_equal_repeated(spark):
    weighted = spark.createDataFrame([("a", 5.0, 3), ("a", 9.0, 1), ("b", 4.0, 2)], "ma_mon string, diem double, w int")
    repeated = spark.createDataFrame([("a", 5.0)] * 3 + [("a", 9.0)] + [("b", 4.0)] * 2, "ma_mon string, diem double")
    first = sorted(subjects.subject_stats(weighted, weight="w").collect())
    assert first == sorted(subjects.subject_stats(repeated).collect())


def test_stats_of_nothing_but_nulls(spark):
    row = subjects.subject_stats(spark.createDataFrame([("a", None)], "ma_mon string, diem double")).first()
    assert (row["TB"], row["SD"], row["F%"], row["TV"], row["MTC%"]) == (None, None, None, None, 100.0)


def test_rule_fallbacks_and_null_average(spark):
    stats = spark.createDataFrame([("1", "x", None, 20.0), ("2", "y", 8.0, 0.0)], "MaMH string, TenMH string, TB double, `F%` double")
    got = {r["MaMH"]: r for r in plans.analyze_subjects(stats).collect()}
    assert got["1"]["ChatLuong"] == labels.QUALITY_NO_DATA
    assert (got["1"]["DoKho"], got["1"]["XuHuong"], got["1"]["TB"]) == (labels.HARD, labels.TREND_FLAT, None)
    assert (got["2"]["DoKho"], got["2"]["XuHuong"]) == (labels.EASY, labels.TREND_UP)


def test_text_numbers_are_cast(spark):
    stats = spark.createDataFrame(
        [("1", "x", "5,5", "20", "1.2", "0", "0"), ("2", "y", "8.126", "0", "0.5", "30", "20")],
        "MaMH string, TenMH string, TB string, `F%` string, SD string, `A%` string, `A+%` string",
    )
    got = {r["MaMH"]: r for r in plans.analyze_subjects(stats).collect()}
    assert (got["1"]["TB"], got["1"]["ChatLuong"]) == (None, labels.QUALITY_UNSTABLE)
    assert (got["2"]["TB"], got["2"]["ChatLuong"]) == (8.13, labels.QUALITY_EVEN)


def test_priority_order(analysed):
    assert [r["MaMH"] for r in subjects.priority_sorted(analysed).collect()] == ["1", "4", "5", "3", "2"]
    assert [r["MaMH"] for r in subjects.priority_sorted(analysed, by="MaMH").collect()] == ["1", "4", "3", "5", "2"]


def test_grouped_list(analysed):
    got = [(r["is_detail"], r["MaMH"], r["item"]) for r in subjects.grouped_list(analysed).collect()]
    assert got == [
        (0, None, "  🔴  Tiêu Cực – Cần Lưu Ý"), (1, "1", "  1 – Toán"),
        (0, None, "  🟡  Không Ổn Định"), (1, "4", "  4 – "),
        (0, None, "  🟣  Ổn Định"), (1, "5", "  5 – Anh"), (1, "3", "  3 – Hóa"),
        (0, None, "  🟢  Xuất Sắc – Kết Quả Tốt"), (1, "2", "  2 – Lý"),
    ]
    assert subjects.grouped_list(analysed, headers=None).count() == 5


def test_filter_list(analysed):
    every = [r["item"] for r in subjects.filter_subject_list(analysed).collect()]
    assert every[:2] == ["  🔴  Tiêu Cực – Cần Lưu Ý", "  1 – Toán"] and len(every) == 9
    assert "  🟢  Tích Cực – Kết Quả Tốt" in every
    assert [r["item"] for r in subjects.filter_subject_list(analysed, " TOÁN ").collect()] == ["  1 – Toán"]
    assert subjects.filter_subject_list(analysed, "zzz").count() == 0


def test_report_lines(analysed):
    lines = [r for r in subjects.report_lines(analysed).collect() if r["MaMH"] == "4"]
    assert [r["tag"] for r in lines] == ["header", *["subheader", "content"] * 3, "divider"]
    assert lines[0]["text"] == "Nội dung phân tích None (4):\n"
    assert lines[2]["text"] == "- Đánh giá: Khó (Điểm TB: None, Tỷ lệ rớt: 12.0%)\n"
    only = subjects.report_lines(analysed, difficulty=False, quality=False).filter("MaMH = '1'").collect()
    assert [(r["seq"], r["tag"]) for r in only] == [(1, "header"), (2, "subheader"), (3, "content"), (4, "divider")]


def test_detail(analysed):
    got = {r["MaMH"]: r for r in subjects.subject_detail(analysed).collect()}
    assert got["4"]["TenMH"] == "4" and got["4"]["average_label"] == "-"
    assert got["5"]["badge"] == "TB: 6.0  |  Rớt: None%" and got["5"]["ChatLuong"] == "-"
    assert got["2"]["group_label"] == "Xuất sắc – Kết quả tốt"


def test_dedupe_last_with_a_hot_key(spark):
    data = [("k", i, i * 10) for i in range(2000)] + [("a", 5, None), ("a", 3, 1)]
    got = sorted(subjects.dedupe_last(spark.createDataFrame(data, "key string, seq int, v int").repartition(6), "key", "seq").collect())
    assert [tuple(r) for r in got] == [("a", 5, None), ("k", 1999, 19990)]


def test_report_pipeline(spark, analysed):
    from pyspark.sql import functions as F

    doubled = analysed.withColumn("seq", F.lit(1)).unionByName(analysed.withColumn("seq", F.lit(2)))
    listed, detail = plans.subject_report(doubled, "seq")
    assert (listed.count(), detail.count()) == (9, 5)


def test_search_subjects(spark):
    stats = spark.createDataFrame(
        [("17", "C++ (nâng cao)"), ("18", "Toán - cơ sở"), ("17", "C++ (nâng cao)"), ("19", None)], "MaMH string, TenMH string")
    found = search.search_subjects(stats, "c++ (", mode="literal")
    assert [r["title"] for r in found.collect()] == ["17 - C++ (nâng cao)"]
    assert search.search_subjects(stats, "  ").count() == 0
    assert {r["title"] for r in search.search_subjects(stats, "1[89]").collect()} == {"18 - Toán - cơ sở", "19"}
    parsed = search.parse_title(search.search_subjects(stats, "1[89]")).collect()
    assert {(r["MaMH"], r["TenMH"]) for r in parsed} == {("18", "Toán - cơ sở"), ("19", "")}
    with pytest.raises(Exception):
        search.search_subjects(stats, "(")
    assert search.search_subjects(stats, "1", limit=1).count() == 1
    # case folding reaches accented letters
    assert [r["MaMH"] for r in search.search_subjects(stats, "TOÁN|NÂNG").orderBy("MaMH").collect()] == ["17", "18"]


def test_search_table(spark):
    df = spark.createDataFrame([("Alpha", 1), ("beta", 22), (None, 3)], "a string, n int")
    assert [r["n"] for r in search.search_any(df, "ALP|^22$").collect()] == [1, 22]
    assert search.search_any(df, " ").count() == 3
    assert search.search_any(df, "^x", limit=2).count() == 0
    assert [r["n"] for r in search.search_any(df, "a", limit=1, order_by=["n"]).collect()] == [1]
    with pytest.raises(ValueError):
        search.search_any(df, "a", mode="fuzzy").count()


def test_filter_codes_and_students(spark):
    df = spark.createDataFrame([(101, "An"), (102, "Bình"), (103, None)], "ma_sv int, ho_ten string")
    assert search.filter_codes(df, ["101", "x", "0102"], "ma_sv").count() == 1
    assert search.filter_codes(df, ["x"], "ma_sv").count() == 0
    assert search.filter_codes(df, ["An", "x"], "ho_ten").count() == 1
    codes = spark.createDataFrame([("102",), ("102",)], "c string")
    assert [r["ma_sv"] for r in search.filter_codes(df, codes, "ma_sv").collect()] == [102]
    assert [r["ma_sv"] for r in search.student_search(df, "BÌNH").collect()] == [102]
    assert search.student_search(df, "10").count() == 3
    assert search.student_search(df, "").count() == 3
    assert search.student_search(df.drop("ho_ten"), "3").count() == 1


def test_selection(spark):
    chosen = spark.createDataFrame([("1", "a")], "MaMH string, TenMH string")
    picked = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "b")], "MaMH string, TenMH string")
    assert sorted(r["MaMH"] for r in search.add_selection(chosen, picked).collect()) == ["1", "2"]


def test_equal_entries_and_null_orders_stay(spark):
    rows = [("1", "A", labels.QUALITY_STABLE)] * 2 + [("2", "B", labels.QUALITY_STABLE)]
    df = spark.createDataFrame(rows, "MaMH string, TenMH string, ChatLuong string")
    for out in (subjects.grouped_list(df), subjects.filter_subject_list(df)):
        assert out.filter("is_detail = 1").count() == 3 and out.filter("is_detail = 0").count() == 1
    assert subjects.filter_subject_list(df, "a").count() == 2
    last = spark.createDataFrame([("k", None, "a"), ("n", 1, "b"), ("n", None, "c"), ("n", 1, "d")], "key string, at int, v string")
    assert sorted(map(tuple, subjects.dedupe_last(last, "key", "at").collect())) == [("k", None, "a"), ("n", 1, "d")]
