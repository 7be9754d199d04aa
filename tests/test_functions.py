"""Thresholds of every scale, band and rule, with nulls and edges."""

from pyspark.sql import functions as F

from scorefold import labels
from scorefold.functions import bands, casts, rules, text
from scorefold.functions.scale import scale4


def test_scale4(column):
    scores = [None, -0.1, 0.0, 3.9, 4.0, 4.9, 5.0, 5.4, 5.5, 6.4, 6.5, 6.9, 7.0, 7.9, 8.0, 8.4, 8.5, 9.0, 10.0, 10.1]
    want = [0, 0, 0, 0, 1, 1, 1.5, 1.5, 2, 2, 2.5, 2.5, 3, 3, 3.5, 3.5, 4, 4, 4, 0]
    assert column(scores, "double", scale4) == want
    assert column(scores, "double", lambda c: scale4(F.col(c))) == want
    assert column([float("nan")], "double", scale4) == [0.0]


def test_safe_numbers(column):
    texts = ["abc", "", " 7 ", "12.5", None, "-3", "1e3"]
    assert column(texts, "string", casts.safe_int) == [0, 0, 7, 0, 0, -3, 0]
    assert column(texts, "string", casts.safe_double) == [0, 0, 7, 12.5, 0, -3, 1000]
    assert column(texts, "string", lambda c: casts.safe_double(c, None)) == [None, None, 7, 12.5, None, -3, 1000]
    assert column([12.5, -1.5, None, float("nan")], "double", casts.safe_int) == [12, -1, 0, 0]
    assert column(["3.9", "x", None, "4"], "string", casts.truncated_int) == [3, 0, 0, 4]


def test_fixed_rounds_half_even_on_the_exact_value(column):
    values = [0.125, 0.375, 1.005, 2.0, 1234.5678]
    assert column(values, "double", lambda c: text.fixed(c, 2)) == [f"{v:.2f}" for v in values]
    ties = [6.25, 0.35, 0.05, 12.0]
    assert column(ties, "double", lambda c: text.fixed(c, 1)) == [f"{v:.1f}" for v in ties]
    assert column([2.5, 3.5], "double", lambda c: text.fixed(c, 0)) == ["2", "4"]


def test_bar_and_padding(column):
    assert column([0.0, 1.9, 2.0, 99.9], "double", text.bar) == ["", "", "█", "█" * 49]
    assert column(["ab", "abcdef"], "string", lambda c: text.pad_left(F.col(c), 4)) == ["  ab", "abcdef"]
    assert column(["ab", "abcdef"], "string", lambda c: text.pad_right(F.col(c), 4)) == ["ab  ", "abcdef"]


def test_student_bands(column):
    assert column([3.6, 3.59, 3.2, 2.5, 2.0, 1.99], "double", bands.gpa_label) == [
        "Xuất sắc", "Giỏi", "Giỏi", "Khá", "Trung bình", "Yếu"]
    assert column([3.2, 2.5, 2.0, 1.9], "double", bands.gpa_color) == [bands.GREEN, bands.BLUE, bands.AMBER, bands.RED]
    assert column([0.3, 0.31, 0.6, 0.9, 0.91], "double", bands.stability_label) == [
        "Rất ổn định", "Ổn định", "Ổn định", "Dao động", "Không ổn định"]
    assert column([0.3, 0.6, 0.9, 1.0], "double", bands.stability_color) == [
        bands.GREEN, bands.BLUE, bands.AMBER, bands.RED]
    assert column([0, 2, 3, 5, 6], "int", bands.failed_label) == [
        "Không có môn trượt ✓", "2 môn – Ít, cần khắc phục", "3 môn – Trung bình, cần chú ý",
        "5 môn – Trung bình, cần chú ý", "6 môn – Nhiều, rủi ro cao"]
    assert column([0, 1, 5, 6], "int", bands.failed_color) == [bands.GREEN, bands.BLUE, bands.AMBER, bands.RED]


def test_excellent_band(rows):
    data = [(5, 10), (3, 10), (1, 10), (0, 10), (4, 0), (1, 40)]
    got = rows(data, "n int, t int", bands.excellent_color("n", "t"), bands.excellent_percent("n", "t"))
    assert got == [(bands.GREEN, 50), (bands.BLUE, 30), (bands.AMBER, 10), (bands.GREY, 0), (bands.GREY, 0), (bands.GREY, 2)]


def test_subject_bands(column):
    assert column([8.0, 6.5, 5.0, 4.9, None], "double", bands.subject_average_label) == [
        "Tốt / Giỏi", "Khá", "Trung bình", "Thấp / Kém", "-"]
    assert column([7.5, 6.0, 5.9, None], "double", bands.subject_average_color) == [
        bands.GREEN, bands.AMBER, bands.RED, bands.NEUTRAL]
    assert column([0.0, 10.0, 20.0, 20.1, None], "double", bands.fail_rate_label) == [
        "Rất thấp", "Thấp", "Trung bình", "Cao / Cảnh báo", "-"]
    assert column([5.0, 15.0, 15.1, None], "double", bands.fail_rate_color) == [
        bands.GREEN, bands.AMBER, bands.RED, bands.NEUTRAL]
    assert column([0.0, 25.0, 60.0, None], "double", bands.fail_rate_fraction) == [1.0, 0.5, 0.0, 0.0]
    assert column([5.0, 11.0, None], "double", bands.subject_average_fraction) == [0.5, 1.0, 0.0]


def test_other_bands(column):
    assert column([0.71, 0.7, 0.51, 0.5, 0.26, 0.25], "double", bands.silhouette_label) == [
        "RẤT TỐT", "TỐT", "TỐT", "TRUNG BÌNH", "TRUNG BÌNH", "KÉM"]
    assert column(["Rất sẵn sàng", "Sẵn sàng cao", "Cần cải thiện", "Chưa sẵn sàng", "x", None], "string",
                  bands.readiness_tag) == ["high", "med", "low", "med", "", ""]
    assert column([0, 1, 2, 5, None], "int", bands.readiness_rank_tag) == ["high", "med", "danger", "danger", ""]
    assert column(["2", "0", "3", "1", "7", "x", None], "string", bands.cluster_tag) == [
        "danger", "warning", "good", "excellent", "good", "excellent", "excellent"]
    assert column([2.0, 3.0], "double", bands.cluster_tag) == ["danger", "good"]


def test_difficulty(rows):
    data = [(5.9, 0.0), (6.0, 15.0), (6.0, 15.1), (7.9, 0.0), (8.0, 15.0), (8.0, 15.1), (None, 20.0), (None, 10.0), (None, None)]
    got = [r[0] for r in rows(data, "TB double, `F%` double", rules.difficulty())]
    hard, easy, medium = labels.HARD, labels.EASY, labels.MEDIUM
    assert got == [hard, medium, hard, medium, easy, hard, hard, medium, medium]


def test_quality_rule(rows):
    data = [(1.1, 10.1, 0.0, 0.0), (1.0, 10.1, 0.0, 0.0), (1.1, 10.0, 0.0, 0.0), (0.69, 0.0, 20.0, 20.1),
            (0.69, 0.0, 20.0, 20.0), (0.7, 0.0, 30.0, 30.0), (None, 50.0, 30.0, 30.0)]
    got = [r[0] for r in rows(data, "SD double, `F%` double, `A%` double, `A+%` double", rules.quality_rule())]
    stable = labels.QUALITY_STABLE
    assert got == [labels.QUALITY_UNSTABLE, stable, stable, labels.QUALITY_EVEN, stable, stable, stable]


def test_trend_and_collapse(column):
    assert column([4.9, 5.0, 7.4, 7.5, None], "double", rules.trend) == [
        labels.TREND_DOWN, labels.TREND_FLAT, labels.TREND_FLAT, labels.TREND_UP, labels.TREND_FLAT]
    assert column([*labels.SUBJECT_CLUSTER_LABELS, None], "string", rules.quality_collapse) == [
        labels.QUALITY_EVEN, labels.QUALITY_STABLE, labels.QUALITY_STABLE, labels.QUALITY_UNSTABLE, labels.QUALITY_STABLE]
    assert column(["1", None], "string", rules.quality_no_data) == [labels.QUALITY_NO_DATA, None]


def test_priorities(column):
    every = [*labels.SUBJECT_CLUSTER_LABELS, labels.QUALITY_EVEN, labels.QUALITY_UNSTABLE, None]
    assert column(every, "string", rules.subject_priority) == [3, 2, 1, 0, 2, 1, 2]
    assert column(every, "string", rules.label_priority) == [3, 1, 2, 0, 1, 1, 1]


def test_roles(column):
    roles = ["Software Engineer", "Data Engineer", "Maintenance", "Web Dev", "DevOps", "Tester", "Backend Data", None]
    fields = list(labels.CAREER_FIELDS)
    ai, web, net, soft, core = fields
    assert column(roles, "string", rules.classify_role) == [soft, ai, ai, web, net, core, soft, core]


def test_competitiveness_label(rows):
    strong, fair = labels.COMPETITIVENESS_STRONG, labels.COMPETITIVENESS_FAIR
    fierce, medium = labels.COMPETITIVENESS_FIERCE, labels.COMPETITIVENESS_MEDIUM
    data = [(3.2, 10.1), (3.2, 10.0), (2.5, 5.1), (2.5, 5.0), (1.9, 50.0), (2.0, 2.0), (2.0, 1.9), (4.0, 1.0)]
    got = [r[0] for r in rows(data, "g double, r double", rules.competitiveness_label("g", "r"))]
    assert got == [strong, fair, fair, medium, fierce, medium, fierce, fierce]


def test_risk_lookup(column):
    from scorefold.operators.clustering import risk_order

    assert column([0, 1, 2, 3, 4, None], "int", risk_order) == [1, 3, 0, 2, None, None]


def test_subject_badges(rows):
    got = rows([("Tiêu cực - Kém", True), ("Không ổn định", True), ("Ổn định", True), ("Xuất sắc - Tốt", True), (None, True), ("Ổn định", False), (None, None)],
               "q string, a boolean", rules.subject_badge("q", F.col("a")))
    assert [r[0].icon for r in got] == ["⚡", "⚠️", "📘", "✅", "📘", "📋", "📋"]
    assert tuple(got[1][0]) == ("#f59e0b", "#1c1917", "⚠️")
