"""Band labels and colours for students, subjects and models.

Each band is a short ladder of thresholds.  `at_least` reads best-first with
>=, `at_most` reads lowest-first with <=; a null value falls through to the
last label, as a failed comparison does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scorefold import labels
from scorefold.functions.casts import as_column, safe_int

GREEN, BLUE, AMBER, RED, GREY = "#10b981", "#3b82f6", "#f59e0b", "#ef4444", "#6b7280"
NEUTRAL = "#64748b"


def at_least(value: Column | str, steps, otherwise) -> Column:
    value = as_column(value)
    ladder = F
    for bound, label in steps:
        ladder = ladder.when(value >= bound, label)
    return ladder.otherwise(otherwise)


def at_most(value: Column | str, steps, otherwise) -> Column:
    value = as_column(value)
    ladder = F
    for bound, label in steps:
        ladder = ladder.when(value <= bound, label)
    return ladder.otherwise(otherwise)


def gpa_label(gpa) -> Column:
    return at_least(gpa, [(3.6, "Xuất sắc"), (3.2, "Giỏi"), (2.5, "Khá"), (2.0, "Trung bình")], "Yếu")


def gpa_color(gpa) -> Column:
    return at_least(gpa, [(3.2, GREEN), (2.5, BLUE), (2.0, AMBER)], RED)


def stability_label(std) -> Column:
    return at_most(std, [(0.3, "Rất ổn định"), (0.6, "Ổn định"), (0.9, "Dao động")], "Không ổn định")


def stability_color(std) -> Column:
    return at_most(std, [(0.3, GREEN), (0.6, BLUE), (0.9, AMBER)], RED)


def failed_label(count) -> Column:
    count = as_column(count)
    text = count.cast("string")
    return (
        F.when(count == 0, "Không có môn trượt ✓")
        .when(count <= 2, F.concat(text, F.lit(" môn – Ít, cần khắc phục")))
        .when(count <= 5, F.concat(text, F.lit(" môn – Trung bình, cần chú ý")))
        .otherwise(F.concat(text, F.lit(" môn – Nhiều, rủi ro cao")))
    )


def failed_color(count) -> Column:
    count = as_column(count)
    return F.when(count == 0, GREEN).otherwise(at_most(count, [(2, BLUE), (5, AMBER)], RED))


def share(part, total) -> Column:
    """part / total, 0 for an empty total."""
    return F.coalesce(F.try_divide(as_column(part), as_column(total)), F.lit(0.0))


def excellent_color(count, total) -> Column:
    return at_least(share(count, total), [(0.5, GREEN), (0.3, BLUE), (0.1, AMBER)], GREY)


def excellent_percent(count, total) -> Column:
    """Whole percent, ties to even."""
    return F.rint(share(count, total) * 100).cast("int")


def unit(value: Column) -> Column:
    """Clamp to 0..1; null stays null."""
    return F.when(value < 0, 0.0).when(value > 1, 1.0).otherwise(value)


def subject_average_label(average) -> Column:
    average = as_column(average)
    return F.when(average.isNull(), "-").otherwise(
        at_least(average, [(8.0, "Tốt / Giỏi"), (6.5, "Khá"), (5.0, "Trung bình")], "Thấp / Kém")
    )


def subject_average_color(average) -> Column:
    average = as_column(average)
    return F.when(average.isNull(), NEUTRAL).otherwise(at_least(average, [(7.5, GREEN), (6.0, AMBER)], RED))


def subject_average_fraction(average) -> Column:
    return unit(F.coalesce(as_column(average) / 10.0, F.lit(0.0)))


def fail_rate_label(percent) -> Column:
    percent = as_column(percent)
    return (
        F.when(percent.isNull(), "-")
        .when(percent == 0, "Rất thấp")
        .otherwise(at_most(percent, [(10, "Thấp"), (20, "Trung bình")], "Cao / Cảnh báo"))
    )


def fail_rate_color(percent) -> Column:
    percent = as_column(percent)
    return F.when(percent.isNull(), NEUTRAL).otherwise(at_most(percent, [(5, GREEN), (15, AMBER)], RED))


def fail_rate_fraction(percent) -> Column:
    return unit(F.coalesce(1.0 - as_column(percent) / 50.0, F.lit(0.0)))


def silhouette_label(score) -> Column:
    score = as_column(score)
    return (
        F.when(score > 0.7, "RẤT TỐT")
        .when(score > 0.5, "TỐT")
        .when(score > 0.25, "TRUNG BÌNH")
        .otherwise("KÉM")
    )


def readiness_tag(label) -> Column:
    """Row tag by substring of the lower-cased label, first match wins, else empty."""
    text = F.lower(as_column(label).cast("string"))
    ladder = F
    for needle, tag in labels.READINESS_TAGS:
        ladder = ladder.when(text.contains(needle), tag)
    return ladder.otherwise("")


def readiness_rank_tag(rank) -> Column:
    """Row tag by rank of the readiness group, 0 best; free of substring accidents."""
    rank = as_column(rank)
    best, middle, worst = labels.READINESS_RANK_TAGS
    return F.when(rank == 0, best).when(rank == 1, middle).when(rank >= 2, worst).otherwise("")


def cluster_tag(cluster) -> Column:
    """Row tag of a student cluster id; no id counts as the default cluster."""
    cluster = F.coalesce(safe_int(cluster, None), F.lit(labels.DEFAULT_CLUSTER).cast("bigint"))
    ladder = F
    for cid, tag in labels.CLUSTER_TAGS.items():
        ladder = ladder.when(cluster == cid, tag)
    return ladder.otherwise(labels.CLUSTER_TAG_DEFAULT)
