"""Label rules for subjects, roles and students against the market."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from scorefold import labels
from scorefold.functions.casts import as_column


def difficulty(average="TB", fail_percent="F%") -> Column:
    average, fail_percent = as_column(average), as_column(fail_percent)
    return (
        F.when((average < 6.0) | (fail_percent > 15), labels.HARD)
        .when(average >= 8.0, labels.EASY)
        .otherwise(labels.MEDIUM)
    )


def quality_rule(std="SD", fail_percent="F%", a="A%", a_plus="A+%") -> Column:
    std, fail_percent = as_column(std), as_column(fail_percent)
    top_share = as_column(a) + as_column(a_plus)
    return (
        F.when((std > 1.0) & (fail_percent > 10), labels.QUALITY_UNSTABLE)
        .when((top_share > 40) & (std < 0.7), labels.QUALITY_EVEN)
        .otherwise(labels.QUALITY_STABLE)
    )


def quality_no_data(code="MaMH") -> Column:
    """For tables without the spread columns; a row without a code stays null."""
    return F.when(as_column(code).isNotNull(), labels.QUALITY_NO_DATA)


def quality_collapse(cluster_label) -> Column:
    """Cluster label -> one of the three rule labels."""
    label = as_column(cluster_label)
    return (
        F.when(label.contains("Kém"), labels.QUALITY_UNSTABLE)
        .when(label.contains("Xuất sắc"), labels.QUALITY_EVEN)
        .otherwise(labels.QUALITY_STABLE)
    )


def trend(average="TB") -> Column:
    average = as_column(average)
    return F.when(average >= 7.5, labels.TREND_UP).when(average < 5.0, labels.TREND_DOWN).otherwise(labels.TREND_FLAT)


def _subject_group(quality, pick: int) -> Column:
    text = F.trim(F.coalesce(as_column(quality), F.lit("")))
    ladder = F
    for needle, *values in labels.SUBJECT_GROUPS:
        ladder = ladder.when(text.contains(needle), values[pick])
    return ladder.otherwise(labels.SUBJECT_GROUP_DEFAULT[pick])


def subject_priority(quality) -> Column:
    """0 worst .. 3 best; a subject without a label counts as stable."""
    return _subject_group(quality, 0)


def subject_group_label(quality) -> Column:
    return _subject_group(quality, 1)


def subject_group_color(quality) -> Column:
    return _subject_group(quality, 2)


def subject_badge(quality, analysed: Column | bool = True) -> Column:
    """A struct of the badge's background, foreground and icon; a subject that is not analysed has its own."""
    priority, known = subject_priority(quality), F.coalesce(F.lit(analysed), F.lit(False))

    def pick(i: int) -> Column:
        ladder = F.when(~known, labels.SUBJECT_BADGE_UNKNOWN[i])
        for p, values in labels.SUBJECT_BADGES.items():
            ladder = ladder.when(priority == p, values[i])
        return ladder

    return F.struct(*[pick(i).alias(name) for i, name in enumerate(("background", "foreground", "icon"))])


def label_priority(label, priorities=None, default: int = labels.LABEL_PRIORITY_DEFAULT) -> Column:
    """Priority by exact label."""
    label = as_column(label)
    ladder = F
    for name, priority in (priorities or labels.LABEL_PRIORITY).items():
        ladder = ladder.when(label == name, priority)
    return ladder.otherwise(default)


def lookup(key, table: dict[int, int]) -> Column:
    """Value of a small constant table, null for a missing key."""
    pairs = [F.lit(part) for pair in table.items() for part in pair]
    return F.create_map(*pairs)[as_column(key)]


def classify_role(role, keywords=labels.ROLE_KEYWORDS, default: str = labels.DEFAULT_FIELD) -> Column:
    """Career field of a job role by substring, first matching field wins."""
    text = F.lower(as_column(role))
    ladder = F
    for field, words in keywords:
        ladder = ladder.when(reduce(or_, [text.contains(word) for word in words]), field)
    return ladder.otherwise(default)


def competitiveness_label(gpa, ratio) -> Column:
    gpa, ratio = as_column(gpa), as_column(ratio)
    return (
        F.when((gpa >= 3.2) & (ratio > 10), labels.COMPETITIVENESS_STRONG)
        .when((gpa >= 2.5) & (ratio > 5), labels.COMPETITIVENESS_FAIR)
        .when((gpa < 2.0) | (ratio < 2), labels.COMPETITIVENESS_FIERCE)
        .otherwise(labels.COMPETITIVENESS_MEDIUM)
    )
