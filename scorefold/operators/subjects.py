"""Subject (course) statistics, labels, lists and reports."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorefold import labels
from scorefold.functions import bands, rules
from scorefold.functions.casts import named
from scorefold.operators.ranks import medians
from scorefold.operators.schema import missing_columns, to_double

# lower bounds of the letter bands on the 10-point scale (a parameter, not part of the rules)
LETTER_CUTS = (("A+%", 9.0), ("A%", 8.5), ("B%", 7.0), ("C%", 5.5), ("D%", 4.0))


def subject_stats(
    scores: DataFrame,
    subject: str = "ma_mon",
    score: str = "diem",
    weight: str | None = None,
    cuts=LETTER_CUTS,
    missing: Column | None = None,
    name: str | None = None,
) -> DataFrame:
    """TB, SD, the letter shares, the median TV and MTC% per subject.

    The first step counts equal scores, so a subject with a third of all rows
    leaves each task as at most one row per distinct score; mean, spread,
    shares and the exact median then come from those counts, the median by
    selection over ranges of scores (see ranks.medians).  `weight` says how
    many results a row stands for.  MTC% is the share of null scores unless
    `missing` gives another expression.  `name` carries a subject's name along.
    """
    n = F.col("n")
    x = F.col("x")
    keys = [named(subject).alias("MaMH"), *([named(name).alias("TenMH")] if name else [])]
    ids = ["MaMH", "TenMH"][: len(keys)]
    counts = (
        scores.select(*keys, named(score).cast("double").alias("x"),
                      (named(weight) if weight else F.lit(1)).cast("bigint").alias("w"))
        .groupBy(*ids, "x")
        .agg(F.sum("w").alias("n"))
    )
    scored = F.sum(F.when(x.isNotNull(), n))

    def share(condition: Column) -> Column:
        return F.try_divide(100.0 * F.coalesce(F.sum(F.when(condition, n)), F.lit(0)), scored)

    shares, above = [], None
    for name, floor in cuts:
        shares.append(share((x >= floor) if above is None else (x >= floor) & (x < above)).alias(name))
        above = floor
    shares.append(share(x < above).alias("F%"))
    s1, s2 = F.sum(n * x), F.sum(n * x * x)
    variance = F.try_divide(scored * s2 - s1 * s1, scored * (scored - 1))
    # greatest() skips nulls, so a single score is kept apart
    spread = F.when(scored > 1, F.sqrt(F.greatest(F.lit(0.0), variance)))
    lost = F.coalesce(F.sum(F.when(x.isNull(), n)), F.lit(0))
    whole = counts.groupBy(*ids).agg(
        F.try_divide(s1, scored).alias("TB"),
        spread.alias("SD"),
        *shares,
        (missing if missing is not None else 100.0 * lost / F.sum(n)).alias("MTC%"),
    )
    middle = medians(counts, ids, "x", "n", "TV").select(*[F.col(i).alias(f"__{i}") for i in ids], "TV")
    same = reduce(and_, [F.col(i).eqNullSafe(F.col(f"__{i}")) for i in ids])
    return whole.join(middle, same, "left").drop(*[f"__{i}" for i in ids])


def label_difficulty_and_trend(stats: DataFrame) -> DataFrame:
    return to_double(stats, labels.SUBJECT_NUMERIC, None).withColumns(
        {"DoKho": rules.difficulty(), "XuHuong": rules.trend()}
    )


def rule_quality(stats: DataFrame) -> Column:
    """The rule label, or the no-data label when the spread columns are absent."""
    if missing_columns(stats, ["SD", "A%", "A+%"]):
        return rules.quality_no_data()
    return rules.quality_rule()


def analysed_columns(labelled: DataFrame) -> DataFrame:
    return labelled.select(
        "MaMH",
        "TenMH",
        "DoKho",
        "ChatLuong",
        "XuHuong",
        F.round(named("TB"), 2).alias("TB"),
        F.round(named("F%"), 2).alias("F%"),
    )


def dedupe_last(df: DataFrame, key: str, order_by: str) -> DataFrame:
    """One row per key, the one with the greatest order_by; null comes before all values.

    Among equals the row with the greatest other columns, from the left, so a rerun
    keeps the same one.  max combines before the shuffle; a row_number per key would
    sort a hot key's rows in one task.
    """
    others = [c for c in df.columns if c != key]
    last = F.max(F.struct(named(order_by).alias("__order"), *[named(c) for c in others])).alias("last")
    return df.groupBy(named(key)).agg(last).select(named(key), "last.*").select(*[named(c) for c in df.columns])


def with_priority(subjects: DataFrame) -> DataFrame:
    return subjects.withColumns(
        {
            "priority": rules.subject_priority("ChatLuong"),
            "group_label": rules.subject_group_label("ChatLuong"),
            "color": rules.subject_group_color("ChatLuong"),
        }
    )


def priority_sorted(subjects: DataFrame, by: str = "TenMH") -> DataFrame:
    """Worst group first, then by name (or by="MaMH")."""
    return with_priority(subjects).orderBy("priority", F.coalesce(named(by), F.lit("")), "MaMH")


LIST_ORDER = ["priority", "is_detail", "sort_name", "MaMH"]


def _list_rows(subjects: DataFrame, by: str) -> DataFrame:
    name = F.coalesce(F.col("TenMH"), F.lit(""))
    return with_priority(subjects).select(
        "priority",
        F.col("MaMH").cast("string").alias("MaMH"),
        (name if by == "TenMH" else F.lit("")).alias("sort_name"),
        F.concat(F.lit("  "), F.col("MaMH").cast("string"), F.lit(" – "), name).alias("item"),
    )


def _with_headers(rows: DataFrame, headers: dict[int, str]) -> DataFrame:
    """All the rows, equal ones too, plus one header per priority they hold."""
    header = F
    for priority, text in headers.items():
        header = header.when(F.col("priority") == priority, "  " + text)
    # leaves each task as at most one row per priority
    shown = rows.select("priority").distinct().select(
        "priority", F.lit(0).alias("is_detail"), F.lit("").alias("sort_name"), F.lit(None).cast("string").alias("MaMH"), header.alias("item")
    )
    return rows.withColumn("is_detail", F.lit(1)).select(*LIST_ORDER, "item").unionByName(shown)


def grouped_list(subjects: DataFrame, headers: dict[int, str] | None = labels.LIST_HEADERS) -> DataFrame:
    """The list to show: a header row, then its subjects, group by group.

    Position is the order (priority, is_detail, sort_name, MaMH), kept as
    columns, because a global row number would gather the list in one task.
    """
    rows = _list_rows(subjects, "TenMH")
    if headers is None:
        return rows.withColumn("is_detail", F.lit(1)).select(*LIST_ORDER, "item").orderBy(*LIST_ORDER)
    return _with_headers(rows, headers).select(*LIST_ORDER, "item").orderBy(*LIST_ORDER)


def filter_subject_list(subjects: DataFrame, keyword: str = "") -> DataFrame:
    """The list by (priority, code): flat matches for a keyword, all with headers without one."""
    rows = _list_rows(subjects, "MaMH")
    keyword = keyword.strip().lower()
    if keyword:
        rows = rows.filter(F.lower("item").contains(keyword)).withColumn("is_detail", F.lit(1))
    else:
        rows = _with_headers(rows, labels.FILTER_HEADERS)
    return rows.select(*LIST_ORDER, "item").orderBy(*LIST_ORDER)


def report_lines(
    subjects: DataFrame, difficulty: bool = True, quality: bool = True, trend: bool = True
) -> DataFrame:
    """The text report: rows (MaMH, seq, tag, text), seq counting the shown lines of a subject."""

    def shown(column: str) -> Column:
        return F.coalesce(named(column).cast("string"), F.lit("None"))

    def line(tag: str, *parts) -> Column:
        texts = [F.lit(p) if isinstance(p, str) else p for p in parts]
        return F.struct(F.lit(tag).alias("tag"), F.concat(*texts).alias("text"))

    lines = [line("header", "Nội dung phân tích ", shown("TenMH"), " (", shown("MaMH"), "):\n")]
    if difficulty:
        lines += [
            line("subheader", "1. Độ khó của học phần:\n"),
            line("content", "- Đánh giá: ", shown("DoKho"), " (Điểm TB: ", shown("TB"),
                 ", Tỷ lệ rớt: ", shown("F%"), "%)\n"),
        ]
    if quality:
        lines += [
            line("subheader", "2. Chất lượng giảng dạy:\n"),
            line("content", "- Đánh giá: ", shown("ChatLuong"), "\n"),
        ]
    if trend:
        lines += [
            line("subheader", "3. Xu hướng học tập chung của sinh viên:\n"),
            line("content", "- Đánh giá: ", shown("XuHuong"), "\n"),
        ]
    lines.append(line("divider", "\n" + "-" * 40 + "\n\n"))
    return subjects.select("MaMH", F.posexplode(F.array(*lines)).alias("pos", "line")).select(
        "MaMH", (F.col("pos") + 1).alias("seq"), "line.tag", "line.text"
    )


def subject_detail(subjects: DataFrame) -> DataFrame:
    """Detail card of each analysed subject: bands, colours and bar fractions."""
    number = {c: F.coalesce(named(c).cast("string"), F.lit("None")) for c in ("TB", "F%")}
    return with_priority(subjects).select(
        "MaMH",
        F.coalesce("TenMH", F.col("MaMH").cast("string")).alias("TenMH"),
        "priority",
        "group_label",
        F.coalesce("DoKho", F.lit("-")).alias("DoKho"),
        F.coalesce("ChatLuong", F.lit("-")).alias("ChatLuong"),
        F.coalesce("XuHuong", F.lit("-")).alias("XuHuong"),
        F.concat(F.lit("TB: "), number["TB"], F.lit("  |  Rớt: "), number["F%"], F.lit("%")).alias("badge"),
        bands.subject_average_label("TB").alias("average_label"),
        bands.subject_average_color("TB").alias("average_color"),
        bands.subject_average_fraction("TB").alias("average_fraction"),
        bands.fail_rate_label("F%").alias("fail_label"),
        bands.fail_rate_color("F%").alias("fail_color"),
        bands.fail_rate_fraction("F%").alias("fail_fraction"),
    )
