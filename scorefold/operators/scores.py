"""Score tables: wide <-> long, student features, field GPAs.

Long form (student, subject, score) aggregates with map-side combine, so one
student or subject holding a large part of the rows costs no extra.  A wide
table already has each student's scores on one row, so its operators are plain
column arithmetic and never shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorefold import labels
from scorefold.functions.casts import named, quoted, string_sql
from scorefold.functions.scale import reaches_sql, scale4, scale4_sql
from scorefold.operators.schema import columns_except

STUDENT, NAME, SUBJECT, SCORE = "ma_sv", "ho_ten", "ma_mon", "diem"


def number_sql(name: str) -> str:
    """A score column as a double, null where it holds no number."""
    return f"try_cast({quoted(name)} AS DOUBLE)"


def sum_sql(terms: list[str]) -> str:
    return " + ".join(terms)


def unpivot_scores(
    wide: DataFrame,
    id_cols=(STUDENT,),
    non_score_cols=(NAME,),
    score_cols: list[str] | None = None,
) -> DataFrame:
    """One row per student and subject; missing scores stay as null rows.

    Name score_cols to read only those: a filter on the subject afterwards
    would not reach the scan.
    """
    scores = score_cols or columns_except(wide, [*id_cols, *non_score_cols])
    # one common type first: inferred schemas mix int and double
    typed = wide.select(*[named(c) for c in id_cols], *[F.expr(number_sql(c)).alias(c) for c in scores])
    return typed.unpivot([named(c) for c in id_cols], [named(c) for c in scores], SUBJECT, SCORE)


def pivot_scores(scores: DataFrame, subjects: list[str], aggregate: str = "avg") -> DataFrame:
    """One column per listed subject, null where a student has no score.

    One filtered aggregate per subject: a single shuffle by student, where the
    two-phase pivot would first shuffle by (student, subject).
    """
    return scores.groupBy(STUDENT).agg(
        *[
            F.expr(f"{aggregate}({SCORE}) FILTER (WHERE {SUBJECT} = {string_sql(code)})").alias(code)
            for code in subjects
        ]
    )


def student_features(
    scores: DataFrame,
    scale=scale4,
    std: str = "sample",
    fail_lt: float = 1.0,
    excellent_ge: float = 3.5,
    fill_std: float | None = 0.0,
) -> DataFrame:
    """GPA, spread, failed and excellent counts per student, on the 4-point scale.

    A missing or out-of-range score counts as 0 and so as failed.  The sample
    spread of a single score is undefined; fill_std replaces it (None keeps null).
    """
    spread = {"sample": F.stddev_samp, "population": F.stddev_pop}[std]("h4")
    return (
        scores.select(STUDENT, scale(SCORE).alias("h4"))
        .groupBy(STUDENT)
        .agg(
            F.avg("h4").alias("gpa"),
            (spread if fill_std is None else F.coalesce(spread, F.lit(fill_std))).alias("std_score"),
            F.count_if(F.col("h4") < fail_lt).alias("failed_subjects"),
            F.count_if(F.col("h4") >= excellent_ge).alias("excellent_subjects"),
        )
    )


def student_features_rowwise(
    wide: DataFrame,
    score_cols: list[str] | None = None,
    id_cols=(STUDENT, NAME),
    non_score_cols=("TOEIC",),
    std: str = "population",
    counts: str = "raw",
    fail_lt: float = 4,
    excellent_ge: float = 8,
    fill_std: float | None = 0.0,
    group: bool = False,
) -> DataFrame:
    """The four features from a wide row, without a shuffle.

    The defaults are the scoring variant: population spread, counts on the raw
    score, and a missing score lowers the GPA but counts neither as failed nor
    as excellent.  counts="scaled" counts on the 4-point scale instead.  group puts
    the rows of one student together, as a long table would; it shuffles the sums.
    """
    ids = [named(c) for c in id_cols if c in wide.columns]
    codes = score_cols or columns_except(wide, [*id_cols, *non_score_cols])
    n = len(codes)
    raw = [number_sql(c) for c in codes]
    h = [f"({scale4_sql(r)})" for r in raw]
    # The ladders stay expressions of one projection, and the counts read an array:
    # a projection of so many columns as plain branches would make one Java method
    # too long for the JIT compiler, several times slower than this.
    taken = f"array({', '.join(raw)})"
    if counts == "scaled":
        failed = f"{n} - size(filter({taken}, x -> {reaches_sql('x', fail_lt)}))"
        excellent = f"size(filter({taken}, x -> {reaches_sql('x', excellent_ge)}))"
    elif counts == "raw":
        failed = f"size(filter({taken}, x -> x < {fail_lt}))"
        excellent = f"size(filter({taken}, x -> x >= {excellent_ge}))"
    else:
        raise ValueError(f"unknown counts: {counts}")
    sums = wide.select(
        *ids,
        F.expr(sum_sql(h)).alias("s1"),
        F.expr(sum_sql([f"{x} * {x}" for x in h])).alias("s2"),
        F.expr(f"CAST({failed} AS BIGINT)").alias("failed_subjects"),
        F.expr(f"CAST({excellent} AS BIGINT)").alias("excellent_subjects"),
    )
    count = F.lit(n)
    if group:
        key, *others = [c for c in id_cols if c in wide.columns]
        added = ["s1", "s2", "failed_subjects", "excellent_subjects"]
        sums = sums.groupBy(named(key)).agg(
            *[F.max(named(c)).alias(c) for c in others], *[F.sum(c).alias(c) for c in added], F.count("*").alias("__rows")
        )
        count = n * F.col("__rows")
    # 4-point values are multiples of one half, so s1, s2 and n*s2 - s1*s1 are exact
    spread2 = F.greatest(F.lit(0.0), count * F.col("s2") - F.col("s1") * F.col("s1"))
    degrees = {"population": count * count, "sample": count * (count - 1)}[std]
    deviation = F.coalesce(F.sqrt(F.try_divide(spread2, degrees)), F.lit(fill_std).cast("double"))
    return sums.select(
        *ids, (F.col("s1") / count).alias("gpa"), deviation.alias("std_score"), "failed_subjects", "excellent_subjects"
    )


def student_features_wide(wide: DataFrame, score_cols: list[str] | None = None, **options) -> DataFrame:
    """student_features for a wide table with one row per student, without unpivoting it."""
    return student_features_rowwise(
        wide, score_cols, std="sample", counts="scaled", fail_lt=1.0, excellent_ge=3.5, **options
    )


def gpa_column(field: str) -> str:
    return "gpa_" + field.replace(" ", "_").replace("/", "_")


def field_gpa(wide: DataFrame, fields: dict[str, list[str]] | None = None, digits: int = 2) -> DataFrame:
    """Add `_<code>_4` per mapped subject, `gpa_<field>` per field and `gpa_tong`.

    Means run over the subjects the table has; a field with none gets 0.0.
    """
    fields = fields or labels.CAREER_FIELDS
    present = {field: [c for c in codes if c in wide.columns] for field, codes in fields.items()}
    mapped = [c for codes in present.values() for c in codes]
    scaled = {c: f"({scale4_sql(number_sql(c))})" for c in dict.fromkeys(mapped)}

    def mean(codes: list[str]) -> Column:
        if not codes:
            return F.lit(0.0)
        # Doubling both sides changes no bit, but a ladder used twice is compiled as a
        # shared method of its own; inlined, this many ladders make one Java method
        # too long for the JIT compiler, several times slower when only a mean is read.
        doubled = sum_sql([f"{scaled[c]} + {scaled[c]}" for c in codes])
        return F.round(F.expr(doubled) / (2 * len(codes)), digits)

    added = {
        **{f"_{c}_4": F.expr(h) for c, h in scaled.items()},
        **{gpa_column(field): mean(codes) for field, codes in present.items()},
        "gpa_tong": mean(mapped),
    }
    return wide.select(
        *[named(c) for c in wide.columns if c not in added], *[value.alias(c) for c, value in added.items()]
    )


def field_gpa_long(
    scores: DataFrame,
    fields: dict[str, list[str]] | None = None,
    subjects: list[str] | None = None,
    digits: int = 2,
) -> DataFrame:
    """`gpa_<field>` and `gpa_tong` per student from long scores, in one aggregation.

    With `subjects` (the table's whole subject list) a subject the student
    lacks counts as 0, as in the wide form.  Without it, means run over the
    rows the student has, and a field without rows is 0.0.
    """
    fields = fields or labels.CAREER_FIELDS
    present = {f: [c for c in codes if subjects is None or c in subjects] for f, codes in fields.items()}
    mapped = [c for codes in present.values() for c in codes]

    def mean(codes: list[str]) -> Column:
        if not codes:
            return F.lit(0.0)
        # a subject listed under several fields weighs as often in the overall mean
        weights = {c: codes.count(c) for c in codes}
        weight = F
        for times in sorted(set(weights.values())):
            weight = weight.when(named(SUBJECT).isin([c for c in weights if weights[c] == times]), times)
        points = F.coalesce(F.sum(weight * F.col("h4")), F.lit(0.0))
        if subjects is None:
            return F.round(F.coalesce(F.try_divide(points, F.sum(weight)), F.lit(0.0)), digits)
        return F.round(points / len(codes), digits)

    return (
        # every student keeps a row, so unmapped subjects are not filtered out
        scores.select(STUDENT, SUBJECT, scale4(SCORE).alias("h4"))
        .groupBy(STUDENT)
        .agg(
            *[mean(codes).alias(gpa_column(f)) for f, codes in present.items()],
            mean(mapped).alias("gpa_tong"),
        )
    )
