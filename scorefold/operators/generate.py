"""Demo cohorts whose every value is a function of (seed, student, subject).

Values come from a hash of the keys, so a retried or repartitioned task makes
the same rows again, which rand() would not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorefold import labels

NAME_PREFIX = "SinhVien_"


def _digest(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def _uniform(digest: Column, word: int) -> Column:
    """One of the four 32-bit words of a digest as a number in (0, 1)."""
    number = F.conv(F.substring(digest, 8 * word + 1, 8), 16, 10).cast("double")
    return (number + 0.5) / 4294967296.0


def _normal(u: Column, v: Column) -> Column:
    return F.sqrt(-2.0 * F.log(u)) * F.cos(6.283185307179586 * v)


def _by_group(pick: int) -> Column:
    ladder = F
    for name, *values in labels.COHORT_GROUPS:
        ladder = ladder.when(F.col("cohort_group") == name, values[pick])
    return ladder


def with_group(students: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Add the ability group of each student."""
    draw = _uniform(_digest(F.lit(seed), F.col(key)), 0)
    group = F
    for name, upto, *_ in labels.COHORT_GROUPS[:-1]:
        group = group.when(draw < upto, name)
    return students.withColumn("cohort_group", group.otherwise(labels.COHORT_GROUPS[-1][0]))


def _score(digest: Column) -> Column:
    slips = (F.col("cohort_group") == labels.COHORT_GROUPS[-1][0]) & (
        _uniform(digest, 2) < labels.COHORT_FAIL_SHARE
    )
    mean = F.when(slips, labels.COHORT_FAIL_MEAN).otherwise(_by_group(1))
    sd = F.when(slips, labels.COHORT_FAIL_SD).otherwise(_by_group(2))
    score = mean + sd * _normal(_uniform(digest, 0), _uniform(digest, 1))
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(10.0), score)), 1)


def generate_scores(students: DataFrame, key: str, subjects: list[str] | None = None, seed: int = 42) -> DataFrame:
    """Long scores for a table of students: (key, cohort_group, ma_mon, diem).

    Students fall into four ability groups; the weakest one fails a share of
    its subjects.
    """
    rows = with_group(students.select(key), key, seed).select(
        key, "cohort_group", F.explode(F.lit(subjects or labels.COHORT_SUBJECTS)).alias("ma_mon")
    )
    digests = rows.withColumn("__h", _digest(F.lit(seed), F.col(key), F.col("ma_mon")))
    return digests.withColumn("diem", _score(F.col("__h"))).drop("__h")


def generate_toeic(students: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Add TOEIC, by the group of generate_scores, in steps of 5 within 200..990."""
    h = _digest(F.lit(seed), F.col(key), F.lit("TOEIC"))
    raw = F.rint(_by_group(3) + _by_group(4) * _normal(_uniform(h, 0), _uniform(h, 1)))
    stepped = (F.rint(raw / 5.0) * 5.0).cast("int")
    return students.withColumn("TOEIC", F.greatest(F.lit(200), F.least(F.lit(990), stepped)))


def generate_cohort(
    spark: SparkSession, n: int, subjects: list[str] | None = None, seed: int = 42, toeic: bool = False
) -> DataFrame:
    """n students in wide form: ma_sv, ho_ten, one column per subject, optional TOEIC."""
    subjects = subjects or (list(labels.SUBJECT_NAMES) if toeic else labels.COHORT_SUBJECTS)
    person = F.col("id")
    people = with_group(spark.range(n), "id", seed)
    people = generate_toeic(people, "id", seed) if toeic else people
    digests = people.withColumns({f"__h{i}": _digest(F.lit(seed), person, F.lit(c)) for i, c in enumerate(subjects)})
    # lpad would cut longer numbers
    digits = F.greatest(F.length(person.cast("string")), F.lit(5))
    return digests.select(
        F.concat(F.lit("SV"), F.lpad(person.cast("string"), digits, F.lit("0"))).alias("ma_sv"),
        F.concat(F.lit(NAME_PREFIX), person.cast("string")).alias("ho_ten"),
        *[_score(F.col(f"__h{i}")).alias(c) for i, c in enumerate(subjects)],
        *([F.col("TOEIC")] if toeic else []),
    )
