"""Student features kept up to date as score files come in.

A student's features follow from five whole numbers: how many scores, the sum and the sum
of squares of the scaled scores in half points, and the failed and excellent ones.  Whole
numbers add up to the same in any order, so states of parts of the scores merge by addition,
and what a row added can be taken off again when a corrected row replaces it.

A kept state is a versioned path with the rows that count, one per student and subject, and
the students' states.  A batch replaces both at once: readers see all of it or nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorefold.functions.scale import scale4
from scorefold.operators.scores import SCORE, STUDENT, SUBJECT
from scorefold.operators.subjects import dedupe_last
from scorefold.session import durable
from scorefold.sources.versions import current, replace

COUNTS = ["n", "halves", "squares", "failed_subjects", "excellent_subjects"]
FAIL_LT, EXCELLENT_GE = 1.0, 3.5


def score_state(scores: DataFrame, sign: int = 1) -> DataFrame:
    """A row per student with the five numbers of their scores; sign -1 takes them off."""
    half = (scale4(SCORE) * 2).cast("bigint")  # scaled scores are whole or half points
    each = scores.select(STUDENT, half.alias("h")).withColumn("one", F.lit(sign).cast("bigint"))
    return each.groupBy(STUDENT).agg(
        F.sum("one").alias("n"), F.sum(F.col("h") * F.col("one")).alias("halves"), F.sum(F.col("h") * F.col("h") * F.col("one")).alias("squares"),
        F.sum(F.when(F.col("h") < 2 * FAIL_LT, F.col("one")).otherwise(0)).alias("failed_subjects"),
        F.sum(F.when(F.col("h") >= 2 * EXCELLENT_GE, F.col("one")).otherwise(0)).alias("excellent_subjects"),
    )


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all the rows that the states stand for; students whose rows are all taken off are left out."""
    rows = states[0]
    for s in states[1:]:
        rows = rows.unionByName(s)
    return rows.groupBy(STUDENT).agg(*[F.sum(c).alias(c) for c in COUNTS]).where(F.col("n") > 0)


def state_features(state: DataFrame, fill_std: float | None = 0.0) -> DataFrame:
    """GPA, sample spread, failed and excellent counts, as student_features defines them."""
    n = F.col("n")
    variance = F.try_divide(n * F.col("squares") - F.col("halves") * F.col("halves"), n * (n - 1))
    spread = F.sqrt(variance) / 2
    return state.select(
        STUDENT, (F.col("halves") / n / 2).alias("gpa"), (spread if fill_std is None else F.coalesce(spread, F.lit(fill_std))).alias("std_score"),
        "failed_subjects", "excellent_subjects",
    )


def _read(spark: SparkSession, place: str, part: str, like: DataFrame) -> DataFrame:
    """A part of the kept version; no rows if nothing is kept yet."""
    try:
        return spark.read.schema(like.schema).parquet(f"{place}/{part}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], like.schema)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The students' kept states."""
    return spark.read.parquet(f"{current(spark, path)}/state")


def update_state(spark: SparkSession, path: str, batch: DataFrame, version: str = "version") -> None:
    """Merge a batch of scores (ma_sv, ma_mon, diem and a version that rises) into the kept state.

    Of all rows of a student and subject, in this batch or an earlier one, the one with the
    greatest version counts (among equals the greater score, null the least); so late rows,
    corrected rows and a batch that comes twice are all right.  Only students of the batch
    are counted anew, by what the replaced rows take off and the new ones add.
    """
    key = F.struct(STUDENT, SUBJECT)
    fresh = batch.select(F.col(STUDENT), F.col(SUBJECT), F.col(SCORE).cast("double").alias(SCORE), F.col(version).cast("bigint").alias("version"))
    fresh = dedupe_last(fresh.select(key.alias("key"), F.struct("version", SCORE).alias("last")), "key", "last")
    kept = _read(spark, place := current(spark, path), "rows", fresh)
    both = fresh.withColumnRenamed("last", "new").join(kept.withColumnRenamed("last", "old"), "key", "full")
    wins = F.col("new").isNotNull() & (F.col("old").isNull() | (F.col("new") > F.col("old")))
    merged = durable(both.withColumn("wins", F.coalesce(wins, F.lit(False))))
    changed = merged.where("wins")
    added = score_state(changed.select("key.*", "new.*"))
    taken = score_state(changed.where("old is not null").select("key.*", "old.*"), -1)
    state = merge_states(_read(spark, place, "state", added), added, taken)
    rows = merged.select("key", F.when(F.col("wins"), F.col("new")).otherwise(F.col("old")).alias("last"))

    def write(folder: str) -> None:
        rows.write.parquet(f"{folder}/rows")
        state.write.parquet(f"{folder}/state")

    replace(spark, path, write)
