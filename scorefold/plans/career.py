"""Career readiness and the job market."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorefold import labels
from scorefold.operators import cards, clustering, kselect, market, scores
from scorefold.operators.schema import clean_features
from scorefold.operators.search import student_search
from scorefold.session import durable

READINESS_COLUMN = "nhom_san_sang"


def readiness_table(wide: DataFrame) -> DataFrame:
    """Field GPAs, gpa_tong and a numeric TOEIC, 0 where there is none."""
    return clean_features(scores.field_gpa(wide), labels.READINESS_FEATURES)


def label_readiness(
    students: DataFrame, model: PipelineModel | None = None, centres: list[list[float]] | None = None
) -> DataFrame:
    """Add cluster, its rank and the readiness label, best centre first."""
    if model is not None:
        clustering.check_feature_count(model, labels.READINESS_FEATURES)
        column, centres = model.stages[-1].getPredictionCol(), clustering.model_centres(model)
        assigned = clustering.apply_clusters(model, students)
        assigned = assigned if column == "cluster" else assigned.withColumnRenamed(column, "cluster")
    else:
        assigned = clustering.assign_fixed_centres(students, centres, labels.READINESS_FEATURES).drop("sq_dist")
    return clustering.rank_labels(
        assigned, centres, labels.READINESS_FEATURES, labels.READINESS_LABELS, READINESS_COLUMN,
        rank_col="readiness_rank",
    )


def train_readiness(
    wide: DataFrame, k: int | None = None, seed: int = 42, scale: bool = False, k_min: int = 2, k_max: int = 6
) -> tuple[PipelineModel, DataFrame | None]:
    """The readiness model and the sweep's metrics; k is chosen from the data if not given.

    Unscaled by default, so TOEIC (up to 990) outweighs the GPA (up to 4).
    """
    data = durable(readiness_table(wide).select(labels.READINESS_FEATURES))
    metrics = None
    if k is None:
        k, metrics = kselect.suggest_k(data, labels.READINESS_FEATURES, k_min, k_max, seed, scale)
    model = clustering.fit_clusters(data, labels.READINESS_FEATURES, k, seed, scale, prediction_col="cluster")
    return model, metrics


def analyze_students(
    wide: DataFrame,
    jobs: DataFrame | None = None,
    keyword: str = "",
    model: PipelineModel | None = None,
    centres: list[list[float]] | None = None,
    k: int = 3,
) -> DataFrame:
    """Field GPAs, readiness group and market report per matching student.

    Without a model, clusters are fitted on the whole cohort and the keyword
    filters afterwards, so a search never changes anyone's group.  No match
    gives an empty table with all columns; no market gives a null report.
    """
    if model is None and centres is None:
        model, _ = train_readiness(wide, k=k)
    # the search reads the student's own columns, so it comes before all other work
    found = label_readiness(readiness_table(student_search(wide, keyword)), model, centres)
    if jobs is None:
        return found.withColumn("top_matched_jobs", F.lit(None).cast("string"))
    return market.competitiveness_report(market.competitiveness(found, jobs))


def readiness_summary(analysed: DataFrame, n: int = 20) -> tuple[DataFrame, DataFrame]:
    """Share of each readiness group, and the first n entries by student number."""
    return cards.group_share(analysed, READINESS_COLUMN), cards.readiness_lines(analysed, n)
