"""Student risk: scoring, training, cards."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorefold import labels
from scorefold.functions.casts import named
from scorefold.operators import cards, clustering, kselect, scores
from scorefold.operators.schema import project
from scorefold.session import durable

RISK_COLUMNS = ["ma_sv", "ho_ten", *labels.STUDENT_FEATURES, "prediction"]


def risk_features(wide: DataFrame, variant: str = "trained", score_cols: list[str] | None = None) -> DataFrame:
    """The four features as training defines them, per student, or by row in the raw-score variant ("rowwise")."""
    if variant == "trained":
        return scores.student_features_wide(wide, score_cols, group=True)
    if variant == "rowwise":
        return scores.student_features_rowwise(wide, score_cols)
    raise ValueError(f"unknown feature variant: {variant}")


def profile_of_risk(position, k: int):
    """Profile number for a risk position 0..k-1; other sizes than four are spread over the four profiles."""
    by_position = {p: c for c, p in labels.RISK_ORDER.items()}
    last = len(by_position) - 1
    ladder = F
    for p in range(k):
        ladder = ladder.when(position == p, by_position[round(p * last / max(k - 1, 1))])
    return ladder.otherwise(labels.DEFAULT_CLUSTER)


def order_by_risk(assigned: DataFrame, centres: list[list[float]], cluster_col: str) -> DataFrame:
    """Students by risk, riskiest first: prediction is the profile number of the row's centre.

    Risk follows the centre's GPA, not the cluster's arbitrary number.
    """
    k = len(centres)
    ranked = clustering.rank_labels(
        assigned, centres, labels.STUDENT_FEATURES, [""], "__label", cluster_col=cluster_col
    ).withColumn("risk_order", (k - 1) - F.col("rank"))
    out = ranked.withColumn("prediction", profile_of_risk(F.col("risk_order"), k))
    return project(out.orderBy("risk_order", "ma_sv"), RISK_COLUMNS, rounded=["gpa", "std_score"])


def score_risk(
    wide: DataFrame, model: PipelineModel | None, variant: str = "trained", score_cols: list[str] | None = None
) -> DataFrame:
    """Wide scores -> features, profile number, riskiest first; without a model the input comes back."""
    if model is None:
        return wide
    clustering.check_feature_count(model, labels.STUDENT_FEATURES)
    column = model.stages[-1].getPredictionCol()
    scored = clustering.apply_clusters(model, risk_features(wide, variant, score_cols))
    scored = scored.withColumn("__cluster_id", named(column)).drop(column)
    return order_by_risk(scored, clustering.model_centres(model), "__cluster_id")


def train_risk(
    wide: DataFrame, k: int | None = None, seed: int = 1, k_min: int = 2, k_max: int = 8
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """The model, the clustered students, and (silhouette, band); k is chosen from the data if not given."""
    features = durable(risk_features(wide))
    if k is None:
        k, _ = kselect.suggest_k(features, labels.STUDENT_FEATURES, k_min, k_max)
    model = clustering.fit_clusters(features, labels.STUDENT_FEATURES, k, seed)
    clusters, report = clustering.evaluate_model(model, features)
    return model, clusters, report


def student_details(scored: DataFrame, total_subjects) -> DataFrame:
    """Detail cards of scored students."""
    return cards.student_card(scored, total_subjects)
