"""Subject analysis, lists and training."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorefold import labels
from scorefold.functions import rules
from scorefold.operators import clustering, kselect, subjects
from scorefold.operators.schema import clean_features
from scorefold.operators.search import filter_codes
from scorefold.session import durable


def cluster_quality(
    stats: DataFrame, model: PipelineModel | None = None, centres: list[list[float]] | None = None
) -> DataFrame:
    """Add the cluster's quality label, from a fitted pipeline or from fixed centres of the raw features."""
    features = labels.SUBJECT_FEATURES
    if model is not None:
        clustering.check_feature_count(model, features)
        assigned = clustering.apply_clusters(model, stats)
        column, centres = model.stages[-1].getPredictionCol(), clustering.model_centres(model)
    else:
        row = F.struct(*[F.col(f"`{c}`") for c in stats.columns]).alias("__row")
        copy = clean_features(stats.withColumn("__row", row), features)
        assigned = clustering.assign_fixed_centres(copy, centres, features, "prediction").select(
            "__row.*", "prediction"
        )
        column = "prediction"
    return clustering.rank_labels(
        assigned,
        centres,
        features,
        labels.SUBJECT_CLUSTER_LABELS,
        "ChatLuongCluster",
        cluster_col=column,
        beyond=labels.UNKNOWN_LABEL,
    )


def analyze_subjects(
    stats: DataFrame,
    codes: list[str] | DataFrame | None = None,
    model: PipelineModel | None = None,
    centres: list[list[float]] | None = None,
    quality: str = "rank",
) -> DataFrame:
    """Difficulty, quality and trend per subject, of all subjects or of the given codes.

    quality: "rank" (the cluster's label), "collapsed" (three labels), "rule".
    Without a model or centres the rule applies.  All labels read the original
    columns; a missing value is 0 only for the distance to a centre.
    """
    if quality not in ("rank", "collapsed", "rule"):
        raise ValueError(f"unknown quality: {quality}")
    if codes is not None:
        stats = filter_codes(stats, codes)
    labelled = subjects.label_difficulty_and_trend(stats)
    if quality == "rule" or (model is None and centres is None):
        out = labelled.withColumn("ChatLuong", subjects.rule_quality(labelled))
    else:
        clustered = cluster_quality(labelled, model, centres)
        label = "ChatLuongCluster"
        out = clustered.withColumn(
            "ChatLuong", F.col(label) if quality == "rank" else rules.quality_collapse(label)
        )
    return subjects.analysed_columns(out)


def train_subject_quality(
    stats: DataFrame, k: int | None = 4, seed: int = 42, sweep: bool = False, k_min: int = 2, k_max: int = 8
) -> tuple[PipelineModel, DataFrame | None]:
    """The scaled model and, if asked for (or k is None), the metrics of the sweep on the same scaled features."""
    metrics = None
    data = durable(clean_features(stats, labels.SUBJECT_FEATURES).select(labels.SUBJECT_FEATURES))
    if sweep or k is None:
        suggested, metrics = kselect.suggest_k(data, labels.SUBJECT_FEATURES, k_min, k_max, seed, scale=True)
        k = suggested if k is None else k
    return clustering.fit_clusters(data, labels.SUBJECT_FEATURES, k, seed, scale=True), metrics


def subject_report(analysed: DataFrame, order_by: str) -> tuple[DataFrame, DataFrame]:
    """The grouped list and the detail cards, one entry per code (the last by order_by)."""
    unique = subjects.dedupe_last(analysed, "MaMH", order_by)
    return subjects.grouped_list(unique), subjects.subject_detail(unique)
