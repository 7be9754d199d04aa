"""Training and evaluation data by kind of model."""

from __future__ import annotations

from enum import Enum

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from scorefold import labels
from scorefold.operators import clustering, kselect
from scorefold.plans import career, students, subjects
from scorefold.session import durable
from scorefold.sources.models import save_model
from scorefold.sources.tables import read_scores, read_subject_stats


class Kind(Enum):
    STUDENT = "student"
    READINESS = "readiness"
    SUBJECT = "subject"


def read_input(spark: SparkSession, kind: Kind | str, path: str, schema: str | None = None) -> DataFrame:
    """The CSV a kind of model is trained on; an unknown kind is an error."""
    reader = read_subject_stats if Kind(kind) is Kind.SUBJECT else read_scores
    return reader(spark, path, schema)


def evaluation_data(kind: Kind | str, df: DataFrame) -> tuple[DataFrame, list[str], bool]:
    """The features a kind of model is fitted on, their names, and whether they are scaled."""
    kind = Kind(kind)
    if kind is Kind.STUDENT:
        return students.risk_features(df), labels.STUDENT_FEATURES, False
    if kind is Kind.READINESS:
        return career.readiness_table(df), labels.READINESS_FEATURES, False
    return df, labels.SUBJECT_FEATURES, True


def evaluate_k(kind: Kind | str, df: DataFrame, k_min: int = 2, k_max: int = 8, seed: int = 42) -> DataFrame:
    """The metrics table behind the choice of k, on the features training uses."""
    data, columns, scale = evaluation_data(kind, df)
    return kselect.k_sweep(durable(clustering.clean_features(data, columns).select(columns)), columns, k_min, k_max, seed, scale)


def train(kind: Kind | str, df: DataFrame, k: int, path: str | None = None) -> PipelineModel:
    """Fit one kind of model with k clusters and save it if a path is given."""
    data, columns, scale = evaluation_data(kind, df)
    kind = Kind(kind)
    seed = 1 if kind is Kind.STUDENT else 42
    column = "cluster" if kind is Kind.READINESS else "prediction"
    model = clustering.fit_clusters(durable(data.select(columns)), columns, k, seed, scale, column)
    if path is not None:
        save_model(model, path)
    return model
