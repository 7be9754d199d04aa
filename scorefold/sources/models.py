"""Saved cluster models."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from scorefold.sources.versions import current, replace


def save_model(model: PipelineModel, path: str) -> None:
    """Save the whole pipeline, scaling included, as the path's new version."""
    replace(SparkSession.active(), path, lambda place: model.write().save(place))


def _is_model(spark: SparkSession, path: str) -> bool:
    """Whether the path holds a saved pipeline; errors other than its absence are raised."""
    try:
        first = spark.read.text(f"{path}/metadata").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    try:
        return first is not None and str(json.loads(first["value"]).get("class", "")).endswith("PipelineModel")
    except (ValueError, AttributeError):
        return False


def load_or(
    path: str | None, on_missing: str = "raise", fit: Callable[[], PipelineModel] | None = None
) -> PipelineModel | None:
    """Load a saved model; without one at the path: "passthrough" -> None, "fit" -> fit(), "raise" -> an error.

    There is none if the path is absent or holds something else.  Any other failure, such
    as a path that may not be read or a model that is damaged, is raised.
    """
    if on_missing not in ("passthrough", "fit", "raise"):
        raise ValueError(f"unknown on_missing: {on_missing}")
    spark = SparkSession.active()
    found = None if path is None else current(spark, path)
    if found is not None and _is_model(spark, found):
        return PipelineModel.load(found)
    if on_missing == "passthrough":
        return None
    if on_missing == "fit":
        return fit()
    raise RuntimeError(f"no model at {path}; train one first")
