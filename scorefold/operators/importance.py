"""Which subjects decide a student's readiness group."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorefold.operators.ranks import label_index
from scorefold.operators.schema import columns_between, to_double

SCHEMA = "subject string, percent double"


def top_importances(importances: DataFrame, min_importance: float = 0.01, top: int = 10) -> DataFrame:
    """(column, importance) -> the subjects that matter, as percent with one decimal."""
    return (
        importances.filter(F.col("importance") > min_importance)
        .select(
            F.regexp_extract("column", "^_(.+)_4$", 1).alias("subject"),
            F.round(100 * F.col("importance"), 1).alias("percent"),
        )
        .orderBy(F.desc("percent"), "subject")
        .limit(top)
    )


def feature_importance(
    df: DataFrame,
    feature_cols: list[str] | None = None,
    label_col: str = "nhom_san_sang",
    trees: int = 10,
    depth: int = 5,
    seed: int = 42,
    min_importance: float = 0.01,
    top: int = 10,
) -> DataFrame:
    """Random-forest importances of the `_<code>_4` columns; empty without columns, label or two classes."""
    spark = df.sparkSession
    columns = feature_cols or columns_between(df)
    if not columns or label_col not in df.columns:
        return spark.createDataFrame([], SCHEMA)
    data = to_double(df.select(label_col, *columns), columns).dropna(subset=[label_col])
    if data.select(label_col).distinct().limit(2).count() < 2:
        return spark.createDataFrame([], SCHEMA)
    data = VectorAssembler(inputCols=columns, outputCol="dt_features").transform(label_index(data, label_col))
    forest = RandomForestClassifier(
        featuresCol="dt_features", labelCol="ml_label", numTrees=trees, maxDepth=depth, seed=seed
    ).fit(data.select("dt_features", "ml_label"))
    rows = list(zip(columns, map(float, forest.featureImportances.toArray())))
    return top_importances(spark.createDataFrame(rows, "column string, importance double"), min_importance, top)
