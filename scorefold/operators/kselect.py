"""Choosing the number of clusters from a metrics table (k, wcss, silhouette).

A metrics table has one row per tried k, so its unpartitioned windows stay tiny.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorefold.functions.casts import named
from scorefold.operators.clustering import distinct_up_to
from scorefold.operators.joint_kmeans import fit_together
from scorefold.operators.schema import clean_features

METRICS_SCHEMA = "k int, wcss double, silhouette double"


def k_sweep(
    df: DataFrame,
    feature_cols: list[str],
    k_min: int = 2,
    k_max: int = 10,
    seed: int = 42,
    scale: bool = False,
) -> DataFrame:
    """Fit every k and measure it; k stops at the number of distinct feature rows: the table shows which were tried.

    All k are fitted in the same passes over the features, which are cached once; give a
    durable table, so that a lost executor costs a re-read.  The cost never rises with k.
    """
    points = clean_features(df, feature_cols).select(*[named(c).cast("double").alias(c) for c in feature_cols])
    if scale:
        spread = points.agg(*[F.stddev_samp(named(c)).alias(c) for c in feature_cols]).first()
        # a feature that does not vary counts as 0, as in training
        points = points.select(*[(named(c) / spread[c] if spread[c] else F.lit(0.0)).alias(c) for c in feature_cols])
    points = points.persist()
    try:
        tried = list(range(k_min, min(k_max, distinct_up_to(points, k_max)) + 1))
        fits = fit_together(points, feature_cols, tried, seed)
    finally:
        points.unpersist()
    return df.sparkSession.createDataFrame([(k, float(f.cost), float(f.silhouette)) for k, f in fits.items()], METRICS_SCHEMA)


def default_k(metrics: DataFrame) -> DataFrame:
    """The middle k of those tried."""
    position = F.row_number().over(Window.orderBy("k")) - 1
    middle = F.floor(F.count("*").over(Window.partitionBy()) / 2)
    return metrics.withColumns({"__i": position, "__mid": middle}).filter("__i = __mid").select(
        F.col("k").alias("default_k")
    )


def elbow_point(metrics: DataFrame) -> DataFrame:
    """The k after which the fall of wcss slows most (the lowest such k); the middle k below three rows."""
    by_k = Window.orderBy("k")
    drops = metrics.withColumn("__drop", F.lag("wcss").over(by_k) - F.col("wcss"))
    bends = drops.select(
        F.lag("k").over(by_k).alias("elbow_k"), (F.lag("__drop").over(by_k) - F.col("__drop")).alias("bend")
    )
    best = bends.filter("bend is not null").agg(F.min(F.struct((-F.col("bend")).alias("bend"), "elbow_k")).alias("b"))
    fallback = default_k(metrics).scalar()
    return best.select(F.coalesce(F.col("b.elbow_k"), fallback).alias("elbow_k"))


def choose_k(metrics: DataFrame, w_silhouette: float = 0.7, w_wcss: float = 0.3) -> DataFrame:
    """One row: the best k by silhouette, at the elbow, by the weighted score, and the choice.

    The weighted best counts only when one of the other two agrees with it;
    otherwise silhouette decides.  With equal wcss everywhere its part is 0.
    """
    everything = Window.partitionBy()
    high, low = F.max("wcss").over(everything), F.min("wcss").over(everything)
    reduction = F.coalesce(F.try_divide(high - F.col("wcss"), high - low), F.lit(0.0)) * 100
    scored = metrics.withColumn("score", w_silhouette * (F.col("silhouette") * 100) + w_wcss * reduction)
    # greatest value, lowest k among equals
    best = scored.agg(
        F.min(F.struct((-F.col("silhouette")).alias("v"), "k"))["k"].alias("silhouette_k"),
        F.min(F.struct((-F.col("score")).alias("v"), "k"))["k"].alias("combined_k"),
    ).withColumn("elbow_k", elbow_point(metrics).scalar())
    agreed = F.col("combined_k").isin(F.col("silhouette_k"), F.col("elbow_k"))
    return best.select(
        "silhouette_k", "elbow_k", "combined_k",
        F.when(agreed, F.col("combined_k")).otherwise(F.col("silhouette_k")).alias("optimal_k"),
    )


def suggest_k(
    df: DataFrame,
    feature_cols: list[str],
    k_min: int = 2,
    k_max: int = 8,
    seed: int = 42,
    scale: bool = False,
    auto_select: bool = True,
) -> tuple[int, DataFrame]:
    """The suggested k and the metrics it rests on."""
    metrics = k_sweep(df, feature_cols, k_min, k_max, seed, scale)
    if auto_select:
        return choose_k(metrics).first()["optimal_k"], metrics
    return default_k(metrics).first()["default_k"], metrics
