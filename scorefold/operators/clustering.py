"""Grouping students and subjects: KMeans pipelines, fixed centres, rank labels.

KMeans numbers its clusters arbitrarily (the numbers change with the seed and
with the partitioning), so every meaning here hangs on the rank of a centre,
never on its number.
"""

from __future__ import annotations

import logging
from functools import reduce
from operator import add

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorefold import labels
from scorefold.functions import bands
from scorefold.functions.casts import named
from scorefold.functions.rules import lookup
from scorefold.operators.schema import clean_features

RAW, VECTOR = "raw_features", "features"
log = logging.getLogger(__name__)


# --- features ---------------------------------------------------------------

def feature_stages(feature_cols: list[str], scale: bool = False) -> list:
    """Vector assembly, with division by the sample deviation when scale is set."""
    if not scale:
        return [VectorAssembler(inputCols=feature_cols, outputCol=VECTOR)]
    return [
        VectorAssembler(inputCols=feature_cols, outputCol=RAW),
        StandardScaler(inputCol=RAW, outputCol=VECTOR, withStd=True, withMean=False),
    ]


def assemble(df: DataFrame, feature_cols: list[str], scale: bool = False) -> DataFrame:
    """Add the feature vector; missing and null features count as 0."""
    df = clean_features(df, feature_cols)
    out = Pipeline(stages=feature_stages(feature_cols, scale)).fit(df).transform(df)
    return out.drop(RAW)


def vector_columns(df: DataFrame, names: list[str], vector: str = VECTOR) -> DataFrame:
    """The vector's entries as plain columns, in place of the vector."""
    values = vector_to_array(vector)
    return df.withColumns({n: values[i] for i, n in enumerate(names)}).drop(vector)


# --- fitted models ----------------------------------------------------------

def distinct_up_to(df: DataFrame, limit: int) -> int:
    """min(number of distinct rows, limit).

    A sketch of fixed size tells many distinct rows from few; few leave each task as few rows, so only
    those are compared in a shuffle.
    """
    about = df.agg(F.approx_count_distinct(F.xxhash64(*[named(c) for c in df.columns]))).first()[0]
    return limit if about > 10 * limit + 100 else df.distinct().limit(limit).count()


def _lowered(k: int, distinct: int) -> int:
    if distinct < k:
        log.warning("k lowered from %d to the %d distinct feature rows", k, distinct)
    return min(k, distinct)


def fit_clusters(
    df: DataFrame,
    feature_cols: list[str],
    k: int,
    seed: int,
    scale: bool = False,
    prediction_col: str = "prediction",
) -> PipelineModel:
    """Fit assembly, optional scaling and KMeans as one model, so scoring scales as training did.

    k is lowered to the number of distinct feature rows, with a warning in the log.
    """
    data = clean_features(df, feature_cols).select(*[named(c) for c in feature_cols])
    distinct = distinct_up_to(data, k)
    if distinct < 2:
        raise ValueError("clustering needs at least two distinct feature rows")
    kmeans = KMeans(k=_lowered(k, distinct), seed=seed, featuresCol=VECTOR, predictionCol=prediction_col)
    return Pipeline(stages=[*feature_stages(feature_cols, scale), kmeans]).fit(data)


def model_features(model: PipelineModel) -> list[str]:
    return model.stages[0].getInputCols()


def check_feature_count(model: PipelineModel, feature_cols: list[str]) -> None:
    found = len(model.stages[-1].clusterCenters()[0])
    if found != len(feature_cols):
        raise ValueError(f"the model expects {found} features, the data has {len(feature_cols)}")


def apply_clusters(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Nearest-centre cluster per row; nulls are replaced in the features only, not in the row."""
    features = model_features(model)
    kept = F.struct(*[named(c) for c in df.columns]).alias("__row")
    data = clean_features(df.select(kept, *[named(c) for c in features if c in df.columns]), features)
    return model.transform(data).select("__row.*", model.stages[-1].getPredictionCol())


def model_centres(model: PipelineModel) -> list[list[float]]:
    return [[float(v) for v in centre] for centre in model.stages[-1].clusterCenters()]


def misplaced(model: PipelineModel, df: DataFrame) -> DataFrame:
    """One row: n rows, clusters in use, the sum of squared distances, and rows that another centre is nearer to."""
    features, column = model_features(model), model.stages[-1].getPredictionCol()
    names, centres = [f"__f{i}" for i in range(len(features))], model_centres(model)
    vectors = model.transform(clean_features(df, features)).select(VECTOR, named(column).alias("__own"))
    table = assign_fixed_centres(vector_columns(vectors, names), centres, names, "__nearest")
    own = F
    for i, centre in enumerate(centres):
        own = own.when(F.col("__own") == i, _squared_distance(centre, names))
    # vector arithmetic rounds differently, so a tie is not a fault
    far = own > F.col("sq_dist") + 1e-6 * (1 + F.col("sq_dist"))
    return table.agg(
        F.count("*").alias("n"), F.count_distinct("__own").alias("clusters"), F.sum(own).alias("wcss"), F.count_if(far).alias("misplaced")
    )


def centres_frame(spark: SparkSession, centres: list[list[float]], feature_cols: list[str]) -> DataFrame:
    """One row per cluster: cluster and its centre in each feature."""
    schema = "cluster int, " + ", ".join(f"`{c}` double" for c in feature_cols)
    return spark.createDataFrame([(i, *map(float, c)) for i, c in enumerate(centres)], schema)


def centres_long(spark: SparkSession, centres: list[list[float]], feature_cols: list[str]) -> DataFrame:
    """The centres to print: rows (cluster, feature, value)."""
    wide = centres_frame(spark, centres, feature_cols)
    return wide.unpivot("cluster", [named(c) for c in feature_cols], "feature", "value")


def evaluate_model(model: PipelineModel, df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The clustered rows, and one row (silhouette, band); df is read twice, so it should be durable."""
    column = model.stages[-1].getPredictionCol()
    vectors = model.transform(clean_features(df, model_features(model))).select(VECTOR, column)
    score = ClusteringEvaluator(predictionCol=column, featuresCol=VECTOR).evaluate(vectors)
    report = df.sparkSession.createDataFrame([(float(score),)], "silhouette double")
    return apply_clusters(model, df), report.withColumn("band", bands.silhouette_label("silhouette"))


# --- fixed centres ----------------------------------------------------------

def _squared_distance(centre: list[float], feature_cols: list[str]) -> Column:
    parts = [(named(c) - float(v)) * (named(c) - float(v)) for c, v in zip(feature_cols, centre)]
    return reduce(add, parts)


def assign_fixed_centres(
    df: DataFrame, centres: list[list[float]], feature_cols: list[str], cluster_col: str = "cluster"
) -> DataFrame:
    """Add the nearest centre's number (lowest wins a tie) and the squared distance to it.

    The centres are constants in the expression: no join, no row blow-up.
    """
    distances = df.withColumns({f"__d{i}": _squared_distance(c, feature_cols) for i, c in enumerate(centres)})
    columns = [F.col(f"__d{i}") for i in range(len(centres))]
    nearest = F.least(*columns) if len(columns) > 1 else columns[0]
    picked = F
    for i, d in enumerate(columns):
        picked = picked.when(d == F.col("sq_dist"), i)
    return (
        distances.withColumn("sq_dist", nearest)
        .withColumn(cluster_col, picked)
        .drop(*[f"__d{i}" for i in range(len(centres))])
    )


def wcss(assigned: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """Rows and sum of squared distances per cluster."""
    return assigned.groupBy(named(cluster_col)).agg(F.count("*").alias("n"), F.sum("sq_dist").alias("wcss"))


def cluster_sums(k: int, feature_cols: list[str], cluster_col: str = "cluster") -> Column:
    """An aggregate: count, sum of squared norms and coordinate sums of the clusters 0..k-1, as one struct."""
    norm = reduce(add, [named(c) * named(c) for c in feature_cols])
    own = named(cluster_col)
    stats = []
    for j in range(k):
        inside = own == j
        stats.append(
            F.struct(
                F.count_if(inside).cast("double").alias("n"),
                F.sum(F.when(inside, norm)).alias("psi"),
                *[F.sum(F.when(inside, named(c))).alias(f"y{i}") for i, c in enumerate(feature_cols)],
            ).alias(f"c{j}")
        )
    return F.struct(*stats)


def silhouette(
    assigned: DataFrame, k: int, feature_cols: list[str], cluster_col: str = "cluster", sums: Column | None = None
) -> DataFrame:
    """Add each row's silhouette for squared Euclidean distance.

    The mean squared distance from x to a cluster needs only that cluster's
    count, coordinate sums and sum of squared norms.  One aggregation makes
    these for all k clusters; a scalar subquery hands them to every task, so no
    pair of rows is ever formed.  A row alone in its cluster gets 0.  sums are the
    cluster_sums, if a column holds them already.
    """
    norm = reduce(add, [named(c) * named(c) for c in feature_cols])
    own = named(cluster_col)
    summary = assigned.agg(cluster_sums(k, feature_cols, cluster_col).alias("s")).scalar() if sums is None else sums

    table = assigned.withColumns({"__norm": norm, "__s": summary})
    means = {}
    for j in range(k):
        c = F.col(f"__s.c{j}")
        dot = reduce(add, [named(f) * c[f"y{i}"] for i, f in enumerate(feature_cols)])
        # null for an empty cluster
        means[f"__m{j}"] = F.when(c["n"] > 0, F.col("__norm") + c["psi"] / c["n"] - 2.0 * dot / c["n"])
    table = table.withColumns(means)
    size, inner, outer = F, F, []
    for j in range(k):
        size = size.when(own == j, F.col(f"__s.c{j}.n"))
        inner = inner.when(own == j, F.col(f"__m{j}"))
        outer.append(F.when(own != j, F.col(f"__m{j}")))
    table = table.withColumns({"__n": size, "__a": inner, "__b": F.least(*outer) if k > 1 else outer[0]})
    a = F.col("__a") * F.col("__n") / (F.col("__n") - 1)
    value = F.when(F.col("__n") <= 1, 0.0).otherwise(
        F.coalesce(F.try_divide(F.col("__b") - a, F.greatest(F.col("__b"), a)), F.lit(0.0))
    )
    return table.withColumn("silhouette", value).drop(
        "__norm", "__s", "__n", "__a", "__b", *[f"__m{j}" for j in range(k)]
    )


# --- rank labels ------------------------------------------------------------

def rank_centres(centres: DataFrame, by: list[str]) -> DataFrame:
    """Rank of each centre, 0 the highest in the first feature, further features breaking ties."""
    # one row per cluster: the unpartitioned window stays as small as the model
    order = Window.orderBy(*[named(c).desc() for c in by], F.col("cluster"))
    return centres.withColumn("rank", F.row_number().over(order) - 1)


def rank_label(rank, pack: list[str], beyond: str | None = None) -> Column:
    """Label of a rank; ranks past the pack get `beyond`, or the last label."""
    ladder = F
    for i, label in enumerate(pack):
        ladder = ladder.when(rank == i, label)
    last = pack[-1] if beyond is None else beyond
    return ladder.when(rank >= len(pack), last).otherwise(labels.UNKNOWN_LABEL)


def rank_labels(
    assigned: DataFrame,
    centres: list[list[float]],
    feature_cols: list[str],
    pack: list[str],
    label_col: str,
    cluster_col: str = "cluster",
    beyond: str | None = None,
    rank_col: str = "rank",
) -> DataFrame:
    """Add the rank of each row's centre and the label of that rank."""
    ranked = rank_centres(centres_frame(assigned.sparkSession, centres, feature_cols), feature_cols)
    table = ranked.select(F.col("cluster").alias("__cluster"), F.col("rank").alias(rank_col))
    joined = assigned.join(
        F.broadcast(table), named(cluster_col) == F.col("__cluster"), "left"  # at most k rows
    ).drop("__cluster")
    return joined.withColumn(label_col, rank_label(named(rank_col), pack, beyond))


def risk_order(cluster="prediction", table: dict[int, int] | None = None) -> Column:
    """Risk position of a fixed cluster number, null for others; 0 is the riskiest."""
    return lookup(cluster, table or labels.RISK_ORDER)
