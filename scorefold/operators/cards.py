"""Student cards, group shares and short reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorefold import labels
from scorefold.functions import bands, text
from scorefold.functions.casts import as_column, named, safe_double, safe_int, truncated_int

MOST_PROFILES = 1000
PROFILE_SCHEMA = (
    "cluster int, label string, risk string, color_tag string, badge_bg string, badge_fg string, icon string, "
    "gpa_range string, description string, reasons array<string>, suggestions array<string>"
)


def sanitize_student(df: DataFrame) -> DataFrame:
    """Numbers a card can rely on: unparsable or missing values become 0, the cluster its default."""
    return df.withColumns(
        {
            "gpa": safe_double("gpa"),
            "std_score": safe_double("std_score"),
            "failed_subjects": truncated_int("failed_subjects"),
            "excellent_subjects": truncated_int("excellent_subjects"),
            "prediction": F.coalesce(
                safe_int("prediction", None).try_cast("int"), F.lit(labels.DEFAULT_CLUSTER)
            ),
        }
    )


def profiles(spark, rows=None) -> DataFrame:
    return spark.createDataFrame(rows or labels.CLUSTER_PROFILES, PROFILE_SCHEMA)


def enrich_cluster(df: DataFrame, cluster: str = "prediction", rows=None, default: int = labels.DEFAULT_CLUSTER) -> DataFrame:
    """Attach the profile of the row's cluster; an unknown id gets the default profile.

    rows are the profiles, at most MOST_PROFILES: they go to every task.
    """
    rows = rows or labels.CLUSTER_PROFILES
    if len(rows) > MOST_PROFILES:
        raise ValueError(f"more than {MOST_PROFILES} profiles")
    known = [r.cluster for r in rows]
    key = F.when(named(cluster).isin(known), named(cluster)).otherwise(default).cast("int")
    # one row per constant profile
    table = F.broadcast(profiles(df.sparkSession, rows).withColumnRenamed("cluster", "__cluster"))
    return df.withColumn("__cluster", key).join(table, "__cluster", "left").drop("__cluster")


def metric_fractions(df: DataFrame, total_subjects) -> DataFrame:
    """Bar fractions in 0..1, high always good."""
    n = F.greatest(_number(total_subjects), F.lit(1))
    return df.withColumns(
        {
            "gpa_fraction": bands.unit(F.col("gpa") / 4.0),
            "stability_fraction": bands.unit(1.0 - F.col("std_score") / 1.5),
            "failed_fraction": bands.unit(1.0 - F.col("failed_subjects") / n),
            "excellent_fraction": bands.unit(F.col("excellent_subjects") / n),
        }
    )


def _number(value) -> Column:
    return F.lit(value) if isinstance(value, int) else as_column(value)


def student_card(scored: DataFrame, total_subjects) -> DataFrame:
    """Everything the detail card of a scored student shows.

    total_subjects is the number of subjects in the table, or a column with it.
    """
    n = _number(total_subjects)
    card = metric_fractions(sanitize_student(scored), n)
    card = card.withColumns(
        {
            "gpa_text": text.fixed("gpa", 2),
            "gpa_label": bands.gpa_label("gpa"),
            "gpa_color": bands.gpa_color("gpa"),
            "std_text": text.fixed("std_score", 2),
            "stability_label": bands.stability_label("std_score"),
            "stability_color": bands.stability_color("std_score"),
            "failed_label": bands.failed_label("failed_subjects"),
            "failed_color": bands.failed_color("failed_subjects"),
            "excellent_label": F.concat(
                bands.excellent_percent("excellent_subjects", n).cast("string"), F.lit("% tổng số môn")
            ),
            "excellent_color": bands.excellent_color("excellent_subjects", n),
        }
    )
    return enrich_cluster(card)


def group_share(df: DataFrame, label: str) -> DataFrame:
    """Rows and percent per label, largest first."""
    groups = df.groupBy(named(label)).agg(F.count("*").alias("n"))
    # the total is one value that every task gets, however many labels there are; it adds up the same grouped rows
    total = groups.agg(F.sum("n")).scalar()
    return groups.withColumn("percent", F.col("n") / total * 100).orderBy(
        F.desc("n"), named(label)
    )


def first_n(df: DataFrame, n: int, order_by: list) -> DataFrame:
    """The first n rows of an order, numbered from 1; a top-n, not a full sort, for an n that one task can hold."""
    return df.orderBy(*order_by).limit(n).withColumn(
        "idx", F.row_number().over(Window.orderBy(*order_by))
    )


def readiness_lines(df: DataFrame, n: int = 20, order_by=("ma_sv",)) -> DataFrame:
    """The numbered three-line entries of the readiness summary."""

    def shown(column: str) -> Column:
        return F.coalesce(named(column).cast("string"), F.lit("")) if column in df.columns else F.lit("")

    top = first_n(df, n, list(order_by))
    entry = F.concat(
        F.lit("["), F.col("idx").cast("string"), F.lit("] "), shown("ma_sv"), F.lit(" - "), shown("ho_ten"),
        F.lit("\n    GPA: "), shown("gpa_tong"), F.lit(" | TOEIC: "), shown("TOEIC"),
        F.lit(" | Nhóm: "), shown("nhom_san_sang"),
        F.lit("\n    Phân tích: "), shown("top_matched_jobs"), F.lit("\n\n"),
    )
    return top.select("idx", "ma_sv", entry.alias("text"))
