"""The job market table: Category, Role, JobCount."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorefold import labels
from scorefold.functions.casts import as_column, truncated_int
from scorefold.sources.tables import read_table, write_table

MARKET_SCHEMA = "Category string, Role string, JobCount string"
# counts are read as text, so that 3, "3" and 3.0 are all three
DOCUMENT_SCHEMA = (
    "data array<struct<name: string, job_count: string, roles: array<struct<name: string, job_count: string>>>>, "
    "_broken string"
)


def read_market(spark: SparkSession, path: str) -> DataFrame:
    """The market CSV (UTF-8, with or without a byte-order mark), by header names; an absent path is an empty market."""
    try:
        return read_table(spark, path, MARKET_SCHEMA, sep=",", multiline=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MARKET_SCHEMA)


def write_market(market: DataFrame, path: str, fmt: str = "csv") -> None:
    write_table(market.select("Category", "Role", "JobCount"), path, fmt)


def _parsed(column: str) -> Column:
    return F.from_json(as_column(column), DOCUMENT_SCHEMA, {"columnNameOfCorruptRecord": "_broken"})


def broken_documents(documents: DataFrame, column: str = "json") -> DataFrame:
    """The rows whose text is not a market document."""
    parsed = documents.withColumn("__doc", _parsed(column))
    return parsed.filter(F.col("__doc._broken").isNotNull()).drop("__doc")


def flatten_market(
    documents: DataFrame, column: str = "json", category: str | None = labels.MARKET_CATEGORY, keep=(), broken: str = "raise"
) -> DataFrame:
    """Market JSON documents -> rows (keep..., Category, Role, JobCount).

    One row per role of the category; a category without roles gives one row
    under its own name.  A missing name is "Unknown", a missing count 0.  A text
    that is no document raises, or is left out with broken="skip" (see
    broken_documents); a null text has no rows.
    """
    if broken not in ("raise", "skip"):
        raise ValueError(f"unknown way with broken documents: {broken}")
    kept = [as_column(c) for c in keep]
    parsed = documents.select(*kept, _parsed(column).alias("doc"))
    data = F.col("doc.data")
    if broken == "raise":
        error = F.raise_error(F.concat(F.lit("not a market document: "), F.left("doc._broken", F.lit(200))))
        data = F.when(F.col("doc._broken").isNotNull(), error).otherwise(data)
    categories = parsed.select(*kept, F.inline(data)).select(
        *kept, F.coalesce("name", F.lit(labels.UNKNOWN_NAME)).alias("Category"), "job_count", "roles"
    )
    if category is not None:
        categories = categories.filter(F.col("Category") == category)
    no_roles = F.coalesce(F.size("roles"), F.lit(0)) <= 0
    roles = categories.withColumn("no_roles", no_roles).select(
        *kept, "Category", "job_count", "no_roles", F.explode_outer("roles").alias("role")
    )
    return roles.select(
        *kept,
        "Category",
        F.when(F.col("no_roles"), F.col("Category"))
        .otherwise(F.coalesce("role.name", F.lit(labels.UNKNOWN_NAME)))
        .alias("Role"),
        truncated_int(F.when(F.col("no_roles"), F.col("job_count")).otherwise(F.col("role.job_count"))).alias("JobCount"),
    )
