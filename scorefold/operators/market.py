"""Job market: demand per field and students against it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorefold import labels
from scorefold.functions import rules, text
from scorefold.functions.casts import named, safe_int
from scorefold.operators.scores import gpa_column


def _in_category(category: str) -> Column:
    return F.col("Category") == category


def market_total(market: DataFrame, category: str = labels.MARKET_CATEGORY) -> DataFrame:
    """One row: jobs in the category and rows in the table."""
    return market.agg(
        F.coalesce(F.sum(F.when(_in_category(category), safe_int("JobCount"))), F.lit(0)).alias("total_jobs"),
        F.count("*").alias("n_rows"),
    )


def market_by_field(
    market: DataFrame,
    category: str = labels.MARKET_CATEGORY,
    keywords=labels.ROLE_KEYWORDS,
    fields=tuple(labels.CAREER_FIELDS),
) -> DataFrame:
    """One row per career field: its jobs within the category (null without a role) and the totals.

    All sums come from one pass into a single row, which is then unfolded, so
    the result has exactly one row per field even for an empty market.
    """
    count = F.when(_in_category(category), safe_int("JobCount"))
    sums = market.select(count.alias("jobs"), rules.classify_role("Role", keywords).alias("field")).agg(
        *[F.sum(F.when(F.col("field") == name, F.col("jobs"))).alias(f"f{i}") for i, name in enumerate(fields)],
        F.coalesce(F.sum("jobs"), F.lit(0)).alias("total_jobs"),
        F.count("*").alias("n_rows"),
    )
    rows = [
        F.struct(F.lit(i).alias("field_pos"), F.lit(name).alias("field"), F.col(f"f{i}").alias("jobs"))
        for i, name in enumerate(fields)
    ]
    return sums.select(F.inline(F.array(*rows)), "total_jobs", "n_rows")


def role_share(market: DataFrame, category: str = labels.MARKET_CATEGORY) -> DataFrame:
    """Each role with its percent of the category's jobs, largest first."""
    # a scalar subquery: the total reaches every task without a join
    total = market_total(market, category).select("total_jobs").scalar()
    return (
        market.select("Category", "Role", safe_int("JobCount").alias("jobs"))
        .withColumn("percent", F.col("jobs") / F.greatest(total, F.lit(1)) * 100)
        .orderBy(F.desc("jobs"), "Role", "Category")
    )


def market_report(market: DataFrame, category: str = labels.MARKET_CATEGORY) -> DataFrame:
    """role_share with the line to print."""
    role = text.pad_right(F.substring("Role", 1, 30), 30)
    count = text.pad_left(F.col("jobs").cast("string"), 4)
    percent = text.pad_left(text.fixed("percent", 1), 4)
    line = F.concat(role, F.lit(": "), count, F.lit(" jobs ("), percent, F.lit("%) "), text.bar("percent"))
    return role_share(market, category).withColumn("line", line)


def best_field(
    gpas: DataFrame, fields=tuple(labels.CAREER_FIELDS), default: str = labels.DEFAULT_FIELD
) -> DataFrame:
    """Add best_field and best_gpa: the first field with the highest GPA above 0."""
    values = [F.coalesce(F.nanvl(named(gpa_column(f)).cast("double"), F.lit(0.0)), F.lit(0.0)) for f in fields]
    best = F.greatest(F.lit(0.0), *values)
    pick = F.when(best <= 0.0, default)
    for field, value in zip(fields, values):
        pick = pick.when(value == best, field)
    return gpas.withColumns({"best_field": pick.otherwise(default), "best_gpa": best})


def competitiveness(
    students: DataFrame,
    market: DataFrame,
    default_jobs: int = labels.DEFAULT_FIELD_JOBS,
    category: str = labels.MARKET_CATEGORY,
) -> DataFrame:
    """Add best_field, best_gpa, field_jobs, market_ratio and competitiveness.

    A table without any market row gives null figures and the no-market label.
    """
    # one row per field, so the broadcast is bounded by the field list
    demand = market_by_field(market, category).withColumnRenamed("field", "best_field").drop("field_pos")
    joined = best_field(students).join(F.broadcast(demand), "best_field", "left")
    jobs = F.when(F.col("n_rows") > 0, F.coalesce("jobs", F.lit(default_jobs)))
    ratio = F.col("field_jobs") / F.greatest(F.col("total_jobs"), F.lit(1)) * 100
    with_jobs = joined.withColumn("field_jobs", jobs).withColumn("market_ratio", ratio)
    label = F.when(F.col("field_jobs").isNull(), labels.NO_MARKET).otherwise(
        rules.competitiveness_label("best_gpa", "market_ratio")
    )
    return with_jobs.withColumn("competitiveness", label).select(
        *[named(c) for c in students.columns],
        "best_field", "best_gpa", "field_jobs", "market_ratio", "competitiveness",
    )


def competitiveness_report(scored: DataFrame, column: str = "top_matched_jobs") -> DataFrame:
    """Add the three-line text for rows of competitiveness()."""
    lines = F.concat(
        F.lit("Ngành Đề Xuất: "), F.col("best_field"),
        F.lit(" (GPA: "), text.fixed("best_gpa", 2), F.lit("/4.0)\n"),
        F.lit("Nhu cầu TT: "), F.col("field_jobs").cast("string"),
        F.lit(" Jobs (Sức hút: "), text.fixed("market_ratio", 1), F.lit("% toàn ngành IT)\n"),
        F.lit("=> Đánh giá Cơ hội: "), F.col("competitiveness"),
    )
    return scored.withColumn(column, F.when(F.col("field_jobs").isNull(), labels.NO_MARKET).otherwise(lines))
