"""The library's input tables, derived from the star-schema and page tables.

students = customers, subjects of a student = part brands, subjects with
statistics = parts, job postings = parts.  Summed quantities stay whole
numbers and are divided once, so every engine gets the same doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorefold import labels
from scorefold.operators.scores import pivot_scores
from scorefold.operators.search import filter_codes
from scorefold.operators.subjects import subject_stats

# brand number (from 1) -> subject code: the mapped subjects and two others
SUBJECT_CODES = [c for codes in labels.CAREER_FIELDS.values() for c in codes] + ["17102", "29101"]

# posting number modulo the list's length -> role; one or more per career field, some unmatched
ROLES = [
    "Software Engineer", "Data Engineer", "Maintenance Lead", "Web Developer", "DevOps Engineer", "Tester",
    "Backend Data Developer", "Network Admin", "Mobile Developer", "Machine Learning Researcher",
    "Business Analyst with a very long role title", "Security Officer", "Fullstack Developer",
]
# posting number modulo the list's length -> text in place of its count, null keeps the count
ODD_COUNTS = [None, None, None, "12.5", None, "abc", None, "", None, None, None]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list, number: Column) -> Column:
    """values[number % len(values)]."""
    return F.get(F.array(*[F.lit(v) for v in values]), (number % len(values)).cast("int"))


def scores_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ma_sv, ma_mon, diem): one row per student and subject taken."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    # no broadcast hint: part and orders grow, Spark checks their size; a hot key is split by AQE
    points = F.least(
        F.lit(100).cast("bigint"),
        F.col("l_quantity").cast("bigint") + 10 * (F.col("p_size") % 4) + 15 * (F.col("o_custkey") % 4),
    )
    return (
        lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", "p_brand")
        .agg((F.avg(points) / 10.0).alias("diem"))
        .select(
            F.col("o_custkey").alias("ma_sv"),
            F.get(F.lit(SUBJECT_CODES), F.substring("p_brand", 7, 2).try_cast("int") - 1).alias("ma_mon"),
            "diem",
        )
    )


def scores_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ma_sv and one column per subject code; null for a subject not taken."""
    return pivot_scores(scores_long(spark, sf_dir), SUBJECT_CODES, "max")


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """scores_wide with ho_ten and TOEIC."""
    names = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("ho_ten"))
    wide = scores_wide(spark, sf_dir).join(names, F.col("ma_sv") == F.col("c_custkey"), "left")
    toeic = (200 + 5 * (F.col("ma_sv") % 159)).cast("int")
    return wide.select("ma_sv", "ho_ten", *SUBJECT_CODES, toeic.alias("TOEIC"))


def subject_points(spark: SparkSession, sf_dir: str, codes: DataFrame | None = None) -> DataFrame:
    """(ma_mon, TenMH, x, n): how often each subject got x of 100 points; of the parts in codes only, if given.

    Results are counted per (part, quantity) before the join with part, so a
    part with a third of all rows reaches it as 50 rows.
    """
    lines = table(spark, sf_dir, "lineitem")
    if codes is not None:
        lines = filter_codes(lines, codes, "l_partkey")
    counts = (
        lines.groupBy("l_partkey", "l_quantity").agg(F.count("*").alias("n"))
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    x = F.least(F.lit(100).cast("bigint"), F.col("l_quantity").cast("bigint") + 10 * (F.col("p_size") % 8))
    return counts.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_partkey").alias("ma_mon"), F.col("p_name").alias("TenMH"), x.alias("x"), "n"
    )


# letter bands on 100 points
POINT_CUTS = (("A+%", 90), ("A%", 85), ("B%", 70), ("C%", 55), ("D%", 40))


def stats(spark: SparkSession, sf_dir: str, codes: DataFrame | None = None) -> DataFrame:
    """The subject statistics table: MaMH, TenMH and the ten numeric columns; a choice of codes is made on the rows."""
    points = subject_points(spark, sf_dir, codes)
    base = subject_stats(points, "ma_mon", "x", "n", POINT_CUTS, missing=F.lit(0.0), name="TenMH")
    return base.select(
        F.col("MaMH").cast("string").alias("MaMH"),
        "TenMH",
        F.round(F.col("TB") / 10.0, 4).alias("TB"),
        F.round(F.col("SD") / 10.0, 6).alias("SD"),
        *[F.col(f"`{c}`") for c, _ in POINT_CUTS],
        F.col("F%"),
        F.col("MTC%"),
        (F.col("TV") / 10.0).alias("TV"),
    )


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job posting group per part: Category, Role, JobCount (text, at times no number)."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") % 3 != 0, labels.MARKET_CATEGORY).otherwise("Finance").alias("Category"),
        F.concat(pick(ROLES, key), F.lit(" "), F.col("p_type")).alias("Role"),
        F.coalesce(pick(ODD_COUNTS, key), F.concat(F.lit(" "), F.col("p_size").cast("string"))).alias("JobCount"),
    )


# posting number modulo the list's length -> a skill the posting asks for
SKILLS = [s for skills in labels.FIELD_SKILLS.values() for s in skills] + ["teamwork", "English", "Python 3", "c / c++"]


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job posting per part: posting, text (role and skills asked for; null for some)."""
    key = F.col("p_partkey")
    asked = [pick(SKILLS, key), pick(SKILLS, key * 7 + F.col("p_size")), pick(SKILLS, F.col("p_size") * 3), F.lit("teamwork")]
    return table(spark, sf_dir, "part").select(
        key.alias("posting"), F.when(key % 29 != 0, F.concat_ws(", ", pick(ROLES, key), F.col("p_type"), *asked)).alias("text")
    )


def market_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One market JSON document per customer: a category per order priority, a role per order status."""
    roles = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", "o_orderpriority", "o_orderstatus")
        .agg(F.count("*").alias("job_count"))
    )
    # at most one entry per status, and per priority below
    categories = roles.groupBy("o_custkey", "o_orderpriority").agg(
        F.sum("job_count").alias("job_count"),
        F.collect_list(F.struct(F.col("o_orderstatus").alias("name"), "job_count")).alias("roles"),
    )
    no_roles = F.col("o_custkey") % 5 == 0
    category = F.struct(
        F.when(F.col("o_orderpriority") == "1-URGENT", labels.MARKET_CATEGORY)
        .otherwise(F.col("o_orderpriority"))
        .alias("name"),
        "job_count",
        F.when(~no_roles, F.col("roles")).alias("roles"),
    )
    documents = categories.groupBy("o_custkey").agg(F.collect_list(category).alias("data"))
    return documents.select("o_custkey", F.to_json(F.struct("data")).alias("json"))
