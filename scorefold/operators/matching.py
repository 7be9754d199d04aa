"""Job postings for students by what they can do: TF-IDF vectors, cosine, an inverted index.

Texts are bags of terms; a term's weight is its count times ln((1 + n) / (1 + df)) + 1 over
the n postings, and vectors have length one.  Equal bags are one vector, so a posting text
that is printed a million times is compared once.

Candidates meet by rare terms.  Terms have one order for all vectors, rare ones first.  If
what follows a place in a vector is shorter than the least cosine, no other vector can reach
that cosine by those terms alone; so two vectors that do reach it have their first common
term in both beginnings, and only beginnings are indexed and looked up.  A term that many
postings begin with is cut into blocks, each a join key of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorefold import labels
from scorefold.functions.casts import named
from scorefold.operators.scores import gpa_column
from scorefold.session import durable

#: Letters and digits, with the signs that belong to names like C++ and C#.
TERM = r"[\p{L}\p{N}]+[+#]*"
#: Vectors of one term that one join key holds.
BLOCK = 4096


def terms(text: Column) -> Column:
    """The terms of a text, as often as they stand there; none for a null text."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)), F.array().cast("array<string>"))


def skill_profile(gpas: DataFrame, least: float = 2.5, fields=tuple(labels.CAREER_FIELDS), skills=None) -> DataFrame:
    """Add `skills`: those of the fields with a GPA of at least `least`, or of the best field if there is none.

    gpas has best_field (see market.best_field) and a GPA column per field.
    """
    skills = skills or labels.FIELD_SKILLS
    able = [F.when(F.nanvl(named(gpa_column(f)).cast("double"), F.lit(0.0)) >= least, ", ".join(skills[f])) for f in fields]
    best = F
    for f in fields:
        best = best.when(F.col("best_field") == f, ", ".join(skills[f]))
    able_text = F.concat_ws(", ", *able)
    return gpas.withColumn("skills", F.when(able_text != "", able_text).otherwise(best))


def _bags(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, bag (a digest of the sorted terms), terms; rows without terms are left out."""
    own = df.select(named(key).alias("key"), F.sort_array(terms(named(text))).alias("terms"))
    return own.where(F.size("terms") > 0).select("key", F.sha2(F.array_join("terms", " "), 256).alias("bag"), "terms")


def _vectors(bags: DataFrame, idf: DataFrame, min_cosine: float) -> DataFrame:
    """bag, term, v for the terms each vector begins with; v is the whole vector: (df, term, weight), rare terms first."""
    counts = bags.select("bag", F.explode("terms").alias("term")).groupBy("bag", "term").agg(F.count("*").alias("tf"))
    weighed = counts.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    own = Window.partitionBy("bag")
    behind = own.orderBy(F.desc("df"), F.desc("term")).rowsBetween(Window.unboundedPreceding, 0)
    rows = weighed.withColumns({"norm2": F.sum(F.col("w") * F.col("w")).over(own), "rest": F.sum(F.col("w") * F.col("w")).over(behind)})
    entry = F.struct("df", "term", (F.col("w") / F.sqrt("norm2")).alias("w"))
    rows = rows.withColumn("v", F.collect_list(entry).over(own))
    return rows.where(F.col("rest") >= (min_cosine * min_cosine - 1e-9) * F.col("norm2")).select("bag", "term", F.sort_array("v").alias("v"))


def _common(one: str, weights: str) -> Column:
    """The terms of a vector that the map of another one holds, in order, with the product of both weights."""
    held = F.filter(one, lambda x: F.map_contains_key(F.col(weights), x["term"]))
    return F.transform(held, lambda x: F.struct(x["term"].alias("term"), (x["w"] * F.element_at(F.col(weights), x["term"])).alias("w")))


def match_jobs(
    seekers: DataFrame,
    postings: DataFrame,
    k: int = 10,
    min_cosine: float = 0.1,
    seeker: str = "ma_sv",
    skills: str = "skills",
    posting: str = "posting",
    text: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """seeker, rank (from 1), posting, cosine: each seeker's k most similar postings with a cosine of at least min_cosine.

    cosine has six decimals, which the ranks and the bound go by; ties go to the smaller
    posting (null last).  Seekers whose skills no posting asks for have no rows; every row
    of a repeated seeker or posting counts.
    """
    if k < 1 or not 0 < min_cosine <= 1:
        raise ValueError("k is at least 1, min_cosine above 0 and at most 1")
    # a cosine of just under the bound may round up to it
    least = max(1e-6, min_cosine - 5e-7)
    jobs, people = durable(_bags(postings, posting, text)), _bags(seekers, seeker, skills)
    bags = jobs.groupBy("bag").agg(F.count("*").alias("n"), F.first("terms").alias("terms"), F.min("key").alias("least_key"))
    total = postings.agg(F.count("*")).scalar()
    df = bags.select("n", F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.sum("n").alias("df"))
    idf = df.select("term", "df", (F.log((1.0 + total) / (1.0 + F.col("df"))) + 1.0).alias("idf"))
    idf = durable(idf)
    index = durable(_vectors(bags, idf, least))
    wanted = _vectors(people.groupBy("bag").agg(F.first("terms").alias("terms")), idf, least)
    sizes = index.groupBy("term").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    postings_side = index.join(sizes, "term").select(
        "term", F.pmod(F.xxhash64("bag"), F.col("blocks")).cast("int").alias("block"), F.col("bag").alias("job_bag"),
        F.map_from_entries(F.transform("v", lambda x: F.struct(x["term"], x["w"]))).alias("weights"),
    )
    seekers_side = wanted.join(sizes, "term").select("term", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "bag", "v")
    met = seekers_side.join(postings_side, ["term", "block"]).select("bag", "job_bag", "term", _common("v", "weights").alias("common"))
    # two vectors count where they meet first
    product = F.aggregate("common", F.lit(0.0), lambda s, x: s + x["w"])
    scored = met.where(F.col("common")[0]["term"] == F.col("term")).select("bag", "job_bag", F.round(product, 6).alias("cosine")).where(F.col("cosine") >= min_cosine)
    by_bag = Window.partitionBy("bag").orderBy(F.desc("cosine"), F.col("least_key").asc_nulls_last(), "job_bag")
    best = scored.join(bags.select(F.col("bag").alias("job_bag"), "least_key"), "job_bag").withColumn("r", F.row_number().over(by_bag)).where(F.col("r") <= k)
    # the first k postings lie within the first k bags, and no bag gives more than k
    members = jobs.select(F.col("bag").alias("job_bag"), F.col("key").alias("posting"))
    members = members.withColumn("r", F.row_number().over(Window.partitionBy("job_bag").orderBy(F.col("posting").asc_nulls_last()))).where(F.col("r") <= k).drop("r")
    order = Window.partitionBy("bag").orderBy(F.desc("cosine"), F.col("posting").asc_nulls_last())
    ranked = best.select("bag", "job_bag", "cosine").join(members, "job_bag").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return people.select(F.col("key").alias(seeker), "bag").join(ranked, "bag").select(named(seeker), F.col("rank").cast("int").alias("rank"), F.col("posting").alias(posting), "cosine")
