"""Named queries: one per operator or pipeline, each over the whole of its tables."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorefold import labels
from scorefold.functions import bands, casts, rules, scale
from scorefold.operators import (
    cards, clustering, feature_state, importance, kselect, market, matching, pages, ranks, schema, scores, search, search_index, subjects,
)
from scorefold.plans import career, inputs, students, training
from scorefold.plans import subjects as subject_plans
from scorefold.session import durable, scratch_path
from scorefold.sources import market as market_source
from scorefold.sources import models, tables

# centres on gpa, std_score, failed_subjects, excellent_subjects, the weakest first
STUDENT_CENTRES = [[0.8, 0.8, 15.0, 0.0], [2.0, 0.9, 4.0, 2.0], [3.0, 0.6, 0.0, 8.0], [3.7, 0.4, 0.0, 16.0]]
# further ones, so that prefixes of the list give a metrics table
MORE_CENTRES = [*STUDENT_CENTRES, [1.4, 0.9, 9.0, 1.0], [2.5, 0.8, 2.0, 5.0]]
READINESS_CENTRES = [[0.8, 300.0], [2.0, 600.0], [3.2, 900.0]]
# centres on the ten subject features
SUBJECT_CENTRES = [
    [8.5, 0.8, 40.0, 10.0, 40.0, 8.0, 2.0, 0.0, 0.0, 8.6],
    [7.2, 1.3, 15.0, 10.0, 35.0, 25.0, 12.0, 3.0, 0.0, 7.2],
    [6.0, 1.4, 5.0, 5.0, 22.0, 30.0, 28.0, 10.0, 0.0, 6.0],
    [4.2, 1.4, 0.0, 1.0, 8.0, 22.0, 30.0, 39.0, 0.0, 4.1],
]
N_SUBJECTS = len(inputs.SUBJECT_CODES)
K_TRIED = range(2, len(MORE_CENTRES) + 1)

QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


# --- shared inputs ----------------------------------------------------------

def _features(spark: SparkSession, d: str) -> DataFrame:
    return scores.student_features(inputs.scores_long(spark, d)).withColumn("std_score", F.round("std_score", 6))


def _gpas(spark, d):
    return scores.field_gpa_long(inputs.scores_long(spark, d), subjects=inputs.SUBJECT_CODES)


def _ready(spark, d):
    """Students with readiness groups from the fixed centres."""
    return career.label_readiness(career.readiness_table(inputs.cohort(spark, d)), centres=READINESS_CENTRES)


def _analysed(spark, d, **options):
    return subject_plans.analyze_subjects(inputs.stats(spark, d), centres=SUBJECT_CENTRES, **options)


def _assigned(spark, d):
    return clustering.assign_fixed_centres(_features(spark, d), STUDENT_CENTRES, labels.STUDENT_FEATURES)


def _parts(spark, d):
    """Parts as a list of subjects."""
    return inputs.table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("MaMH"), F.col("p_name").alias("TenMH"), "p_size", "p_type"
    )


def _k_tried(spark, d) -> list[int]:
    """The sizes that a sweep over the students would try: up to the number of distinct feature rows."""
    most = clustering.distinct_up_to(_features(spark, d).select(labels.STUDENT_FEATURES), max(K_TRIED))
    return [k for k in K_TRIED if k <= most]


def _metrics(spark, d):
    """wcss and silhouette over the students for each prefix of the centres.

    All prefixes are assigned in one projection; their cluster sums are one aggregate,
    the silhouettes another, so the features are read twice.
    """
    table = durable(_features(spark, d))
    for k in K_TRIED:
        table = clustering.assign_fixed_centres(table, MORE_CENTRES[:k], labels.STUDENT_FEATURES, f"cluster_{k}")
        table = table.withColumnRenamed("sq_dist", f"sq_dist_{k}")
    sums = [clustering.cluster_sums(k, labels.STUDENT_FEATURES, f"cluster_{k}").alias(f"k{k}") for k in K_TRIED]
    table = table.withColumn("__sums", table.agg(F.struct(*sums).alias("s")).scalar())
    for k in K_TRIED:
        scored = clustering.silhouette(table, k, labels.STUDENT_FEATURES, f"cluster_{k}", F.col(f"__sums.k{k}"))
        table = scored.withColumnRenamed("silhouette", f"silhouette_{k}")
    rows = F.array(*[
        F.struct(F.lit(k).alias("k"), F.sum(f"sq_dist_{k}").alias("wcss"), F.avg(f"silhouette_{k}").alias("silhouette")) for k in K_TRIED
    ])
    return durable(table.agg(rows.alias("rows")).select(F.inline("rows")))


# --- sources and columns ----------------------------------------------------

@query
def csv_scores_roundtrip(spark, d):
    path = scratch_path(spark, "cohort")
    cohort = inputs.cohort(spark, d)
    tables.write_table(cohort, path, "csv", sep=";")
    return tables.read_table(spark, path, cohort.schema)


@query
def csv_stats_roundtrip(spark, d):
    path = scratch_path(spark, "stats")
    named = inputs.stats(spark, d).withColumnsRenamed({"A+%": "A+ %", "F%": " F %"})
    tables.write_table(named, path, "csv")
    return tables.read_subject_stats(spark, path)  # types follow from the header


@query
def detect_delimiter(spark, d):
    scores_path, stats_path = scratch_path(spark, "cohort"), scratch_path(spark, "stats")
    tables.write_table(inputs.cohort(spark, d), scores_path, "csv", sep=";")
    tables.write_table(inputs.stats(spark, d), stats_path, "csv", sep=",")
    # the readers' own function, and what they make of the tables with it
    found = None
    shapes = {"scores": (scores_path, inputs.cohort(spark, d).schema), "stats": (stats_path, inputs.stats(spark, d).schema)}
    for name, (path, shape) in shapes.items():
        rows = tables.read_table(spark, path, shape).agg(
            F.lit(name).alias("name"), F.lit(tables.detect_delimiter(spark, path)).alias("separator"), F.count("*").alias("n")
        )
        found = rows if found is None else found.unionByName(rows)
    return found


@query
def market_roundtrip(spark, d):
    path = scratch_path(spark, "market")
    market_source.write_market(inputs.market(spark, d), path)
    return market_source.read_market(spark, path)


@query
def market_flatten(spark, d):
    return market_source.flatten_market(inputs.market_documents(spark, d), keep=["o_custkey"])


@query
def csv_folder(spark, d):
    """A folder of files by `;` and by `,`, with columns in other orders and some missing, and line breaks in names."""
    path, stats = scratch_path(spark, "folder"), inputs.stats(spark, d)
    stats = durable(stats.select("MaMH", F.concat("TenMH", F.lit("\n, one; two")).alias("TenMH"), "TB", "SD", F.col("F%")))  # three files come from it
    shapes = {"a": (";", ["MaMH", "TenMH", "TB", "SD", "F%"]), "b": (",", ["F%", "TB", "MaMH"]), "c": (",", ["SD", "TenMH", "MaMH"])}
    for i, (name, (sep, columns)) in enumerate(shapes.items()):
        own = stats.filter(F.col("MaMH").cast("bigint") % 3 == i).select(*[casts.named(c) for c in columns])
        own.write.options(**tables.CSV_OPTIONS, sep=sep).csv(f"{path}/{name}")
    found = tables.read_folder(spark, f"{path}/*", "MaMH string, TenMH string, TB double, SD double, `F%` double", multiline=True)
    return found.withColumn("TenMH", F.replace("TenMH", F.lit("\n"), F.lit("|")))


@query
def normalize_columns(spark, d):
    part = inputs.table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    return schema.normalize_columns(part.toDF("p partkey", " p_ brand", "p_size % "))


@query
def required_columns(spark, d):
    customers = inputs.table(spark, d, "customer").select("c_custkey", "c_acctbal")
    missing = schema.missing_columns(customers, ["c_custkey", "TOEIC", "gpa_tong"])
    return schema.ensure_columns(customers, missing)


@query
def safe_double(spark, d):
    return schema.to_double(inputs.market(spark, d), ["JobCount"])


@query
def keep_null_double(spark, d):
    return schema.to_double(inputs.market(spark, d), ["JobCount"], None)


@query
def safe_int(spark, d):
    return inputs.market(spark, d).select("Category", "Role", casts.safe_int("JobCount").alias("jobs"))


@query
def display_columns(spark, d):
    return schema.project(_features(spark, d), students.RISK_COLUMNS, rounded=["gpa", "std_score"])


@query
def row_count(spark, d):
    """Rows of the written table, and how many students and subjects they name."""
    kept, n = tables.counted(inputs.scores_long(spark, d))
    # one count of distinct values at a time: several in one aggregate would multiply the rows
    students_n = kept.select("ma_sv").distinct().agg(F.count("*").alias("students"))
    subjects_n = kept.select("ma_mon").distinct().agg(F.count("*")).scalar()
    return students_n.select(F.lit(n).cast("bigint").alias("n"), "students", subjects_n.alias("subjects"))


@query
def load_report(spark, d):
    """Rows, nulls and unparsable texts of the market's columns, and how many counts were read as numbers."""
    loaded, report = tables.load_typed(inputs.market(spark, d), {"JobCount": "double"})
    numbers = loaded.agg(F.count("JobCount")).scalar()
    return report.withColumn("numbers", F.when(F.col("column") == "JobCount", numbers))


@query
def market_replace(spark, d):
    """The market file filtered and written back to the path that it was read from, twice."""
    path = scratch_path(spark, "market")
    market_source.write_market(inputs.market(spark, d), path)
    for kept in (F.col("Category") == labels.MARKET_CATEGORY, F.col("JobCount") != ""):
        market_source.write_market(market_source.read_market(spark, path).filter(kept), path)
    return market_source.read_market(spark, path)


@query
def bounded_sample(spark, d):
    orders = inputs.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return search.bounded_sample(orders, search.TABLE_PAGE, ["o_orderkey"])


# --- scores -----------------------------------------------------------------

@query
def unpivot_scores(spark, d):
    return scores.unpivot_scores(inputs.scores_wide(spark, d))


@query
def pivot_scores(spark, d):
    return inputs.scores_wide(spark, d)


@query
def scale4(spark, d):
    return inputs.scores_long(spark, d).withColumn("diem_he4", scale.scale4("diem"))


@query
def student_features(spark, d):
    return _features(spark, d).withColumn("band", bands.gpa_label("gpa"))


@query
def student_features_kept(spark, d):
    """Features from a state that took the scores in three batches: some wrong at first, some late and outdated."""
    path, all_ = scratch_path(spark, "features"), durable(inputs.scores_long(spark, d))
    wrong, late = F.col("ma_sv") % 3 == 0, F.col("ma_sv") % 5 == 0
    first = all_.where(~late).withColumns({"diem": F.when(wrong, 9.5).otherwise(F.col("diem")), "version": F.lit(2)})
    outdated = all_.where(~wrong & ~late).withColumns({"diem": F.lit(0.5), "version": F.lit(1)})
    corrected = all_.where(wrong | late).withColumn("version", F.lit(3))
    for batch in (first, outdated, corrected):
        feature_state.update_state(spark, path, batch)
    return feature_state.state_features(feature_state.read_state(spark, path)).withColumn("std_score", F.round("std_score", 6))


@query
def student_features_rowwise(spark, d):
    out = scores.student_features_rowwise(inputs.cohort(spark, d))
    return out.withColumn("std_score", F.round("std_score", 6))


@query
def student_features_wide(spark, d):
    out = scores.student_features_wide(inputs.cohort(spark, d))
    return out.withColumn("std_score", F.round("std_score", 6))


@query
def field_gpa(spark, d):
    table = scores.field_gpa(inputs.scores_wide(spark, d))
    return table.select("ma_sv", *[c for c in table.columns if c.startswith(("_", "gpa_"))])


@query
def field_gpa_long(spark, d):
    return _gpas(spark, d)


@query
def field_gpa_taken(spark, d):
    return scores.field_gpa_long(inputs.scores_long(spark, d))


@query
def overall_gpa(spark, d):
    return scores.field_gpa(inputs.scores_wide(spark, d)).select("ma_sv", "gpa_tong")


# --- student cards ----------------------------------------------------------

@query
def gpa_band(spark, d):
    return _features(spark, d).select(
        "ma_sv", "gpa", bands.gpa_label("gpa").alias("label"), bands.gpa_color("gpa").alias("color")
    )


@query
def stability_band(spark, d):
    return _features(spark, d).select(
        "ma_sv", bands.stability_label("std_score").alias("label"), bands.stability_color("std_score").alias("color")
    )


@query
def failed_band(spark, d):
    n = "failed_subjects"
    return _features(spark, d).select("ma_sv", bands.failed_label(n).alias("label"), bands.failed_color(n).alias("color"))


@query
def excellent_band(spark, d):
    n, total = "excellent_subjects", F.lit(N_SUBJECTS)
    return _features(spark, d).select(
        "ma_sv",
        bands.excellent_percent(n, total).alias("percent"),
        bands.excellent_color(n, total).alias("color"),
    )


@query
def metric_fractions(spark, d):
    table = cards.metric_fractions(_features(spark, d), N_SUBJECTS)
    return table.select("ma_sv", *[c for c in table.columns if c.endswith("_fraction")])


@query
def cluster_tag(spark, d):
    return _assigned(spark, d).select("ma_sv", "cluster", bands.cluster_tag("cluster").alias("tag"))


@query
def cluster_profile_join(spark, d):
    table = cards.enrich_cluster(_assigned(spark, d).select("ma_sv", (F.col("cluster") + 1).alias("prediction")))
    return table.select(
        "ma_sv", "prediction", "label", "risk", "color_tag", "gpa_range",
        F.size("reasons").alias("n_reasons"), F.array_join("suggestions", "; ").alias("suggestions"),
    )


@query
def student_card(spark, d):
    scored = students.order_by_risk(_assigned(spark, d), STUDENT_CENTRES, "cluster")
    return students.student_details(scored, N_SUBJECTS).select(
        "ma_sv", "gpa_text", "gpa_label", "gpa_color", "std_text", "stability_label", "failed_label",
        "excellent_label", "excellent_color", "label", "risk",
    )


@query
def sanitize_student(spark, d):
    """Cards over rows whose numbers are the market's texts."""
    columns = ["gpa", "std_score", "failed_subjects", "excellent_subjects", "prediction"]
    dirty = inputs.market(spark, d).select(F.col("Role").alias("ma_sv"), *[F.col("JobCount").alias(c) for c in columns])
    return cards.sanitize_student(dirty)


@query
def risk_ranking(spark, d):
    return students.order_by_risk(_assigned(spark, d), STUDENT_CENTRES, "cluster")


# --- subjects ---------------------------------------------------------------

@query
def subject_stats(spark, d):
    return inputs.stats(spark, d)


@query
def subject_difficulty(spark, d):
    return inputs.stats(spark, d).select("MaMH", rules.difficulty().alias("DoKho"))


@query
def subject_quality_rule(spark, d):
    stats = inputs.stats(spark, d)
    return stats.select("MaMH", subjects.rule_quality(stats).alias("ChatLuong"))


@query
def subject_quality_no_data(spark, d):
    stats = inputs.stats(spark, d).drop("SD")
    return stats.select("MaMH", subjects.rule_quality(stats).alias("ChatLuong"))


@query
def subject_quality_collapse(spark, d):
    table = subject_plans.cluster_quality(inputs.stats(spark, d), centres=SUBJECT_CENTRES)
    return table.select("MaMH", "ChatLuongCluster", rules.quality_collapse("ChatLuongCluster").alias("ChatLuong"))


@query
def subject_trend(spark, d):
    return inputs.stats(spark, d).select("MaMH", rules.trend().alias("XuHuong"))


@query
def subject_analysis_all(spark, d):
    return _analysed(spark, d)


@query
def subject_analysis_rule(spark, d):
    return subject_plans.analyze_subjects(inputs.stats(spark, d), quality="rule")


@query
def subject_analysis_selected(spark, d):
    chosen = inputs.table(spark, d, "part").filter("p_type = 'PROMO'").select("p_partkey")
    return subject_plans.analyze_subjects(inputs.stats(spark, d, chosen), centres=SUBJECT_CENTRES, quality="collapsed")


@query
def subject_avg_band(spark, d):
    return inputs.stats(spark, d).select(
        "MaMH",
        bands.subject_average_label("TB").alias("label"),
        bands.subject_average_color("TB").alias("color"),
        bands.subject_average_fraction("TB").alias("fraction"),
    )


@query
def fail_rate_band(spark, d):
    return inputs.stats(spark, d).select(
        "MaMH",
        bands.fail_rate_label("F%").alias("label"),
        bands.fail_rate_color("F%").alias("color"),
        bands.fail_rate_fraction("F%").alias("fraction"),
    )


@query
def subject_priority_sorted(spark, d):
    return subjects.priority_sorted(_analysed(spark, d)).select("MaMH", "TenMH", "ChatLuong", "priority", "group_label", "color")


@query
def subject_badge(spark, d):
    """Badges of all parts as subjects; those without a line are not analysed."""
    found = _analysed(spark, d).select("MaMH", "ChatLuong", F.lit(True).alias("analysed"))
    listed = _parts(spark, d).select("MaMH").join(found, "MaMH", "left")
    return listed.select("MaMH", rules.subject_badge("ChatLuong", F.col("analysed")).alias("b")).select("MaMH", "b.*")


@query
def label_priority(spark, d):
    return _analysed(spark, d).select("MaMH", rules.label_priority("ChatLuong").alias("priority"))


@query
def subject_grouped_list(spark, d):
    return subjects.grouped_list(_analysed(spark, d))


@query
def subject_filter_list(spark, d):
    return subjects.filter_subject_list(_analysed(spark, d))


@query
def subject_filter_list_keyword(spark, d):
    return subjects.filter_subject_list(_analysed(spark, d), "Gear")


@query
def subject_report_lines(spark, d):
    return subjects.report_lines(_analysed(spark, d))


@query
def subject_detail(spark, d):
    return subjects.subject_detail(_analysed(spark, d))


@query
def dedupe_last(spark, d):
    orders = inputs.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    return subjects.dedupe_last(orders, "o_custkey", "o_orderkey")


@query
def price_medians(spark, d):
    """Median price of each part's lines: nearly as many distinct values as rows."""
    lines = inputs.table(spark, d, "lineitem").select("l_partkey", F.col("l_extendedprice").cast("double").alias("price"), F.lit(1).alias("n"))
    return ranks.medians(lines, ["l_partkey"], "price", "n")


@query
def median_price(spark, d):
    """One key for all lines: the median price by order priority's first letter."""
    orders = inputs.table(spark, d, "orders").select(F.substring("o_orderpriority", 2, 1).alias("sign"), F.col("o_totalprice").cast("double").alias("price"))
    return ranks.medians(orders.withColumn("n", F.lit(1)), ["sign"], "price", "n")


@query
def customer_index(spark, d):
    """Customers numbered by how many orders they have: a label for each."""
    orders = inputs.table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"))
    return ranks.label_index(orders, "customer", "number").withColumn("number", F.col("number").cast("bigint"))


# --- search -----------------------------------------------------------------

@query
def subject_search(spark, d):
    return search.search_subjects(_parts(spark, d), "GEAR|^1.7$")


@query
def subject_title_parse(spark, d):
    titles = search.search_subjects(_parts(spark, d), "r").select("title")
    return search.parse_title(titles)


@query
def selection_add(spark, d):
    parts = _parts(spark, d)
    columns = ["MaMH", "TenMH"]
    return search.add_selection(parts.filter("p_type = 'PROMO'").select(columns), parts.filter("p_size > 25").select(columns))


@query
def table_search_regex(spark, d):
    return search.search_any(_parts(spark, d), "BOLT|conomy$|^4.$")


@query
def table_search_literal(spark, d):
    documents = inputs.table(spark, d, "documents").select("doc_id", "text", "source")
    return search.search_any(documents, "+1 (", ["text", "source"], mode="literal").select("doc_id", "source")


@query
def indexed_search_literal(spark, d):
    """The documents' words by a stored index: which documents hold the keyword."""
    path = scratch_path(spark, "search")
    search_index.save_index(inputs.table(spark, d, "documents").select("doc_id", "text", "source"), path, ["text", "source"], 16)
    return search_index.SearchIndex(spark, path).search_any("+1 (", ["text", "source"], mode="literal").select("doc_id", "source")


@query
def indexed_search_regex(spark, d):
    path = scratch_path(spark, "search")
    search_index.save_index(_parts(spark, d), path, block_rows=64)
    return search_index.SearchIndex(spark, path).search_any("^small.*bolt")


@query
def indexed_student_search(spark, d):
    people = inputs.table(spark, d, "customer").select(F.col("c_custkey").alias("ma_sv"), F.col("c_name").alias("ho_ten"))
    path = scratch_path(spark, "search")
    search_index.save_index(people, path)
    return search_index.SearchIndex(spark, path).student_search("R#00000011")


@query
def student_search(spark, d):
    people = inputs.table(spark, d, "customer").select(F.col("c_custkey").alias("ma_sv"), F.col("c_name").alias("ho_ten"))
    return search.student_search(people, "R#00000000")


@query
def filter_codes(spark, d):
    return search.filter_codes(inputs.scores_long(spark, d), labels.CAREER_FIELDS["AI / Data Science"], "ma_mon")


@query
def filter_codes_table(spark, d):
    chosen = inputs.table(spark, d, "part").filter("p_type = 'PROMO'").select("p_partkey")
    lines = inputs.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return search.filter_codes(lines, chosen, "l_partkey")


# --- market -----------------------------------------------------------------

@query
def market_total(spark, d):
    return market.market_total(inputs.market(spark, d))


@query
def market_by_field(spark, d):
    return market.market_by_field(inputs.market(spark, d))


@query
def market_role_share(spark, d):
    return market.role_share(inputs.market(spark, d))


@query
def market_report(spark, d):
    return market.market_report(inputs.market(spark, d)).select("Category", "line")


@query
def role_classify(spark, d):
    return inputs.market(spark, d).select("Role", rules.classify_role("Role").alias("field"))


@query
def best_field(spark, d):
    return market.best_field(_gpas(spark, d)).select("ma_sv", "best_field", "best_gpa")


@query
def competitiveness(spark, d):
    return market.competitiveness(_gpas(spark, d), inputs.market(spark, d)).select(
        "ma_sv", "best_field", "best_gpa", "field_jobs", "market_ratio", "competitiveness"
    )


@query
def competitiveness_report(spark, d):
    scored = market.competitiveness(_gpas(spark, d), inputs.market(spark, d))
    return market.competitiveness_report(scored).select("ma_sv", "top_matched_jobs")


@query
def match_jobs_fields(spark, d):
    """Postings for each career field's skills."""
    fields = spark.createDataFrame([(f, ", ".join(s)) for f, s in labels.FIELD_SKILLS.items()], "field string, skills string")
    return matching.match_jobs(fields, inputs.postings(spark, d), 25, 0.2, seeker="field")


@query
def match_jobs_students(spark, d):
    """Postings for each student by the fields that they are good at."""
    able = matching.skill_profile(market.best_field(_gpas(spark, d)))
    return matching.match_jobs(able, inputs.postings(spark, d), 5)


@query
def career_analysis(spark, d):
    out = career.analyze_students(
        inputs.cohort(spark, d), inputs.market(spark, d), keyword="customer", centres=READINESS_CENTRES
    )
    return out.select("ma_sv", "gpa_tong", "TOEIC", "cluster", "nhom_san_sang", "best_field", "competitiveness")


@query
def career_analysis_search(spark, d):
    out = career.analyze_students(inputs.cohort(spark, d), keyword="R#0000000", centres=READINESS_CENTRES)
    return out.select("ma_sv", "gpa_tong", "TOEIC", "nhom_san_sang", "top_matched_jobs")


@query
def group_share(spark, d):
    return cards.group_share(_ready(spark, d), "nhom_san_sang")


@query
def readiness_tag(spark, d):
    return _ready(spark, d).select(
        "ma_sv",
        bands.readiness_tag("nhom_san_sang").alias("tag"),
        bands.readiness_rank_tag("readiness_rank").alias("rank_tag"),
    )


@query
def first_n_indexed(spark, d):
    return cards.first_n(_features(spark, d).select("ma_sv", "gpa"), 20, [F.desc("gpa"), "ma_sv"])


@query
def readiness_summary(spark, d):
    return cards.readiness_lines(_ready(spark, d))


# --- clustering with fixed centres ------------------------------------------

@query
def assemble_scale(spark, d):
    vectors = clustering.assemble(inputs.stats(spark, d).select("MaMH", *labels.SUBJECT_FEATURES), labels.SUBJECT_FEATURES, True)
    names = [f"f{i}" for i in range(len(labels.SUBJECT_FEATURES))]
    plain = clustering.vector_columns(vectors.select("MaMH", clustering.VECTOR), names)
    return plain.select("MaMH", *[F.round(n, 6).alias(n) for n in names])


@query
def assign_fixed_centres(spark, d):
    return _assigned(spark, d).select("ma_sv", "cluster", F.round("sq_dist", 6).alias("sq_dist"))


@query
def wcss_fixed_centres(spark, d):
    return clustering.wcss(_assigned(spark, d)).withColumn("wcss", F.round("wcss", 4))


@query
def silhouette_fixed_centres(spark, d):
    rows = clustering.silhouette(_assigned(spark, d), len(STUDENT_CENTRES), labels.STUDENT_FEATURES)
    return rows.groupBy("cluster").agg(F.count("*").alias("n"), F.round(F.avg("silhouette"), 6).alias("silhouette"))


@query
def silhouette_band(spark, d):
    rows = clustering.silhouette(_assigned(spark, d), len(STUDENT_CENTRES), labels.STUDENT_FEATURES)
    scores_by_cluster = rows.groupBy("cluster").agg(F.avg("silhouette").alias("s"))
    return scores_by_cluster.select("cluster", bands.silhouette_label("s").alias("band"))


@query
def rank_labels(spark, d):
    return _ready(spark, d).select("ma_sv", "cluster", "readiness_rank", "nhom_san_sang")


@query
def risk_order(spark, d):
    return _assigned(spark, d).select("ma_sv", "cluster", clustering.risk_order("cluster").alias("risk_order"))


@query
def k_metrics_fixed(spark, d):
    return _metrics(spark, d).select("k", F.round("wcss", 4).alias("wcss"), F.round("silhouette", 6).alias("silhouette"))


@query
def elbow_point(spark, d):
    return kselect.elbow_point(_metrics(spark, d))


@query
def choose_k(spark, d):
    return kselect.choose_k(_metrics(spark, d))


@query
def default_k(spark, d):
    return kselect.default_k(spark.createDataFrame([(k,) for k in _k_tried(spark, d)], "k int"))


@query
def label_index(spark, d):
    table = ranks.label_index(_ready(spark, d).select("ma_sv", "nhom_san_sang"), "nhom_san_sang")
    return table.withColumn("ml_label", F.col("ml_label").cast("int"))


# --- pages ------------------------------------------------------------------

@query
def page_headings(spark, d):
    found = pages.extract_headings(inputs.table(spark, d, "pages"), "h1")
    return found.select("page_id", "n_headings", F.array_join("headings", "\n").alias("headings"))


@query
def page_link_texts(spark, d):
    found = pages.extract_headings(inputs.table(spark, d, "pages"), "a")
    return found.select("page_id", "n_headings", F.array_join("headings", "\n").alias("headings"))


@query
def page_paragraphs(spark, d):
    """Paragraphs of all pages, most of them without an end tag."""
    found = pages.extract_headings(inputs.table(spark, d, "pages"), "p")
    return found.select("page_id", "n_headings", F.array_join("headings", "\n").alias("headings"))


@query
def page_marker(spark, d):
    found = inputs.table(spark, d, "pages")
    payload = pages.has_marker(found).withColumnRenamed("has_marker", "has_payload")
    advert = pages.has_marker(payload, "div", "class", "ad").withColumnRenamed("has_marker", "has_advert")
    return pages.has_marker(advert, "html", "lang", "en").select("page_id", "has_payload", "has_advert", "has_marker")


@query
def page_payload_titles(spark, d):
    """The pages wrapped as JSON payloads: their URLs are the titles."""
    wrapped = inputs.table(spark, d, "pages").select(
        "page_id", F.concat(F.col("html"), F.lit('{"title" : "'), "url", F.lit('","x":1,"title":"'), "url", F.lit('"}')).alias("html")
    )
    found = pages.payload_values(wrapped)
    return found.select(
        "page_id", "n_payload", F.array_join("payload", "\n").alias("payload"),
        F.array_join("payload_sample", "\n").alias("payload_sample"),
    )


@query
def page_scripts(spark, d):
    """Calls and advert numbers that the pages themselves state."""
    return pages.count_phrases(inputs.table(spark, d, "pages"), (r"track\((\d+)\)", r"<!-- ad (\d+) -->"))


@query
def page_count_phrases(spark, d):
    """Result counts stated in the pages: one phrase per page is added to its text."""
    phrase = F.concat(
        F.lit(" tìm thấy "), F.col("page_id"), F.lit(" KẾT QUẢ, "), F.length("url"), F.lit("kết quả, "),
        F.length("html"), F.lit("  Việc Làm"),
    )
    table = inputs.table(spark, d, "pages").select("page_id", F.concat("html", phrase).alias("html"))
    return pages.count_phrases(table)


# --- fitted -----------------------------------------------------------------
# A fit's numbers depend on its random start, so these queries return what must hold for any
# good fit: counts and sums of the rows that went through it, and checks of the fit itself.

def _fit_checks(model, features) -> DataFrame:
    """Rows, clusters in use, rows that another centre is nearer to, and whether the training cost is the sum of squares."""
    cost = model.stages[-1].summary.trainingCost
    checks = clustering.misplaced(model, features)
    same = F.abs(F.col("wcss") - cost) <= 0.01 * F.greatest(F.lit(1.0), F.lit(cost))
    return checks.select("n", "clusters", "misplaced", same.alias("cost_agrees"))


@query
def kmeans_risk(spark, d):
    """Students by fitted risk group: their number and summed counts, the groups, and the fit's checks."""
    features = durable(students.risk_features(inputs.cohort(spark, d)))
    model = clustering.fit_clusters(features, labels.STUDENT_FEATURES, 4, 1)
    clustering.check_feature_count(model, labels.STUDENT_FEATURES)
    ranked = students.order_by_risk(
        clustering.apply_clusters(model, features).withColumnRenamed("prediction", "cluster"), clustering.model_centres(model), "cluster"
    )
    # the profile of the riskiest group comes first, and its students have the lowest mean GPA
    groups = ranked.groupBy("prediction").agg(F.avg("gpa").alias("mean"), F.count("*").alias("n"), F.sum("failed_subjects").alias("f"),
                                              F.sum("excellent_subjects").alias("e"))
    riskiest = F.min_by("prediction", "mean").alias("riskiest")
    facts = groups.agg(F.sum("n").alias("students"), F.sum("f").alias("failed"), F.sum("e").alias("excellent"), riskiest)
    return _together(facts, _fit_checks(model, features))


def _together(one: DataFrame, other: DataFrame) -> DataFrame:
    """Two single rows side by side."""
    return one.select("*", other.select(F.struct("*").alias("__o")).scalar().alias("__o")).select(*one.columns, "__o.*")


@query
def kmeans_readiness(spark, d):
    """Students by fitted readiness group and with their market report, and the fit's checks."""
    wide = durable(inputs.cohort(spark, d))
    model, _ = career.train_readiness(wide, k=3)
    out = career.analyze_students(wide, inputs.market(spark, d), model=model)
    groups = out.groupBy("nhom_san_sang").agg(
        F.count("*").alias("n"), F.sum("TOEIC").alias("t"), F.count_if(F.col("top_matched_jobs").isNotNull()).alias("r"), F.avg("gpa_tong").alias("gpa")
    )
    facts = groups.agg(F.sum("n").alias("students"), F.sum("t").cast("bigint").alias("toeic"), F.sum("r").alias("reports"), F.count("*").alias("groups"))
    return _together(facts, _fit_checks(model, career.readiness_table(wide)))


@query
def kmeans_subject(spark, d):
    """Subjects by difficulty, all with one of the four quality labels of the fitted clusters, and the fit's checks."""
    stats = durable(inputs.stats(spark, d))
    model, _ = subject_plans.train_subject_quality(stats)
    analysed = subject_plans.analyze_subjects(stats, model=model)
    facts = analysed.agg(
        F.count("*").alias("subjects"), F.count_if(F.col("ChatLuong").isin(labels.SUBJECT_CLUSTER_LABELS)).alias("labelled"),
        F.count_if(F.col("DoKho") == labels.HARD).alias("hard"),
    )
    return _together(facts, _fit_checks(model, stats))


@query
def kmeans_centres(spark, d):
    """Per feature: the number of centres, and whether their mean, weighted by cluster size, is the feature's mean."""
    stats = durable(inputs.stats(spark, d))
    features = labels.SUBJECT_FEATURES
    model, _ = subject_plans.train_subject_quality(stats)
    centres = clustering.centres_long(spark, clustering.model_centres(model), features)
    sizes = clustering.apply_clusters(model, stats).groupBy(F.col("prediction").alias("cluster")).agg(F.count("*").alias("n"))
    # centres are scaled by the features' deviations
    scales = dict(zip(features, (float(x) for x in model.stages[1].std)))
    spread = F.element_at(F.create_map(*[F.lit(x) for pair in scales.items() for x in pair]), F.col("feature"))
    means = centres.join(sizes, "cluster").groupBy("feature").agg(
        F.count("*").alias("centres"), (F.sum(F.col("value") * F.col("n") * spread) / F.sum("n")).alias("mean")
    )
    values = stats.unpivot(["MaMH"], [casts.named(c) for c in features], "feature", "x")
    true_means = values.groupBy("feature").agg(F.avg("x").alias("m"), F.min("x").alias("least"), F.max("x").alias("greatest"))
    agrees = F.abs(F.col("mean") - F.col("m")) <= 0.02 * spread + 1e-9
    return means.join(true_means, "feature").select("feature", "centres", "least", "greatest", agrees.alias("agrees"))


@query
def kmeans_evaluation(spark, d):
    """The report of a fitted model against the silhouette computed row by row."""
    features = durable(students.risk_features(inputs.cohort(spark, d)))
    model = clustering.fit_clusters(features, labels.STUDENT_FEATURES, 4, 1)
    clusters, report = clustering.evaluate_model(model, features)
    own = clustering.silhouette(clusters, 4, labels.STUDENT_FEATURES, "prediction").agg(F.avg("silhouette").alias("s"), F.count("*").alias("students"))
    close = F.abs(F.col("s") - F.col("silhouette")) < 1e-6
    same_band = bands.silhouette_label("s") == F.col("band")
    return _together(own, report).select("students", close.alias("agrees"), same_band.alias("band_agrees"))


@query
def k_sweep(spark, d):
    """Every tried k: whether its cost lies under that of a single cluster and its silhouette is one."""
    features = durable(students.risk_features(inputs.cohort(spark, d)))
    metrics = kselect.k_sweep(features, labels.STUDENT_FEATURES, 2, 8)
    total = reduce(add, [F.var_pop(c) * F.count(c) for c in labels.STUDENT_FEATURES])
    single = features.agg(total).scalar()
    inside = F.col("silhouette").between(-1.0, 1.0)
    falls = F.col("wcss") <= F.coalesce(F.lag("wcss").over(Window.orderBy("k")), F.col("wcss"))  # a row per k
    return metrics.select("k", (F.col("wcss") < single).alias("below_single"), inside.alias("silhouette_ok"), falls.alias("cost_falls"))


@query
def suggest_k(spark, d):
    """The suggested k against the rule spelt out over the metrics that it rests on, and the middle k."""
    features = durable(students.risk_features(inputs.cohort(spark, d)))
    k, metrics = kselect.suggest_k(features, labels.STUDENT_FEATURES, 2, 5)
    rows = sorted(map(tuple, metrics.collect()))  # a row per k
    by_silhouette = min(rows, key=lambda r: (-r[2], r[0]))[0]
    high, low = max(r[1] for r in rows), min(r[1] for r in rows)
    weighed = min(rows, key=lambda r: (-(70 * r[2] + 30 * (high - r[1]) / (high - low)), r[0]))[0]
    bends = [(-(a[1] - 2 * b[1] + c[1]), b[0]) for a, b, c in zip(rows, rows[1:], rows[2:])]
    chosen = weighed if weighed in (by_silhouette, min(bends)[1]) else by_silhouette
    middle = kselect.default_k(metrics).select("default_k")
    return middle.select(F.lit(len(rows)).alias("tried"), F.lit(k == chosen).alias("by_rule"), "default_k")


@query
def train_risk(spark, d):
    """Students grouped by a model whose k is chosen from the data: their counts, and checks of the model."""
    wide = durable(inputs.cohort(spark, d))
    model, clusters, report = students.train_risk(wide, k_max=4)
    k = len(clustering.model_centres(model))
    facts = clusters.agg(F.count("*").alias("students"), F.sum("failed_subjects").alias("failed"), (F.count_distinct("prediction") == k).alias("all_used"))
    good = report.select(F.col("silhouette").between(-1.0, 1.0).alias("silhouette_ok"), (bands.silhouette_label("silhouette") == F.col("band")).alias("band_ok"))
    scored = students.score_risk(wide, model).agg(F.count("*")).scalar()
    return _together(facts, good).withColumns({"k_ok": F.lit(2 <= k <= 4), "scored": scored})


@query
def evaluation_data(spark, d):
    """What each kind of model is fitted on: rows, features and sums."""
    cohort, stats = inputs.cohort(spark, d), inputs.stats(spark, d)
    rows = None
    for kind, table in (("student", cohort), ("readiness", cohort), ("subject", stats)):
        data, columns, scaled = training.evaluation_data(kind, table)
        data = schema.clean_features(data, columns)
        one = data.agg(F.lit(kind).alias("kind"), F.lit(len(columns)).alias("features"), F.lit(scaled).alias("scaled"), F.count("*").alias("n"),
                       F.round(F.sum(casts.named(columns[0])), 4).alias("first_sum"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query
def career_no_match(spark, d):
    """The empty-input guard: a search without a match still gives all columns, here counted beside a search with matches."""
    cohort = inputs.cohort(spark, d)
    rows = None
    for name, keyword in (("none", "no such student"), ("some", "R#00000000")):
        found = career.analyze_students(cohort, keyword=keyword, centres=READINESS_CENTRES)
        one = found.agg(F.lit(name).alias("search"), F.lit(len(found.columns)).alias("n_columns"), F.count("*").alias("n"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query
def rf_importance(spark, d):
    """Importances of all scaled subject columns: their number, and whether they are shares of one."""
    ready = durable(_ready(spark, d).select("nhom_san_sang", *schema.columns_between(scores.field_gpa(inputs.scores_wide(spark, d)))))
    found = importance.feature_importance(ready, min_importance=-1.0, top=len(ready.columns))
    total = F.abs(F.sum("percent") - 100) <= 0.05 * F.count("*")
    known = F.count_if(F.col("subject").isin(inputs.SUBJECT_CODES)).alias("known")
    return found.agg(F.count("*").alias("subjects"), known, total.alias("sums_to_one"), F.min(F.col("percent") >= 0).alias("not_negative"))


@query
def importance_top(spark, d):
    """The report of importances, here each subject's share of all scores."""
    shares = cards.group_share(inputs.scores_long(spark, d), "ma_mon")
    return importance.top_importances(
        shares.select(F.concat(F.lit("_"), "ma_mon", F.lit("_4")).alias("column"), (F.col("percent") / 100).alias("importance"))
    )


@query
def model_roundtrip(spark, d):
    features = durable(students.risk_features(inputs.cohort(spark, d)))
    model = clustering.fit_clusters(features, labels.STUDENT_FEATURES, 4, 1)
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    absent = scratch_path(spark, "absent")
    loaded = models.load_or(path)
    fitted = models.load_or(absent, "fit", lambda: model)
    passed = models.load_or(absent, "passthrough")
    before = clustering.apply_clusters(model, features).withColumnRenamed("prediction", "before")
    both = clustering.apply_clusters(loaded, before).withColumnRenamed("prediction", "loaded")
    both = clustering.apply_clusters(fitted, both)
    same = F.count_if((F.col("before") == F.col("loaded")) & (F.col("before") == F.col("prediction"))).alias("same")
    # without a model, scoring hands its input back
    unscored = students.score_risk(features, passed).agg(F.count("*")).scalar()
    return both.agg(F.count("*").alias("n"), same, F.count_distinct("loaded").alias("clusters")).withColumn("unscored", unscored)
