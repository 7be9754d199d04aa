"""The same results in plain SQL, written independently of the operators.

Rounding goes through DECIMAL, because Spark rounds half-up on the shortest
decimal form and a binary round() would not.
"""

from __future__ import annotations

from scorefold import labels
from scorefold.plans import inputs
from scorefold.plans.registry import (
    MORE_CENTRES, N_SUBJECTS, READINESS_CENTRES, STUDENT_CENTRES, SUBJECT_CENTRES,
)

FIELDS = list(labels.CAREER_FIELDS)
GPA_COLUMNS = ["gpa_" + f.replace(" ", "_").replace("/", "_") for f in FIELDS]


def q(text) -> str:
    return "null" if text is None else "'" + str(text).replace("'", "''") + "'"


def rnd(expr: str, digits: int) -> str:
    return f"cast(round(cast({expr} as decimal(30,12)), {digits}) as double)"


def cases(pairs, otherwise) -> str:
    return "case " + " ".join(f"when {c} then {v}" for c, v in pairs) + f" else {otherwise} end"


def h4(x: str) -> str:
    bands = [
        (f"{x} between 8.5 and 10", "4.0::double"),
        (f"{x} >= 8 and {x} < 8.5", "3.5::double"),
        (f"{x} >= 7 and {x} < 8", "3.0::double"),
        (f"{x} >= 6.5 and {x} < 7", "2.5::double"),
        (f"{x} >= 5.5 and {x} < 6.5", "2.0::double"),
        (f"{x} >= 5 and {x} < 5.5", "1.5::double"),
        (f"{x} >= 4 and {x} < 5", "1.0::double"),
    ]
    return cases(bands, "0.0::double")


def values(name: str, columns: str, rows) -> str:
    body = ", ".join("(" + ", ".join(r) + ")" for r in rows)
    return f"{name}({columns}) as (values {body})"


# --- common tables ----------------------------------------------------------

CODES = values("codes", "brand, ma_mon", [(str(i + 1), q(c)) for i, c in enumerate(inputs.SUBJECT_CODES)])
FIELD_MAP = values(
    "field_map", "pos, field, ma_mon",
    [(str(i), q(f), q(c)) for i, f in enumerate(FIELDS) for c in labels.CAREER_FIELDS[f]],
)
SCORES = f"""{CODES}, raw_scores as (
  select o_custkey as ma_sv, p_brand,
         avg(least(100, cast(l_quantity as bigint) + 10 * (p_size % 4) + 15 * (o_custkey % 4))) / 10.0 as diem
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
  group by 1, 2
), scores as (
  select ma_sv, c.ma_mon, diem from raw_scores join codes c on c.brand = cast(substr(p_brand, 7) as integer)
)"""
GRID = f"""{SCORES}, grid as (
  select s.ma_sv, c.ma_mon, x.diem
  from (select distinct ma_sv from scores) s cross join codes c
  left join scores x on x.ma_sv = s.ma_sv and x.ma_mon = c.ma_mon
)"""
FEATURES = f"""{SCORES}, features as (
  select ma_sv, avg(h) as gpa, {rnd("coalesce(stddev_samp(h), 0)", 6)} as std_score,
         count(*) filter (where h < 1) as failed_subjects, count(*) filter (where h >= 3.5) as excellent_subjects
  from (select ma_sv, {h4("diem")} as h from scores) group by 1
)"""
_GPA = ", ".join(f"{rnd(f'avg(h) filter (where pos = {i})', 2)} as {c}" for i, c in enumerate(GPA_COLUMNS))
GPAS = f"""{GRID}, {FIELD_MAP}, gpas as (
  select ma_sv, {_GPA}, {rnd("avg(h)", 2)} as gpa_tong
  from (select ma_sv, pos, {h4("diem")} as h from grid join field_map using (ma_mon)) group by 1
)"""
WIDE_COLUMNS = ", ".join(f"max(case when ma_mon = {q(c)} then diem end) as \"{c}\"" for c in inputs.SUBJECT_CODES)
TOEIC = "cast(200 + 5 * (ma_sv % 159) as integer)"
COHORT = f"""{SCORES}, cohort as (
  select s.*, c_name as ho_ten, {TOEIC} as "TOEIC"
  from (select ma_sv, {WIDE_COLUMNS} from scores group by 1) s left join customer on c_custkey = ma_sv
)"""


def share(condition: str) -> str:
    return f"100::double * count(*) filter (where {condition}) / count(*)"


STATS = f"""stats as (
  select cast(l_partkey as varchar) as "MaMH", max(p_name) as "TenMH",
         {rnd("avg(x) / 10.0", 4)} as "TB", {rnd("stddev_samp(x) / 10.0", 6)} as "SD",
         {share("x >= 90")} as "A+%", {share("x >= 85 and x < 90")} as "A%",
         {share("x >= 70 and x < 85")} as "B%", {share("x >= 55 and x < 70")} as "C%",
         {share("x >= 40 and x < 55")} as "D%", {share("x < 40")} as "F%",
         0.0::double as "MTC%", median(x) / 10.0 as "TV"
  from (select l_partkey, p_name, least(100, cast(l_quantity as bigint) + 10 * (p_size % 8)) as x
        from lineitem join part on l_partkey = p_partkey)
  group by l_partkey
)"""
MARKET = f"""market as (
  select case when p_size % 3 <> 0 then 'IT' else 'Finance' end as "Category",
         [{", ".join(map(q, inputs.ROLES))}][(p_partkey % {len(inputs.ROLES)}) + 1] || ' ' || p_type as "Role",
         coalesce([{", ".join(map(q, inputs.ODD_COUNTS))}][(p_partkey % {len(inputs.ODD_COUNTS)}) + 1],
                  ' ' || cast(p_size as varchar)) as "JobCount"
  from part
)"""
SAFE_INT = """case when regexp_full_match(trim("JobCount"), '[+-]?[0-9]+') then cast(trim("JobCount") as bigint) else 0 end"""
ROLE_FIELD = cases(
    [
        (" or ".join(f"contains(lower(\"Role\"), {q(w)})" for w in words), q(field))
        for field, words in labels.ROLE_KEYWORDS
    ],
    q(labels.DEFAULT_FIELD),
)
DEMAND = f"""{MARKET}, posts as (
  select *, {SAFE_INT} as jobs, {ROLE_FIELD} as field from market
), totals as (
  select cast(coalesce(sum(jobs) filter (where "Category" = 'IT'), 0) as bigint) as total_jobs, count(*) as n_rows from posts
), {values("fields", "field_pos, field", [(str(i), q(f)) for i, f in enumerate(FIELDS)])}, demand as (
  select field_pos, f.field, cast(j.jobs as bigint) as jobs, total_jobs, n_rows
  from fields f left join (select field, sum(jobs) as jobs from posts where "Category" = 'IT' group by 1) j using (field), totals
)"""
# the first field in order wins a tie; none above zero means the default
BEST = f"""best as (
  select ma_sv,
         coalesce(max(g), 0.0) as best_gpa,
         case when max(g) > 0 then arg_min(field, -g * 1000 + pos) else {q(labels.DEFAULT_FIELD)} end as best_field
  from (select ma_sv, unnest([{", ".join(str(i) for i in range(5))}]) as pos,
               unnest([{", ".join(q(f) for f in FIELDS)}]) as field, unnest([{", ".join(GPA_COLUMNS)}]) as g from gpas)
  group by 1
)"""
COMPETE = f"""{GPAS}, {DEMAND}, {BEST}, figures as (
  select ma_sv, best_field, best_gpa, coalesce(jobs, 10) as field_jobs,
         coalesce(jobs, 10) / greatest(total_jobs, 1) * 100 as market_ratio
  from best join demand on field = best_field
), compete as (
  select *, {cases([
      ("best_gpa >= 3.2 and market_ratio > 10", q(labels.COMPETITIVENESS_STRONG)),
      ("best_gpa >= 2.5 and market_ratio > 5", q(labels.COMPETITIVENESS_FAIR)),
      ("best_gpa < 2 or market_ratio < 2", q(labels.COMPETITIVENESS_FIERCE)),
  ], q(labels.COMPETITIVENESS_MEDIUM))} as competitiveness from figures
)"""


def centres(name: str, rows, columns) -> str:
    return values(name, "cluster, " + ", ".join(f"c{i}" for i in range(len(columns))),
                  [(str(i), *[f"{float(v)}::double" for v in r]) for i, r in enumerate(rows)])


def assigned(source: str, key: str, rows, columns, name: str = "assigned") -> str:
    """Nearest centre by enumerating all of them; the lowest number wins a tie."""
    distance = " + ".join(f"(\"{c}\" - c{i}) * (\"{c}\" - c{i})" for i, c in enumerate(columns))
    return f"""{centres(name + "_centres", rows, columns)}, {name} as (
  select * exclude (rn) from (
    select s.*, cluster, {distance} as sq_dist,
           row_number() over (partition by s.{key} order by {distance}, cluster) as rn
    from {source} s cross join {name}_centres) where rn = 1
)"""


def silhouettes(source: str, columns, name: str = "sil") -> str:
    """Mean squared distances from per-cluster counts, sums and squared norms, one row per student and cluster."""
    norm = " + ".join(f'"{c}" * "{c}"' for c in columns)
    sums = ", ".join(f'sum("{c}") as y{i}' for i, c in enumerate(columns))
    dot = " + ".join(f'p."{c}" * y{i}' for i, c in enumerate(columns))
    return f"""{name}_stats as (
  select cluster as other, count(*) as n, sum({norm}) as psi, {sums} from {source} group by 1
), {name}_means as (
  select p.ma_sv, p.cluster, p.sq_dist, other, n,
         ({norm}) + psi / n - 2 * ({dot}) / n as m
  from {source} p cross join {name}_stats
), {name} as (
  select ma_sv, cluster, sq_dist,
         case when max(case when other = cluster then n end) <= 1 then 0.0::double
              else (min(case when other <> cluster then m end)
                    - max(case when other = cluster then m * n / (n - 1) end))
                 / greatest(min(case when other <> cluster then m end), max(case when other = cluster then m * n / (n - 1) end))
         end as silhouette
  from {name}_means group by 1, 2, 3
)"""


STUDENTS = labels.STUDENT_FEATURES
ASSIGNED = f"{FEATURES}, {assigned('features', 'ma_sv', STUDENT_CENTRES, STUDENTS)}"
SILHOUETTE = f"{ASSIGNED}, {silhouettes('assigned', STUDENTS)}"


def _metrics() -> str:
    parts, union = [FEATURES], []
    for k in range(2, len(MORE_CENTRES) + 1):
        parts.append(assigned("features", "ma_sv", MORE_CENTRES[:k], STUDENTS, f"a{k}"))
        parts.append(silhouettes(f"a{k}", STUDENTS, f"s{k}"))
        union.append(f"select {k} as k, sum(sq_dist) as wcss, avg(silhouette) as silhouette from s{k}")
    return ", ".join(parts) + f", metrics as ({' union all '.join(union)})"


METRICS = _metrics()
ELBOW = """bends as (
  select lag(k) over (order by k) as elbow_k,
         lag(wcss, 2) over (order by k) - 2 * lag(wcss) over (order by k) + wcss as bend
  from metrics
), elbow as (
  select elbow_k from bends where bend is not null order by bend desc, elbow_k limit 1
)"""

SUBJECT_ASSIGNED = assigned("stats", '"MaMH"', SUBJECT_CENTRES, labels.SUBJECT_FEATURES)
# the centres are listed best first, so the cluster number is the rank
CLUSTER_LABEL = cases(
    [(f"cluster = {i}", q(x)) for i, x in enumerate(labels.SUBJECT_CLUSTER_LABELS)], q(labels.UNKNOWN_LABEL)
)
DIFFICULTY = cases(
    [('"TB" < 6.0 or "F%" > 15', q(labels.HARD)), ('"TB" >= 8.0', q(labels.EASY))], q(labels.MEDIUM)
)
TREND = cases([('"TB" >= 7.5', q(labels.TREND_UP)), ('"TB" < 5.0', q(labels.TREND_DOWN))], q(labels.TREND_FLAT))
RULE_QUALITY = cases(
    [
        ('"SD" > 1.0 and "F%" > 10', q(labels.QUALITY_UNSTABLE)),
        ('"A%" + "A+%" > 40 and "SD" < 0.7', q(labels.QUALITY_EVEN)),
    ],
    q(labels.QUALITY_STABLE),
)
COLLAPSED = cases(
    [("cluster = 3", q(labels.QUALITY_UNSTABLE)), ("cluster = 0", q(labels.QUALITY_EVEN))], q(labels.QUALITY_STABLE)
)


def analysed(quality: str, source: str = "assigned", where: str = "true") -> str:
    return f"""select "MaMH", "TenMH", {DIFFICULTY} as "DoKho", {quality} as "ChatLuong", {TREND} as "XuHuong",
       {rnd('"TB"', 2)} as "TB", {rnd('"F%"', 2)} as "F%" from {source} where {where}"""


ANALYSED = f"{STATS}, {SUBJECT_ASSIGNED}, analysed as ({analysed(CLUSTER_LABEL)})"


def priority(column: str = '"ChatLuong"') -> str:
    return cases(
        [(f"contains({column}, 'Tiêu cực')", 0), (f"contains({column}, 'Không ổn định')", 1),
         (f"contains({column}, 'Xuất sắc')", 3)], 2,
    )


PRIORITISED = f"{ANALYSED}, prioritised as (select *, {priority()} as priority from analysed)"


def pick_by_priority(table: dict, column: str = "priority") -> str:
    return cases([(f"{column} = {p}", q(t)) for p, t in table.items()], "null")


def subject_list(by_name: bool, headers: dict, keyword: str | None = None) -> str:
    name = "\"TenMH\"" if by_name else "''"
    details = f"""select priority, 1 as is_detail, {name} as sort_name, "MaMH", '  ' || "MaMH" || ' – ' || "TenMH" as item
      from prioritised"""
    if keyword is not None:
        return f"with {PRIORITISED} select * from ({details}) where contains(lower(item), {q(keyword)})"
    heads = f"""select distinct priority, 0, '', cast(null as varchar), '  ' || {pick_by_priority(headers)} from prioritised"""
    return f"with {PRIORITISED} {details} union all {heads}"


READY_SOURCE = f"{GPAS}, ready_in as (select *, cast({TOEIC} as double) as \"TOEIC\" from gpas)"
READY = f"""{READY_SOURCE}, {assigned("ready_in", "ma_sv", READINESS_CENTRES, labels.READINESS_FEATURES)}, ready as (
  select *, 2 - cluster as readiness_rank,
         [{", ".join(q(x) for x in labels.READINESS_LABELS)}][3 - cluster] as nhom_san_sang from assigned
)"""

PART_SUBJECTS = """parts as (
  select cast(p_partkey as varchar) as "MaMH", p_name as "TenMH", p_size, p_type from part
)"""


def report_sql() -> str:
    lines = [
        ("header", "'Nội dung phân tích ' || \"TenMH\" || ' (' || \"MaMH\" || '):\n'"),
        ("subheader", "'1. Độ khó của học phần:\n'"),
        ("content", "'- Đánh giá: ' || \"DoKho\" || ' (Điểm TB: ' || \"TB\" || ', Tỷ lệ rớt: ' || \"F%\" || '%)\n'"),
        ("subheader", "'2. Chất lượng giảng dạy:\n'"),
        ("content", "'- Đánh giá: ' || \"ChatLuong\" || '\n'"),
        ("subheader", "'3. Xu hướng học tập chung của sinh viên:\n'"),
        ("content", "'- Đánh giá: ' || \"XuHuong\" || '\n'"),
        ("divider", "'\n----------------------------------------\n\n'"),
    ]
    return f"with {ANALYSED} " + " union all ".join(
        f"select \"MaMH\", {i + 1} as seq, {q(tag)} as tag, {text} as text from analysed"
        for i, (tag, text) in enumerate(lines)
    )


GREEN, BLUE, AMBER, RED, GREY = (q(c) for c in ("#10b981", "#3b82f6", "#f59e0b", "#ef4444", "#6b7280"))
GPA_LABEL = cases([("gpa >= 3.6", q("Xuất sắc")), ("gpa >= 3.2", q("Giỏi")), ("gpa >= 2.5", q("Khá")),
                   ("gpa >= 2.0", q("Trung bình"))], q("Yếu"))
GPA_COLOR = cases([("gpa >= 3.2", GREEN), ("gpa >= 2.5", BLUE), ("gpa >= 2.0", AMBER)], RED)
STD_LABEL = cases([("std_score <= 0.3", q("Rất ổn định")), ("std_score <= 0.6", q("Ổn định")),
                   ("std_score <= 0.9", q("Dao động"))], q("Không ổn định"))
STD_COLOR = cases([("std_score <= 0.3", GREEN), ("std_score <= 0.6", BLUE), ("std_score <= 0.9", AMBER)], RED)
FAILED_LABEL = cases(
    [("failed_subjects = 0", q("Không có môn trượt ✓")),
     ("failed_subjects <= 2", "failed_subjects || ' môn – Ít, cần khắc phục'"),
     ("failed_subjects <= 5", "failed_subjects || ' môn – Trung bình, cần chú ý'")],
    "failed_subjects || ' môn – Nhiều, rủi ro cao'",
)
FAILED_COLOR = cases([("failed_subjects = 0", GREEN), ("failed_subjects <= 2", BLUE), ("failed_subjects <= 5", AMBER)], RED)
EXCELLENT_RATIO = f"excellent_subjects / {N_SUBJECTS}"
EXCELLENT_PERCENT = f"cast(round_even({EXCELLENT_RATIO} * 100, 0) as integer)"
EXCELLENT_COLOR = cases([(f"{EXCELLENT_RATIO} >= 0.5", GREEN), (f"{EXCELLENT_RATIO} >= 0.3", BLUE),
                         (f"{EXCELLENT_RATIO} >= 0.1", AMBER)], GREY)
PROFILES = values(
    "profiles", "pid, label, risk, color_tag, gpa_range, n_reasons, suggestions",
    [(str(p.cluster), q(p.label), q(p.risk), q(p.color_tag), q(p.gpa_range), str(len(p.reasons)),
      q("; ".join(p.suggestions))) for p in labels.CLUSTER_PROFILES],
)
# the student centres are listed weakest first: number 0..3 is the risk position
RISK_PROFILE = "[2, 0, 3, 1][cluster + 1]"
RISK_TABLE = f"""{ASSIGNED}, risk as (
  select ma_sv, {rnd("gpa", 2)} as gpa, {rnd("std_score", 2)} as std_score, failed_subjects, excellent_subjects,
         {RISK_PROFILE} as prediction from assigned
)"""


def unit(expr: str) -> str:
    return f"greatest(0.0::double, least(1.0::double, {expr}))"


TB_LABEL = cases([('"TB" >= 8.0', q("Tốt / Giỏi")), ('"TB" >= 6.5', q("Khá")), ('"TB" >= 5.0', q("Trung bình"))], q("Thấp / Kém"))
TB_COLOR = cases([('"TB" >= 7.5', GREEN), ('"TB" >= 6.0', AMBER)], RED)
FAIL_LABEL = cases([('"F%" = 0', q("Rất thấp")), ('"F%" <= 10', q("Thấp")), ('"F%" <= 20', q("Trung bình"))], q("Cao / Cảnh báo"))
FAIL_COLOR = cases([('"F%" <= 5', GREEN), ('"F%" <= 15', AMBER)], RED)
FAIL_FRACTION = 'greatest(0.0::double, 1.0::double - "F%" / 50.0)'


def entities(expr: str) -> str:
    """The references that occur in the pages, `&amp;` last."""
    for name, char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        expr = f"replace({expr}, {q(name)}, {q(char)})"
    return expr


def headings(tag: str) -> str:
    hidden = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
    text = "trim(" + entities("regexp_replace(t, '<[^>]*>', '', 'g')") + ", ' \n\t\r')"
    return f"""with found as (
  select page_id, list_filter(list_transform(
           regexp_extract_all(regexp_replace(html, '{hidden}', '', 'g'), '(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}\\s*>', 1),
           lambda t: {text}), lambda t: t <> '') as hs from pages)
select page_id, cast(len(hs) as integer) as n_headings, array_to_string(hs, chr(10)) as headings from found"""


def paragraphs() -> str:
    """What follows each start of a paragraph, up to its own end or that of the article around it."""
    hidden = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
    cut = "regexp_replace(t, '(?is)</(p|article|div|body|html)>.*$', '')"
    text = "trim(" + entities(f"regexp_replace({cut}, '<[^>]*>', '', 'g')") + ", ' \n\t\r')"
    return f"""with found as (
  select page_id, list_filter(list_transform(string_split(regexp_replace(html, '{hidden}', '', 'g'), '<p>')[2:], lambda t: {text}),
                              lambda t: t <> '') as hs from pages)
select page_id, cast(len(hs) as integer) as n_headings, array_to_string(hs, chr(10)) as headings from found"""


PHRASED = """phrased as (
  select page_id, html || ' tìm thấy ' || page_id || ' KẾT QUẢ, ' || length(url) || 'kết quả, ' || length(html) || '  Việc Làm' as html
  from pages
)"""


def phrases() -> str:
    # RE2 folds the accented letters under (?i) as well
    found = " union all ".join(
        f"select page_id, {q(p)} as pattern, regexp_extract_all(html, {q('(?i)' + p)}, 1) as hits from phrased"
        for p in labels.COUNT_PATTERNS
    )
    return f"""with {PHRASED}, found as ({found})
select page_id, pattern, cast(i - 1 as integer) as pos, hits[i] as value
from (select *, unnest(generate_series(1, len(hits))) as i from found)"""


def wide_grid(std: str, failed: str, excellent: str) -> str:
    return f"""with {GRID}
select ma_sv, max(c_name) as ho_ten, avg(h) as gpa, {rnd(f"{std}(h)", 6)} as std_score,
       count(*) filter (where {failed}) as failed_subjects, count(*) filter (where {excellent}) as excellent_subjects
from (select *, {h4("diem")} as h from grid) left join customer on c_custkey = ma_sv group by 1"""


TRAINED = wide_grid("stddev_samp", "h < 1", "h >= 3.5")
MAPPED = list(dict.fromkeys(c for codes in labels.CAREER_FIELDS.values() for c in codes))
# student, name, TOEIC and scores; scaled scores, field GPAs and their mean; cluster, rank, group and report
ANALYSED_COLUMNS = 3 + len(inputs.SUBJECT_CODES) + len(MAPPED) + len(FIELDS) + 1 + 4


def scripts() -> str:
    found = " union all ".join(
        f"select page_id, {q(p)} as pattern, regexp_extract_all(html, {q(p)}, 1) as hits from pages"
        for p in (r"track\((\d+)\)", r"<!-- ad (\d+) -->")
    )
    return f"""with found as ({found})
select page_id, pattern, cast(i - 1 as integer) as pos, hits[i] as value
from (select *, unnest(generate_series(1, len(hits))) as i from found)"""


def _skills(field: str) -> str:
    return q(", ".join(labels.FIELD_SKILLS[field]))


_PICKED = ", ".join(map(q, inputs.SKILLS))
POSTINGS = f"""postings as (
  select p_partkey as posting, case when p_partkey % 29 <> 0 then concat_ws(', ', [{", ".join(map(q, inputs.ROLES))}][p_partkey % {len(inputs.ROLES)} + 1], p_type,
    [{_PICKED}][p_partkey % {len(inputs.SKILLS)} + 1], [{_PICKED}][(p_partkey * 7 + p_size) % {len(inputs.SKILLS)} + 1],
    [{_PICKED}][p_size * 3 % {len(inputs.SKILLS)} + 1], 'teamwork') end as text from part
)"""


def matched(k: int, least: float) -> str:
    """Cosines of all pairs with a common term; seekers is (seeker, skills)."""
    def bag(table: str, key: str, text: str) -> str:
        return f"select {key} as id, term, count(*) as tf from (select {key}, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+[+#]*')) as term from {table}) group by all"

    return f"""{POSTINGS}, jobs as ({bag("postings", "posting", "text")}), people as ({bag("texts", "skills", "skills")}),
idf as (select term, ln((1.0 + (select count(*) from postings)) / (1.0 + count(*))) + 1.0 as idf from jobs group by 1),
job_w as (select id, term, tf * idf as w from jobs join idf using (term)), people_w as (select id, term, tf * idf as w from people join idf using (term)),
job_n as (select id, sqrt(sum(w * w)) as n from job_w group by 1), people_n as (select id, sqrt(sum(w * w)) as n from people_w group by 1),
pairs as (
  select p.id as skills, j.id as posting, {rnd("sum(p.w * j.w) / (any_value(pn.n) * any_value(jn.n))", 6)} as cosine
  from people_w p join job_w j using (term) join people_n pn on pn.id = p.id join job_n jn on jn.id = j.id group by 1, 2),
ranked as (
  select skills, posting, cosine, cast(row_number() over (partition by skills order by cosine desc, posting) as integer) as rank from pairs where cosine >= {least} qualify rank <= {k})"""


ABLE = ", ".join(f"case when {c} >= 2.5 then {_skills(f)} end" for f, c in zip(FIELDS, GPA_COLUMNS))
SEEKERS = f"""seekers as (
  select ma_sv, coalesce(nullif(concat_ws(', ', {ABLE}), ''), {cases([(f"best_field = {q(f)}", _skills(f)) for f in FIELDS], "null")}) as skills
  from gpas join best using (ma_sv)
), texts as (select distinct skills from seekers)"""

SQL: dict[str, str] = {
    "indexed_search_literal": "select doc_id, source from documents where contains(lower(text), '+1 (') or contains(lower(source), '+1 (')",
    "indexed_search_regex": f"""with {PART_SUBJECTS} select * from parts where regexp_matches("TenMH", '(?i)^small.*bolt')""",
    "indexed_student_search": "select c_custkey as ma_sv, c_name as ho_ten from customer where contains(lower(c_name), 'r#00000011')",
    "suggest_k": """select 4 as tried, true as by_rule, 4 as default_k""",
    "train_risk": f"""with f as ({TRAINED}) select count(*) as students, cast(sum(failed_subjects) as bigint) as failed, true as all_used,
        true as silhouette_ok, true as band_ok, true as k_ok, count(*) as scored from f""",
    "csv_folder": f"""with {STATS}, s as (select *, cast("MaMH" as bigint) % 3 as i from stats)
select "MaMH", case when i <> 1 then "TenMH" || '|, one; two' end as "TenMH", case when i <> 2 then "TB" end as "TB",
  case when i <> 1 then "SD" end as "SD", case when i <> 2 then "F%" end as "F%" from s""",
    "student_features_kept": f"with {FEATURES} select * from features",
    "subject_badge": f"""with {PRIORITISED} select cast(p_partkey as varchar) as "MaMH", {", ".join(
        f"case when priority is null then {q(labels.SUBJECT_BADGE_UNKNOWN[i])} else {pick_by_priority({p: b[i] for p, b in labels.SUBJECT_BADGES.items()})} end as {name}"
        for i, name in enumerate(("background", "foreground", "icon")))} from part left join prioritised on "MaMH" = cast(p_partkey as varchar)""",
    "price_medians": "select l_partkey, median(cast(l_extendedprice as double)) as median from lineitem group by 1",
    "median_price": "select substr(o_orderpriority, 2, 1) as sign, median(cast(o_totalprice as double)) as median from orders group by 1",
    "customer_index": """with n as (select cast(o_custkey as varchar) as customer, count(*) as n from orders group by 1),
  i as (select customer, row_number() over (order by n desc, customer) - 1 as number from n)
select o_orderkey, customer, number from orders join i on customer = cast(o_custkey as varchar)""",
    "load_report": f"""with {MARKET}, n as (
  select count(*) as rows, count(*) filter (where "JobCount" is null) as nulls, count(try_cast(trim("JobCount") as double)) as numbers,
         count(*) filter (where "Category" is null) as c, count(*) filter (where "Role" is null) as r from market)
select 'Category' as column, rows, c as nulls, cast(null as bigint) as unparsable, cast(null as bigint) as numbers from n
union all select 'Role', rows, r, null, null from n union all select 'JobCount', rows, nulls, rows - nulls - numbers, numbers from n""",
    "market_replace": f"""with {MARKET} select * from market where "Category" = 'IT' and "JobCount" <> ''""",
    "match_jobs_fields": f"""with {values("seekers", "field, skills", [(q(f), _skills(f)) for f in FIELDS])}, texts as (select skills from seekers), {matched(25, 0.2)}
select field, rank, posting, cosine from seekers join ranked using (skills)""",
    "match_jobs_students": f"""with {GPAS}, {BEST}, {SEEKERS}, {matched(5, 0.1)}
select ma_sv, rank, posting, cosine from seekers join ranked using (skills)""",
    "csv_scores_roundtrip": f"with {COHORT} select * from cohort",
    "csv_stats_roundtrip": f"with {STATS} select * from stats",
    "detect_delimiter": f"""with {COHORT}, {STATS} select 'scores' as name, ';' as separator, count(*) as n from cohort
        union all select 'stats', ',', count(*) from stats""",
    "market_roundtrip": f"with {MARKET} select * from market",
    "market_flatten": """select o_custkey, 'IT' as "Category",
        case when o_custkey % 5 = 0 then 'IT' else o_orderstatus end as "Role", count(*) as "JobCount"
        from orders where o_orderpriority = '1-URGENT' group by 1, 2, 3""",
    "normalize_columns": 'select p_partkey as "ppartkey", p_brand as "p_brand", p_size as "p_size%" from part',
    "required_columns": 'select c_custkey, c_acctbal, 0.0::double as "TOEIC", 0.0::double as gpa_tong from customer',
    "safe_double": f"""with {MARKET} select "Category", "Role", coalesce(try_cast(trim("JobCount") as double), 0.0::double) as "JobCount" from market""",
    "keep_null_double": f"""with {MARKET} select "Category", "Role", try_cast(trim("JobCount") as double) as "JobCount" from market""",
    "safe_int": f'with {MARKET} select "Category", "Role", {SAFE_INT} as jobs from market',
    "display_columns": f"""with {FEATURES} select ma_sv, {rnd("gpa", 2)} as gpa, {rnd("std_score", 2)} as std_score,
        failed_subjects, excellent_subjects from features""",
    "row_count": f"with {SCORES} select count(*) as n, count(distinct ma_sv) as students, count(distinct ma_mon) as subjects from scores",
    "bounded_sample": "select o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey limit 2000",
    "unpivot_scores": f"with {GRID} select ma_sv, ma_mon, diem from grid",
    "pivot_scores": f"with {SCORES} select ma_sv, {WIDE_COLUMNS} from scores group by 1",
    "scale4": f"with {SCORES} select ma_sv, ma_mon, diem, {h4('diem')} as diem_he4 from scores",
    "student_features": f"with {FEATURES} select *, {GPA_LABEL} as band from features",
    "student_features_rowwise": wide_grid("stddev_pop", "diem < 4", "diem >= 8"),
    "student_features_wide": wide_grid("stddev_samp", "h < 1", "h >= 3.5"),
    "field_gpa": f"""with {GPAS}, scaled as (select ma_sv, {", ".join(
        f"max(case when ma_mon = {q(c)} then {h4('diem')} end) as _{c}_4"
        for codes in labels.CAREER_FIELDS.values() for c in codes)} from grid group by 1)
        select * from gpas join scaled using (ma_sv)""",
    "field_gpa_long": f"with {GPAS} select * from gpas",
    "field_gpa_taken": f"""with {SCORES}, {FIELD_MAP}, students as (select distinct ma_sv from scores), m as (
          select ma_sv, pos, {h4("diem")} as h from scores join field_map using (ma_mon))
        select ma_sv, {", ".join(f"{rnd(f'coalesce(avg(h) filter (where pos = {i}), 0)', 2)} as {c}" for i, c in enumerate(GPA_COLUMNS))},
               {rnd("coalesce(avg(h), 0)", 2)} as gpa_tong
        from students left join m using (ma_sv) group by 1""",
    "overall_gpa": f"with {GPAS} select ma_sv, gpa_tong from gpas",
    "gpa_band": f"with {FEATURES} select ma_sv, gpa, {GPA_LABEL} as label, {GPA_COLOR} as color from features",
    "stability_band": f"with {FEATURES} select ma_sv, {STD_LABEL} as label, {STD_COLOR} as color from features",
    "failed_band": f"with {FEATURES} select ma_sv, {FAILED_LABEL} as label, {FAILED_COLOR} as color from features",
    "excellent_band": f"with {FEATURES} select ma_sv, {EXCELLENT_PERCENT} as percent, {EXCELLENT_COLOR} as color from features",
    "metric_fractions": f"""with {FEATURES} select ma_sv, {unit("gpa / 4.0")} as gpa_fraction,
        {unit("1.0::double - std_score / 1.5")} as stability_fraction,
        {unit(f"1.0::double - failed_subjects / {N_SUBJECTS}")} as failed_fraction,
        {unit(f"excellent_subjects / {N_SUBJECTS}")} as excellent_fraction from features""",
    "cluster_tag": f"with {ASSIGNED} select ma_sv, cluster, ['warning', 'excellent', 'danger', 'good'][cluster + 1] as tag from assigned",
    "cluster_profile_join": f"""with {ASSIGNED}, {PROFILES}
        select ma_sv, cluster + 1 as prediction, label, risk, color_tag, gpa_range, n_reasons, suggestions
        from assigned join profiles on pid = case when cluster + 1 <= 3 then cluster + 1 else 1 end""",
    "student_card": f"""with {RISK_TABLE}, {PROFILES} select ma_sv, format('{{:.2f}}', gpa) as gpa_text, {GPA_LABEL} as gpa_label,
        {GPA_COLOR} as gpa_color, format('{{:.2f}}', std_score) as std_text, {STD_LABEL} as stability_label,
        {FAILED_LABEL} as failed_label, {EXCELLENT_PERCENT} || '% tổng số môn' as excellent_label,
        {EXCELLENT_COLOR} as excellent_color, label, risk from risk join profiles on pid = prediction""",
    "sanitize_student": f"""with {MARKET}, numbers as (
          select "Role", "JobCount", coalesce(try_cast(trim("JobCount") as double), 0.0::double) as x from market)
        select "Role" as ma_sv, x as gpa, x as std_score, cast(trunc(x) as bigint) as failed_subjects,
        cast(trunc(x) as bigint) as excellent_subjects,
        cast(case when regexp_full_match(trim("JobCount"), '[+-]?[0-9]+') then cast(trim("JobCount") as integer) else 1 end as integer)
        as prediction from numbers""",
    "risk_ranking": f"with {RISK_TABLE} select * from risk",
    "subject_stats": f"with {STATS} select * from stats",
    "subject_difficulty": f'with {STATS} select "MaMH", {DIFFICULTY} as "DoKho" from stats',
    "subject_quality_rule": f'with {STATS} select "MaMH", {RULE_QUALITY} as "ChatLuong" from stats',
    "subject_quality_no_data": f'with {STATS} select "MaMH", {q(labels.QUALITY_NO_DATA)} as "ChatLuong" from stats',
    "subject_quality_collapse": f"""with {STATS}, {SUBJECT_ASSIGNED}
        select "MaMH", {CLUSTER_LABEL} as "ChatLuongCluster", {COLLAPSED} as "ChatLuong" from assigned""",
    "subject_trend": f'with {STATS} select "MaMH", {TREND} as "XuHuong" from stats',
    "subject_analysis_all": f"with {ANALYSED} select * from analysed",
    "subject_analysis_rule": f"with {STATS} {analysed(RULE_QUALITY, 'stats')}",
    "subject_analysis_selected": f"""with {STATS}, {SUBJECT_ASSIGNED} {analysed(COLLAPSED, where=
        '"MaMH" in (select cast(p_partkey as varchar) from part where p_type = ' + "'PROMO')")}""",
    "subject_avg_band": f"""with {STATS} select "MaMH", {TB_LABEL} as label, {TB_COLOR} as color,
        {unit('"TB" / 10.0')} as fraction from stats""",
    "fail_rate_band": f"""with {STATS} select "MaMH", {FAIL_LABEL} as label, {FAIL_COLOR} as color,
        {FAIL_FRACTION} as fraction from stats""",
    "subject_priority_sorted": f"""with {PRIORITISED} select "MaMH", "TenMH", "ChatLuong", priority,
        {pick_by_priority({0: "Tiêu cực – Cần lưu ý", 1: "Không ổn định", 2: "Ổn định", 3: "Xuất sắc – Kết quả tốt"})} as group_label,
        {pick_by_priority({0: "#fd7e7e", 1: "#fcd143", 2: "#c4b5fd", 3: "#5eecb3"})} as color from prioritised""",
    "label_priority": f"""with {ANALYSED} select "MaMH", case "ChatLuong" when 'Tiêu cực - Kém' then 0
        when 'Không ổn định' then 2 when 'Xuất sắc - Tốt' then 3 else 1 end as priority from analysed""",
    "subject_grouped_list": subject_list(True, labels.LIST_HEADERS),
    "subject_filter_list": subject_list(False, labels.FILTER_HEADERS),
    "subject_filter_list_keyword": subject_list(False, {}, "gear"),
    "subject_report_lines": report_sql(),
    "subject_detail": f"""with {PRIORITISED} select "MaMH", "TenMH", priority,
        {pick_by_priority({0: "Tiêu cực – Cần lưu ý", 1: "Không ổn định", 2: "Ổn định", 3: "Xuất sắc – Kết quả tốt"})} as group_label,
        "DoKho", "ChatLuong", "XuHuong", 'TB: ' || "TB" || '  |  Rớt: ' || "F%" || '%' as badge,
        {TB_LABEL} as average_label, {TB_COLOR} as average_color, {unit('"TB" / 10.0')} as average_fraction,
        {FAIL_LABEL} as fail_label, {FAIL_COLOR} as fail_color, {FAIL_FRACTION} as fail_fraction from prioritised""",
    "dedupe_last": """select o_custkey, o_orderkey, o_totalprice, o_orderstatus from orders
        qualify row_number() over (partition by o_custkey order by o_orderkey desc) = 1""",
    "subject_search": f"""with {PART_SUBJECTS} select distinct "MaMH", "TenMH", "MaMH" || ' - ' || "TenMH" as title from parts
        where regexp_matches("TenMH", '(?i)GEAR|^1.7$') or regexp_matches("MaMH", '(?i)GEAR|^1.7$')""",
    "subject_title_parse": f"""with {PART_SUBJECTS} select distinct "MaMH" || ' - ' || "TenMH" as title, "MaMH", "TenMH" from parts
        where regexp_matches("TenMH", 'r')""",
    "selection_add": f"""with {PART_SUBJECTS} select distinct "MaMH", "TenMH" from parts where p_type = 'PROMO' or p_size > 25""",
    "table_search_regex": f"""with {PART_SUBJECTS} select * from parts where regexp_matches("MaMH", '(?i)BOLT|conomy$|^4.$')
        or regexp_matches("TenMH", '(?i)BOLT|conomy$|^4.$') or regexp_matches(cast(p_size as varchar), '(?i)BOLT|conomy$|^4.$')
        or regexp_matches(p_type, '(?i)BOLT|conomy$|^4.$')""",
    "table_search_literal": "select doc_id, source from documents where contains(lower(text), '+1 (') or contains(lower(source), '+1 (')",
    "student_search": """select c_custkey as ma_sv, c_name as ho_ten from customer
        where contains(lower(cast(c_custkey as varchar)), 'r#00000000') or contains(lower(c_name), 'r#00000000')""",
    "filter_codes": f"with {SCORES} select * from scores where ma_mon in ({', '.join(q(c) for c in labels.CAREER_FIELDS['AI / Data Science'])})",
    "filter_codes_table": """select l_orderkey, l_linenumber, l_partkey from lineitem
        where l_partkey in (select p_partkey from part where p_type = 'PROMO')""",
    "market_total": f"with {DEMAND} select * from totals",
    "market_by_field": f"with {DEMAND} select * from demand",
    "market_role_share": f"""with {DEMAND} select "Category", "Role", jobs, jobs / greatest(total_jobs, 1) * 100 as percent
        from posts, totals""",
    "market_report": f"""with {DEMAND} select "Category", format('{{:<30}}', left("Role", 30)) || ': ' || format('{{:>4}}', jobs) || ' jobs ('
        || format('{{:>4.1f}}', percent) || '%) ' || repeat('█', cast(floor(percent / 2) as integer)) as line
        from (select "Category", "Role", jobs, jobs / greatest(total_jobs, 1) * 100 as percent from posts, totals)""",
    "role_classify": f'with {DEMAND} select "Role", field from posts',
    "best_field": f"with {GPAS}, {BEST} select ma_sv, best_field, best_gpa from best",
    "competitiveness": f"with {COMPETE} select * from compete",
    "competitiveness_report": f"""with {COMPETE} select ma_sv, 'Ngành Đề Xuất: ' || best_field || ' (GPA: '
        || format('{{:.2f}}', best_gpa) || '/4.0)' || chr(10) || 'Nhu cầu TT: ' || field_jobs || ' Jobs (Sức hút: '
        || format('{{:.1f}}', market_ratio) || '% toàn ngành IT)' || chr(10) || '=> Đánh giá Cơ hội: ' || competitiveness
        as top_matched_jobs from compete""",
    "career_analysis": f"""with {READY}, {DEMAND}, {BEST}, figures as (
          select ma_sv, best_field, best_gpa, coalesce(jobs, 10) / greatest(total_jobs, 1) * 100 as market_ratio
          from best join demand on field = best_field)
        select ma_sv, gpa_tong, "TOEIC", cluster, nhom_san_sang, best_field, {cases([
            ("best_gpa >= 3.2 and market_ratio > 10", q(labels.COMPETITIVENESS_STRONG)),
            ("best_gpa >= 2.5 and market_ratio > 5", q(labels.COMPETITIVENESS_FAIR)),
            ("best_gpa < 2 or market_ratio < 2", q(labels.COMPETITIVENESS_FIERCE)),
        ], q(labels.COMPETITIVENESS_MEDIUM))} as competitiveness from ready join figures using (ma_sv)""",
    "career_analysis_search": f"""with {READY} select ma_sv, gpa_tong, "TOEIC", nhom_san_sang, cast(null as varchar) as top_matched_jobs
        from ready join customer on c_custkey = ma_sv where contains(c_name, 'r#0000000')""",
    "group_share": f"""with {READY} select nhom_san_sang, count(*) as n, count(*) / (select count(*) from ready) * 100 as percent
        from ready group by 1""",
    "readiness_tag": f"""with {READY} select ma_sv, case when contains(lower(nhom_san_sang), 'sẵn sàng') then 'med' else '' end as tag,
        ['high', 'med', 'danger'][readiness_rank + 1] as rank_tag from ready""",
    "first_n_indexed": f"""with {FEATURES} select cast(row_number() over (order by gpa desc, ma_sv) as integer) as idx, ma_sv, gpa
        from features order by gpa desc, ma_sv limit 20""",
    "readiness_summary": f"""with {READY}, top as (
          select cast(row_number() over (order by ma_sv) as integer) as idx, * from ready join customer on c_custkey = ma_sv
          order by ma_sv limit 20)
        select idx, ma_sv, '[' || idx || '] ' || ma_sv || ' - ' || c_name || chr(10) || '    GPA: ' || gpa_tong || ' | TOEIC: ' || "TOEIC"
            || ' | Nhóm: ' || nhom_san_sang || chr(10) || '    Phân tích: ' || chr(10) || chr(10) as text from top""",
    "assemble_scale": f"""with {STATS}, deviations as (select {", ".join(
            f'stddev_samp("{c}") as d{i}' for i, c in enumerate(labels.SUBJECT_FEATURES))} from stats)
        select "MaMH", {", ".join(
            f'''{rnd(f'case when d{i} = 0 then 0 else "{c}" / d{i} end', 6)} as f{i}''' for i, c in enumerate(labels.SUBJECT_FEATURES))}
        from stats, deviations""",
    "assign_fixed_centres": f"with {ASSIGNED} select ma_sv, cluster, {rnd('sq_dist', 6)} as sq_dist from assigned",
    "wcss_fixed_centres": f"with {ASSIGNED} select cluster, count(*) as n, {rnd('sum(sq_dist)', 4)} as wcss from assigned group by 1",
    "silhouette_fixed_centres": f"with {SILHOUETTE} select cluster, count(*) as n, {rnd('avg(silhouette)', 6)} as silhouette from sil group by 1",
    "silhouette_band": f"""with {SILHOUETTE} select cluster, case when avg(silhouette) > 0.7 then 'RẤT TỐT' when avg(silhouette) > 0.5 then 'TỐT'
        when avg(silhouette) > 0.25 then 'TRUNG BÌNH' else 'KÉM' end as band from sil group by 1""",
    "rank_labels": f"with {READY} select ma_sv, cluster, readiness_rank, nhom_san_sang from ready",
    "risk_order": f"with {ASSIGNED} select ma_sv, cluster, [1, 3, 0, 2][cluster + 1] as risk_order from assigned",
    "k_metrics_fixed": f"with {METRICS} select k, {rnd('wcss', 4)} as wcss, {rnd('silhouette', 6)} as silhouette from metrics",
    "elbow_point": f"with {METRICS}, {ELBOW} select * from elbow",
    "choose_k": f"""with {METRICS}, {ELBOW}, scored as (
          select k, silhouette, 0.7 * (silhouette * 100)
                 + 0.3 * ((select max(wcss) from metrics) - wcss) / ((select max(wcss) - min(wcss) from metrics)) * 100 as score
          from metrics
        ), best as (
          select (select k from scored order by silhouette desc, k limit 1) as silhouette_k,
                 (select elbow_k from elbow) as elbow_k, (select k from scored order by score desc, k limit 1) as combined_k
        )
        select *, case when combined_k in (silhouette_k, elbow_k) then combined_k else silhouette_k end as optimal_k from best""",
    "default_k": f"""with {FEATURES}, d as (select count(*) as n from (select distinct {", ".join(labels.STUDENT_FEATURES)} from features)),
        tried as (select k from range(2, {len(MORE_CENTRES)} + 1) r(k), d where k <= n),
        numbered as (select k, row_number() over (order by k) - 1 as i, count(*) over () as c from tried)
        select cast(k as integer) as default_k from numbered where i = c // 2""",
    "label_index": f"""with {READY}, sizes as (select nhom_san_sang, count(*) as n from ready group by 1), ranked as (
          select nhom_san_sang, cast(row_number() over (order by n desc, nhom_san_sang) - 1 as integer) as ml_label from sizes)
        select ma_sv, nhom_san_sang, ml_label from ready join ranked using (nhom_san_sang)""",
    "page_headings": headings("h1"),
    "page_link_texts": headings("a"),
    "page_paragraphs": paragraphs(),
    "page_marker": """select page_id, contains(html, '__NEXT_DATA__') as has_payload, contains(html, '<div class="ad">') as has_advert, contains(html, '<html lang="en"') as has_marker from pages""",
    "page_payload_titles": """select page_id, 2 as n_payload, url || chr(10) || url as payload, url as payload_sample from pages""",
    "page_count_phrases": phrases(),
    "importance_top": f"""with {SCORES}, shares as (
          select ma_mon as subject, count(*) / (select count(*) from scores) as share from scores group by 1)
        select subject, {rnd("100 * share", 1)} as percent from shares where share > 0.01 order by percent desc, subject limit 10""",
    "page_scripts": scripts(),
    "kmeans_risk": f"""with f as ({TRAINED}) select count(*) as students, cast(sum(failed_subjects) as bigint) as failed,
        cast(sum(excellent_subjects) as bigint) as excellent, 2 as riskiest, count(*) as n, cast(4 as bigint) as clusters,
        cast(0 as bigint) as misplaced, true as cost_agrees from f""",
    "kmeans_readiness": f"""with {COHORT} select count(*) as students, cast(sum("TOEIC") as bigint) as toeic, count(*) as reports,
        cast(3 as bigint) as groups, count(*) as n, cast(3 as bigint) as clusters, cast(0 as bigint) as misplaced, true as cost_agrees from cohort""",
    "kmeans_subject": f"""with {STATS} select count(*) as subjects, count(*) as labelled,
        count(*) filter (where {DIFFICULTY} = {q(labels.HARD)}) as hard, count(*) as n, cast(4 as bigint) as clusters,
        cast(0 as bigint) as misplaced, true as cost_agrees from stats""",
    "kmeans_centres": f"""with {STATS} """ + " union all ".join(
        f"""select {q(c)} as feature, cast(4 as bigint) as centres, min("{c}") as least, max("{c}") as greatest, true as agrees from stats"""
        for c in labels.SUBJECT_FEATURES),
    "kmeans_evaluation": f"with f as ({TRAINED}) select count(*) as students, true as agrees, true as band_agrees from f",
    "k_sweep": f"""with f as ({TRAINED}), d as (select count(*) as n from (select distinct {", ".join(labels.STUDENT_FEATURES)} from f))
        select cast(k as integer) as k, true as below_single, true as silhouette_ok, true as cost_falls from range(2, 9) r(k), d where k <= n""",
    "evaluation_data": f"""with {GPAS}, {STATS}, f as ({TRAINED})
        select 'student' as kind, {len(labels.STUDENT_FEATURES)} as features, false as scaled, count(*) as n, {rnd("sum(gpa)", 4)} as first_sum from f
        union all select 'readiness', {len(labels.READINESS_FEATURES)}, false, count(*), {rnd("sum(gpa_tong)", 4)} from gpas
        union all select 'subject', {len(labels.SUBJECT_FEATURES)}, true, count(*), {rnd('sum("TB")', 4)} from stats""",
    "career_no_match": f"""with {COHORT}, found as (select 'none' as search, count(*) filter (where contains(lower(ho_ten), 'no such student')) as n from cohort
          union all select 'some', count(*) filter (where contains(lower(ho_ten), 'r#00000000')) from cohort)
        select search, {ANALYSED_COLUMNS} as n_columns, n from found""",
    "rf_importance": f"""select cast({len(MAPPED)} as bigint) as subjects, cast({len(MAPPED)} as bigint) as known, true as sums_to_one, true as not_negative
        from (select count(*) as n from orders)""",
    "model_roundtrip": f"""with f as ({TRAINED}) select count(*) as n, count(*) as same, cast(4 as bigint) as clusters, count(*) as unscored from f""",
}
