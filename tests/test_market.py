"""Market sources, demand and competitiveness."""

import pytest

from scorefold import labels
from scorefold.operators import market
from scorefold.operators.scores import gpa_column
from scorefold.session import scratch_path
from scorefold.sources import market as source

FIELDS = list(labels.CAREER_FIELDS)
SCHEMA = "Category string, Role string, JobCount string"


@pytest.fixture
def jobs(spark):
    return spark.createDataFrame(
        [("IT", "Software Engineer", "60"), ("IT", "Data Engineer", " 30 "), ("IT", "Tester", "x"),
         ("IT", "Web", "10"), ("Sales", "Data", "500")], SCHEMA)


def gpas(spark, *rows):
    schema = "ma_sv string, " + ", ".join(f"{gpa_column(f)} double" for f in FIELDS)
    return spark.createDataFrame([(f"s{i}", *r) for i, r in enumerate(rows)], schema)


def test_demand(jobs):
    got = {r["field"]: r["jobs"] for r in market.market_by_field(jobs).collect()}
    assert got == {FIELDS[0]: 30, FIELDS[1]: 10, FIELDS[2]: None, FIELDS[3]: 60, FIELDS[4]: 0}
    assert tuple(market.market_total(jobs).first()) == (100, 5)


def test_empty_market(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert market.market_by_field(empty).count() == 5
    assert tuple(market.market_total(empty).first()) == (0, 0)
    assert market.role_share(empty).count() == 0
    scored = market.competitiveness(gpas(spark, (3.0, 1.0, 1.0, 1.0, 1.0)), empty)
    assert market.competitiveness_report(scored).first()["top_matched_jobs"] == labels.NO_MARKET


def test_no_category_jobs(spark):
    other = spark.createDataFrame([("Sales", "Data", "5")], SCHEMA)
    row = market.competitiveness(gpas(spark, (3.3, 0.0, 0.0, 0.0, 0.0)), other).first()
    # the default of 10 jobs against a total of at least 1
    assert (row["field_jobs"], row["market_ratio"], row["competitiveness"]) == (10, 1000.0, labels.COMPETITIVENESS_STRONG)


def test_best_field(spark):
    got = market.best_field(gpas(spark, (2.0, 3.0, 3.0, 1.0, 0.0), (0.0,) * 5, (None,) * 5, (float("nan"), 1.0, 0.5, 0.0, 0.0), (0.0, 0.0, 0.0, 0.0, 4.0)))
    assert [(r["best_field"], r["best_gpa"]) for r in got.collect()] == [
        (FIELDS[1], 3.0), (labels.DEFAULT_FIELD, 0.0), (labels.DEFAULT_FIELD, 0.0), (FIELDS[1], 1.0), (FIELDS[4], 4.0)]


def test_report_text(spark, jobs):
    scored = market.competitiveness(gpas(spark, (3.25, 0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 2.1, 0.0, 0.0)), jobs)
    texts = [r["top_matched_jobs"] for r in market.competitiveness_report(scored).orderBy("ma_sv").collect()]
    assert texts[0] == (
        "Ngành Đề Xuất: AI / Data Science (GPA: 3.25/4.0)\nNhu cầu TT: 30 Jobs (Sức hút: 30.0% toàn ngành IT)\n"
        f"=> Đánh giá Cơ hội: {labels.COMPETITIVENESS_STRONG}")
    # no role of that field on the market: the default of 10 jobs
    assert "Nhu cầu TT: 10 Jobs (Sức hút: 10.0% toàn" in texts[1]


def test_market_lines(jobs):
    got = [r["line"] for r in market.market_report(jobs).collect()]
    assert got[0] == f"{'Data':<30}:  500 jobs (500.0%) " + "█" * 250
    assert got[1] == f"{'Software Engineer':<30}:   60 jobs (60.0%) " + "█" * 30
    assert got[-1] == f"{'Tester':<30}:    0 jobs ( 0.0%) "


def test_csv_roundtrip_and_bom(spark, jobs, tmp_path):
    path = scratch_path(spark, "jobs")
    source.write_market(jobs, path)
    assert sorted(map(tuple, source.read_market(spark, path).collect())) == sorted(map(tuple, jobs.collect()))
    with_mark = tmp_path / "bom.csv"
    with_mark.write_text("﻿Category,Role,JobCount\nIT,Tester,5\n", encoding="utf-8")
    assert [tuple(r) for r in source.read_market(spark, str(with_mark)).collect()] == [("IT", "Tester", "5")]
    assert source.read_market(spark, str(tmp_path / "absent.csv")).count() == 0


def test_flatten(spark):
    documents = spark.createDataFrame(
        [
            ('{"data": [{"name": "IT", "job_count": 9, "roles": [{"name": "Dev", "job_count": 4}, {"job_count": 2}, {"name": "QA"}]},'
             ' {"name": "Sales", "job_count": 3}]}',),
            ('{"data": [{"name": "IT", "job_count": 7, "roles": []}]}',),
            ('{"data": [{"name": "IT"}, {"job_count": 1}]}',),
            ('{"data": []}',), ("{}",), ("not json",), (None,),
        ], "json string")
    with pytest.raises(Exception, match="not a market document"):
        source.flatten_market(documents).collect()
    got = sorted(tuple(r) for r in source.flatten_market(documents, broken="skip").collect())
    assert got == [("IT", "Dev", 4), ("IT", "IT", 0), ("IT", "IT", 7), ("IT", "QA", 0), ("IT", "Unknown", 2)]
    every = sorted(tuple(r) for r in source.flatten_market(documents, category=None, broken="skip").collect())
    assert ("Unknown", "Unknown", 1) in every and ("Sales", "Sales", 3) in every
