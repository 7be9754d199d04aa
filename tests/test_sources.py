"""Delimited tables, column names, pages, generated cohorts."""

import pytest
from pyspark.sql import functions as F

from scorefold import labels
from scorefold.functions import casts
from scorefold.operators import cards, generate, pages, schema
from scorefold.sources import market, models, tables, versions


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("line, want", [("a;b;c", ";"), ("a,b,c", ","), ("a;b,c", ","), ("abc", ","), ("", ","), ("a;b;c,d\n1,2,3,4,5", ";")])
def test_detect_delimiter(spark, tmp_path, line, want):
    assert tables.detect_delimiter(spark, write(tmp_path, "t.csv", line)) == want


def test_read_table(spark, tmp_path):
    path = write(tmp_path, "s.csv", "MaMH, Ten MH,F %\n011,Toán,2.5\n12,,\n")
    df = tables.read_table(spark, path)
    assert df.columns == ["MaMH", "TenMH", "F%"]
    assert [tuple(r) for r in tables.read_subject_stats(spark, path).collect()] == [("011", "Toán", 2.5), ("12", None, None)]
    typed = tables.read_table(spark, path, "MaMH string, TenMH string, `F%` double")
    assert typed.first()["MaMH"] == "011"
    scores = tables.read_scores(spark, write(tmp_path, "w.csv", "ma_sv;ho_ten;17\nSV1;An;7.5\n"))
    assert tuple(scores.first()) == ("SV1", "An", 7.5)


def test_counted(spark):
    kept, n = tables.counted(spark.range(10))
    assert n == 10 and not kept.is_cached and kept.count() == 10
    assert tables.counted(spark.range(0))[1] == 0


def test_load_report_in_one_pass(spark):
    rows = [("1.5", "7", None), ("NaN", "7.5", "a"), (None, " 8 ", "b"), ("x", None, None), ("", "9", "c")]
    raw = spark.createDataFrame(rows, "a string, `b c` string, t string")
    table, report = tables.load_typed(raw, {"a": "double", "b c": "bigint"})
    assert sorted(map(tuple, table.collect()), key=str) == sorted([(1.5, 7, None), (None, None, "a"), (None, 8, "b"), (None, None, None), (None, 9, "c")], key=str)
    assert {r.column: tuple(r)[1:] for r in report.collect()} == {"a": (5, 1, 3), "b c": (5, 1, 1), "t": (5, 2, None)}
    none, report = tables.load_typed(raw.limit(0), {"a": "double"})
    assert none.count() == 0 and [tuple(r)[1:] for r in report.collect()] == [(0, 0, 0), (0, 0, None), (0, 0, None)]


def test_columns(spark):
    df = spark.createDataFrame([(1, "2", None)], "a int, `b c` string, bc string")
    with pytest.raises(ValueError):
        schema.normalize_columns(df)
    assert schema.missing_columns(df, ["z", "a", "y"]) == ["z", "y"]
    assert schema.to_double(df, ["b c", "bc", "none"]).first()[1:] == (2.0, 0.0)
    assert schema.columns_except(df, ["a"]) == ["b c", "bc"]
    assert schema.columns_between(spark.createDataFrame([(1, 1, 1)], "_1_4 int, _2 int, x_4 int")) == ["_1_4"]
    got = schema.project(spark.createDataFrame([(1.005, 2.0)], "x double, y double"), ["x", "none"], rounded=["x"])
    assert [tuple(r) for r in got.collect()] == [(1.01,)]


PAGE = (
    '<h3> A <b>x</b></h3><h3 class="j">T &amp; &lt;C&gt; &#233;&#x1F600; &nope; &</h3><h3>\n  </h3><!-- <h3>no</h3> -->'
    '<script>var s = "<h3>no</h3>";</script><script id="__NEXT_DATA__">{"title" : "T1", "title":"T2","title": "T1"}</script>'
    "<H3>up</H3><h30>not</h30> Tìm thấy 12, 34 việc làm, 5 kết quả, 6 VIỆC LÀM"
)


def test_headings(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "none"), (3, None)], "page_id int, html string")
    got = {r["page_id"]: (r["headings"], r["n_headings"]) for r in pages.extract_headings(df).collect()}
    assert got[1] == (["A x", "T & <C> é😀 &nope; &", "up"], 3)
    assert got[2] == ([], 0)


def test_marker_and_payload(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "<script>__NEXT_DATA__</script>")], "page_id int, html string")
    assert [r["has_marker"] for r in pages.has_marker(df).orderBy("page_id").collect()] == [True, False]
    row = pages.payload_values(df).orderBy("page_id").first()
    assert (row["payload"], row["n_payload"], row["payload_sample"]) == (["T1", "T2", "T1"], 3, ["T1", "T2"])


def test_phrases(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "nothing")], "page_id int, html string")
    got = sorted((r["pattern"], r["pos"], r["value"]) for r in pages.count_phrases(df).collect())
    jobs, results, found = labels.COUNT_PATTERNS
    assert got == sorted([(jobs, 0, "34"), (jobs, 1, "6"), (results, 0, "5"), (found, 0, "12")])


def test_cohort_is_a_function_of_its_keys(spark):
    one = generate.generate_cohort(spark, 200, seed=3, toeic=True)
    again = generate.generate_cohort(spark, 200, seed=3, toeic=True).repartition(7)
    assert one.exceptAll(again).count() == 0
    assert one.exceptAll(generate.generate_cohort(spark, 200, seed=4, toeic=True)).count() > 190
    assert one.columns == ["ma_sv", "ho_ten", *labels.SUBJECT_NAMES, "TOEIC"]
    first = one.orderBy("ma_sv").first()
    assert (first["ma_sv"], first["ho_ten"]) == ("SV00000", "SinhVien_0")
    bad = one.filter("TOEIC < 200 or TOEIC > 990 or TOEIC % 5 <> 0")
    assert bad.count() == 0
    plain = generate.generate_cohort(spark, 10)
    assert plain.columns == ["ma_sv", "ho_ten", *labels.COHORT_SUBJECTS]


def test_cohort_distribution(spark):
    long = generate.generate_scores(spark.range(4000), "id")
    got = {r["cohort_group"]: r for r in long.groupBy("cohort_group").agg(
        F.avg("diem").alias("m"), F.stddev("diem").alias("s"), F.count_distinct("id").alias("n"),
        F.min("diem").alias("low"), F.max("diem").alias("high")).collect()}
    for name, share, mean, sd in [("xuat_sac", 0.2, 8.8, 0.4), ("kha", 0.3, 7.5, 0.6), ("trung_binh", 0.3, 6.0, 0.8)]:
        assert got[name]["n"] / 4000 == pytest.approx(share, abs=0.03)
        assert got[name]["m"] == pytest.approx(mean, abs=0.05) and got[name]["s"] == pytest.approx(sd, abs=0.05)
    assert got["nguy_hiem"]["m"] == pytest.approx(0.4 * 3.5 + 0.6 * 5.0, abs=0.05)
    assert min(r["low"] for r in got.values()) >= 0 and max(r["high"] for r in got.values()) <= 10


def test_columns_by_header_name(spark, tmp_path):
    path = tmp_path / "m.csv"
    for end in ("\n", "\r\n"):
        path.write_bytes(end.join(['﻿Role,Category,JobCount', '"C++ ""senior"", lead","IT"," 7 "', '"two\nlines",IT,3', '  out ,"",', ""]).encode())
        got = sorted(map(tuple, market.read_market(spark, str(path)).collect()), key=str)
        assert got == sorted([("IT", 'C++ "senior", lead', " 7 "), ("IT", "two\nlines", "3"), ("", "  out ", None)], key=str)
    scores = tmp_path / "s.csv"
    scores.write_text("ma_sv;b;a\n01;2.5;9\n")
    assert [tuple(r) for r in tables.read_table(spark, str(scores), "a double, ma_sv string, b double, c int").collect()] == [(9.0, "01", 2.5, None)]
    assert tables.read_scores(spark, str(scores)).dtypes == [("ma_sv", "string"), ("b", "double"), ("a", "double")]
    folder = tmp_path / "two"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,2\n")
    (folder / "2.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="header"):
        tables.read_table(spark, str(folder), "a int, b int").collect()


def test_codes_and_spaces_survive(spark, tmp_path):
    rows = [("01101", ' "q" ', 1.0), ("1E3", "", 2.0), ("7", None, None), ("8", "a\\b,c", 3.0)]
    df = spark.createDataFrame(rows, "MaMH string, TenMH string, TB double")
    tables.write_table(df, str(tmp_path / "t"), "csv")
    assert sorted(map(tuple, tables.read_subject_stats(spark, str(tmp_path / "t")).collect()), key=str) == sorted(rows, key=str)


def test_market_counts_and_broken_documents(spark):
    texts = [
        '{"data":[{"name":"IT","job_count":"3","roles":[]}]}', '{"data":[{"name":"IT","roles":[{"name":"a","job_count":3.0},{"name":"b","job_count":"x"}]}]}',
        None, '{"data":[{"name":"IT","job_count":4}]}', '{"data": [',
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, json string")
    got = sorted(map(tuple, market.flatten_market(df, keep=["i"], broken="skip").collect()))
    assert got == [(0, "IT", "IT", 3), (1, "IT", "a", 3), (1, "IT", "b", 0), (3, "IT", "IT", 4)]
    assert [r.i for r in market.broken_documents(df).collect()] == [4]
    with pytest.raises(Exception, match="not a market document"):
        market.flatten_market(df).collect()


def test_references_as_html_defines_them(spark):
    texts = ["&copy 5", "&#150;", "&#x0000041;", "&notit;", "&amp;lt;", "&#0;&#55296;&#99999999;", "&#65", "&nosuch;", "a & b", "&AMPx", "&#x;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    import html

    assert [r[0] for r in df.coalesce(1).select(pages.decode_entities(df["t"])).collect()] == [html.unescape(t) for t in texts]
    page = spark.createDataFrame([("<i id='aXb'><h.3>x</h.3><hx3>y</hx3>",)], "html string")
    assert not pages.has_marker(page, "i", "id", "a.b").first()["has_marker"]
    assert pages.extract_headings(page, "h.3").first()["headings"] == ["x"]


def test_numbers_that_are_none(spark):
    df = spark.createDataFrame([("NaN", "9999999999"), ("1.5", "3"), (None, "x")], "gpa string, prediction string")
    df = df.selectExpr("gpa", "gpa std_score", "gpa failed_subjects", "gpa excellent_subjects", "prediction")
    rows = cards.sanitize_student(df).collect()
    assert [r.gpa for r in rows] == [0.0, 1.5, 0.0] and rows[1].prediction == 3 and rows[0].prediction == rows[2].prediction
    assert [r.gpa for r in schema.clean_features(df.select("gpa"), ["gpa"]).collect()] == [0.0, 1.5, 0.0]


def test_nan_counts_as_missing(spark):
    from scorefold.operators import subjects

    stats = spark.createDataFrame([("1", "NaN", "20"), ("2", None, "20"), ("3", "9", "5")], "MaMH string, TB string, `F%` string")
    got = {r.MaMH: (r.DoKho, r.XuHuong) for r in subjects.label_difficulty_and_trend(stats).collect()}
    assert got["1"] == got["2"] != got["3"]
    assert [r.x for r in spark.createDataFrame([("NaN",), ("2",)], "x string").select(casts.safe_double("x", None).alias("x")).collect()] == [None, 2.0]


def test_a_path_may_be_replaced_by_what_was_read_from_it(spark, tmp_path):
    """Plain files and folders, and versioned paths."""
    plain = write(tmp_path, "jobs.csv", "Category,Role,JobCount\nIT,a,1\nIT,b,2\nArt,c,3\n")
    folder = str(tmp_path / "folder")
    for path in (plain, folder):
        if path == folder:
            spark.createDataFrame([("IT", "a", "1"), ("IT", "b", "2"), ("Art", "c", "3")], market.MARKET_SCHEMA).coalesce(1).write.csv(path, header=True)
        before = market.read_market(spark, path)
        market.write_market(before.filter("Category = 'IT'"), path)
        assert sorted(r.Role for r in market.read_market(spark, path).collect()) == ["a", "b"]
        read = market.read_market(spark, path)
        market.write_market(read.filter("Role = 'a'"), path)
        # who began to read before still reads the whole old version
        assert read.count() == 2 and [r.Role for r in market.read_market(spark, path).collect()] == ["a"]
        kept = versions.versions(spark, path)
        assert len(kept) == 3 and versions.vacuum(spark, path, keep=1) == kept[:2]
        assert [r.Role for r in market.read_market(spark, path).collect()] == ["a"]
        assert not [p for p in tmp_path.iterdir() if "before" in p.name or ".v-" in p.name]


def test_a_failed_write_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("IT", "a", "1")], market.MARKET_SCHEMA)
    market.write_market(rows, path)
    for place in (path, write(tmp_path, "p.csv", "Category,Role,JobCount\nIT,a,1\n")):
        bad = market.read_market(spark, place).withColumn("Role", F.raise_error(F.lit("broken on purpose")).cast("string"))
        with pytest.raises(Exception, match="broken on purpose"):
            market.write_market(bad, place)
        assert [tuple(r) for r in market.read_market(spark, place).collect()] == [("IT", "a", "1")]
    assert len(versions.versions(spark, path)) == 1


def test_two_writers_do_not_mix(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "t")
    market.write_market(spark.createDataFrame([("IT", "first", "1")], market.MARKET_SCHEMA), path)
    tables_of = [spark.range(200).selectExpr("'IT' Category", f"'w{w}' Role", "cast(id as string) JobCount").repartition(4) for w in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda t: market.write_market(t, path), tables_of))
    rows = market.read_market(spark, path)
    assert rows.count() == 200 and rows.select("Role").distinct().count() == 1 and len(versions.versions(spark, path)) == 5


def test_models_are_replaced_and_only_absence_counts(spark, tmp_path):
    from scorefold.operators import clustering

    df = spark.createDataFrame([(0.0,), (0.1,), (5.0,), (5.1,)], "x double")
    fitted = [clustering.fit_clusters(df, ["x"], k, 1) for k in (2, 3)]
    path = str(tmp_path / "m")
    for model in fitted:
        models.save_model(model, path)
        assert len(clustering.model_centres(models.load_or(path))) == len(clustering.model_centres(model))
    assert models.load_or(None, "passthrough") is None and models.load_or(str(tmp_path / "none"), "fit", lambda: 7) == 7
    df.write.parquet(str(tmp_path / "data"))
    fitted[0].stages[-1].write().save(str(tmp_path / "other"))
    for place in ("data", "other"):
        assert models.load_or(str(tmp_path / place), "passthrough") is None
        with pytest.raises(RuntimeError):
            models.load_or(str(tmp_path / place))
    # a damaged model is an error, not a missing one
    from pathlib import Path

    for part in (Path(versions.current(spark, path)) / "stages").glob("*/metadata/part-*"):
        part.write_text("{}")
    with pytest.raises(Exception):
        models.load_or(path, "passthrough")


def test_folder_of_files_that_differ(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "1.csv").write_text('a;b;c d\n1;"x\n;y";2.5\n', encoding="utf-8")
    (folder / "2.csv").write_bytes("\ufeffb,a\r\n\"q, \"\"r\"\"\",7\r\n,8\r\n".encode())
    (folder / "3.csv").write_text("e\nonly\n")
    (folder / "4.csv").write_text("")
    (folder / "5.csv").write_text("a;b;c d\n3;z;4\n")
    found = tables.read_folder(spark, str(folder), "a int, b string, cd double", multiline=True)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(1, "x\n;y", 2.5), (7, 'q, "r"', None), (8, None, None), (None, None, None), (3, "z", 4.0)], key=str)
    texts = tables.read_folder(spark, str(folder), multiline=True)
    assert texts.columns == ["a", "b", "cd", "e"] and texts.where("e = 'only'").count() == 1
    (tmp_path / "none").mkdir()
    assert tables.read_folder(spark, str(tmp_path / "none"), "a int").collect() == []


def test_folder_computes_its_table_once(spark, monkeypatch):
    """csv_folder writes three tables of files, and derives the statistics behind them once."""
    from scorefold.plans import inputs, registry

    seen = spark.sparkContext.accumulator(0)

    def counted(x):
        seen.add(1)
        return x

    one = F.udf(counted, "string")
    table = spark.createDataFrame([(str(i), f"n{i}", i / 2, 0.5, 1.0) for i in range(9)], "MaMH string, TenMH string, TB double, SD double, `F%` double")
    monkeypatch.setattr(inputs, "stats", lambda spark, d: table.withColumn("TenMH", one("TenMH")))
    got = sorted(map(tuple, registry.csv_folder(spark, "none").collect()))
    assert len(got) == 9 and got[0] == ("0", "n0|, one; two", 0.0, 0.5, 1.0) and got[1] == ("1", None, 0.5, None, 1.0) and seen.value == 9
