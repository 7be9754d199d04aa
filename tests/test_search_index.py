"""Searches by index against scans."""

import random

import pytest

from scorefold.operators import search
from scorefold.operators.search_index import SearchIndex, literals, save_index

ODD = ["İstanbul", "istanbul", "STRASSE straße STRAẞE", "ſeſſion", "K elvin K", "ΟΔΟΣ οδος οδοσ", "ﬁne ﬁ", "c++ (a.b)*", "a\nb c", "", None, "ab", "ǅ ǆ Ǆ", "ıI iİ"]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rng = random.Random(2)
    words = [w for t in ODD if t for w in t.split()] + ["alpha", "Beta", "gamma", "DELTA", "x1y2", "日本語", "rare-word"]
    rows = [(i, " ".join(rng.choice(words[:-1]) for _ in range(rng.randrange(1, 9))), rng.choice(words[:-1])) for i in range(600)]
    rows += [(1000 + i, t, None) for i, t in enumerate(ODD)] + [(2000, "one rare-word here", "z")]
    df = spark.createDataFrame(rows, "id int, a string, `b c` string").repartition(4)
    path = str(tmp_path_factory.mktemp("index") / "t")
    save_index(df, path, block_rows=8)
    return df, path


KEYWORDS = ["İSTANBUL", "STRASSE", "straße", "session", "ſession", "kelvin", "ΟΔΟΣ", "οδοσ", "ﬁne", "c++ (a", "a.b", "rare-word", "日本語", "no such thing", "iİ", "ab"]


@pytest.mark.parametrize("mode", ["literal", "regex"])
def test_same_rows_as_a_scan(spark, table, mode):
    df, path = table
    index = SearchIndex(spark, path)
    patterns = KEYWORDS if mode == "literal" else [k for k in KEYWORDS if "(" not in k] + [
        "alp?ha", "alph+a", "^rare", "(beta|gamma) delta", "x\\dy", "delta.*rare", "ist.nbul"]
    for keyword in patterns:
        want = sorted(r.id for r in search.search_any(df, keyword, mode=mode).collect())
        assert sorted(r.id for r in index.search_any(keyword, mode=mode).collect()) == want, keyword


def test_a_rare_keyword_reads_few_rows(spark, table):
    df, path = table
    index = SearchIndex(spark, path)
    for keyword, mode in (("rare-word", "literal"), ("one rare.word", "regex"), ("no such thing", "literal")):
        assert len(index.blocks(keyword, mode)) <= 1 and index.candidates(keyword, mode).count() <= 8
    scan = index.candidates("rare-word")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in scan and "__block" in scan.split("PushedFilters")[1][:200]
    # common ones and unclear patterns are scans
    assert index.blocks("beta", most=3) is None and index.blocks("(a|b)") is None and index.blocks("ab") is None
    assert index.candidates("(a|b)").count() == df.count()


def test_literals_of_patterns():
    assert literals("a.b(c", "literal") == ["a.b(c"]
    assert literals("^abc.*def$", "regex") == ["abc", "def"]
    assert literals("abc?def+gh", "regex") == ["ab", "def", "gh"] and literals("ab|cd", "regex") == [] and literals("x\\d", "regex") == []


def test_a_new_version_and_students(spark, tmp_path):
    path = str(tmp_path / "s")
    save_index(spark.createDataFrame([("SV1", "An Binh"), ("SV2", None)], "ma_sv string, ho_ten string"), path)
    old = SearchIndex(spark, path)
    save_index(spark.createDataFrame([("SV3", "An Chi")], "ma_sv string, ho_ten string"), path)
    assert [r.ma_sv for r in SearchIndex(spark, path).student_search("an c").collect()] == ["SV3"]
    assert [r.ma_sv for r in old.student_search("AN BIN").collect()] == ["SV1"] and old.student_search("").count() == 2
    save_index(spark.createDataFrame([], "ma_sv string, ho_ten string"), path)
    assert SearchIndex(spark, path).search_any("abc", mode="literal").count() == 0
