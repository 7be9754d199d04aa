from collections import Counter

import pytest
from cases import LONG, documents, make, remainder

from scorefold.llm import langid


def grams(text):
    found = Counter()
    for run in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split(" "):
        if run:
            w = f" {run} "
            found.update(w[i : i + n] for n in (1, 2, 3) for i in range(len(w) - n + 1) if w[i : i + n] != " ")
    return found


def order(found, n=langid.GRAMS):
    return [g for g, _ in sorted(found.items(), key=lambda x: (-x[1], x[0]))[:n]]


def brute(rows, n=langid.GRAMS):
    totals = {}
    for doc_id, text, lang in rows:
        if text is not None and lang is not None and (doc_id is None or remainder(doc_id, 3) != 1):
            totals.setdefault(lang, Counter()).update(grams(text))
    profiles = {lang: {g: i for i, g in enumerate(order(c, n))} for lang, c in totals.items() if c}
    out = []
    for doc_id, text, _ in rows:
        own = order(grams(text), n)
        held = doc_id is not None and remainder(doc_id, 3) == 1
        if own and profiles:
            d, lang = min((sum(abs(p[g] - i) if g in p else n for i, g in enumerate(own)), lang) for lang, p in profiles.items())
            out.append((doc_id, held, lang, 1 - d / (len(own) * n)))
        else:
            out.append((doc_id, held, "und", 0.0))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, r[1:])


ROWS = [
    (1, "The cat and the dog, and then the other one.", "en"), (2, "Der Hund und die Katze und der Vogel.", "de"), (3, "the thing that they thought", "en"),
    (4, None, "en"), (5, "", "de"), (6, "1234 !? \t", "en"), (7, LONG, None), (8, "Ünïcode Straße İstanbul ﬁn ǅ", "de"), (9, "und der", None),
    (10, "中文 文字 和 语言", "zh"), (11, "语言", None), (12, "the", "en"), (12, "the", "en"), (None, "the cat", "en"), (None, None, None),
]


def run(spark, rows, **more):
    schema = "doc_id long, text string, lang string, source string, held_out int, lang_pred int, score string, gram long, n int, rank int, share double"
    df = spark.createDataFrame([(i, t, l, "s", 3, 4, "x", 5, 6, 7, 0.5) for i, t, l in rows], schema).repartition(3)
    return sorted((tuple(r) for r in langid.document_language(df, **more).collect()), key=key)


def test_by_hand(spark):
    assert run(spark, ROWS) == sorted(brute(ROWS), key=key)


def test_small_profiles_and_groups_of_languages(spark, monkeypatch):
    """Few n-grams, so ranks tie and are cut; languages looked at two at a time."""
    rows = [
        (i, " ".join(chr(97 + i % 7) + c + chr(97 + (i * k) % 11) for k, c in enumerate("abcabdxy")), f"l{i % 7}") for i in range(60)
    ]
    assert run(spark, rows, grams=12) == sorted(brute(rows, 12), key=key)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = langid.learn_profiles(docs.where("crc32(cast(doc_id as string)) % 3 <> 1"), 12)
    by_two = langid.with_language(docs, profiles, 12, languages=2)
    assert sorted((r.doc_id, r.lang_pred, r.score) for r in by_two.collect()) == [(i, lang, s) for i, _, lang, s in sorted(brute(rows, 12), key=key)]


@pytest.mark.parametrize("stretch", [1, 2, 3, 7, 1000])
def test_stretches_of_long_texts(stretch):
    for text in ("a", "ab", " ab  cd, e", "the cat's hat -- 42 über", "x" * 50, "", "..", "a b c d e f"):
        codes, n = langid.gram_counts(text, stretch)
        got = {"".join(chr(p) for p in (c >> 42, (c >> 21) & 0x1FFFFF, c & 0x1FFFFF) if p): k for c, k in zip(codes.tolist(), n.tolist())}
        assert got == dict(grams(text)), text


def test_tasks_of_bounded_memory(spark, monkeypatch):
    monkeypatch.setattr(langid, "GATHERED", 50)
    assert run(spark, ROWS) == sorted(brute(ROWS), key=key)


def test_nothing_to_learn_and_odd_rows(spark):
    assert run(spark, []) == []
    rows = [(1, "abc", None), (2, None, "en")]
    assert run(spark, rows) == [(1, remainder(1, 3) == 1, "und", 0.0), (2, remainder(2, 3) == 1, "und", 0.0)]
    docs = make(spark)
    got = sorted((tuple(r) for r in langid.document_language(docs).collect()), key=key)
    assert got == sorted(brute([(r[0], r[1], r[2]) for r in documents()]), key=key)


def test_held_out_languages_are_recognised(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = langid.document_language(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.selectExpr("avg(cast(lang = lang_pred as int))").first()[0] > 0.97
