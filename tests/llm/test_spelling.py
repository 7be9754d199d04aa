import random
import re
import zlib
from collections import Counter

import pytest
from cases import make

from scorefold.llm import spelling


def brute_counts(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    words = brute_counts(rows)
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    forms = {w: min(o, key=lambda x: (-words[x], x)) if o else None for w, o in near.items()}
    forms = {w: f if f is not None and words[f] >= 5 * words[w] else None for w, f in forms.items()}

    def root(w):
        return w if forms[w] is None else root(forms[w])

    return sorted((w, n, len(near[w]), forms[w] or "", words.get(forms[w], 0), root(w)) for w, n in words.items())


def result(df):
    return sorted((r.word, r.n, r.n_near, r.form or "", r.form_n or 0, r.root) for r in df.collect())


def variants_of(word, letters, n, rng):
    for _ in range(n):
        i, kind = rng.randrange(len(word) + 1), rng.randrange(3)
        if kind == 0:
            yield word[:i] + rng.choice(letters) + word[i:]
        elif i < len(word):
            yield word[:i] + (rng.choice(letters) if kind == 1 else "") + word[i + 1 :]


@pytest.mark.parametrize("letters", ["ab", "abcdefgé", "etaoinshrdluüñ÷"])
def test_every_pair_is_found(spark, letters):
    """Words over few letters, so that bigrams repeat within words and ranks tie."""
    rng = random.Random(letters)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(6, 12))) for _ in range(60)}
    for w in list(words):
        words.update(x for x in variants_of(w, letters, 6, rng) if len(x) >= 6)
    df = spark.createDataFrame([(w, 5 + i) for i, w in enumerate(sorted(words))], "word string, n long").repartition(3)
    got = {(r.word, r.other) for r in spelling.near_words(df).collect()}
    assert got == {(a, b) for a in words for b in words if one_edit(a, b)} and got


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(4)
    for _ in range(300):
        word = "".join(rng.choice("abcd") for _ in range(rng.randrange(6, 15)))
        rank = {a + b: i for i, (a, b) in enumerate(sorted(((a, b) for a in "abcd" for b in "abcd"), key=lambda _: rng.random()))}
        prefix, (a, b) = spelling.prefix_and_pivots(word, rank)
        at = {p: r for r, p in prefix}
        assert b >= a + 2 and at[a] + at[b] == min(at[x] + at[y] for x in at for y in at if y >= x + 2)
        assert len(prefix) >= 3 and {p for p in range(len(word) - 1) if rank[word[p : p + 2]] <= prefix[-1][0]} == set(at)


def test_whole_texts_by_brute_force(spark):
    rng = random.Random(8)
    base = ["straße", "abcdefgh", "mulțumesc", "naïveté", "Überfluß", "wonderful", "colours"]
    rows = []
    for i in range(80):
        words = []
        for w in base:
            words += [w] * rng.randrange(1, 30)
            words += [x for x in variants_of(w, "abeé", 2, rng)] * rng.randrange(1, 5)
        rng.shuffle(words)
        rows.append((i if i % 9 else None, " ".join(words).replace("abc", "ABC", 3)))
    rows += [(1, None), (2, ""), (3, "12 34 !"), (4, "wonderful" * 4000), (5, " ".join(["chainword"] * 5 + ["chainwordx"] * 25 + ["chainwordxy"] * 125))]
    docs = make(spark, [(i, t, *[None] * 9) for i, t in rows])
    got = result(spelling.variants(docs))
    assert got == brute(rows) and any(g[3] for g in got)
    assert ("chainword", "chainwordxy") in {(g[0], g[5]) for g in got}


def test_odd_rows_and_none(spark):
    docs = make(spark)
    from cases import documents

    assert result(spelling.variants(docs)) == brute([(r[0], r[1]) for r in documents()])
    assert result(spelling.variants(make(spark, []))) == []
    with pytest.raises(ValueError):
        spelling.variants(docs, least_length=4)


def test_a_hot_word_leaves_tasks_as_counts(spark):
    rows = [(i, "popular " * 500) for i in range(300)]
    docs = make(spark, [(i, t, *[None] * 9) for i, t in rows])
    got = {r.word: r.n for r in spelling.word_counts(docs).collect()}
    assert got == brute_counts(rows)
