"""Spelling variants: words within one edit of each other, found by pivotal grams.

Words are counted over the whole texts first.  All bigrams that occur are ranked, rare
ones first.  A word's prefix is its three rarest bigrams (and what has the third one's
rank); of the prefix, dynamic programming picks the two bigrams, disjoint in place, that
cost least: its pivots.  One edit touches at most one of two disjoint pivots, and if the
pivots are those of the word whose prefix ends at the lower rank, the untouched one is
in the other word's prefix.  So every pair of near words meets where one word's pivot is
in the other's prefix.

The place limits are as tight as one edit allows: left of an edit all characters keep
their distance from the start, right of it from the end.  An edit behind the left pivot
leaves the word's beginning as far as the pivot, any other edit leaves its end from the
right pivot on; halving what is left of the word once gives four cases, in each of which
pivot, shared characters and length are one key.  What meets is verified by edit
distance within the join, so pairs that merely share a key are never rows.

Defined results: a null text has no words; a null id counts as empty text in the slip
rule; repeated rows count as often as they stand; of equally frequent near words the
first in code-point order is the form; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorefold.llm.common import batches, texts, written

#: A-Z and a-z and U+00C0 to U+00FF, in UTF-8, after A-Z are lowered.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
#: A run slips if this divides the checksum of id and run.
SLIP = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A form is so many times as frequent as its variant.
RATIO = 5
#: Distinct words that a task gathers.
GATHERED = 200_000
PREFIX = 3


def slipped(run: bytes, id_checksum: int, slip: int = SLIP) -> bytes:
    """A lower-cased run, without one character if its checksum says so."""
    h = zlib.crc32(run, id_checksum)
    if h % slip:
        return run
    word = run.decode()
    at = h % len(word)
    return (word[:at] + word[at + 1 :]).encode()


def _counted(least_length: int, gathered: int):
    names = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def rows_of(found: Counter) -> Iterator[pa.RecordBatch]:
        kept = {w: n for b, n in found.items() if len(w := b.decode()) >= least_length}
        return batches({"word": list(kept), "n": list(kept.values())}, names)

    def counted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in rows:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), strict=True):
                own = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in Counter(m.group() for m in _RUN.finditer(text.encode(errors="surrogatepass").lower())).items():
                    found[slipped(run, own)] += n
                if len(found) > gathered:
                    yield from rows_of(found)
                    found.clear()
        yield from rows_of(found)

    return counted


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of the words that are long and frequent enough."""
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").alias("text"))
    parts = rows.mapInArrow(_counted(least_length, GATHERED), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def prefix_and_pivots(word: str, rank: dict[str, int]) -> tuple[list[tuple[int, int]], tuple[int, int]]:
    """The (rank, place) of a word's prefix, and the places of its pivots, the left one first."""
    grams = sorted((rank[word[i : i + 2]], i) for i in range(len(word) - 1))
    last = grams[min(PREFIX, len(grams)) - 1][0]
    prefix = [g for g in grams if g[0] <= last]
    # cheapest choice of one bigram up to each place, then of a second one that does not touch it
    best: tuple[int, int, int] | None = None
    left: tuple[int, int] | None = None
    by_place = sorted((place, cost) for cost, place in prefix)
    behind = 0
    for place, cost in by_place:
        while by_place[behind][0] <= place - 2:
            earlier = (by_place[behind][1], by_place[behind][0])
            left = earlier if left is None else min(left, earlier)
            behind += 1
        if left is not None and (best is None or left[0] + cost < best[0]):
            best = (left[0] + cost, left[1], place)
    return prefix, best[1:]


def _keys_behind(word: str, place: int, length: int) -> Iterator[int]:
    """Keys for an edit behind the left pivot, as a word of `length` cuts the rest; place: the pivot's, from the start."""
    cut = place + 2 + (length - place - 2) // 2
    tail = word[len(word) - (length - cut) :]
    yield xxhash.xxh64_intdigest(f"a {length} {place} {word[:cut]}") - (1 << 63)
    yield xxhash.xxh64_intdigest(f"b {length} {place} {word[: place + 2]} {tail}") - (1 << 63)


def _keys_before(word: str, from_end: int, length: int) -> Iterator[int]:
    """Keys for an edit that leaves the right pivot; from_end: the pivot's place from the end."""
    cut = (length - from_end) // 2
    yield xxhash.xxh64_intdigest(f"c {length} {from_end} {word[:cut]} {word[len(word) - from_end :]}") - (1 << 63)
    yield xxhash.xxh64_intdigest(f"d {length} {from_end} {word[len(word) - (length - cut) :]}") - (1 << 63)


def pivot_keys(word: str, rank: dict[str, int]) -> tuple[int, list[int]]:
    """The rank at which the word's prefix ends, and the keys by which it looks for others."""
    prefix, (left, right) = prefix_and_pivots(word, rank)
    n = len(word)
    return prefix[-1][0], [*_keys_behind(word, left, n), *_keys_before(word, n - right, n)]


def prefix_keys(word: str, rank: dict[str, int]) -> tuple[int, set[int]]:
    """The rank at which the word's prefix ends, and the keys by which it is found, for words up to one character shorter or longer."""
    prefix, n = prefix_and_pivots(word, rank)[0], len(word)
    keys: set[int] = set()
    for _, place in prefix:
        for length in (n - 1, n, n + 1):
            if place + 4 <= length:  # room for a right pivot
                keys.update(_keys_behind(word, place, length))
            if length - (n - place) >= 2:  # room for a left pivot
                keys.update(_keys_before(word, n - place, length))
    return prefix[-1][0], keys


def _keyed(rank: dict[str, int], keys_of, names: pa.Schema):
    def keyed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                last, keys = keys_of(word, rank)
                out[0].extend(keys)
                out[1].extend([word] * len(keys))
                out[2].extend([n] * len(keys))
                out[3].extend([last] * len(keys))
            yield from batches(dict(zip(names.names, out, strict=True)), names)

    return keyed


def near_words(words: DataFrame) -> DataFrame:
    """word, n -> word, other, n, other_n for every ordered pair of words exactly one edit apart; words are distinct."""
    two = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(2)))
    # at most (26 + 64)^2 bigrams
    counts = words.select(F.explode(two).alias("gram")).groupBy("gram").count().collect()
    rank = {r.gram: i for i, r in enumerate(sorted(counts, key=lambda r: (r["count"], r.gram)))}
    sides = []
    for keys_of, (word, n, last) in ((pivot_keys, ("word", "n", "last")), (prefix_keys, ("other", "other_n", "other_last"))):
        names = pa.schema([("key", pa.int64()), (word, pa.string()), (n, pa.int64()), (last, pa.int32())])
        sides.append(words.mapInArrow(_keyed(rank, keys_of, names), f"key long, {word} string, {n} long, {last} int"))
    seeking, found = sides
    meet = (seeking["key"] == found["key"]) & (F.col("last") <= F.col("other_last")) & (F.levenshtein("word", "other", 1) == 1)
    one = seeking.hint("merge").join(found, meet).select("word", "other", "n", "other_n")
    pairs = one.union(one.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("other_n").alias("n"), F.col("n").alias("other_n")))
    return pairs.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, form (never null) -> word, root: the last word on the way from form to form.

    Every round doubles the steps; counts rise fivefold a step, so few are needed.
    """
    state = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        up = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        state = written(state.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if not state.where("moved").limit(1).count():
            return state.select("word", "root")
        state = state.select("word", "root")


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of docs that is long and frequent enough (at least 6 characters)."""
    if least_length < 6:
        raise ValueError("pivots need words of at least 6 characters on both sides of an edit")
    words = written(word_counts(docs, least_length, least_count), "spelling-words")
    order = F.struct((-F.col("other_n")).alias("minus"), F.col("other"))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(order).alias("best"))
    found = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.minus") >= ratio * F.col("n"), F.col("best")).alias("best"),
    ), "spelling-near")
    ends = roots(found.where("best is not null").select("word", F.col("best.other").alias("form")))
    return found.join(ends, "word", "left").select(
        "word", "n", "n_near", F.col("best.other").alias("form"), (-F.col("best.minus")).alias("form_n"), F.coalesce("root", "word").alias("root")
    )
