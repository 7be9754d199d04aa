"""Passages that documents share, by suffixes that are grouped by hashes.

Of a document's suffixes only those are kept that start at minimisers: in every
window of min_words words, the run of `seed` words with the smallest hash, the
leftmost of equals.  The choice depends on the window's words only, so a passage of
min_words words that two documents share has the same suffix kept in both.  The
kept suffixes are grouped by their first words' hash and, within it, by the hash
of their whole surroundings (as far as a window around the seed can reach).  This
replaces sorting suffixes, comparing neighbours and extending matches: Spark
pre-aggregates and splits the groups, and nothing is compared pair by pair:

* surroundings that two documents share are a match to their full width;
* a seed that two documents share in different surroundings: each of the windows
  around it that has this minimiser is looked up, by its hash, among those of the
  other documents.

Matches of a document that overlap or touch become one passage.  A word belongs to
a passage exactly if some min_words consecutive words around it occur in another
document too.  Words are compared by 64-bit hashes of their bytes, A-Z lowered.

Defined results: a null text is an empty one; documents of fewer than min_words
words have no passages; documents are told apart by id, so repeated rows of one id
do not share passages, and rows without an id are left out; an empty table gives
an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorefold.llm.common import small, texts, word_bytes, written

MIN_WORDS = 50
SEED = 20
#: Rows with open seeds (24 bytes each) are broadcast up to this many, else joined by shuffle.
BROADCAST_ROWS = 200_000
#: Windows looked at together, which bounds memory for very long texts.
STRIDE = 1 << 16

_BYTE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Rolling:
    """Hashes of any stretches of a sequence of 64-bit values, from sums of values times powers of an odd base."""

    def __init__(self, values: np.ndarray, base: int):
        n = len(values)
        powers = np.full(n + 1, base, "u8")
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        self.sums = np.zeros(n + 1, "u8")
        np.add.accumulate(values * powers[:-1], out=self.sums[1:])
        back = np.full(n + 1, pow(base, -1, 1 << 64), "u8")
        back[0] = 1
        self.back = np.multiply.accumulate(back)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.back[start] + _mixed((end - start).astype("u8")))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    out = []
    for at in range(0, len(words), STRIDE):
        some = words[at : at + STRIDE]
        ends = np.cumsum([len(w) for w in some])
        data = np.frombuffer(b"".join(some), "u1").astype("u8") + np.uint64(1)
        out.append(_Rolling(_mixed(data), _BYTE).of(ends - [len(w) for w in some], ends))
    return np.concatenate(out) if out else np.zeros(0, "u8")


def minimisers(seeds: np.ndarray, windows: int, width: int) -> np.ndarray:
    """For each of so many windows of `width` seeds, the place of the smallest, the leftmost of equals."""
    out = np.empty(windows, "i8")
    for at in range(0, windows, STRIDE):
        to = min(windows, at + STRIDE)
        view = np.lib.stride_tricks.sliding_window_view(seeds[at : to + width - 1], width)
        out[at:to] = view.argmin(axis=1) + np.arange(at, to)
    return out


class _Suffixes:
    """The kept suffixes of one text."""

    def __init__(self, text: str, min_words: int, seed: int):
        words = word_hashes(word_bytes(text))
        self.n, self.min_words, self.seed = len(words), min_words, seed
        windows = self.n - min_words + 1
        if windows < 1:
            self.chosen = self.at = np.zeros(0, "i8")
            return
        self.rolling = _Rolling(words, _WORD_BASE)
        starts = np.arange(self.n - seed + 1)
        seeds = self.rolling.of(starts, starts + seed)
        self.chosen = minimisers(seeds, windows, min_words - seed + 1)
        self.at = np.unique(self.chosen)
        self.seeds = seeds[self.at]

    def surroundings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and hash of what a window around each kept seed can reach; the hash knows where the seed is."""
        start = np.maximum(0, self.at - (self.min_words - self.seed))
        end = np.minimum(self.n, self.at + self.min_words)
        return start, end, _mixed(self.rolling.of(start, end) + (self.at - start).astype("u8"))

    def windows_of(self, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows whose minimiser is one of the seeds at these places."""
        starts = np.flatnonzero(np.isin(self.chosen, seeds))
        return starts, self.rolling.of(starts, starts + self.min_words)


def _kept(min_words: int, seed: int):
    names = ["doc_id", "at", "start", "end", "seed", "around"]

    def keep(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out: list[list[np.ndarray]] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("__text")), strict=True):
                s = _Suffixes(text, min_words, seed)
                if len(s.at):
                    start, end, around = s.surroundings()
                    out.append([np.full(len(s.at), doc_id, "i8"), s.at, start, end, s.seeds.view("i8"), around.view("i8")])
            if out:
                columns = [np.concatenate(c) for c in zip(*out, strict=True)]
                for at in range(0, len(columns[0]), 100_000):
                    some = [c[at : at + 100_000] for c in columns]
                    yield pa.record_batch([pa.array(c) if i in (0, 4, 5) else pa.array(c.astype("i4")) for i, c in enumerate(some)], names=names)

    return keep


def _windows(min_words: int, seed: int):
    def windows(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for doc_id, text, places in zip(batch.column("doc_id").to_pylist(), texts(batch.column("__text")), batch.column("places"), strict=True):
                starts, hashes = _Suffixes(text, min_words, seed).windows_of(places.values.to_numpy(zero_copy_only=False))
                for at in range(0, len(starts), 100_000):
                    some, h = starts[at : at + 100_000], hashes[at : at + 100_000]
                    yield pa.record_batch([pa.array(np.full(len(some), doc_id, "i8")), pa.array(some.astype("i4")), pa.array(h.view("i8"))], names=["doc_id", "start", "window"])

    return windows


def shared_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, first_word, words, other_doc_id: the passages that other documents have too, disjoint in each document.

    other_doc_id is the smallest id among the other documents that its matches were found with;
    a document that has only part of a wider match may go unnamed.
    """
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("__text")).where("doc_id is not null")
    kept = written(own.mapInArrow(_kept(min_words, seed), "doc_id long, at int, start int, end int, seed long, around long"), "repeats-suffixes")
    # runs of equal surroundings: their smallest and largest document, then the same for their seed
    least, most = F.min("doc_id"), F.max("doc_id")
    runs = kept.groupBy("seed", "around").agg(least.alias("least"), most.alias("most"))
    seeds = runs.groupBy("seed").agg(F.min("least").alias("s_least"), F.max("most").alias("s_most"),
                                     F.max(F.col("least") == F.col("most")).alias("any_open")).where("s_least <> s_most")
    shared = written(runs.join(seeds.select("seed", "any_open"), "seed"), "repeats-runs")
    rows = shared.count()
    found = kept.join(small(shared, rows, BROADCAST_ROWS), ["seed", "around"])
    other = lambda a, b: F.when(F.col(a) == F.col("doc_id"), F.col(b)).otherwise(F.col(a)).alias("other")
    full = found.where("least <> most").select("doc_id", "start", "end", other("least", "most"))
    # open seeds, and the outermost documents of the shared runs with the same seed, as the others to look among
    look = found.where("any_open and (doc_id = least or doc_id = most)").groupBy("doc_id").agg(F.collect_set("at").alias("places"))
    look = written(look, "repeats-open")
    texts_of = own.join(small(look, look.count(), BROADCAST_ROWS), "doc_id")
    windows = written(texts_of.mapInArrow(_windows(min_words, seed), "doc_id long, start int, window long"), "repeats-windows")
    twice = windows.groupBy("window").agg(least.alias("least"), most.alias("most")).where("least <> most")
    extended = windows.join(twice, "window").select("doc_id", "start", (F.col("start") + min_words).alias("end"), other("least", "most"))
    # overlapping and touching matches of a document are one passage
    order = Window.partitionBy("doc_id").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("start") <= F.col("before"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    matches = full.union(extended).groupBy("doc_id", "start", "end").agg(F.min("other").alias("other"))
    return (
        matches.withColumn("before", before).withColumn("island", island).groupBy("doc_id", "island")
        .agg(F.min("start").cast("long").alias("first_word"), F.max("end").alias("last"), F.min("other").alias("other_doc_id"))
        .select("doc_id", "first_word", (F.col("last") - F.col("first_word")).cast("long").alias("words"), "other_doc_id")
    )
