"""Toxic passages: maximal scoring segments over token log-odds.

The numbers of toxic and of clean training texts with a word, or with words of one
beginning (so that inflected forms count together, and what one text repeats weighs
once), give it a log-odds ratio under a Dirichlet prior in proportion to the pooled
numbers.  Words with a significant ratio score it, all words pay a small drift, so
the expected score of clean text is negative.  One pass over a text's scores finds all maximal scoring
segments (every one of them, disjoint, in linear time).  The chance of a segment's
score in clean text follows extreme-value statistics: about K * n * exp(-lambda *
S) segments of score S or more occur in n clean words.  A logistic fit on the
sample turns the segments' evidence into a document's score.

Defined results: a null text is an empty one; a text without scoring words has no
segments; without labels of both classes, or without a significant word, every
document gets the share of toxic labels (0 without labels); an empty table gives
an empty result; repeated rows get equal scores; of the other columns only ids
are read.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorefold.llm.common import batches, texts
from scorefold.llm.training import SAMPLE_PER_CLASS, held_out, logistic, training_sample

#: Weight of the prior, as a share of the pooled counts.
PRIOR = 0.1
#: Significance of a scoring unit, in standard errors; its least log-odds; what every word pays.
LEAST_Z = 3.5
LEAST_ODDS = 1.0
DRIFT = 0.05
#: Units are whole words and beginnings of so many characters.
BEGINNINGS = range(3, 9)
#: Words whose scores a task remembers.
REMEMBERED = 200_000


def tokens(text: str) -> list[str]:
    """Words in lower case without ASCII punctuation at their ends; words of punctuation only are left out."""
    return [w for x in text.lower().split() if (w := x.strip(string.punctuation))]


def units(word: str) -> list[str]:
    """A word and its beginnings, which end with a star."""
    return [word, *[f"{word[:k]}*" for k in BEGINNINGS if k < len(word)]]


class Lexicon(NamedTuple):
    """Scores of significant words; the extreme-value constants; the weights of segment evidence."""

    scores: dict[str, float]
    rate: float
    scale: float
    weights: list[float]
    share: float


def segments(hits: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a text, in linear time.

    hits: places and scores of the words that score more than the drift; every other
    word scores -drift.  After Ruzzo and Tompa: a list of candidate segments with the
    sums before and through each; a new one is joined with the last that starts lower
    as long as its sum ends higher.  Each candidate keeps the place of the last one
    before it that starts lower, so no search passes over the others again.
    """
    found: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum through, place of the last that starts lower
    total, at = 0.0, 0
    for place, score in hits:
        total -= drift * (place - at)
        at = place + 1
        start, end, left = place, at, total
        total = right = total + score
        if score <= 0:
            continue
        j = len(found) - 1
        while True:
            # what a link passes over starts no lower than the candidate that it belongs to, so no later search looks at it
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                found.append((start, end, left, right, j))
                break
            start, left, before = found[j][0], found[j][2], found[j][4]
            del found[j:]
            j = before
    return [(a, b, right - left) for a, b, left, right, _ in found]


class Scorer:
    """Scores of words by a lexicon of units: the highest of a word's units, remembered."""

    def __init__(self, scores: dict[str, float], drift: float = DRIFT):
        self.scores, self.drift, self.known = scores, drift, {}

    def score(self, word: str) -> float:
        found = [self.scores[u] for u in units(word) if u in self.scores]
        return max(found) if found else 0.0

    def hits(self, text: str) -> tuple[list[tuple[int, float]], int]:
        """Places and scores (less the drift) of a text's scoring words, and its number of words."""
        words, known = tokens(text), self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self.score(w)
        return [(i, known[w] - self.drift) for i, w in enumerate(words) if known[w]], len(words)


def evidence(text: str, lexicon: Lexicon, scorer: Scorer) -> list[float]:
    """Of the best segment and of all segments, above what chance gives in as many clean words; length."""
    hits, n = scorer.hits(text)
    found = segments(hits)
    if not found:
        return [0.0, 0.0, 1.0, math.log1p(n) / 10]
    chance = math.log(max(1e-300, lexicon.scale * n))
    above = [max(0.0, lexicon.rate * s - chance) for _, _, s in found]
    return [min(20.0, max(above)) / 10, min(40.0, sum(above)) / 10, 0.0, math.log1p(n) / 10]


def _counts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("word", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
    for batch in rows:
        counts = (Counter(), Counter())
        for text, label in zip(texts(batch.column("text")), batch.column("label").to_pylist(), strict=True):
            counts[label].update({u for w in set(tokens(text)) for u in units(w)})
        words = list(counts[0].keys() | counts[1].keys())
        yield from batches({"word": words, "toxic": [counts[1][w] for w in words], "clean": [counts[0][w] for w in words]}, schema)


def unit_scores(sample: DataFrame, prior: float = PRIOR, least_z: float = LEAST_Z, least_odds: float = LEAST_ODDS) -> dict[str, float]:
    """Log-odds of all units that are significant for toxic texts; every task knows them.

    A unit counts once in a text, and one that no clean text has needs more than 20 toxic
    texts for its significance (with as many units in all clean texts as in all toxic ones),
    so their number is at most a twentieth of the sampled toxic texts' units.
    """
    counts = sample.mapInArrow(_counts, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    counts = counts.persist()
    try:
        n_t, n_c = (x or 0 for x in counts.agg(F.sum("t"), F.sum("c")).first())
        if not n_t or not n_c:
            return {}
        a, mass = (F.col("t") + F.col("c")) * prior, (n_t + n_c) * prior
        odds = lambda y, n: F.log((y + a) / (n + mass - y - a))
        ratio = odds(F.col("t"), n_t) - odds(F.col("c"), n_c)
        z = ratio / F.sqrt(1 / (F.col("t") + a) + 1 / (F.col("c") + a))
        rows = counts.select("word", ratio.alias("ratio"), z.alias("z")).where((F.col("z") >= least_z) & (F.col("ratio") >= least_odds))
        rows = rows.select("word", "ratio").collect()
    finally:
        counts.unpersist()
    return {r.word: r.ratio for r in rows}


def extreme_rate(scores: np.ndarray, shares: np.ndarray, drift: float = DRIFT) -> float:
    """The positive root of: the mean of exp(rate * (score - drift)) over clean words is 1; 1 if there is none."""
    s, p = np.asarray(scores, float) - drift, np.asarray(shares, float) / np.sum(shares)
    mean = lambda rate: p @ np.exp(np.minimum(700, rate * s))
    if not (s > 0).any() or p @ s >= 0:
        return 1.0
    high = 1e-3
    while mean(high) < 1:
        high *= 2
    low = high / 2 if high > 1e-3 else 0.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return high


def _score_counts(scores: dict[str, float]):
    def count(rows):
        scorer, counts = Scorer(scores, 0.0), Counter()
        for batch in rows:
            for text in batch["text"]:
                hits, n = scorer.hits(text)
                counts.update(round(10 * s) for _, s in hits)
                counts[0] += n - len(hits)
        yield pd.DataFrame({"tenth": list(counts), "n": list(counts.values())}, dtype="int64")

    return count


def fit_lexicon(docs: DataFrame, labels: DataFrame, label: str = "toxic", divisor: int = 4, remainder: int = 2,
                per_class: int = SAMPLE_PER_CLASS) -> Lexicon:
    """Learn from at most per_class labelled documents of each class that are not held out."""
    sample, sizes = training_sample(docs, labels, label, divisor, remainder, per_class)
    sample = sample.where("label in (0, 1)")
    share = sizes.get(1, 0) / max(1, sizes.get(0, 0) + sizes.get(1, 0))
    scores = unit_scores(sample)
    if not scores or not 0 < share < 1:
        return Lexicon({}, 1.0, 1.0, [0.0] * 5, share)
    # how often clean text scores what, by tenths: the law of its segments
    clean = sample.where("label = 0").mapInPandas(_score_counts(scores), "tenth long, n long").groupBy("tenth").agg(F.sum("n").alias("n")).toPandas()
    value, n = clean["tenth"].to_numpy() / 10, clean["n"].to_numpy().astype(float)
    positive = value > 0
    rate = extreme_rate(np.where(positive, value, 0.0), (n + 0.5 * positive) / n.sum())
    typical = float(np.median(list(scores.values()))) - DRIFT
    scale = max(0.5, n[positive].sum()) / n.sum() * math.exp(min(600.0, rate * typical))
    plain = Lexicon(scores, rate, scale, [0.0] * 5, share)

    def measured(rows):
        scorer = Scorer(plain.scores)
        for batch in rows:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "x": [evidence(t, plain, scorer) for t in batch["text"]]})

    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.mapInPandas(measured, f"doc_id {kind}, label int, x array<double>").toPandas().sort_values("doc_id", kind="stable")
    x = np.column_stack([np.ones(len(rows)), np.array(rows["x"].tolist())])
    y = rows["label"].to_numpy().astype(float)
    weight = np.where(y == 1, share / max(1, y.sum()), (1 - share) / max(1, (1 - y).sum())) * len(y)
    return plain._replace(weights=logistic(x, y, weight, penalty=0.1).tolist())


def with_score(docs: DataFrame, lexicon: Lexicon, text: str = "text", score: str = "score") -> DataFrame:
    """docs with a score from 0 to 1 added."""
    weights = np.array(lexicon.weights)

    @F.pandas_udf("double")
    def scored(column: pd.Series) -> pd.Series:
        if not lexicon.scores:
            return pd.Series(np.full(len(column), lexicon.share))
        scorer = Scorer(lexicon.scores)
        x = np.array([[1.0, *evidence(t or "", lexicon, scorer)] for t in column]).reshape(-1, 5)
        return pd.Series(1 / (1 + np.exp(-np.clip(x @ weights, -500, 500))))

    return docs.withColumn(score, scored(F.col(text)))


def passages(docs: DataFrame, lexicon: Lexicon, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, first_word, words, score, expected (such segments in as many clean words) of every toxic passage.

    Words are counted without those of punctuation only.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def found(rows):
        scorer = Scorer(lexicon.scores)
        for batch in rows:
            out = []
            for key, t in zip(batch["doc_id"], batch["text"], strict=True):
                hits, n = scorer.hits(t or "")
                out += [(key, a, b - a, s, lexicon.scale * n * math.exp(-lexicon.rate * s)) for a, b, s in segments(hits)]
            yield pd.DataFrame(out, columns=["doc_id", "first_word", "words", "score", "expected"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(found, f"doc_id {kind}, first_word long, words long, score double, expected double")


def document_toxicity(docs: DataFrame, labels: DataFrame, divisor: int = 4, remainder: int = 2, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    lexicon = fit_lexicon(docs, labels, "toxic", divisor, remainder)
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    return with_score(rows, lexicon).select(
        "doc_id", held_out(F.col("doc_id"), divisor, remainder).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
