"""Language of texts by rank-order profiles of n-grams, after Cavnar and Trenkle.

A text is lower-cased and cut into runs of letters; each run, with a blank on either
side, gives its n-grams of one to three characters (the lone blank excepted).  A
language's profile is the order of the GRAMS most frequent ones over all its training
texts, ties in code-point order.  A text's own order of its most frequent n-grams is
compared with every profile by the out-of-place distance: the difference of ranks,
summed, GRAMS for an n-gram that the profile lacks.  The nearest language is the
answer (ties: the first in code-point order), its score 1 - distance / the distance
of a text that has nothing in common with the profile.

All training texts count, whole, combined in the tasks; the profiles are GRAMS numbers
a language.  Languages are looked at LANGUAGES at a time, so what a task is sent does
not grow with the values of the column.

Defined results: a null text or one without a letter is `und`, score 0, and so is
every text if nothing can be learned; rows without a language teach nothing; a null id
is not held out; repeated rows count as often as they stand and get equal answers; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorefold.llm.common import texts, written
from scorefold.llm.training import held_out

GRAMS = 300
UNKNOWN = "und"
#: Profiles that tasks are sent at once, characters of a text that are counted at once, n-grams that a task gathers.
LANGUAGES = 2048
STRETCH = 1 << 20
GATHERED = 1 << 21
_BLANK = 32
_LETTERS: list[np.ndarray] = []


def _is_letter(points: np.ndarray) -> np.ndarray:
    if not _LETTERS:  # once in a process
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0][points]


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, with the sums of their counts."""
    if len(parts) == 1:
        return parts[0]
    codes, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(place, np.concatenate([n for _, n in parts])).astype("i8")


def gram_counts(text: str, stretch: int = STRETCH) -> tuple[np.ndarray, np.ndarray]:
    """The text's n-grams and how often they stand there.

    An n-gram is its characters' code points in 21 bits each, filled up with zeros, so
    that numbers are in code-point order.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    parts, tail = [], np.array([_BLANK], "i8")
    for at in range(0, len(points) + 1, stretch):
        piece = points[at : at + stretch].astype("i8")
        piece = np.where(_is_letter(piece), piece, _BLANK)
        if at + stretch > len(points):
            piece = np.append(piece, _BLANK)
        # tail: the last two characters before this piece, counted already where they end an n-gram
        line = np.concatenate([tail, piece])
        line = line[np.r_[True, (line[1:] != _BLANK) | (line[:-1] != _BLANK)]]
        fresh = line[len(tail) :]
        one = fresh[fresh != _BLANK] << 42
        pairs = line[len(tail) - 1 :]
        two = (pairs[:-1] << 42) | (pairs[1:] << 21)
        inner = line[1:-1] != _BLANK
        three = ((line[:-2] << 42) | (line[1:-1] << 21) | line[2:])[inner]
        parts.append(np.unique(np.concatenate([one, two, three]), return_counts=True))
        tail = line[-2:]
    return _added(parts)


def gram_order(text: str, grams: int = GRAMS) -> np.ndarray:
    """The text's most frequent n-grams, most frequent first."""
    codes, n = gram_counts(text)
    return codes[np.lexsort((codes, -n))][:grams]


def out_of_place(order: np.ndarray, codes: np.ndarray, ranks: np.ndarray, grams: int = GRAMS) -> int:
    """The distance of a text's order from a profile, given as ascending codes and their ranks."""
    if not len(codes):
        return len(order) * grams
    at = np.searchsorted(codes, order).clip(max=len(codes) - 1)
    return int(np.where(codes[at] == order, np.abs(ranks[at] - np.arange(len(order))), grams).sum())


def _counted(gathered: int):
    """Rows of lang, text -> lang, gram, n, combined within a task as far as its memory is bounded."""

    def rows_of(sums: dict) -> Iterator[pa.RecordBatch]:
        for lang, parts in sums.items():
            codes, n = _added(parts)
            for at in range(0, len(codes), 100_000):
                c = codes[at : at + 100_000]
                yield pa.record_batch([pa.array([lang] * len(c), pa.string()), pa.array(c), pa.array(n[at : at + 100_000].astype("i8"))], names=["lang", "gram", "n"])

    def counted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, held = defaultdict(list), 0
        for batch in rows:
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch.column("text")), strict=True):
                codes, n = gram_counts(text)
                sums[lang].append((codes, n.astype("i8")))
                held += len(codes)
                if held > gathered:
                    sums = defaultdict(list, {k: [_added(v)] for k, v in sums.items()})
                    held = sum(len(v[0][0]) for v in sums.values())
                    if held > gathered // 2:
                        yield from rows_of(sums)
                        sums, held = defaultdict(list), 0
        yield from rows_of(sums)

    return counted


def learn_profiles(rows: DataFrame, grams: int = GRAMS) -> DataFrame:
    """lang, gram, rank (from 0) of the most frequent n-grams of each language; rows have text and lang."""
    own = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("text").alias("text"))
    counts = own.mapInArrow(_counted(GATHERED), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < grams).select("lang", "gram", "rank")


def _nearest(profiles: pd.DataFrame, grams: int):
    """A UDF: text -> (distance / the largest distance, lang) of the nearest profile, null without letters."""
    known = []
    for lang, own in profiles.sort_values(["lang", "gram"]).groupby("lang", sort=True):
        known.append((lang, own["gram"].to_numpy("i8"), own["rank"].to_numpy("i8")))

    @F.pandas_udf("share double, lang string")
    def nearest(column: pd.Series) -> pd.DataFrame:
        out = []
        for text in column:
            order = gram_order(text or "", grams)
            best = min(((out_of_place(order, c, r, grams), lang.encode(), lang) for lang, c, r in known), default=None) if len(order) else None
            out.append((None, None) if best is None else (best[0] / (len(order) * grams), best[2]))
        return pd.DataFrame(out, columns=["share", "lang"])

    return nearest


def with_language(docs: DataFrame, profiles: DataFrame, grams: int = GRAMS, languages: int = LANGUAGES, text: str = "text",
                  lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """docs with the predicted language and its score added, by learned profiles."""
    count = profiles.where("rank = 0").count()
    groups = -(-count // languages)
    answers = []
    for group in range(groups):
        own = profiles if groups == 1 else profiles.where(F.pmod(F.xxhash64("lang"), F.lit(groups)) == group)
        answers.append(_nearest(own.toPandas(), grams)(F.col(text)))  # languages * grams rows
    if not answers:
        return docs.withColumn(lang, F.lit(UNKNOWN)).withColumn(score, F.lit(0.0))
    found = [F.when(a["share"].isNotNull(), a) for a in answers]
    best = found[0] if groups == 1 else F.least(*found)
    columns = [F.col(f"`{c}`") for c in docs.columns if c not in (lang, score)]
    return docs.select(*columns, best.alias(lang)).select(
        *columns, F.coalesce(F.col(lang)["lang"], F.lit(UNKNOWN)).alias(lang), F.coalesce(1 - F.col(lang)["share"], F.lit(0.0)).alias(score)
    )


def document_language(docs: DataFrame, divisor: int = 3, remainder: int = 1, grams: int = GRAMS) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of docs, learned from the rows that are not held out."""
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    taught = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"), F.col("lang").alias("lang")).where(~held_out(F.col("doc_id"), divisor, remainder))
    profiles = written(learn_profiles(taught, grams), "language-profiles")
    return with_language(rows, profiles, grams).select("doc_id", held_out(F.col("doc_id"), divisor, remainder).alias("held_out"), "lang_pred", "score")
