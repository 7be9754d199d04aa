"""Small tables with everything that an operator must stand, and plain counterparts of the rules."""

import re
import zlib

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, uid long, size string, kept double, score string, word int, label string"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
SHARED = " ".join(f"shared{i}" for i in range(60))


def documents():
    texts = {
        1: "The quick brown fox jumps over the lazy dog",
        2: "the  quick brown fox\njumps over the lazy dog ",
        3: "The quick brown fox jumps over the lazy dog",
        4: None, 5: "", 6: " \t\n\x0b\x0c\r ", 7: LONG, 8: "one", 9: "ONE",
        10: "début " + SHARED + " fin", 11: "autre début " + SHARED + " autre fin", 12: SHARED[: len(SHARED) // 2],
        13: "中文   and   wide \x1c blanks <|endoftext|> it's 1234", 14: " ".join(["again"] * 300), 15: LONG + " end",
    }
    sources = {1: "a", 2: "b", 3: None, 4: "a", 7: "b", 8: "ü", 10: "a", 11: None, 15: "b"}
    rows = [(i, t, "en", sources.get(i, "c"), None if t is None else len(t), 7, "x", 0.5, "s", 1, "l") for i, t in texts.items()]
    # a row without an id, one with nothing at all, and one three times
    rows += [(None, "no id here", None, "a", 10, None, None, None, None, None, None), (None, None, *[None] * 9), rows[7], rows[7]]
    return rows


#: Columns named as the operators name their own.
OWN_NAMES = ["__row", "__words", "__size", "__SCORE", "___row", "__text"]


def make(spark, rows=None, schema=SCHEMA):
    docs = spark.createDataFrame(documents() if rows is None else rows, schema)
    return docs.withColumns({c: F.lit(f"own {c}") for c in OWN_NAMES}).repartition(3)


def words(text):
    return (text or "").encode().lower().split()


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def own(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def remainder(doc_id, divisor):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % divisor
