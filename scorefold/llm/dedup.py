"""Exact duplicates by counting quotient filters.

Every task puts the 64-bit fingerprints of its rows into a counting quotient
filter: the high bits (the quotient) name a run, the low bits (the remainder) are
kept sorted in their run, each with its count.  No bit is lost, so filters merge
exactly by merging sorted remainders and adding counts.  Filters are cut by the
first bits of the quotient, and each part is merged by one task.  Only
fingerprints with a count above one go on: the texts of those rows are compared
byte by byte (they are the key of an aggregation); all other rows are unique.

Defined results: a null text is an empty one, and all empty texts are equal; of
equal texts the row with the most characters stays, then the smallest id (null
last), then the first row, so that of repeated rows exactly one stays; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorefold.llm.common import ROW, SPACES, bits_for, free, numbered, shuffle_partitions, small, written

#: A filter's head: bits of the prefix and of a remainder, slots, prefix.  Slots (a multiple of 8) that are packed together.
HEAD = struct.Struct("<BBqQ")
STRIDE = 1 << 16
#: Fingerprints that a task holds before it emits its filter; rows per merged part.
HOLD = 1_000_000
PART_ROWS = 1 << 20
#: Repeated fingerprints (16 bytes each) are broadcast up to this many, else joined by shuffle.
BROADCAST_ROWS = 500_000


def _packed(values: np.ndarray, width: int) -> bytes:
    """The lowest `width` bits of each value, one after the other."""
    out = []
    for at in range(0, len(values), STRIDE):
        bits = np.unpackbits(values[at : at + STRIDE].astype(">u8").view("u1").reshape(-1, 8), axis=1)
        out.append(np.packbits(bits[:, 64 - width :]))
    return b"".join(x.tobytes() for x in out)


def _unpacked(data: memoryview, width: int, n: int) -> np.ndarray:
    out = np.zeros(n, "u8")
    for at in range(0, n, STRIDE):
        some = min(STRIDE, n - at)
        bits = np.zeros((some, 64), "u1")
        begin = at * width // 8
        bits[:, 64 - width :] = np.unpackbits(np.frombuffer(data, "u1", -(-some * width // 8), begin), count=some * width).reshape(some, width)
        out[at : at + some] = np.packbits(bits, axis=1).view(">u8").ravel()
    return out


def filter_of(fingerprints: np.ndarray, counts: np.ndarray, prefix_bits: int = 0) -> bytes:
    """A counting quotient filter over distinct sorted uint64 fingerprints with their counts.

    The first prefix_bits are the same in all fingerprints and stored once.  A quotient names
    a slot; remainders of one quotient are a run of slots in ascending order, which begins at its
    own slot or, if that is taken, after the runs before it (the last ones may lie beyond the last
    quotient).  Every slot has an occupied, a continuation and a shifted bit, and a counter bit:
    slots with it hold the digits of the count less two of the remainder before them.
    """
    bits = 64 - prefix_bits
    # one slot for a remainder, and room for the digits of counts; 90% of the slots are taken at most
    quotient_bits = min(bits - 1, max(1, int(np.ceil(np.log2((len(counts) + 2 * np.count_nonzero(counts > 1) + 1) / 0.9)))))
    width = bits - quotient_bits
    prefix = int(fingerprints[0]) >> bits if prefix_bits and len(fingerprints) else 0
    own = fingerprints & np.uint64((1 << bits) - 1)
    digits = np.zeros(len(counts), "i8")
    more = (counts - 2).astype("i8")
    left = np.where(counts > 1, more, -1)
    while (open_ := left >= 0).any():
        digits += open_
        left = np.where(open_ & (left >> width > 0), left >> width, -1) if width < 63 else np.full(len(left), -1)
    entry = np.repeat(np.arange(len(counts)), 1 + digits)
    nth = np.arange(len(entry)) - np.repeat(np.cumsum(1 + digits) - 1 - digits, 1 + digits)  # 0: the remainder, then its digits
    quotient = (own >> np.uint64(width)).astype("i8")[entry]
    place = np.arange(len(entry))
    slot = np.maximum.accumulate(quotient - place) + place
    slots = max(1 << quotient_bits, int(slot[-1]) + 1 if len(slot) else 0)
    low = np.uint64((1 << width) - 1)
    held = np.zeros(slots, "u8")
    digit = more[entry] >> np.minimum(63, np.maximum(0, nth - 1) * width)
    held[slot] = np.where(nth == 0, own[entry], digit.astype("u8")) & low
    flags = np.zeros((4, slots), "u1")
    flags[0, quotient] = 1
    flags[1, slot[1:]] = quotient[1:] == quotient[:-1]
    flags[2, slot] = slot != quotient
    flags[3, slot] = nth > 0
    return HEAD.pack(prefix_bits, width, slots, prefix) + np.packbits(flags, axis=1).tobytes() + _packed(held, width)


def entries_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The sorted fingerprints and counts that a filter holds."""
    prefix_bits, width, slots, prefix = HEAD.unpack_from(data)
    at, row = HEAD.size, -(-slots // 8)
    occupied, continuation, shifted, counter = np.unpackbits(np.frombuffer(data, "u1", 4 * row, at).reshape(4, row), axis=1, count=slots).astype(bool)
    used = np.flatnonzero(occupied | continuation | shifted)
    held = _unpacked(memoryview(data)[at + 4 * row :], width, slots)[used]
    # the n-th run is that of the n-th occupied quotient
    quotient = np.flatnonzero(occupied)[np.cumsum(~continuation[used]) - 1].astype("u8")
    digit = counter[used]
    entry = np.cumsum(~digit) - 1
    nth = np.arange(len(used)) - np.flatnonzero(~digit)[entry] if len(used) else entry
    counts = np.ones(int((~digit).sum()), "i8")
    np.add.at(counts, entry[digit & (nth == 1)], 1)
    np.add.at(counts, entry[digit], held[digit].astype("i8") << np.minimum(63, (nth[digit] - 1) * width))
    values = (quotient[~digit] << np.uint64(width)) | held[~digit]
    return values | np.uint64(prefix << (64 - prefix_bits) if prefix_bits else 0), counts


def counted(fingerprints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints in order, with the sums of their counts."""
    order = np.argsort(fingerprints, kind="stable")
    fingerprints, counts = fingerprints[order], counts[order]
    first = np.flatnonzero(np.r_[True, fingerprints[1:] != fingerprints[:-1]]) if len(fingerprints) else np.zeros(0, int)
    return fingerprints[first], np.add.reduceat(counts, first) if len(first) else counts


def _merged(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two ordered lists of fingerprints with counts as one, without sorting."""
    (a, n), (b, m) = x, y
    if not len(a) or not len(b):
        return y if len(b) else x
    at = np.searchsorted(a, b)
    same = a[np.minimum(at, len(a) - 1)] == b
    n = n.copy()
    n[at[same]] += m[same]
    return np.insert(a, at[~same], b[~same]), np.insert(n, at[~same], m[~same])


def merged_entries(filters: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of all filters in order, with the sums of their counts: neighbours are merged until one list is left."""
    lists = [entries_of(x) for x in filters]
    while len(lists) > 1:
        lists = [_merged(*lists[i : i + 2]) if i + 1 < len(lists) else lists[i] for i in range(0, len(lists), 2)]
    return lists[0]


def merged(filters: list[bytes]) -> bytes:
    """One filter with what all of them hold; they have one prefix."""
    return filter_of(*merged_entries(filters), HEAD.unpack_from(filters[0])[0])


def _filters(part_bits: int):
    def cut(held: list[np.ndarray]) -> pa.RecordBatch:
        values = np.concatenate(held)
        values, counts = counted(values, np.ones(len(values), "i8"))
        part = (values >> np.uint64(64 - part_bits)).astype("i8") if part_bits else np.zeros(len(values), "i8")
        edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
        filters = [filter_of(values[a:b], counts[a:b], part_bits) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return pa.record_batch([pa.array(part[edges[:-1]]), pa.array(filters, pa.binary())], names=["part", "filter"])

    def build(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in rows:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).astype("i8").view("u8"))
            n += len(held[-1])
            if n >= HOLD:
                yield cut(held)
                held, n = [], 0
        if n:
            yield cut(held)

    return build


def _repeated(group: pd.DataFrame) -> pd.DataFrame:
    values, counts = merged_entries(list(group["filter"]))
    return pd.DataFrame({"fingerprint": values[counts > 1].view("i8"), "copies": counts[counts > 1]})


def repeated_fingerprints(fingerprints: DataFrame, rows: int) -> DataFrame:
    """fingerprint (long) -> fingerprint, copies for those that occur more than once."""
    spark = fingerprints.sparkSession
    part_bits = bits_for(rows, PART_ROWS, least=bits_for(shuffle_partitions(spark), 1))
    filters = fingerprints.select("fingerprint").mapInArrow(_filters(part_bits), "part long, filter binary")
    return filters.groupBy("part").applyInPandas(_repeated, "fingerprint long, copies long")


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, "")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", uid: Column | None = None) -> DataFrame:
    """One row per row of docs: uid, doc_id, keep_uid, keep_id, group_size, kept, text_sha256.

    Texts are read twice, once for fingerprints and once for the bytes of rows whose
    fingerprint repeats; only the latter's texts are shuffled.
    """
    own = normalised(F.col(text))
    rows = written(
        docs.select(
            (F.monotonically_increasing_id() if uid is None else uid).alias("uid"), F.col(doc_id).alias("doc_id"),
            F.coalesce(F.length(F.col(text)), F.lit(0)).alias("chars"), own.alias("own"),
        ).select("uid", "doc_id", "chars", F.xxhash64("own").alias("fingerprint"), F.sha2(F.encode("own", "UTF-8"), 256).alias("text_sha256")),
        "dedup-rows",
    )
    repeated = written(repeated_fingerprints(rows, rows.count()), "dedup-repeated")
    n = repeated.count()
    candidates = (
        docs.select(own.alias("own")).withColumn("fingerprint", F.xxhash64("own"))
        .join(small(repeated.select("fingerprint"), n, BROADCAST_ROWS), "fingerprint", "left_semi")
    )
    # byte verification: the texts themselves are the key, so rows meet only if all their bytes agree
    verified = (
        candidates.groupBy("fingerprint", "own").agg(F.count("*").alias("copies"))
        .select("fingerprint", F.sha2(F.encode("own", "UTF-8"), 256).alias("text_sha256"))
        .groupBy("fingerprint", "text_sha256").agg(F.count("*").alias("texts"))
        .withColumn("texts", F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts have one SHA-256"))).otherwise(F.col("texts")))
    )
    key = ["fingerprint", "text_sha256"]
    order = F.struct((-F.col("chars")).alias("c"), F.col("doc_id").isNull().alias("n"), F.col("doc_id"), F.col("uid"))
    groups = (
        rows.join(small(repeated.select("fingerprint"), n, BROADCAST_ROWS), "fingerprint", "left_semi")
        .groupBy(*key).agg(F.count("*").alias("size"), F.min(order).alias("keep"))
        .join(verified.where("texts = 1").select(*key), key)
    )
    groups = small(written(groups, "dedup-groups"), n, BROADCAST_ROWS)
    keep_uid = F.coalesce("keep.uid", "uid")
    return rows.join(groups, key, "left").select(
        "uid", "doc_id", keep_uid.alias("keep_uid"),
        F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"), (keep_uid == F.col("uid")).alias("kept"), "text_sha256",
    )


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    row = free(ROW, docs)
    rows = numbered(docs, "dedup-numbered", row)
    dropped = exact_groups(rows, doc_id, text, uid=F.col(row)).where("not kept").select(F.col("uid").alias(row))
    return rows.join(dropped, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
