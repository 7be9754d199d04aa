"""One row of each group of near copies: texts that share most of their word shingles.

Two texts are near copies if the Jaccard similarity of their sets of five-word
shingles, over the whole texts, is 0.8 or more; groups are what such pairs connect.
Texts with equal sets become one value first.  A value has a SimHash fingerprint of
its set; fingerprints within the bit budget are found by walking tries, as `simhash`
does, and every value of such a component is a candidate with its smallest one.  A
value's MinHash signature is cut into bands; values with an equal band share a bucket
and are candidates too, as most pairs of similarity 0.8 differ in more bits.  Every
candidate is compared on the whole sets, in the task that finds it:

* each value is compared with the smallest value of its SimHash component and with one
  value of each of its buckets (CENTRES different ones at most), which joins a large
  group of near copies in linear work;
* values of a bucket that are still in different groups are then compared with each
  other, if their signatures agree in enough places: blocks of bounded size that hold
  the sets meet in pairs, and a task forgets what it has linked already.

A task passes on a spanning forest of the verified links, so neither the pairs that a
bucket holds nor the links of a group are ever rows, and a set is copied for a block,
not for a pair.

A pair of similarity s has no band in common with the chance (1 - s^ROWS)^BANDS, 5 in
100,000 at 0.8; the least agreement lies four standard errors below 0.8.

Defined results: words and short texts are as for SimHash (fewer words than a shingle
count as one shingle), texts without words are copies of each other; ids may be null
or repeat; the row that stays has the smallest id; an empty table gives an empty
result.  Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorefold.llm import simhash
from scorefold.llm.common import ROW, free, numbered, small, texts, word_bytes, written
from scorefold.llm.components import components
from scorefold.llm.repeats import _WORD_BASE, _mixed, _Rolling, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
PLACES = BANDS * ROWS
#: Values that a block holds, and bytes of their sets (a single larger set is a block of its own).
BLOCK = 2048
BLOCK_BYTES = 4 << 20
#: Different values that the buckets of a group of near copies are compared with.
CENTRES = 5
#: Rows (24 bytes each) that are broadcast at most.
BROADCAST_ROWS = 200_000
_XOR = _mixed(np.arange(1, PLACES + 1, dtype="u8") * np.uint64(0x9E3779B97F4A7C15))
_TIMES = _mixed(_XOR + np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def shingles(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a text's word shingles."""
    words = word_hashes(word_bytes(text))
    if not len(words):
        return words
    starts = np.arange(max(1, len(words) - shingle + 1))
    return np.unique(_Rolling(words, _WORD_BASE).of(starts, starts + min(shingle, len(words))))


def signature(values: np.ndarray) -> np.ndarray:
    """The MinHash signature of a set of hashes."""
    out = np.full(PLACES, np.iinfo("u8").max, "u8")
    for at in range(0, len(values), 256):
        np.minimum(out, ((values[at : at + 256, None] ^ _XOR) * _TIMES).min(0), out=out)
    return out


def fingerprint(values: np.ndarray) -> int:
    """The SimHash of a set of hashes as a signed 64-bit integer: a bit is one if it is set in over half of them."""
    ones = np.zeros(64, "i8")
    for at in range(0, len(values), 65_536):
        ones += np.unpackbits(_mixed(values[at : at + 65_536]).astype("<u8").view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i8")
    return int(np.packbits(ones * 2 > len(values), bitorder="little").view("<i8")[0])


def bands(places: np.ndarray) -> np.ndarray:
    """A hash of each band of a signature, which knows the band."""
    out = np.arange(1, BANDS + 1, dtype="u8")
    for column in places.reshape(BANDS, ROWS).T:
        out = _mixed(out + _mixed(column))
    return out


def near(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether two sorted sets are so similar."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)) - 1e-9:
        return False
    if not len(a):
        return True
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return common >= similarity * (len(both) - common) - 1e-9


def least_agreement(similarity: float = SIMILARITY) -> int:
    """Places in which the signatures of a pair of this similarity agree but for four standard errors."""
    return max(1, math.floor(PLACES * similarity - 4 * math.sqrt(PLACES * similarity * (1 - similarity))))


def _sketches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        keys, fps, cut, places = [], [], [], []
        for text in texts(batch.column("__text")):
            values = shingles(text)
            s = signature(values)
            keys.append(int(_mixed((_mixed(values).sum(dtype="u8") + np.array([len(values)], "u8"))).view("i8")[0]))
            fps.append(fingerprint(values))
            cut.append(bands(s).view("i8"))
            places.append(s.astype("<u2").tobytes())
        yield pa.record_batch(
            [batch.column("uid"), batch.column("doc_id"), pa.array(keys, pa.int64()), pa.array(fps, pa.int64()), pa.array(cut, pa.list_(pa.int64())), pa.array(places, pa.binary())],
            names=["uid", "doc_id", "key", "fp", "bands", "places"],
        )


def _sets(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for key, text in zip(batch.column("key").to_pylist(), texts(batch.column("__text")), strict=True):
            yield pa.record_batch([pa.array([key], pa.int64()), pa.array([shingles(text).tobytes()], pa.binary())], names=["key", "values"])


class _Groups:
    """Union-find over the groups that a task sees."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def of(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([x for x, _ in pairs], pa.int64()), pa.array([x for _, x in pairs], pa.int64())], names=["a", "b"])


def _around(similarity: float):
    """Blocks of values, each with the centre that they are compared with -> links with it."""

    def around(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for centre, own, block in zip(batch.column("centre").to_pylist(), batch.column("centre_values"), batch.column("block"), strict=True):
                whole, found = np.frombuffer(own.as_buffer(), "u8"), []
                for key, values in zip(block.values.field("key").to_pylist(), block.values.field("values"), strict=True):
                    if near(whole, np.frombuffer(values.as_buffer(), "u8"), similarity):
                        found.append((min(centre, key), max(centre, key)))
                yield _links(found)

    return around


def _between(similarity: float, least: int):
    """Pairs of blocks -> a spanning forest of the links between values of different groups."""

    def between(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for left, right, same in zip(batch.column("left"), batch.column("right"), batch.column("same").to_pylist(), strict=True):
                (ka, ga, pa_, va), (kb, gb, pb, vb) = (
                    (x.field("key").to_pylist(), x.field("root").to_numpy(), np.frombuffer(b"".join(x.field("places").to_pylist()), "<u2").reshape(-1, PLACES), x.field("values"))
                    for x in (left.values, right.values)
                )
                groups, found, now = _Groups(), [], gb.copy()
                for i, places in enumerate(pa_):
                    own = groups.of(int(ga[i]))
                    may = np.flatnonzero(now != own)
                    may = may[may > i] if same else may
                    may = may[(pb[may] == places).sum(1) >= least]
                    if not len(may):
                        continue
                    whole = np.frombuffer(va[i].as_buffer(), "u8")
                    for j in may:
                        other = groups.of(int(gb[j]))
                        own = groups.of(own)
                        if own != other and near(whole, np.frombuffer(vb[int(j)].as_buffer(), "u8"), similarity):
                            found.append((min(ka[i], kb[j]), max(ka[i], kb[j])))
                            low, high = min(own, other), max(own, other)
                            groups.up[high] = low
                            now[now == high] = low
                yield _links(found)

    return between


def _chunks(count: str, size: str, block: int):
    """Into how many blocks so many values of so many bytes go."""
    return F.ceil(F.greatest(F.col(count) / block, F.col(size) / BLOCK_BYTES)).cast("long")


def simhash_centres(values: DataFrame) -> DataFrame:
    """key, fp of distinct values -> centre, key: each value with the smallest one that fingerprints within the budget connect it to."""
    fps = written(values.select("fp").distinct(), "near-fingerprints")
    found = simhash.near_components(fps, fps.count()).withColumnRenamed("node", "fp")
    grouped = written(values.select("key", "fp").join(found, "fp", "left").select("key", F.coalesce("root", "fp").alias("root")), "near-fingerprint-groups")
    firsts = grouped.groupBy("root").agg(F.min("key").alias("centre"))
    return grouped.join(firsts, "root").where("key <> centre").select("centre", "key")


def near_components(values: DataFrame, sets, similarity: float = SIMILARITY, block: int = BLOCK, centres: DataFrame | None = None) -> DataFrame:
    """key, bands, places of distinct values -> node, root for every value that has a near copy.

    sets gives key, values (the whole set) for a table of keys; centres has further
    candidates (centre, key), those of `simhash_centres`.
    """
    spread = values.select("key", F.posexplode("bands").alias("at", "band"))
    centre = F.min_by("key", F.xxhash64("key", F.col("at") % CENTRES)).alias("centre")
    buckets = spread.groupBy("band").agg(F.count("*").alias("n"), centre).where("n > 1")
    members = written(spread.hint("merge").join(buckets, "band"), "near-members")
    # each value with its component's and its buckets' centres, in blocks round a centre
    first, keys = members.where("key <> centre").select("centre", "key"), members.select("key")
    if centres is not None:
        first = first.union(centres)
        keys = keys.union(centres.select("key")).union(centres.select("centre"))
    whole = written(sets(keys.distinct()), "near-sets")
    first = first.distinct()
    round_ = first.hint("merge").join(whole, "key")
    round_sizes = round_.groupBy("centre").agg(F.count("*").alias("count"), F.sum(F.length("values")).alias("bytes")).select("centre", _chunks("count", "bytes", block).alias("chunks"))
    blocks = (
        round_.join(round_sizes, "centre").groupBy("centre", F.pmod(F.xxhash64("key"), F.col("chunks")).alias("chunk"))
        .agg(F.collect_list(F.struct("key", "values")).alias("block"))
    )
    blocks = blocks.hint("merge").join(whole.select(F.col("key").alias("centre"), F.col("values").alias("centre_values")), "centre")
    links = written(blocks.select("centre", "centre_values", "block").mapInArrow(_around(similarity), "a long, b long"), "near-links")
    found = components(links, "near-links")
    # what is left: buckets of three or more that are in different groups
    rest = members.where("n > 2").join(found, F.col("key") == F.col("node"), "left").select("band", "key", F.coalesce("root", "key").alias("root"))
    apart = rest.groupBy("band").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most").select("band")
    rest = rest.join(apart, "band").join(values.select("key", "places"), "key").join(whole, "key")
    sizes = rest.groupBy("band").agg(F.count("*").alias("count"), F.sum(F.length("values")).alias("bytes")).select("band", _chunks("count", "bytes", block).alias("chunks"))
    chunk = F.pmod(F.xxhash64("key"), F.col("chunks")).alias("chunk")
    blocks = written(
        rest.join(sizes, "band").groupBy("band", chunk).agg(F.collect_list(F.struct("key", "root", "places", "values")).alias("left")), "near-blocks"
    )
    pairs = blocks.hint("merge").join(blocks.select("band", F.col("chunk").alias("other"), F.col("left").alias("right")), "band").where("chunk <= other")
    second = written(pairs.select("left", "right", (F.col("chunk") == F.col("other")).alias("same")).mapInArrow(_between(similarity, least_agreement(similarity)), "a long, b long").distinct(), "near-links")
    return components(links.union(second), "near-links")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs, one of every group of near copies (smallest id), with all their columns."""
    row = free(ROW, docs)
    rows = numbered(docs, "near-numbered", row)
    own = rows.select(F.col(row).alias("uid"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("__text"))
    uid = dict(own.dtypes)["uid"]
    sketches = written(own.mapInArrow(_sketches, f"uid {uid}, doc_id long, key long, fp long, bands array<long>, places binary"), "near-sketches")
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id"), F.col("uid"))
    values = written(sketches.groupBy("key").agg(F.min(order).alias("least"), F.first("fp").alias("fp"), F.first("bands").alias("bands"), F.first("places").alias("places")), "near-values")

    def sets(keys: DataFrame) -> DataFrame:
        wanted = written(values.join(keys, "key").select("key", F.col("least.uid").alias("uid")), "near-wanted")
        found = own.join(small(wanted, wanted.count(), BROADCAST_ROWS), "uid")
        return found.select("key", "__text").mapInArrow(_sets, "key long, values binary")

    centres = written(simhash_centres(values), "near-centres")
    found = near_components(values.select("key", "bands", "places"), sets, similarity, centres=centres)
    groups = values.select("key", "least").join(found.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    groups = written(groups, "near-groups")
    firsts = groups.groupBy("root").agg(F.min("least").alias("least")).select("root", F.col("least.uid").alias("stays"))
    labels = groups.select("key", "root").join(firsts, "root").select("key", "stays")
    dropped = sketches.select("uid", "key").join(labels, "key").where("uid <> stays").select(F.col("uid").alias(row))
    return rows.join(dropped, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
