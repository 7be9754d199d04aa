"""SimHash fingerprints, near copies among them by a self-join of binary tries.

A fingerprint bit is one if it is set in over half of the hashes of the word
shingles, repeats included.  Distinct fingerprints are cut into blocks by their
first bits; blocks whose first bits differ in few enough places meet in a task,
once.  A task walks the binary tries of its two blocks together: pairs of nodes go
down bit by bit, differing bits add up, and a pair is dropped as soon as they
exceed the budget.  Pairs that reach small nodes are compared directly.  A task
passes on a spanning forest of the links that it found, so no group of near copies
is ever spread out into all its pairs.

Defined results: a text without words (null, empty, blanks) has fingerprint zero
and is linked like any other; fewer words than a shingle count as one shingle;
ids may be null or repeat: every row gets its fingerprint's component, whose id is
the smallest id in it (null only if all are null); an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorefold.llm.common import ROW, bits_for, free, numbered, texts, word_bytes, written
from scorefold.llm.components import components

SHINGLE = 3
HASH_SEED = 42
BUDGET = 3
#: Fingerprints in a block; pairs of trie nodes walked at once; pairs of values compared directly.
BLOCK = 16_384
WALK = 1 << 19
DIRECT = 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text's word shingles."""
    words = word_bytes(text)
    if not words:
        return 0
    line = memoryview(b" ".join(words))
    ends = [x + i for i, x in enumerate(accumulate(map(len, words)))]
    starts = [0, *[x + 1 for x in ends[:-1]]]
    last = max(0, len(words) - shingle)
    digest = xxhash.xxh64_intdigest
    n, ones = last + 1, np.zeros(64, "i8")
    for at in range(0, n, 65_536):
        to = min(n, at + 65_536)
        hashes = np.fromiter(
            (digest(line[a:b], HASH_SEED) for a, b in zip(starts[at:to], ends[at + min(shingle, len(words)) - 1 :], strict=False)), "<u8", to - at
        )
        ones += np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i8")
    bits = (ones * 2 > n).astype("u1")
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        found = np.array([fingerprint(x) for x in texts(batch.column("__text"))], "u8").view("i8")
        yield pa.record_batch([batch.column("uid"), batch.column("doc_id"), pa.array(found)], names=["uid", "doc_id", "fp"])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", uid: Column | None = None) -> DataFrame:
    """uid, doc_id, fp (the 64 bits as a long), one row per row of docs."""
    rows = docs.select((F.monotonically_increasing_id() if uid is None else uid).alias("uid"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("__text"))
    return rows.mapInArrow(_fingerprints, f"uid {dict(rows.dtypes)['uid']}, doc_id long, fp long")


class _Trie:
    """The binary trie of sorted distinct values, level by level: node bounds and children."""

    def __init__(self, values: np.ndarray, depth: int):
        self.values, self.lo, self.hi, self.child = values, [], [], []
        firsts = np.zeros(1, "i8")
        for level in range(depth + 1):
            bounds = np.append(firsts, len(values))
            self.lo.append(bounds[:-1])
            self.hi.append(bounds[1:])
            if level == depth:
                break
            prefix = values >> np.uint64(63 - level)
            firsts = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
            child = np.full((len(self.lo[-1]), 2), -1, "i8")
            parent = np.searchsorted(self.lo[-1], firsts, "right") - 1
            child[parent, (prefix[firsts] & np.uint64(1)).astype("i8")] = np.arange(len(firsts))
            self.child.append(child)


def _hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class _Forest:
    """Smallest member of each node's group; takes links in bulk."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, u: np.ndarray, v: np.ndarray) -> None:
        root = self.root
        while True:
            a, b = root[u], root[v]
            apart = a != b
            if not apart.any():
                return
            u, v, a, b = u[apart], v[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (up := root[root]).tobytes() != root.tobytes():
                root[:] = up


def near_links(a: np.ndarray, b: np.ndarray | None, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of all pairs within the budget between sorted distinct a and b (or within a)."""
    same = b is None
    values = a if same else np.unique(np.concatenate([a, b]))
    b = a if same else b
    if not len(a) or not len(b):
        return values[:0], values[:0]
    place_a, place_b = np.searchsorted(values, a), np.searchsorted(values, b)
    depth = min(64, max(1, int(np.ceil(np.log2(max(len(a), len(b))))) + 4))
    ta = _Trie(a, depth)
    tb = ta if same else _Trie(b, depth)
    forest = _Forest(len(values))

    def compare(level: int, x: np.ndarray, y: np.ndarray) -> None:
        """All pairs of values below the node pairs, in pieces of bounded size."""
        nx, ny = ta.hi[level][x] - ta.lo[level][x], tb.hi[level][y] - tb.lo[level][y]
        rows, at = np.repeat(np.arange(len(x)), nx), 0
        left = ta.lo[level][x][rows] + np.arange(len(rows)) - np.repeat(np.cumsum(nx) - nx, nx)
        sizes = ny[rows]
        ends = np.cumsum(sizes)
        while at < len(rows):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 4 * WALK)))
            size = sizes[at:to]
            one = np.repeat(left[at:to], size)
            two = np.repeat(tb.lo[level][y][rows[at:to]], size) + np.arange(len(one)) - np.repeat(np.cumsum(size) - size, size)
            near = _hamming(a[one], b[two]) <= budget
            if same:
                near &= one != two
            if near.any():
                forest.link(place_a[one[near]], place_b[two[near]])
            at = to

    work = [(0, np.zeros(1, "i8"), np.zeros(1, "i8"), np.zeros(1, "u1"))]
    while work:
        level, x, y, differ = work.pop()
        if len(x) > WALK:
            half = len(x) // 2
            work += [(level, x[:half], y[:half], differ[:half]), (level, x[half:], y[half:], differ[half:])]
            continue
        tiny = (ta.hi[level][x] - ta.lo[level][x]) * (tb.hi[level][y] - tb.lo[level][y]) <= DIRECT
        if level == depth:
            tiny[:] = True
        if tiny.any():
            compare(level, x[tiny], y[tiny])
            x, y, differ = x[~tiny], y[~tiny], differ[~tiny]
        if not len(x):
            continue
        down = []
        for i in (0, 1):
            for j in (0, 1):
                cx, cy, d = ta.child[level][x, i], tb.child[level][y, j], differ + (i != j)
                go = (cx >= 0) & (cy >= 0) & (d <= budget)
                if same:
                    go &= cx <= cy
                down.append((cx[go], cy[go], d[go]))
        if any(len(z[0]) for z in down):
            work.append((level + 1, *[np.concatenate(z) for z in zip(*down, strict=True)]))
    linked = np.flatnonzero(forest.root != np.arange(len(values)))
    return values[linked], values[forest.root[linked]]


def _links(budget: int):
    def links(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for left, right, same in zip(batch.column("left"), batch.column("right"), batch.column("same").to_pylist(), strict=True):
                a = np.sort(left.values.to_numpy(zero_copy_only=False).astype("i8").view("u8"))
                b = None if same else np.sort(right.values.to_numpy(zero_copy_only=False).astype("i8").view("u8"))
                one, two = near_links(a, b, budget)
                yield pa.record_batch([pa.array(one.view("i8")), pa.array(two.view("i8"))], names=["a", "b"])

    return links


def _masks(bits: int, budget: int) -> list[int]:
    return [m for m in range(1 << bits) if m.bit_count() <= budget]


def near_components(values: DataFrame, rows: int, budget: int = BUDGET, block: int = BLOCK) -> DataFrame:
    """fp (distinct longs, rows of them) -> node, root for every fingerprint linked to another one."""
    bits = min(16, bits_for(rows, block, least=2))
    cells = values.withColumn("cell", F.shiftrightunsigned("fp", 64 - bits))
    chunks = cells.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("long").alias("chunks"))
    blocks = written(
        cells.join(chunks, "cell").withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")))
        .groupBy("cell", "chunk").agg(F.collect_list("fp").alias("fps")),
        "simhash-blocks",
    )
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(bits, budget)])
    left = blocks.select(F.col("cell").alias("lcell"), F.col("chunk").alias("lchunk"), F.col("fps").alias("left"), F.explode(masks).alias("mask"))
    left = left.withColumn("cell", F.col("lcell").bitwiseXOR(F.col("mask"))).where("cell >= lcell").drop("mask")
    pairs = left.hint("merge").join(blocks.withColumnRenamed("fps", "right"), "cell").where("cell > lcell or chunk >= lchunk")
    pairs = pairs.select("left", "right", ((F.col("cell") == F.col("lcell")) & (F.col("chunk") == F.col("lchunk"))).alias("same"))
    return components(pairs.mapInArrow(_links(budget), "a long, b long"), "simhash-links")


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", budget: int = BUDGET, uid: Column | None = None) -> DataFrame:
    """uid, doc_id, fingerprint (16 hex digits), component_id, first (one row of each component), per row of docs."""
    rows = written(fingerprints(docs, doc_id, text, uid), "simhash-fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id"), F.col("uid"))
    values = written(rows.groupBy("fp").agg(F.min(order).alias("least")), "simhash-values")
    found = near_components(values.select("fp"), values.count(), budget)
    grouped = values.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    grouped = written(grouped, "simhash-groups")
    firsts = grouped.groupBy("root").agg(F.min("least").alias("least"))
    labels = grouped.select("fp", "root").join(firsts, "root").select("fp", "least")
    return rows.join(labels, "fp").select(
        "uid", "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least.doc_id").alias("component_id"),
        (F.col("least.uid") == F.col("uid")).alias("first"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", budget: int = BUDGET) -> DataFrame:
    """The rows of docs, one of every group of near copies (smallest id), with all their columns."""
    row = free(ROW, docs)
    rows = numbered(docs, "simhash-numbered", row)
    dropped = near_copies(rows, doc_id, text, budget, uid=F.col(row)).where("not first").select(F.col("uid").alias(row))
    return rows.join(dropped, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
