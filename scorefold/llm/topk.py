"""Exact top inner products between vectors of integers.

Vectors are sorted by length and cut into blocks, longest first.  A query's twenty
best among the longest vectors give a floor for its result.  A block is skipped
for a query if the product of lengths cannot reach the floor.  In the others,
vectors and queries are rotated so that the first coordinates carry most of the
length (singular vectors of a bounded sample; any rotation gives right results):
the product of the first coordinates plus the product of the lengths of the rest
bounds the score (Cauchy-Schwarz), and only pairs whose bound reaches the floor
are scored, in exact integers.  The floor rises as a task goes through its block.

Defined results: vectors that are null or hold null, NaN or infinite components
take no part; shorter vectors count as filled up with zeros, an empty one scores 0
with all; ids may repeat, every row but the query's own id is a candidate, and
each query row has its result; null ids take no part; an empty table gives an
empty result; other columns are not looked at.  Scores beyond 64 bits are cut off
at the largest long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorefold.llm.common import written

K = 20
SCALE = 64
QUERY_EVERY = 20
#: Vectors and queries in a block; longest vectors that give the floors; vectors that the rotation is fitted on.
BLOCK = 2048
QUERY_BLOCK = 8192
#: Blocks that one task works through with its block of queries.
RUN = 8
SEED_ROWS = 4096
SAMPLE = 4096
#: Share of coordinates in the partial product; share of pairs above which a block is multiplied as a whole.
HEAD = 4
DENSE = 0.05
#: Components up to this size keep sums of 2^10 products exact in a double.
EXACT = 1 << 21


def integer_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, v (the integers over scale, a power of two, so that none overflows), norm2 for the rows that take part."""
    own = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= 1.7976931348623157e308))
    # components whose multiple is whole anyway stay what they are
    floor = lambda c: F.when(F.abs(c) < 2.0**52 / scale, F.floor(c * scale).cast("double") / scale).otherwise(c)
    whole = own.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & finite).select("vec_id", F.transform("x", floor).alias("v"))
    return whole.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c))


def _matrix(column: pa.Array | pd.Series, width: int) -> np.ndarray:
    """The lists as rows, filled up with zeros."""
    column = column if isinstance(column, pa.Array) else pa.array(column, pa.list_(pa.float64()))
    lengths, values = column.value_lengths().to_numpy(zero_copy_only=False), column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = values
    return out


def _small(*rows: np.ndarray) -> bool:
    """Whether sums of products are exact in doubles."""
    return all(np.abs(m).max(initial=0) <= EXACT / SCALE and m.shape[1] <= 1024 for m in rows)


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of rows with rows, cut off at the range of a long."""
    if _small(q, x):
        return ((q * SCALE) @ (x * SCALE).T).astype("i8")
    integer = lambda c: int(c) * SCALE if abs(c) > 2.0**60 else int(c * SCALE)
    whole, top = [[integer(c) for c in r] for r in x.tolist()], (1 << 63) - 1
    rows = [[integer(c) for c in r] for r in q.tolist()]
    return np.array([[max(-top - 1, min(top, sum(a * b for a, b in zip(row, r, strict=True)))) for r in whole] for row in rows], "i8").reshape(len(q), len(x))


def _scaled(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows over powers of two, and these: 1 unless squares might leave the range of a double."""
    largest = np.abs(rows).max(1, initial=0)
    scale = np.ldexp(1.0, np.where((largest > 1e60) | (largest < 1e-60) & (largest > 0), np.frexp(largest)[1] - 1, 0))
    return rows / scale[:, None], scale


def rotation(sample: np.ndarray) -> np.ndarray:
    """An orthogonal matrix whose first columns carry most of the sample's length."""
    scale = np.abs(sample).max(initial=0) or 1.0
    return np.linalg.svd((sample / scale).T @ (sample / scale), hermitian=True)[0]


def block_top(q_ids: np.ndarray, q: np.ndarray, floors: np.ndarray, x_ids: np.ndarray, x: np.ndarray, turn: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query rows, candidate rows and scores of one block that may belong to the queries' k best.

    floors: a lower bound of each query's k-th best score (-inf without one).
    """
    (sq, scale_q), (sx, scale_x) = _scaled(q), _scaled(x)
    with np.errstate(over="ignore"):
        order = np.argsort(-np.linalg.norm(sx, axis=1) * scale_x, kind="stable")
    x, x_ids, sx, scale_x = x[order], x_ids[order], sx[order], scale_x[order]
    norm_q, norm_x = np.linalg.norm(sq, axis=1), np.linalg.norm(sx, axis=1)
    head = max(1, x.shape[1] // HEAD)
    rq, rx = sq @ turn, sx @ turn
    rest_q, rest_x = np.linalg.norm(rq[:, head:], axis=1), np.linalg.norm(rx[:, head:], axis=1)

    def reaches(bound: np.ndarray, rows: np.ndarray, columns: slice) -> np.ndarray:
        """Whether a bound of scaled rows, with room for rounding, may reach the floors; one that is no number may."""
        with np.errstate(over="ignore", invalid="ignore"):
            room = bound + 1e-9 * norm_q[rows, None] * norm_x[None, columns]
            return ~(room * (scale_q[rows, None] * scale_x[None, columns]) * SCALE**2 + 1e-6 < floors[rows, None])

    floors = floors.astype(float).copy()
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    best = [np.full((len(q), k), -np.inf)]
    small = _small(q, x)
    for at in range(0, len(x), 512):
        to = min(at + 512, len(x))
        live = np.flatnonzero(reaches(norm_q[:, None] * norm_x[None, at : at + 1], np.arange(len(q)), slice(at, at + 1)))
        if not len(live):
            break  # all further vectors are shorter
        bound = rq[live, :head] @ rx[at:to, :head].T + rest_q[live, None] * rest_x[None, at:to]
        may = reaches(bound, live, slice(at, to)) & (q_ids[live, None] != x_ids[None, at:to])
        if not may.any():
            continue
        rows, columns = np.nonzero(may)
        if len(rows) > DENSE * may.size or not small:
            score = _exact(q[live], x[at:to])[rows, columns]
        else:
            score = np.einsum("ij,ij->i", q[live[rows]] * SCALE, x[at + columns] * SCALE).astype("i8")
        rows = live[rows]
        keep = score >= floors[rows]
        rows, columns, score = rows[keep], columns[keep], score[keep]
        found.append((rows, at + columns, score))
        # the k best so far raise the floors
        if len(rows):
            order_in = np.lexsort((-score, rows))
            r, s = rows[order_in], score[order_in]
            first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
            place = np.arange(len(r)) - np.repeat(first, np.diff(np.r_[first, len(r)]))
            top = np.full((len(q), k), -np.inf)
            top[r[place < k], place[place < k]] = s[place < k]
            best[0] = -np.sort(-np.hstack([best[0], top]), axis=1)[:, :k]
            floors = np.maximum(floors, best[0][:, k - 1])
    if not found:
        return np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0, "i8")
    rows, columns, score = (np.concatenate(z) for z in zip(*found, strict=True))
    keep = score >= floors[rows]
    return rows[keep], x_ids[columns[keep]], score[keep]


def top_inner_products(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K, query: Column | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest scores, ties to smaller ids.

    The queries are the rows whose id is divisible by 20, or those that the column
    `query` marks.  Blocks of queries meet blocks of vectors; every block is bounded.
    """
    query = (F.col("vec_id") % QUERY_EVERY == 0) if query is None else query
    vectors = written(integer_vectors(rows, vec_id, embedding), "topk-vectors")
    total, width, queries_n = vectors.agg(F.count("*"), F.max(F.size("v")), F.sum(query.cast("long"))).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not queries_n or total < 2:
        return rows.sparkSession.createDataFrame([], schema)
    width = max(1, width)
    longest = vectors.orderBy(F.desc("norm2"), "vec_id").limit(SEED_ROWS).toPandas()
    seeds, seed_ids = _matrix(longest["v"], width), longest["vec_id"].to_numpy()
    turn = rotation(seeds[:SAMPLE])

    # queries in blocks, with the floor that the longest vectors give
    def with_floor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, q = batch.column("vec_id").to_numpy(), _matrix(batch.column("v"), width)
            floor = np.full(len(ids), -np.inf)
            for at in range(0, len(ids) if len(seeds) >= k else 0, 512):
                score = _exact(q[at : at + 512], seeds).astype(float)
                score[ids[at : at + 512, None] == seed_ids[None, :]] = -np.inf
                floor[at : at + 512] = -np.partition(-score, k - 1, axis=1)[:, k - 1]
            yield pa.record_batch([batch.column("vec_id"), batch.column("row"), batch.column("v"), pa.array(floor), batch.column("norm2")],
                                  names=["vec_id", "row", "v", "floor", "norm2"])

    numbered = vectors.withColumn("row", F.monotonically_increasing_id())
    queries = numbered.where(query).mapInArrow(with_floor, "vec_id long, row long, v array<double>, floor double, norm2 double")
    q_blocks = -(-queries_n // QUERY_BLOCK)
    queries = written(queries.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(q_blocks))), "topk-queries")
    # vectors in blocks by length: bounds at equal shares of the lengths' distribution, equal lengths spread by a hash
    x_blocks = -(-total // BLOCK)
    bounds = vectors.approxQuantile("norm2", [i / x_blocks for i in range(1, x_blocks)], 0.2 / x_blocks) if 1 < x_blocks <= 4096 else []
    if x_blocks > 4096:
        bounds = vectors.approxQuantile("norm2", [i / 4096 for i in range(1, 4096)], 0.2 / 4096)
    bounds = sorted(set(bounds))
    band = F.lit(0) if not bounds else F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col("norm2")))
    banded = vectors.withColumn("band", band)
    sizes = banded.groupBy("band").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("parts"))
    banded = banded.join(sizes, "band").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")))
    # which blocks of queries a block of vectors must meet is known by their lengths and lowest floors, before any vector moves
    runs = max(1, -(-x_blocks // RUN))
    lengths = banded.groupBy("band", "part").agg(F.max("norm2").alias("x_norm2"))
    lengths = lengths.withColumn("run", F.pmod(F.xxhash64("band", "part"), F.lit(runs)))
    lengths = lengths.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long"))))
    meet = lengths.join(queries.groupBy("chunk").agg(F.min("floor").alias("floor"), F.max("norm2").alias("q_norm2")), "chunk")
    meet = meet.where((F.col("floor") <= 0) | (F.sqrt(F.col("q_norm2")) * F.sqrt(F.col("x_norm2")) * SCALE**2 * 1.000001 + 1 >= F.col("floor")))
    meet = written(meet.select("band", "part", "chunk", "run"), "topk-meet")
    blocks = banded.groupBy("band", "part").agg(F.collect_list(F.struct("vec_id", "v")).alias("vectors"))
    chunks = queries.groupBy("chunk").agg(F.collect_list(F.struct("vec_id", "row", "v", "floor")).alias("queries"))
    # RUN blocks to a task with their block of queries
    left = blocks.hint("merge").join(meet, ["band", "part"])
    pairs = left.hint("merge").join(chunks.hint("merge").join(meet.select("chunk", "run").distinct(), "chunk"), ["chunk", "run"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own, other = batch.column("queries")[i].values, batch.column("vectors")[i].values
                q_ids, q_rows, floors = (own.field(f).to_numpy(zero_copy_only=False) for f in ("vec_id", "row", "floor"))
                x_ids = other.field("vec_id").to_numpy(zero_copy_only=False)
                r, ids, s = block_top(q_ids, _matrix(own.field("v"), width), floors, x_ids, _matrix(other.field("v"), width), turn, k)
                yield pa.record_batch([pa.array(q_rows[r]), pa.array(q_ids[r]), pa.array(ids), pa.array(s)], names=["row", "query_id", "vec_id", "score"])

    found = pairs.select("queries", "vectors").mapInArrow(score, "row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
