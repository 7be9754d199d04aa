"""Labelled rows, all or a bounded sample, and logistic fits of few weights for them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorefold.llm.common import id_remainder, written

#: Labelled rows that a sample has at most, of each class; the rest of the labels is not in it.
SAMPLE_PER_CLASS = 10_000


def held_out(doc_id: Column, divisor: int, remainder: int) -> Column:
    """Whether a row is kept from learning: crc32 of its id's text leaves this remainder; false for a null id."""
    return doc_id.isNotNull() & (id_remainder(doc_id, divisor) == remainder)


def training_labels(labels: DataFrame, label: str, divisor: int, remainder: int) -> tuple[DataFrame, dict[int, int]]:
    """doc_id, label of all labelled rows that are not held out, and how many each class has.

    Rows without an id or a label are left out; of repeated labels the largest counts.
    """
    all_labels = (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull()).where(~held_out(F.col("doc_id"), divisor, remainder))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    return all_labels, {int(x): n for x, n in all_labels.groupBy("label").count().collect() if x in (0, 1)}


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, divisor: int, remainder: int, per_class: int = SAMPLE_PER_CLASS
) -> tuple[DataFrame, dict[int, int]]:
    """doc_id, text, label of a bounded sample, and how many training labels each class has in all.

    Rows that are held out, have no id or no label are left out; of repeated labels
    the largest counts, of repeated ids' texts the one with the smallest hash.  The
    sample takes the smallest hashes of ids, so it is the same in every run.
    """
    all_labels, sizes = training_labels(labels, label, divisor, remainder)
    chosen = [all_labels.where(F.col("label") == x).orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(per_class) for x in (0, 1)]
    ids = F.broadcast(chosen[0].union(chosen[1]))  # 2 * per_class rows at most
    texts = docs.select(F.col("doc_id").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    order = F.struct(F.xxhash64("text").alias("hash"), F.col("text"))
    rows = texts.join(ids, "doc_id").groupBy("doc_id").agg(F.min(order).alias("least"), F.first("label").alias("label"))
    return written(rows.select("doc_id", F.col("least.text").alias("text"), "label"), f"sample-{label}"), sizes


def summed(rows: DataFrame, sums: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray | None:
    """The sum of what sums gives for the batches; None without rows.  Every task hands out one short array."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                total = sums(batch) if total is None else total + sums(batch)
        if total is not None:
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tolist()], pa.list_(pa.float64()))], names=["task", "total"])

    found = rows.mapInArrow(add, "task int, total array<double>").collect()
    return np.sum([r.total for r in sorted(found)], axis=0) if found else None


def vectors(column: pa.Array, width: int) -> np.ndarray:
    """A column of arrays of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def newton(sums: Callable[[np.ndarray], tuple], size: int, penalty: float, rounds: int = 50) -> np.ndarray:
    """Weights w minimising a convex loss plus penalty * |w|^2 / 2 by damped steps; sums gives loss, gradient and curvature at w."""

    def at(w: np.ndarray) -> tuple:
        loss, gradient, curve = sums(w)
        return float(loss + penalty * w @ w / 2), gradient + penalty * w, curve + penalty * np.eye(size)

    w = np.zeros(size)
    now = at(w)
    for _ in range(rounds):
        step, part = np.linalg.solve(now[2], now[1]), 1.0
        after = at(w - step)
        while part > 1e-6 and after[0] > now[0]:
            part /= 2
            after = at(w - part * step)
        if now[0] - after[0] < 1e-9 * max(1.0, abs(now[0])):
            break
        w, now = w - part * step, after
    return w


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, rounds: int = 50) -> np.ndarray:
    """Weights w minimising the weighted logistic loss of x @ w plus penalty * |w|^2 / 2."""

    def sums(w: np.ndarray) -> tuple:
        z = x @ w
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        return weight @ (np.logaddexp(0, z) - y * z), x.T @ (weight * (p - y)), (x * (weight * p * (1 - p))[:, None]).T @ x

    return newton(sums, x.shape[1], penalty, rounds)
