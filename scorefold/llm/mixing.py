"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks.

Every source's documents are shuffled by a hash and laid end to end, again and
again if its target is larger than the source; that endless text is cut into
blocks of block_words words.  The schedule has one slot for each block that the
mix takes.  Slot i gets the van der Corput point of i (its bits reversed); the
points of N slots are spread evenly, so mapping them through the cumulative
shares of the sources gives every source exactly its number of slots and, in any
stretch of the schedule, close to its share.  The slots of a source are ranked
and slot number r of a source takes its block r.

Defined results: a null text has size 0 and is never taken; a null source is a
source of its own, after all others; a null id and repeated rows are documents
like any other; with no words at all every target is 0 and the schedule is
empty; an empty table gives empty results; other columns are not looked at.
Ties in the shuffle order are broken by id and size.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorefold.llm.common import ROW, WORD, free, numbered, written

WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 256
CAP = 3
SEED = "mix"
#: Rows that one window sorts at most: documents of a hash bucket (on average), slots of a stretch.
STRETCH = 1024


class Mix(NamedTuple):
    """documents: uid, doc_id, size, source, source_size, target.
    schedule: slot (the order of the mix), source, uid, doc_id, epoch, start, length (words of the document)."""

    documents: DataFrame
    schedule: DataFrame


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Add weight and target to source, source_size: one row per source, as many as there are sources.

    Sources in code point order, null last, take the weights in turn and share the
    sum of all sizes; no target exceeds cap times its source, the excess goes to the
    others by weight.  With the sources sorted by the share at which they fill up,
    the first that stays below its cap fixes the level for all that follow.
    """
    all_rows = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    ranked = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int")))
    full = (F.col("source_size") * cap).cast("long")
    by_level = Window.orderBy(full / F.col("weight"), F.col("source").isNull(), "source")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(0, Window.unboundedFollowing)
    levels = (
        ranked.withColumn("at", F.row_number().over(by_level))
        .withColumn("left", F.sum("source_size").over(all_rows) - F.coalesce(F.sum(full).over(before), F.lit(0)))
        .withColumn("level", F.col("left").cast("double") / F.sum("weight").over(onward))
    )
    fits = F.when(F.col("level") * F.col("weight") <= full, F.struct("at", "level"))
    return (
        levels.withColumn("level", F.min(fits).over(all_rows)["level"])
        .withColumn("target", F.least(full.cast("double"), F.col("level") * F.col("weight")))
        .select("source", "source_size", "weight", "target")
    )


def reversed_bits(x: Column, bits: Column) -> Column:
    """The lowest bits of x in reverse order, for bits up to 62."""
    for shift, mask in ((1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F),
                        (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF), (32, 0x00000000FFFFFFFF)):
        m = F.lit(mask)
        x = F.shiftrightunsigned(x, shift).bitwiseAND(m).bitwiseOR(F.shiftleft(x.bitwiseAND(m), shift))
    return F.call_function("shiftrightunsigned", x, (64 - bits).cast("int"))


def slots(quotas: DataFrame) -> DataFrame:
    """source_key, blocks -> slot, source_key, rank: the schedule, with the slots of a source ranked from 0."""
    first = Window.orderBy("source_key").rowsBetween(Window.unboundedPreceding, -1)
    shares = (
        quotas.withColumn("first", F.coalesce(F.sum("blocks").over(first), F.lit(0)))
        .withColumn("all", F.sum("blocks").over(Window.partitionBy()))
        .where("blocks > 0")
        .withColumn("bits", F.length(F.bin(F.col("all"))))
    )
    # a source's points in two steps, so that no array grows with the corpus beyond a few MB
    points = (
        shares.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(blocks - 1) div 4096"))))
        .withColumn("point", F.explode(F.expr("sequence(first + chunk * 4096, first + least(blocks, (chunk + 1) * 4096) - 1)")))
        .select("source_key", reversed_bits(F.col("point"), F.col("bits")).alias("slot"))
        .withColumn("stretch", F.shiftright("slot", 12))
    )
    counts = points.groupBy("source_key", "stretch").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source_key").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("source_key", "stretch", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ranked"))
    within = Window.partitionBy("source_key", "stretch").orderBy("slot")
    # Spark takes exploded rows for as few as before; the hint keeps it from sending them to every task
    return points.hint("merge").join(starts, ["source_key", "stretch"]).select(
        "slot", "source_key", (F.col("ranked") + F.row_number().over(within) - 1).alias("rank")
    )


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, block_words: int = BLOCK_WORDS, cap: int = CAP, seed: str = SEED,
    uid: Column | None = None,
) -> Mix:
    """The mix of all documents.  Sizes are counted in one scan and written once; texts are not moved.

    uid: a column that names a row, if docs has one; else rows are numbered here.
    """
    sized = written(
        docs.select(
            (F.monotonically_increasing_id() if uid is None else uid).alias("uid"), F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"), F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ).withColumn("order_key", F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
        .withColumn("source_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    , "mix-sizes")
    digits, reach = 0, STRETCH
    rows = sized.count()
    while reach < rows:
        digits, reach = digits + 1, reach * 16
    sized = sized.withColumn("bucket", F.substring("order_key", 1, digits))

    sources = written(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
                      .withColumn("source_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
                      .withColumn("take", F.floor(F.col("target") + 0.5)), "mix-targets")
    schedule_slots = slots(sources.select("source_key", F.expr(f"(take + {block_words - 1}) div {block_words}").alias("blocks")))

    # where each document starts in its source: sums per bucket, then within the bucket
    earlier = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        sized.groupBy("source_key", "bucket").agg(F.sum("size").alias("words"))
        .select("source_key", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("words_before"))
    )
    within = Window.partitionBy("source_key", "bucket").orderBy("order_key", "doc_id", "size", "uid").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        sized.where("size > 0").join(buckets, ["source_key", "bucket"])
        .withColumn("begin", F.col("words_before") + F.sum("size").over(within) - F.col("size"))
        .join(sources.where("take > 0").select("source_key", "source_size", "take"), "source_key")
    )
    # a document's parts in the blocks, for each time that the source is gone through
    parts = (
        placed.withColumn("epoch", F.explode(F.expr("sequence(0L, (take - 1) div source_size)")))
        .withColumn("begin", F.col("begin") + F.col("epoch") * F.col("source_size"))
        .where("begin < take")
        .withColumn("end", F.expr("least(begin + size, take)"))
        .withColumn("rank", F.explode(F.expr(f"sequence(begin div {block_words}, (end - 1) div {block_words})")))
        .withColumn("from", F.expr(f"greatest(begin, rank * {block_words})"))
        .withColumn("length", F.expr(f"least(end, (rank + 1) * {block_words})") - F.col("from"))
        .select("source_key", "rank", "source", "uid", "doc_id", "epoch", (F.col("from") - F.col("begin")).alias("start"), "length")
    )
    schedule = schedule_slots.hint("merge").join(parts, ["source_key", "rank"]).select(
        "slot", "source", "uid", "doc_id", "epoch", "start", "length"
    )
    documents = sized.join(sources.select("source_key", "source_size", "target"), "source_key").select(
        "uid", "doc_id", "size", "source", "source_size", "target"
    )
    return Mix(documents, schedule)


def taken(mixed: Mix) -> DataFrame:
    """doc_id, size, source_size, target, taken: what the schedule takes of each document."""
    words = mixed.schedule.groupBy("uid").agg(F.sum("length").alias("taken"))
    return mixed.documents.join(words, "uid", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, block_words: int = BLOCK_WORDS, cap: int = CAP) -> DataFrame:
    """The rows of docs (doc_id, text, lang, source, n_chars, ...) as often as the mix takes them.

    A document that the end of its source's target cuts keeps the words before the cut.
    """
    row, words, size = (free(x, docs) for x in (ROW, "__words", "__size"))
    rows = numbered(docs, "mix-numbered", row)
    mixed = mix(rows, weights=weights, block_words=block_words, cap=cap, uid=F.col(row))
    copies = mixed.schedule.groupBy("uid", "epoch").agg(F.sum("length").alias(words))
    sizes = mixed.documents.select("uid", "size")
    kept = copies.join(sizes, "uid").select(F.col("uid").alias(row), words, F.col("size").alias(size))
    # pieces that each end with a word, so the first n pieces hold the first n words
    pieces = F.split("text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])", -1)
    cut = F.when(F.col(words) < F.col(size), F.array_join(F.slice(pieces, F.lit(1), F.col(words).cast("int")), "")).otherwise(F.col("text"))
    out = rows.join(kept, row).withColumn("text", cut)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(words) < F.col(size), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
