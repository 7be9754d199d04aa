"""Likelihood of texts summed over all segmentations of their words into subwords.

The pieces of an existing vocabulary get weights from the training texts: from
equal weights on, every round of expectation goes over all distinct training words.  A word is a lattice: every way to spell a blank
and the word by pieces is a path, a path's probability is the product of its
pieces' weights, and a forward pass adds up all paths.  The edges of every training
word's lattice (pieces and their places) are found once and written; the rounds and
the last scores are array operations over the edges of many words at once, on
products scaled by a constant per byte, which cancels.  Words that are longer, or
whose products leave the range of doubles, are added up one by one in log space.  Only a word's first piece begins with a blank, so a
text's words and its end follow from its pieces, and the pieces' probabilities
make a distribution over texts.  A training word is one more path, with its count
less a discount; the discounts' mass weighs the pieces (both are probabilities of
the same event, so the mixture is one too).

Word counts cover the whole training corpus and stay distributed.  The most
frequent words, so many as fit a fixed bound, are known to every task; the others
are joined by word.

Defined results: a null text is an empty one and has one token, its end; ids may
be null or repeat, every row is scored; without training texts every word is
unknown, the base has N = V = 0 and the pieces are equally likely; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import base64
import math
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorefold.llm.common import batches, id_remainder, texts, word_bytes, written
from scorefold.llm.training import held_out

#: Words that all tasks know at most; distinct words that a task counts before it passes them on.
HEAD_WORDS = 300_000
HOLD = 500_000
#: Bytes of such a word at most; longer ones are joined.
HEAD_BYTES = 64
#: Added to each piece's count; scores of words that a task remembers.
PIECE_PRIOR = 0.01
#: Rounds of expectation, each over all distinct words.
ROUNDS = 5
#: Bytes up to which a single word's paths are added up as plain numbers, if their sum is not too small for that.
SHORT = 24
SAFE = 1e-290
#: Bytes, blank included, up to which a word's edges are written; natural log of what a byte's weight is scaled by.
KEPT = 64
SCALE = 3.0
REMEMBERED = 200_000
LOG10 = math.log(10)


def _log_sum(a: float, b: float) -> float:
    """log(exp(a) + exp(b))."""
    if b == -math.inf:
        return a
    return b if a == -math.inf else max(a, b) + math.log1p(math.exp(-abs(a - b)))


class Pieces:
    """Pieces of a vocabulary file (base64 piece and number per line) with natural log weights; the end's is the last."""

    def __init__(self, pieces: list[bytes], log_weights: np.ndarray | None = None):
        if log_weights is None:
            log_weights = np.full(len(pieces) + 1, -math.log(len(pieces) + 1))
        self.pieces, self.end = pieces, float(log_weights[-1])
        # all beginnings of pieces, with the weight and number of those that are pieces themselves
        self.plain: dict[bytes, tuple[float, float, int]] = {}
        for i, piece in enumerate(pieces):
            for k in range(1, len(piece)):
                self.plain.setdefault(piece[:k], (0.0, -math.inf, -1))
            self.plain[piece] = (math.exp(log_weights[i]), float(log_weights[i]), i)

    def _edges(self, data: bytes, backwards: bool = False) -> Iterator[tuple[int, int, tuple[float, float, int]]]:
        get, n = self.plain.get, len(data)
        for i in reversed(range(n)) if backwards else range(n):
            for j in range(i + 1, n + 1):
                found = get(data[i:j])
                if found is None:
                    break
                if found[2] >= 0:
                    yield i, j, found

    def edges(self, data: bytes) -> list[int]:
        """Piece number * KEPT + place of every piece in data, which has KEPT bytes at most."""
        get, n, out = self.plain.get, len(data), []
        for i in range(n):
            for j in range(i + 1, n + 1):
                found = get(data[i:j])
                if found is None:
                    break
                if found[2] >= 0:
                    out.append(found[2] * KEPT + i)
        return out

    def spelled(self, data: bytes) -> float:
        """Natural log of the summed probability of all segmentations of data."""
        n = len(data)
        if n <= SHORT:
            sums = [1.0, *[0.0] * n]
            for i, j, (w, _, _) in self._edges(data):
                sums[j] += sums[i] * w
            if sums[n] > SAFE:
                return math.log(sums[n])
        return self._forward(data)[n]

    def _forward(self, data: bytes) -> array:
        """Natural log of the summed probability of all segmentations of each beginning of data."""
        forward = array("d", [-math.inf]) * (len(data) + 1)
        forward[0] = 0.0
        for i, j, (_, w, _) in self._edges(data):
            forward[j] = _log_sum(forward[j], forward[i] + w)
        return forward

    def word(self, word: bytes) -> float:
        return self.spelled(b" " + word)

    def expect(self, word: bytes, counts: dict[int, float]) -> None:
        """Add the expected number of each piece in a segmentation of the word to counts."""
        data = b" " + word
        if len(data) > SHORT:
            self._expect_long(data, counts)
            return
        n, edges = len(data), list(self._edges(data))
        forward, backward = [1.0, *[0.0] * n], [*[0.0] * n, 1.0]
        for i, j, (w, _, _) in edges:
            forward[j] += forward[i] * w
        for i, j, (w, _, _) in reversed(edges):
            backward[i] += w * backward[j]
        whole = forward[n]
        if whole <= SAFE:
            self._expect_long(data, counts)
            return
        for i, j, (w, _, k) in edges:
            if share := forward[i] * w * backward[j] / whole:
                counts[k] = counts.get(k, 0.0) + share

    def _expect_long(self, data: bytes, counts: dict[int, float]) -> None:
        """The same in log space, with the edges found again on the way back instead of kept."""
        forward = self._forward(data)
        whole = forward[-1]
        if whole == -math.inf:
            return
        backward = array("d", [-math.inf]) * len(forward)
        backward[-1] = 0.0
        for i, j, (_, w, k) in self._edges(data, backwards=True):
            backward[i] = _log_sum(backward[i], w + backward[j])
            if share := math.exp(min(0.0, forward[i] + w + backward[j] - whole)):
                counts[k] = counts.get(k, 0.0) + share


def vocabulary(path: str) -> list[bytes]:
    """The pieces of a file by their numbers."""
    with open(path, "rb") as lines:
        numbered = {int(i): base64.b64decode(piece) for piece, i in map(bytes.split, lines)}
    return [numbered[i] for i in range(len(numbered))]


def weights_of(counts: np.ndarray, prior: float) -> np.ndarray:
    return np.log((counts + prior) / (counts + prior).sum())


def _word_counts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, counts = pa.schema([("word", pa.binary()), ("n", pa.int64())]), Counter()

    def out():
        yield from batches({"word": list(counts.keys()), "n": list(counts.values())}, schema)

    for batch in rows:
        for text in texts(batch.column(0)):
            counts.update(word_bytes(text))
            if len(counts) >= HOLD:
                yield from out()
                counts.clear()
    if counts:
        yield from out()


def word_counts(training: DataFrame, text: str = "text") -> DataFrame:
    """word (bytes, A-Z lowered), c for every distinct word."""
    return training.select(text).mapInArrow(_word_counts, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


class Lattices:
    """The lattices of many words by their written edges, added up place by place for all words together."""

    def __init__(self, sizes: np.ndarray, per_word: np.ndarray, edges: np.ndarray, piece_sizes: np.ndarray, weights: np.ndarray):
        self.sizes, self.n = sizes, len(sizes)
        word, self.piece, start = np.repeat(np.arange(self.n), per_word), edges // KEPT, edges % KEPT
        end = start + piece_sizes[self.piece]
        self.word, self.start, self.end = word, start * self.n + word, end * self.n + word
        # log weights scaled by the bytes that a piece covers
        self.weight = np.exp(weights[self.piece] + SCALE * piece_sizes[self.piece])
        self.by_end, self.by_start = (self._places(x) for x in (end, start))
        self.forward = self._sums(1, range(1, KEPT + 1), self.by_end, self.start)

    @staticmethod
    def _places(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges in the order of a place, and where each place's begin."""
        return np.argsort(at.astype("u1"), kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(at, minlength=KEPT + 1))])

    def _sums(self, first: np.ndarray | int, places: range, order: tuple[np.ndarray, np.ndarray], other: np.ndarray) -> np.ndarray:
        """Sums of paths at every place of every word, from those at the edges' other ends."""
        sums = np.zeros((KEPT + 1) * self.n)
        sums[first if isinstance(first, np.ndarray) else slice(self.n)] = 1
        edges, begins = order
        for place in places:
            here = edges[begins[place] : begins[place + 1]]
            if len(here):
                row = slice(place * self.n, (place + 1) * self.n)
                sums[row] += np.bincount(self.word[here], sums[other[here]] * self.weight[here], self.n)
        return sums

    @property
    def last(self) -> np.ndarray:
        return self.sizes * self.n + np.arange(self.n)

    def logs(self) -> np.ndarray:
        """Natural log of each word's summed probability; NaN where the sum is too small for a plain number."""
        whole = self.forward[self.last]
        with np.errstate(divide="ignore"):
            return np.where(whole > SAFE, np.log(whole) - SCALE * self.sizes, np.nan)

    def expected(self, counts: np.ndarray) -> None:
        """Add the expected number of each piece in all words, but for those whose log is NaN, to counts."""
        backward = self._sums(self.last, range(KEPT - 1, -1, -1), self.by_start, self.end)
        whole = self.forward[self.last]
        one = np.divide(1.0, whole, out=np.zeros(self.n), where=whole > SAFE)
        share = self.forward[self.start] * self.weight * backward[self.end] * one[self.word]
        counts[:-1] += np.bincount(self.piece, share, len(counts) - 1)


def _edges_of(shared):
    def find(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = Pieces(shared.value)
        for batch in rows:
            found = [plain.edges(b" " + w) if len(w) < KEPT else None for w in batch.column("word").to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(found, pa.list_(pa.int32()))], names=[*batch.schema.names, "edges"])

    return find


def with_edges(counts: DataFrame, pieces: list[bytes]) -> DataFrame:
    """word, c and edges (see Pieces.edges; null for a word of KEPT bytes or more) of every word."""
    if len(pieces) >= 2**31 // KEPT:
        raise ValueError(f"{len(pieces)} pieces do not fit into the numbers of edges")
    shared = counts.sparkSession.sparkContext.broadcast(pieces)
    return counts.select("word", "c").mapInArrow(_edges_of(shared), "word binary, c long, edges array<int>")


class _Weighted:
    """A task's pieces with their weights: lattices of batches, and single words, for which a dictionary is made when one comes."""

    def __init__(self, pieces: list[bytes], weights: np.ndarray):
        self.pieces, self.weights, self._plain = pieces, weights, None
        self.piece_sizes = np.fromiter(map(len, pieces), "i8", len(pieces))

    @property
    def plain(self) -> Pieces:
        if self._plain is None:
            self._plain = Pieces(self.pieces, self.weights)
        return self._plain

    def lattices(self, batch: pa.RecordBatch) -> tuple[Lattices, np.ndarray, list[tuple[int, bytes]]]:
        """The batch's lattices, the logs of their sums, and the words (with their places) that have none."""
        edges = batch.column("edges")
        sizes = np.minimum(pc.binary_length(batch.column("word")).to_numpy().astype("i8") + 1, KEPT)
        per_word = pc.fill_null(pc.list_value_length(edges), 0).to_numpy()
        found = Lattices(sizes, per_word, edges.flatten().to_numpy().astype("i8"), self.piece_sizes, self.weights)
        logs = found.logs()
        return found, logs, [(i, batch.column("word")[i].as_py()) for i in np.flatnonzero(np.isnan(logs)).tolist()]


def _expected(shared, weights: np.ndarray):
    def expect(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _Weighted(shared.value, weights)
        counts, single = np.zeros(len(weights)), {}
        for batch in rows:
            found, _, rest = model.lattices(batch)
            found.expected(counts)
            for _, word in rest:
                model.plain.expect(word, single)
        for k, n in single.items():
            counts[k] += n
        some = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(some.astype("i4")), pa.array(counts[some])], names=["piece", "n"])

    return expect


def fitted(edges: DataFrame, pieces: list[bytes], prior: float = PIECE_PRIOR) -> np.ndarray:
    """piece_weights from a written table of edges."""
    shared = edges.sparkSession.sparkContext.broadcast(pieces)
    weights = np.full(len(pieces) + 1, -math.log(len(pieces) + 1))
    for _ in range(ROUNDS):
        expected = edges.select("word", "edges").mapInArrow(_expected(shared, weights), "piece int, n double")
        rows = expected.groupBy("piece").agg(F.sum("n").alias("n")).toPandas()  # one row per piece
        n = np.zeros(len(pieces) + 1)
        n[rows["piece"].to_numpy(dtype=int)] = rows["n"].to_numpy()
        n[-1] = 1
        weights = weights_of(n, prior)
    return weights


def piece_weights(counts: DataFrame, pieces: list[bytes], prior: float = PIECE_PRIOR) -> np.ndarray:
    """Natural log weights of all pieces and, last, of the end.

    Every distinct word counts once, as the pieces are for words that are rare or new.
    """
    return fitted(written(with_edges(counts, pieces), "lattice-edges"), pieces, prior)


def _word_logs(shared, weights: np.ndarray):
    def score(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _Weighted(shared.value, weights)
        for batch in rows:
            _, logs, rest = model.lattices(batch)
            for i, word in rest:
                logs[i] = model.plain.word(word)
            yield pa.record_batch([batch.column("word"), batch.column("c"), pa.array(logs)], names=["word", "c", "lattice"])

    return score


def word_logs(edges: DataFrame, pieces: list[bytes], weights: np.ndarray) -> DataFrame:
    """word, c and lattice, the natural log of the word's probability by pieces."""
    shared = edges.sparkSession.sparkContext.broadcast(pieces)
    return edges.mapInArrow(_word_logs(shared, weights), "word binary, c long, lattice double")


def head_rows(counts: DataFrame, most: int = HEAD_WORDS) -> DataFrame | None:
    """The rows of the highest counts, at most so many: all words above one count, of HEAD_BYTES at most."""
    counts = counts.where(F.length("word") <= HEAD_BYTES)
    tiers = counts.groupBy(F.least("c", F.lit(1 << 16)).alias("c")).count().orderBy(F.desc("c")).collect()  # 65536 rows at most
    least, sum_ = None, 0
    for tier in tiers:
        sum_ += tier["count"]
        if sum_ > most:
            break
        least = tier["c"]
    return None if least is None else counts.where(F.col("c") >= least)


def head_of(counts: DataFrame, most: int = HEAD_WORDS) -> dict[bytes, int]:
    """The words of head_rows with their counts."""
    rows = head_rows(counts, most)
    if rows is None:
        return {}
    head = rows.toPandas()
    return dict(zip(map(bytes, head["word"]), head["c"].tolist(), strict=True))


class Model:
    """Base and model log10 probabilities of a word by its training count."""

    def __init__(self, pieces: Pieces | None, total: int, distinct: int, discount: float):
        self.pieces, self.total, self.distinct, self.discount = pieces, total, distinct, discount
        # natural log of the mass that the discounts leave to the pieces
        self.left = math.log(discount * distinct / total) if total else 0.0

    def base(self, c: np.ndarray | int) -> np.ndarray:
        return np.log10((np.asarray(c) + 0.5) / (self.total + 0.5 * (self.distinct + 1)))

    def mixed(self, c: np.ndarray | int, lattice: np.ndarray | float) -> np.ndarray:
        """log10 of the count's share less the discount plus the pieces' share."""
        c, by_pieces = np.asarray(c, float), self.left + np.asarray(lattice)
        by_count = np.log(np.where(c > 0, c - self.discount, 1) / max(1, self.total))
        return np.where(c > 0, np.logaddexp(by_count, by_pieces), by_pieces) / LOG10


def _document_rows(shared):
    def score(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, values = shared.value  # word -> row of (base, score, lattice)
        documents = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("word", pa.binary()), ("n", pa.int64()), ("base", pa.float64()), ("score", pa.float64()),
                               ("lattice", pa.float64()), ("known", pa.int64())])
        end = values[0]
        for batch in rows:
            out: list[tuple] = []
            for uid, doc_id, text in zip(batch.column("uid").to_pylist(), batch.column("doc_id").to_pylist(), texts(batch.column("__text")), strict=True):
                counts = Counter(word_bytes(text))
                n_tokens = counts.total() + 1
                at = np.fromiter(map(places.get, counts, [-1] * len(counts)), "i8", len(counts))
                n = np.fromiter(counts.values(), "i8", len(counts))
                inside = at >= 0
                base, model, lattice = (n[inside] @ values[at[inside], :3]) + end[:3]
                out.append((uid, doc_id, None, n_tokens, base, model, lattice, int(n[inside].sum()) + int(end[3])))
                out += [(uid, None, w, c, None, None, None, None) for (w, c), known in zip(counts.items(), inside.tolist(), strict=True) if not known]
                if len(out) >= 50_000:
                    yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), documents, strict=True)], schema=documents)
                    out = []
            if out:
                yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), documents, strict=True)], schema=documents)

    return score


def _tail_rows(model: Model, shared, weights: np.ndarray):
    def score(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, seen = _Weighted(shared.value, weights), {}
        for batch in rows:
            c = pc.fill_null(batch.column("c"), 0).to_numpy()
            lattice = batch.column("lattice").to_numpy(zero_copy_only=False).copy()
            new = np.flatnonzero(c == 0)
            if len(seen) > REMEMBERED:
                seen.clear()
            for i, w in zip(new.tolist(), batch.column("word").take(pa.array(new)).to_pylist(), strict=True):
                if (found := seen.get(w)) is None:
                    found = seen[w] = pieces.plain.word(w)
                lattice[i] = found
            n = batch.column("n").to_numpy()
            out = [model.base(c) * n, model.mixed(c, lattice) * n, lattice / LOG10 * n]
            yield pa.record_batch([batch.column("uid"), *map(pa.array, out), pa.array(np.where(c > 0, n, 0))], names=["uid", "base", "score", "lattice", "known"])

    return score


def likelihood(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", divisor: int = 5, remainder: int = 1,
               path: str | None = None, head_words: int = HEAD_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score per row of docs.

    path names the vocabulary file, on every executor.  lattice_score is the text's
    log10 probability by pieces alone.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    spark = docs.sparkSession
    training = docs.where(id_remainder(F.col(doc_id), divisor) != remainder)
    pieces = vocabulary(path)
    counts = written(with_edges(word_counts(training, text), pieces), "lattice-edges")
    ends = training.count()
    words, tokens, ones, twos = counts.agg(F.count("*"), F.sum("c"), F.sum((F.col("c") == 1).cast("long")), F.sum((F.col("c") == 2).cast("long"))).first()
    total, distinct = (tokens or 0) + ends, words + bool(ends)
    discount = min(0.95, max(0.05, (ones or 0) / max(1, (ones or 0) + 2 * (twos or 0))))
    weights = fitted(counts, pieces) if words else np.full(len(pieces) + 1, -math.log(len(pieces) + 1))
    counts = written(word_logs(counts, pieces, weights), "lattice-words")
    model, end = Model(None, total, distinct, discount), float(weights[-1])

    places, c, lattice = {}, np.array([ends]), np.array([end])
    if (head := head_rows(counts, head_words)) is not None:
        head = head.toPandas()
        places = {bytes(w): i + 1 for i, w in enumerate(head["word"])}
        c, lattice = np.concatenate([c, head["c"]]), np.concatenate([lattice, head["lattice"]])
    values = np.column_stack([model.base(c), model.mixed(c, lattice), lattice / LOG10, c > 0])
    shared = spark.sparkContext.broadcast((places, values))

    numbered = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("__text"))
    rows = written(
        numbered.mapInArrow(_document_rows(shared), "uid long, doc_id long, word binary, n long, base double, score double, lattice double, known long"),
        "lattice-rows",
    )
    known = spark.sparkContext.broadcast(pieces)
    tail = rows.where("word is not null").select("uid", "word", "n")
    scored = tail.join(counts, "word", "left").select("uid", "word", "n", "c", "lattice").mapInArrow(_tail_rows(model, known, weights), "uid long, base double, score double, lattice double, known long")
    sums = scored.groupBy("uid").agg(*[F.sum(c).alias(f"tail_{c}") for c in ("base", "score", "lattice", "known")])
    heads = rows.where("word is null").select("uid", "doc_id", "n", "base", "score", "lattice", "known")
    both = lambda c: F.col(c) + F.coalesce(F.col(f"tail_{c}"), F.lit(0))
    return heads.join(sums, "uid", "left").select(
        "doc_id", held_out(F.col("doc_id"), divisor, remainder).alias("held_out"), F.col("n").alias("n_tokens"), both("known").cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), both("base").alias("base_score"), both("score").alias("score"), both("lattice").alias("lattice_score"),
    )
