"""Vector codes: product quantisation with whole numbers and Drake-Hamerly adaptive bounds.

Every component x counts as floor(256 * x).  A vector is cut into equal consecutive
parts; each part position has a codebook, which starts as that part of the vectors with
the smallest ids.  In each round every part goes to its nearest entry, then entries
become the floored means of their parts; after the last round parts are assigned again.

The first assignment measures all entries.  It keeps, for every part, its b closest
entries in order, a lower bound for each but the first, and one outer bound for all
others; these are written with the vectors.  After the entries have moved, a bound falls
by its entry's move and the outer bound by the largest move.  A part whose exact
distance to its own entry is below all bounds stays; otherwise only the entries whose
bounds it reaches are measured, and all of them only if it reaches the outer bound.
b starts at a quarter of the entries and shrinks, batch by batch, to what nearly all
parts needed, an eighth at least.  Bounds are rounded down, so ties and doubtful cases
are always measured.

Distances are exact in double precision as long as components are below some millions
(`_exact_up_to`); beyond, entries whose rounded distances overlap are compared in whole
numbers of any size, and errors are computed in them.

Defined results: vectors that are null or hold null, NaN or infinite components take no
part; shorter vectors count as filled up with zeros, and so does a width that the parts
do not divide; rows with a null id come last in the order of ids, equal ids are ordered
by their components; fewer vectors than entries give fewer entries, an empty table an
empty result; errors beyond 64 bits are cut off at the largest long; null labels are one
label; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorefold.llm.common import small, written

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Share of a batch's parts whose entries must be within b; label sums that are broadcast (16 bytes and a label each).
COVER = 0.99
BROADCAST_LABELS = 100_000
#: Rows that a task measures at once.
CHUNK = 4096
_LONG = (1 << 63) - 1
#: Whole numbers travel to the driver as digits of this base, so that any size can be summed.
_DIGIT = 60


def kept_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label, v of the rows that take part; v holds floor(256 * x) / 256, which a double holds exactly."""
    own = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= 1.7976931348623157e308))
    floor = lambda c: F.when(F.abs(c) < 2.0**44, F.floor(c * SCALE).cast("double") / SCALE).otherwise(c)
    return own.where(F.col("x").isNotNull() & finite).select("vec_id", "label", F.transform("x", floor).alias("v"))


def _whole(x: float) -> int:
    """The integer that a component on the grid of 1 / 256 stands for."""
    return int(x * SCALE) if abs(x) < 2.0**44 else int(x) * SCALE


def _exact_up_to(width: int) -> float:
    """Components (on the grid) up to which squared distances of parts are exact in a double."""
    return math.sqrt(2.0**50 / max(1, width)) / SCALE


class Codebooks(NamedTuple):
    """Entries of all parts: whole numbers, and the same on the grid of 1 / 256 times 2^-shift."""

    whole: list[list[list[int]]]
    near: np.ndarray  # part, entry, position
    slack: np.ndarray  # part, entry: how far `near` may be from the entry
    shift: int
    exact: float  # components up to which distances are exact, on the scaled grid; negative: never


def codebooks(whole: list[list[list[int]]], largest: float) -> Codebooks:
    """largest: the largest component of the table, on the grid."""
    shift = max(0, math.frexp(largest)[1] - 400)
    # a quotient of whole numbers is rounded once, whatever their size
    near = np.array([[[c / (SCALE << shift) for c in entry] for entry in part] for part in whole], float)
    kept = lambda f, c: (r := float(f).as_integer_ratio())[0] * (SCALE << shift) == c * r[1]
    same = np.array([[all(map(kept, a, entry)) for a, entry in zip(x, part, strict=True)] for x, part in zip(near, whole, strict=True)], bool)
    slack = np.where(same, 0.0, np.abs(near).max(axis=2, initial=0) * 2.0**-50 * near.shape[2])
    slack += 2.0**-500 if shift else 0.0  # squares of small parts may vanish on the scaled grid
    return Codebooks(whole, near, slack, shift, _exact_up_to(near.shape[2]) if shift == 0 else -1.0)


def digest(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(c) for part in books.whole for entry in part for c in entry).encode()).hexdigest()


class _Part:
    """One part of some vectors against its codebook."""

    def __init__(self, x: np.ndarray, part: int, books: Codebooks):
        self.x, self.books, self.part = np.ldexp(x, -books.shift), books, part
        self.raw, self.c, self.slack = x, books.near[part], books.slack[part]
        self.sure = books.exact > 0 and np.abs(self.x).max(initial=0) <= books.exact and np.abs(self.c).max(initial=0) <= books.exact

    def squares(self, rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Squared distances of rows to the entries listed for each."""
        d = self.x[rows][:, None, :] - self.c[entries]
        return np.einsum("ijk,ijk->ij", d, d)

    def all_squares(self, rows: np.ndarray) -> np.ndarray:
        x, c = self.x[rows], self.c
        if self.sure:  # every product and sum is a whole number below 2^53 on its grid
            return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]
        return ((x[:, None, :] - c[None]) ** 2).sum(2)

    def error(self, row: int, entry: int) -> int:
        return sum((_whole(float(a)) - b) ** 2 for a, b in zip(self.raw[row], self.books.whole[self.part][entry], strict=True))

    def nearest(self, rows: np.ndarray, entries: np.ndarray, square: np.ndarray) -> np.ndarray:
        """The place, in each row of entries, of the nearest one (ties: the lowest index)."""
        if self.sure:
            return np.where(square == square.min(1, keepdims=True), entries, len(self.c)).argmin(1)
        slack, d = self.slack[entries], np.sqrt(square)
        may = d * (1 - 1e-12) - slack <= (d * (1 + 1e-12) + slack).min(1, keepdims=True)
        out = may.argmax(1)
        for i in np.flatnonzero(may.sum(1) > 1):
            out[i] = min(np.flatnonzero(may[i]), key=lambda j: (self.error(rows[i], entries[i, j]), entries[i, j]))
        return out

    def low(self, square: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Distances, rounded down."""
        return np.maximum(np.sqrt(square) * (1 - 1e-9) - self.slack[entries], 0)

    def high(self, square: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Distances, rounded up."""
        return np.sqrt(square) * (1 + 1e-9) + self.slack[entries]


def _ranked(part: _Part, rows: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """All entries measured: the b closest, nearest first, and bounds: of each but the first, and the outer one."""
    d = part.all_squares(rows)
    n, k = d.shape
    everything = np.broadcast_to(np.arange(k), d.shape)
    first = part.nearest(rows, everything, d)
    order = d.copy()
    order[np.arange(n), first] = -1.0
    kept = np.argpartition(order, b - 1, axis=1)[:, :b] if b < k else everything
    kept = np.take_along_axis(kept, np.argsort(np.take_along_axis(order, kept, 1), axis=1, kind="stable"), 1)
    bounds = np.full((n, b), np.inf)
    bounds[:, : b - 1] = part.low(np.take_along_axis(d, kept[:, 1:], 1), kept[:, 1:])
    if b < k:
        rest = part.low(d, everything)
        np.put_along_axis(rest, kept, np.inf, 1)
        bounds[:, b - 1] = rest.min(1)
    return kept, bounds


def _moved(part: _Part, kept: np.ndarray, bounds: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same after the entries moved; third: how many entries each row had to measure (all: the codebook's length)."""
    n, b = kept.shape
    k = len(part.c)
    bounds = bounds.copy()
    bounds[:, : b - 1] -= move[kept[:, 1:]]
    bounds[:, b - 1] -= move.max(initial=0)
    # in order: a bound holds for its entry and for all behind it
    bounds = np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1]
    rows = np.arange(n)
    own = part.high(part.squares(rows, kept[:, :1]), kept[:, :1])
    need = 1 + (bounds <= own).sum(1)
    need[need > b] = k
    kept = kept.copy()
    for m in np.unique(need):
        if m == 1:
            continue
        some = np.flatnonzero(need == m)
        if m > b or m == k:
            kept[some], bounds[some] = _ranked(part, some, b)
            continue
        entries = kept[some, :m]
        d = part.squares(some, entries)
        first = part.nearest(some, entries, d)
        order = d.copy()
        order[np.arange(len(some)), first] = -1.0
        turn = np.argsort(order, axis=1, kind="stable")
        kept[some, :m] = np.take_along_axis(entries, turn, 1)
        bounds[some, : m - 1] = part.low(np.take_along_axis(d, turn[:, 1:], 1), kept[some, 1:m])
    return kept, bounds, need


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The lists as rows, filled up with zeros."""
    lengths, values = column.value_lengths().to_numpy(zero_copy_only=False), column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = values
    return out


class _Assign:
    """Tasks that assign parts: first with all entries, later from the bounds that were written."""

    def __init__(self, books: Codebooks, width: int, unit: float, move: np.ndarray | None = None, last: bool = False):
        self.books, self.width, self.unit, self.move, self.last = books, width, unit, move, last

    def batch(self, v: np.ndarray, state: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
        """Entries (row, part, b) and bounds of some vectors, b chosen for all of them."""
        parts, k = len(self.books.whole), len(self.books.whole[0])
        size = self.width // parts
        kept, bounds, needs = [], [], []
        for p in range(parts):
            part = _Part(np.ascontiguousarray(v[:, p * size : (p + 1) * size]), p, self.books)
            if state is None:
                a, b = _ranked(part, np.arange(len(v)), max(1, k // 4))
                need = np.ones(len(v), "i8")
            else:
                a, b, need = _moved(part, state[0][:, p], state[1][:, p], self.move[p])
            kept.append(a)
            bounds.append(b)
            needs.append(need)
        kept, bounds, needs = np.stack(kept, 1), np.stack(bounds, 1), np.concatenate(needs)
        b = kept.shape[2]
        if state is not None and not self.last:
            within = np.sort(needs[needs <= b])
            want = int(within[min(len(within) - 1, int(COVER * len(within)))]) if len(within) else b
            want = min(b, max(want, k // 8, 1))
            if want < b:  # what is left out is behind the outer bound, which is in order
                kept, bounds = kept[:, :, :want], np.concatenate([bounds[:, :, : want - 1], bounds[:, :, want - 1 :].min(2, keepdims=True)], 2)
        return kept, bounds

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                rows = whole.slice(at, CHUNK)
                if self.move is None:
                    yield self.out(rows, np.arange(rows.num_rows), None)
                    continue
                near = rows.column("near").to_pylist()
                lengths = np.array([len(x) for x in near])
                for size in np.unique(lengths):
                    own = np.flatnonzero(lengths == size)
                    shape = (len(own), len(self.books.whole), -1)
                    kept = np.frombuffer(b"".join(near[i] for i in own), "u1").reshape(shape).astype("i8")
                    low = rows.column("low").take(pa.array(own)).to_pylist()
                    bounds = np.frombuffer(b"".join(low), "<u2").reshape(shape) * self.unit
                    yield self.out(rows.take(pa.array(own)), own, (kept, bounds))

    def out(self, rows: pa.RecordBatch, own: np.ndarray, state: tuple | None) -> pa.RecordBatch:
        v = _matrix(rows.column("v"), self.width)
        kept, bounds = self.batch(v, state)
        if self.last:
            codes = [bytes(x).hex() for x in kept[:, :, 0].astype("u1")]
            return pa.record_batch([rows.column("vec_id"), rows.column("label"), pa.array(codes, pa.string()), pa.array(self.errors(v, kept[:, :, 0]), pa.int64())],
                                   names=["vec_id", "label", "code", "error"])
        near = [x.tobytes() for x in kept.astype("u1")]
        low = [x.tobytes() for x in np.minimum(np.floor(bounds / self.unit), 65_535).clip(0).astype("<u2")]
        return pa.record_batch([rows.column("vec_id"), rows.column("label"), rows.column("v"), pa.array(near, pa.binary()), pa.array(low, pa.binary())],
                               names=["vec_id", "label", "v", "near", "low"])

    def errors(self, v: np.ndarray, entries: np.ndarray) -> list[int]:
        books, size = self.books, self.width // len(self.books.whole)
        sure = books.exact > 0 and np.abs(v).max(initial=0) <= books.exact and np.abs(books.near).max(initial=0) <= books.exact
        if sure:
            chosen = np.concatenate([books.near[p][entries[:, p]] for p in range(len(books.whole))], 1)
            squares = np.rint(((v - chosen) * SCALE) ** 2).astype("i8").reshape(len(v), len(books.whole), -1).sum(2)
            if squares.max(initial=0) < _LONG // len(books.whole):
                return squares.sum(1).tolist()
        return [
            min(_LONG, sum((_whole(float(a)) - b) ** 2 for p in range(len(books.whole)) for a, b in zip(row[p * size : (p + 1) * size], books.whole[p][chosen[p]], strict=True)))
            for row, chosen in zip(v, entries, strict=True)
        ]


def _sums(parts: int, entries: int, width: int):
    """Tasks that add up the parts of each entry: part, entry, position (-1: the count), digit, value."""
    size = width // parts

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, size + 1), object)
        for batch in batches:
            v = _matrix(batch.column("v"), width)
            first = np.array([np.frombuffer(x, "u1").reshape(parts, -1)[:, 0] for x in batch.column("near").to_pylist()], "i8").reshape(-1, parts)
            fits = np.abs(v).max(initial=0) < 2.0**20  # sums of a batch stay whole numbers in a double
            for p in range(parts):
                x = v[:, p * size : (p + 1) * size]
                count = np.bincount(first[:, p], minlength=entries)
                total[p, :, size] += count.astype(object)
                if fits:
                    for j in range(size):
                        total[p, :, j] += np.rint(np.bincount(first[:, p], x[:, j] * SCALE, entries)).astype("i8").astype(object)
                else:
                    for e, row in zip(first[:, p], x, strict=True):
                        for j, c in enumerate(row):
                            total[p, e, j] += _whole(float(c))
        found = []
        for p, e, j in np.argwhere(total != 0):
            n, digit, sign = abs(int(total[p, e, j])), 0, 1 if total[p, e, j] > 0 else -1
            while n:
                found.append((int(p), int(e), int(j), digit, sign * (n & ((1 << _DIGIT) - 1))))
                n, digit = n >> _DIGIT, digit + 1
        columns = list(zip(*found, strict=True)) or [()] * 5
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, [pa.int32()] * 4 + [pa.int64()], strict=True)], names=["part", "entry", "place", "digit", "value"])

    return rows


def _updated(state: DataFrame, books: Codebooks, width: int) -> list[list[list[int]]]:
    """The floored means of the entries' parts; the driver gets parts * entries * (width of a part + 1) sums."""
    parts, entries, size = books.near.shape
    sums = state.select("v", "near").mapInArrow(_sums(parts, entries, width), "part int, entry int, place int, digit int, value long")
    total: dict[tuple[int, int, int], int] = {}
    for r in sums.groupBy("part", "entry", "place", "digit").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        total[r.part, r.entry, r.place] = total.get((r.part, r.entry, r.place), 0) + (int(r.value) << (_DIGIT * r.digit))
    return [
        [[total.get((p, e, j), 0) // n for j in range(size)] if (n := total.get((p, e, size), 0)) else books.whole[p][e] for e in range(entries)]
        for p in range(parts)
    ]


def _moves(old: Codebooks, new: Codebooks) -> np.ndarray:
    """How far each entry moved, rounded up, on the scaled grid."""
    d = np.sqrt(((old.near - new.near) ** 2).sum(2))
    return d * (1 + 1e-9) + old.slack + new.slack


def fit_codes(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, vec_id: str = "vec_id",
              embedding: str = "embedding", label: str = "label") -> tuple[DataFrame, Codebooks | None]:
    """vec_id, label, code, error of every vector that takes part, written once, and the final codebooks (None: no vectors)."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index has to fit two hex digits")
    vectors = kept_vectors(rows, vec_id, embedding, label)
    kind = vectors.schema["label"].dataType.simpleString()
    largest, longest = vectors.agg(F.max(F.array_max(F.transform("v", F.abs))), F.max(F.size("v"))).first()
    if longest is None:
        return vectors.sparkSession.createDataFrame([], f"vec_id long, label {kind}, code string, error long"), None
    size = max(1, -(-longest // parts))
    width = size * parts
    start = vectors.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    first = [[_whole(x) for x in r.v] + [0] * (width - len(r.v)) for r in start]
    books = codebooks([[v[p * size : (p + 1) * size] for v in first] for p in range(parts)], largest or 0.0)
    # bounds are counted in a unit of the codebooks' own extent; larger distances keep the largest bound
    spread = float(np.sqrt(((books.near.max(1) - books.near.min(1)) ** 2).sum(1)).max())
    unit = 2 * spread / 65_535 if spread > 0 else 1.0
    schema = f"vec_id long, label {kind}, v array<double>, near binary, low binary"
    state = move = None
    for _ in range(rounds):
        state = written((vectors if state is None else state).mapInArrow(_Assign(books, width, unit, move), schema), "codes-bounds")
        new = codebooks(_updated(state, books, width), largest or 0.0)
        move, books = _moves(books, new), new
    found = (vectors if state is None else state).mapInArrow(_Assign(books, width, unit, move, last=True), f"vec_id long, label {kind}, code string, error long")
    return written(found, "codes"), books


def vector_codes(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector that takes part."""
    found, books = fit_codes(rows, parts, entries, rounds)
    per_label = found.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("sum"))
    per_label = written(per_label.select(F.col("label").alias("own"), F.least("sum", F.lit(_LONG).cast("decimal(38,0)")).cast("long").alias("label_error")), "codes-labels")
    joined = found.join(small(per_label, per_label.count(), BROADCAST_LABELS), F.col("label").eqNullSafe(F.col("own")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books) if books else None).cast("string").alias("codebooks_sha256"))
