"""Packing documents into training sequences of bounded length and balanced cost.

A document's tokens (its ids and the end id) are cut into whole sequences and a
rest.  Rests are dealt to groups by a hash; in a group, rests in descending order
of estimated cost (linear plus quadratic in the length, as attention costs) go to
the sequence of lowest cost that has room for them.  The number of sequences is
the least that can hold the group's tokens.  A rest that no sequence has room for
waits for the end, when the remaining room is filled with pieces of these rests.
So all sequences of a group are full but for at most one sequence's tokens.

Defined results: a null or empty text has one token, the end id; ids may be null
or repeat, every row is packed on its own; an empty table gives an empty result;
other columns are not looked at.  Ties are broken by id and row.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorefold.llm.common import written

SEQUENCE = 2048
END_ID = 1
#: Rests that one task packs at a time; cost of a token, and of a token's attention to each token of its piece.
GROUP = 4096
#: Bits for a sequence's number in its group.
BIN_BITS = 20
LINEAR, QUADRATIC = 1.0, 1.0 / SEQUENCE
#: Pieces of text whose ids a worker remembers, twice.
REMEMBERED = 400_000
#: Bytes of texts whose words are looked up together.
TOGETHER = 1 << 23
#: Bytes of a text that is cut in Arrow, where it may grow threefold and must stay under 2 GB.
LONGEST = 1 << 29
#: Pre-tokens of pieces made of Latin letters, digits, ASCII marks and single line feeds (an apostrophe has rules of its own).
_PLAIN = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏ]+| ?[0-9]+| ?[!-&(-/:-@\[-`{-~]+|\n(?=[!-~À-ɏ])")
#: Pieces that are one such pre-token of letters, and letters with marks behind them.
_LETTERS = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏ]+")
_MARKED = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]+)")
_SPACE_BLANK = re.compile(r"\s ")
#: White space in which a text may not be cut before each blank and around each line feed (RE2's \s knows ASCII only).
_WHITE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_UNCUT = rf"{_WHITE} |\n{_WHITE}|{_WHITE}\n\z"


class Ids:
    """Token ids of texts by a tokenizer file, remembered for pieces that come again.

    A text may be cut before every blank that follows a character other than white
    space: no token of the byte-level pre-tokenizer reaches over such a place, so the
    pieces' ids joined are the text's ids.  A line feed that follows and precedes
    characters other than white space is a token of its own.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.bytes_as_text = _byte_letters()
        self.blank = self.bytes_as_text[32]

    def _one(self, piece: str) -> bytes:
        """The ids of one pre-token, straight from the model."""
        if piece.isascii() and piece.isprintable():  # all but the blank stand for their own bytes
            letters = piece.replace(" ", self.blank)
        else:
            letters = piece.encode().decode("latin-1").translate(self.bytes_as_text)
        ids = [t.id for t in self.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _new(self, piece: str) -> bytes:
        if _LETTERS.fullmatch(piece):
            return self._one(piece)
        if marked := _MARKED.fullmatch(piece):
            return b"".join(map(self._piece, marked.groups()))
        parts = _PLAIN.findall(piece)
        if "".join(parts) != piece:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes()
        if len(parts) > 1:
            return b"".join(map(self._piece, parts))
        return self._one(piece)

    def _piece(self, piece: str) -> bytes:
        ids = self.known.get(piece)
        if ids is None:
            ids = self.before.get(piece) or self._new(piece)
            if len(piece) <= 64:
                if len(self.known) >= REMEMBERED:
                    self.known, self.before = {}, self.known
                self.known[piece] = ids
        return ids

    def of(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return next(self.of_all(pa.array([text], pa.large_string())))

    def of_all(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, a null as an empty one; each word is looked up once in many texts."""
        texts = texts.fill_null("")
        sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + TOGETHER, "right")))
            yield from self._together(texts.slice(at, stop - at))
            at = stop

    def _together(self, texts: pa.Array) -> Iterator[bytes]:
        uncut = pc.or_(pc.match_substring_regex(texts, _UNCUT), pc.greater(pc.binary_length(texts), LONGEST))
        own, others = self._by_pieces(texts.filter(uncut)), self._by_words(texts.filter(pc.invert(uncut)))
        return (next(own if here else others) for here in uncut.to_pylist())

    def _by_words(self, texts: pa.Array) -> Iterator[bytes]:
        """Of texts that may be cut before each blank and around each line feed."""
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n "), " ")
        words, starts = cut.flatten(), cut.offsets.to_numpy()
        coded = words.dictionary_encode()
        codes = coded.indices.to_numpy().copy()
        # no blank stands before a text's first word, a line feed and the word behind it
        feeds = np.flatnonzero(codes == pc.index(coded.dictionary, pa.scalar("\n", words.type)).as_py())
        bare = np.unique(np.concatenate([starts[:-1], feeds, feeds + 1]))
        without = words.take(pa.array(bare)).dictionary_encode()
        codes[bare] = len(coded.dictionary) + without.indices.to_numpy()
        return _joined(self._found([f" {word}" for word in _strings(coded.dictionary)] + _strings(without.dictionary)), codes, starts)

    def _by_pieces(self, texts: pa.Array) -> Iterator[bytes]:
        cut = list(map(pieces, texts.to_pylist()))
        starts = np.cumsum([0, *map(len, cut)])
        coded = pa.array(chain.from_iterable(cut), pa.large_string()).dictionary_encode()
        del cut
        return _joined(self._found(_strings(coded.dictionary)), coded.indices.to_numpy(), starts)

    def _found(self, words: list[str]) -> list[bytes]:
        """The ids of words; those with marks behind them are not remembered, as they are few among many texts."""
        found = list(map(self.known.get, words))
        for i, word in enumerate(words):
            if found[i] is None:
                marked = None if word[-1:].isalnum() else _MARKED.fullmatch(word)
                found[i] = b"".join(map(self._piece, marked.groups())) if marked else self._piece(word)
        return found


def _joined(found: list[bytes], codes: np.ndarray, starts: np.ndarray) -> Iterator[bytes]:
    """The ids of each text: codes number its words in found, starts are the texts' first places in codes and the end."""
    ids = np.frombuffer(b"".join(found), "<u4")
    sizes = np.fromiter(map(len, found), np.int32, len(found)) // 4
    firsts = np.cumsum(sizes, dtype=np.int32) - sizes
    counts = sizes[codes]
    ends = np.cumsum(counts, dtype=np.int32)
    places = np.repeat(firsts[codes] - (ends - counts), counts)
    places += np.arange(len(places), dtype=np.int32)
    out, stops = ids[places].tobytes(), (4 * np.append(np.int64(0), ends)[starts]).tolist()
    return (out[a:b] for a, b in pairwise(stops))


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 as is, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


def pieces(text: str) -> list[str]:
    """The text cut before every blank that follows a character other than white space."""
    if "\0" in text:
        first, *rest = text.split(" ")
        cut = [first, *[f" {part}" for part in rest]]
    else:
        cut = text.replace(" ", "\0 ").split("\0")
    if not cut[0]:
        del cut[0]
    if not _SPACE_BLANK.search(text):
        return cut
    out: list[str] = []
    for part in cut:
        if out and out[-1][-1].isspace():
            out[-1] += part
        else:
            out.append(part)
    return out


@lru_cache(maxsize=4)
def _ids(path: str) -> Ids:
    return Ids(path)


def _tokenized(path: str, sequence: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()
    names = ["uid", "doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids"]

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _ids(path).of_all
        for batch in rows:
            out = []
            for uid, doc_id, ids in zip(batch.column("uid").to_pylist(), batch.column("doc_id").to_pylist(), ids_of(batch.column("__text")), strict=True):
                ids += end
                n = len(ids) // 4
                for start in range(0, n, sequence):
                    piece = ids[4 * start : 4 * (start + sequence)]
                    whole = len(piece) == 4 * sequence
                    out.append((uid, doc_id, start, len(piece) // 4, n, zlib.crc32(piece), None if whole else _short(piece)))
            for at in range(0, len(out), 2000):
                columns = zip(*out[at : at + 2000], strict=True)
                yield pa.record_batch([pa.array(c, type=f) for c, f in zip(columns, _TYPES, strict=True)], names=names)

    return cut


_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def _short(ids: bytes) -> bytes:
    """Ids in two bytes each if all fit, else in four; a first byte tells which."""
    values = np.frombuffer(ids, "<u4")
    return b"\2" + values.astype("<u2").tobytes() if len(values) and values.max() < 65_536 else b"\4" + ids


def _long(short: bytes) -> bytes:
    return np.frombuffer(short, "<u2", offset=1).astype("<u4").tobytes() if short[:1] == b"\2" else short[1:]


def cost(length: int) -> float:
    """The estimated cost of training on a piece: linear layers plus attention within the piece."""
    return LINEAR * length + QUADRATIC * length * length


def assign(lengths: list[int], sequence: int = SEQUENCE) -> list[tuple[int, int, int, int]]:
    """Pack pieces (of less than a sequence): (piece, start in it, length, sequence number), every token once.

    Pieces in descending order go to the sequence of lowest cost with room; those
    that fit nowhere are cut into the room that is left.
    """
    bins = -(-sum(lengths) // sequence)
    room, spent, out, waiting = np.full(bins, sequence), np.zeros(bins), [], []
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        length = lengths[piece]
        fits = np.where(room >= length, spent, np.inf)
        i = int(np.argmin(fits))
        if np.isfinite(fits[i]):
            out.append((piece, 0, length, i))
            room[i] -= length
            spent[i] += cost(length)
        else:
            waiting.append(piece)
    # the most room first, so that few cuts are made
    left = sorted(((r, -i) for i, r in enumerate(room.tolist()) if r), reverse=True)
    at = 0
    for piece in waiting:
        start = 0
        while start < lengths[piece]:
            free, i = left[at]
            take = min(free, lengths[piece] - start)
            out.append((piece, start, take, -i))
            start += take
            left[at] = (free - take, i)
            at += free == take
    return out


def _packed(sequence: int):
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "uid"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        rows = pd.DataFrame(assign(group["length"].tolist(), sequence), columns=["piece", "from", "length", "bin"])
        of = group.iloc[rows["piece"]].reset_index(drop=True)
        crc = [
            whole if n == total else zlib.crc32(_long(ids)[4 * a : 4 * (a + n)])
            for whole, ids, a, n, total in zip(of["ids_crc32"], of["ids"], rows["from"], rows["length"], of["length"], strict=True)
        ]
        out = pd.DataFrame({
            "uid": of["uid"], "doc_id": of["doc_id"].astype("Int64"), "start": of["start"] + rows["from"], "length": rows["length"],
            "ids_crc32": crc, "doc_tokens": of["doc_tokens"], "bin": rows["bin"],
        })
        out["offset"] = out.groupby("bin")["length"].cumsum() - out["length"]
        out["sequence"] = (group["part"].iloc[0] << BIN_BITS) + out["bin"]
        return out.drop(columns="bin")

    return pack


_PIECES = "uid long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, offset long, sequence long"


def packed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
                     sequence: int = SEQUENCE, end_id: int = END_ID, group: int = GROUP) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, row.

    path names the tokenizer file, on every executor.  Texts are tokenized once and
    only the ids of rests are shuffled.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("__text"))
    cut = written(
        rows.mapInArrow(_tokenized(path, sequence, end_id), "uid long, doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary"),
        "packing-pieces",
    )
    rests = cut.where("ids is not null")
    groups = max(1, -(-rests.count() // group))
    parts = rests.withColumn("part", F.pmod(F.xxhash64(F.lit("packing"), "uid"), F.lit(groups))).groupBy("part").applyInPandas(_packed(sequence), _PIECES)
    whole = cut.where("ids is null").select(
        "uid", "doc_id", "start", "length", "ids_crc32", "doc_tokens", F.lit(0).cast("long").alias("offset"),
        (F.monotonically_increasing_id() * 2).alias("sequence"),
    )
    # even numbers are whole sequences, odd ones those of the groups
    parts = parts.withColumn("sequence", F.col("sequence") * 2 + 1)
    return whole.unionByName(parts).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("sequence").alias("sequence_id"), "offset", F.col("uid").alias("row")
    )
