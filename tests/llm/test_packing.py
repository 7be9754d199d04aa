import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import make
from tokenizers import Tokenizer

from scorefold.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_pieces_give_the_tokenizers_ids(tokenizer):
    ids, rnd = packing.Ids(PATH), random.Random(5)
    letters = "ab éñ\n\t  \x1c\x85  'sX9.,中́<|endoftext|>"
    for _ in range(3000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(30)))
        assert ids.of(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert "".join(packing.pieces(text)) == text


@pytest.mark.parametrize("n", [0, 1, 50, 400])
def test_assign_places_every_token_once(n):
    rnd = random.Random(n)
    lengths = [rnd.randrange(1, 64) for _ in range(n)]
    seen, fill = defaultdict(list), defaultdict(int)
    for piece, start, length, b in packing.assign(lengths, 64):
        seen[piece].append((start, length))
        fill[b] += length
    for i, length in enumerate(lengths):
        at = 0
        for start, k in sorted(seen[i]):
            assert start == at
            at += k
        assert at == length
    assert all(x <= 64 for x in fill.values()) and len(fill) == -(-sum(lengths) // 64)


def test_costs_are_balanced():
    lengths = [100] * 30 + [10] * 60
    costs = defaultdict(float)
    for _, _, length, b in packing.assign(lengths, 400):
        costs[b] += packing.cost(length)
    assert max(costs.values()) < 1.15 * min(costs.values())


@pytest.mark.parametrize("group", [4, 4096])
def test_documents(spark, tokenizer, group):
    docs = make(spark)
    out = packing.packed_documents(docs, sequence=256, group=group).toPandas()
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = defaultdict(list)
    for r in out.itertuples():
        rows[r.row].append(r)
    assert len(rows) == docs.count()
    for own in rows.values():
        doc_id = None if np.isnan(own[0].doc_id) else own[0].doc_id
        if doc_id is None:
            continue
        ids, at = np.array([*tokenizer.encode(text[doc_id], add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    sequences = out.sort_values("offset").groupby("sequence_id")
    for _, s in sequences:
        assert (s["offset"] == s["length"].cumsum() - s["length"]).all() and s["length"].sum() <= 256
    full = sequences["length"].sum()
    if group == 4096:
        assert len(full) * 256 - full.sum() < 2 * 256


def test_empty(spark):
    assert packing.packed_documents(make(spark, [])).count() == 0


def test_new_words_skip_the_general_rule(tokenizer, monkeypatch):
    """Words, with marks or without, go to the model by one match; nulls in a text change no cut."""
    words = ["one", " two", " Über", " three,", " four!!", " \0five", "\0", " six seven", " it's", " 8th.", "\nnine\n", " \xa0x", " ǅz ɏ?"]
    for w in words:
        assert packing.Ids(PATH).of(w) == np.array(tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes()
    assert packing.pieces("a\0b c \0 d") == ["a\0b", " c", " \0", " d"] and packing.pieces(" a") == [" a"] and packing.pieces("") == []

    class Never:
        def findall(self, piece):
            raise AssertionError(piece)

    ids = packing.Ids(PATH)
    ids.of("!! ,")
    monkeypatch.setattr(packing, "_PLAIN", Never())
    ids.known |= {m: np.array(tokenizer.encode(m, add_special_tokens=False).ids, "<u4").tobytes() for m in ("!!", ",")}
    text = "one two Über three, four!!"
    assert ids.of(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_many_texts_give_the_tokenizers_ids(tokenizer, monkeypatch):
    """Whatever white space stands where, in several slices, in texts longer than a slice and too long for Arrow."""
    monkeypatch.setattr(packing, "TOGETHER", 400)
    monkeypatch.setattr(packing, "LONGEST", 600)
    letters, rnd = "ab éñ\n\r\t  \x1c\x85\xa0  '.s9,中́\0", random.Random(9)
    many = [None, "", *["".join(rnd.choice(letters[: rnd.choice([6, 9, 40])]) for _ in range(rnd.randrange(40))) for _ in range(4000)]]
    many += ["a b", "\nx\ny z\n", " a ", "end \n", "end\r\n", "it's, o'er.' <|endoftext|> x", "many words " * 50, "more words " * 60]
    found = list(packing.Ids(PATH).of_all(pa.array(many, pa.string())))
    for text, ids in zip(many, found, strict=True):
        assert ids == np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes(), text


def test_words_are_looked_up_once_for_many_texts(tokenizer):
    class Counted(dict):
        asked = 0

        def get(self, *key):
            self.asked += 1
            return super().get(*key)

    own = packing._ids(PATH)
    own.known = Counted()
    text = "Two lines, with\nmarks. And more\nlines."
    rows = pa.record_batch({"uid": [*range(500)], "doc_id": [*range(500)], "__text": [text] * 500})
    try:
        out = pa.Table.from_batches(packing._tokenized(PATH, 2048, 1)(iter([rows])))
        asked = own.known.asked
    finally:
        packing._ids.cache_clear()
    ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4").tobytes()
    assert out["ids_crc32"].to_pylist() == [zlib.crc32(ids)] * 500 and out["doc_tokens"].to_pylist() == [len(ids) // 4] * 500
    assert asked < 50


def test_no_more_is_remembered_than_stated(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    ids, rnd = packing.Ids(PATH), random.Random(3)
    text = " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(300))
    for _ in range(2):
        assert ids.of(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert len(ids.known) <= 20 and len(ids.before) <= 20
