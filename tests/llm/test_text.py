import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from daybridge.llm import queries as Q
from daybridge.llm import text
from daybridge.llm.text import Words, distinct_per_document, load_tokenizer, shingle_hashes, token_ids
from tests.llm.helpers import words

ALPHABET = ["a", "B", " ", "\n", "\t", "  ", "é", "'s", "1", "<|endoftext|>", "<|", "　", "\r\n", "x", "́", "\x0b", "\x1c", "\x85", "\xa0", "日本", "#$", ".", "'", " "]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_ids_equal_the_library(name):
    rng = random.Random(3)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(4000)] + ["", None, " ", "a b"]
    path = public_tokenizers.path(name)
    ids, off = token_ids(pa.array(texts), path)
    expected = load_tokenizer(path).encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert [list(ids[a:b]) for a, b in zip(off[:-1], off[1:])] == [e.ids for e in expected]


def test_words_and_shingles():
    texts = ["  The  red\x0btree ", "", None, "a", "a b c d e a b c d e", "x y z"]
    w = Words(pa.array(texts))
    got = [[w.vocab[int(i)].as_py().encode() for i in w.ids[a:b]] for a, b in zip(w.offsets[:-1], w.offsets[1:])]
    assert got == [words(t) for t in texts]
    values, off = distinct_per_document(*shingle_hashes(w.hashes()[w.ids], w.offsets, 4))
    sets = [{tuple(x[j : j + 4]) for j in range(max(1, len(x) - 3))} if x else set() for x in got]
    assert np.diff(off).tolist() == [len(s) for s in sets]


def test_bytes_are_looked_up_without_a_wide_index():
    from daybridge.llm import text

    data = np.random.default_rng(2).integers(0, 256, 5000, dtype=np.uint8)
    table = np.arange(255, -1, -1, dtype=np.uint8)
    assert np.array_equal(text.translated(data, table), table[data])
    for bit, kind in ((1, text._ASCII_SPACE), (2, text._MAY_START_SPACE), (4, text._LETTER), (8, text._SIGN)):
        assert np.array_equal((text._KIND & bit) > 0, kind)
    assert np.array_equal((text._KIND & 16) > 0, np.arange(256) >= 0x80)
    some = b"one  two\nthree\xc2\xa0 four.five's \n\n six"
    cuts = text.safe_cuts(np.frombuffer(some, np.uint8), np.array([0]))
    assert [some[a:b] for a, b in zip(cuts, [*cuts[1:], len(some)])] == [
        b"one ", b" two", b"\nthree\xc2\xa0", b" four", b".five's \n\n", b" six"
    ]


def test_a_full_piece_table_goes_on_with_pieces_met_again(monkeypatch):
    tok = load_tokenizer(Q.BYTE_BPE)
    monkeypatch.setattr(text.PieceTable, "MAX_PIECES", 60)
    text.free_tables()
    asked = []
    encoded = text.PieceTable._encoded
    monkeypatch.setattr(text.PieceTable, "_encoded", lambda self, p: asked.extend(str(x) for x in p) or encoded(self, p))
    for i in range(30):
        texts = ["the same words" + "".join(f" only{i}x{j}" for j in range(8)), "", None]
        ids, off = token_ids(pa.array(texts), Q.BYTE_BPE)
        assert off[1] == off[3] == len(ids)
        assert ids.tolist() == tok.encode(texts[0], add_special_tokens=False).ids
        assert asked.count(" same") == 1
        table = text._TABLES[Q.BYTE_BPE]
        assert len(table.known) == len(table.met) == len(table.offsets) - 1 <= 60 and table.offsets[-1] == len(table.ids)
    many = " ".join(f"more{j}" for j in range(100))  # more in one run than the table may hold
    assert token_ids(pa.array([many]), Q.BYTE_BPE)[0].tolist() == tok.encode(many, add_special_tokens=False).ids
    text.free_tables()
