import random

import pytest

from daybridge.llm import queries as Q
from daybridge.llm.text import load_tokenizer
from daybridge.llm.token_counts import count_tokens, spliced_ids
from tests.llm.helpers import edge_rows, frame
from tests.llm.test_text import ALPHABET


@pytest.mark.parametrize("name", [Q.WORD_BPE, Q.BYTE_BPE])
def test_spliced_chunks_equal_the_whole(name):
    tok = load_tokenizer(name)
    rng = random.Random(9)
    for _ in range(300):
        text = "".join(rng.choice([*ALPHABET, "word ", "Text, "]) for _ in range(rng.randint(0, 300)))
        ids, _ = spliced_ids(text, tok, chunk=60, overlap=12)
        assert ids == tok.encode(text, add_special_tokens=False).ids


def test_overlap_widens_until_a_stable_position():
    tok = load_tokenizer(Q.BYTE_BPE)
    text = "some words " * 20 + "x" * 500 + " and more words" * 20
    ids, chunks = spliced_ids(text, tok, chunk=100, overlap=10)
    assert ids == tok.encode(text, add_special_tokens=False).ids and chunks > 5


def test_edges(spark):
    rows = edge_rows()
    tok = load_tokenizer(Q.WORD_BPE)
    got = count_tokens(frame(spark, rows), Q.WORD_BPE, chunk_chars=2_000, overlap_chars=100).collect()
    key = lambda x: tuple((v is not None, v) for v in x)
    expected = [(i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert sorted([(r.doc_id, r.n_bytes, r.n_tokens) for r in got], key=key) == sorted(expected, key=key)
    assert max(r.n_chunks for r in got) > 1
    assert count_tokens(frame(spark, []), Q.WORD_BPE).count() == 0
