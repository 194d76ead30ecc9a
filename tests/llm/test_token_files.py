import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from daybridge.llm import queries as Q
from daybridge.llm.text import load_tokenizer
from daybridge.llm.token_files import read_tokens, token_digests, write_tokens
from daybridge.sources.scratch import scratch_path
from tests.llm.helpers import SF, edge_rows, frame


def local(path):
    return path.removeprefix("file:")


def test_edges_round_trip(spark):
    rows = edge_rows()
    path = scratch_path(spark, "tokens-test")
    write_tokens(frame(spark, rows), path, Q.WORD_BPE, end_id=1, files=3)
    got = read_tokens(spark, path).orderBy("start").collect()
    tok = load_tokenizer(Q.WORD_BPE)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    assert sorted(tuple(r.tokens) for r in got) == sorted(
        tuple(tok.encode(t or "", add_special_tokens=False).ids + [1]) for _, t in rows
    )
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    for r in token_digests(read_tokens(spark, path)).collect():
        tokens = next(g.tokens for g in got if g.start == r.start)
        assert r.ids_crc32 == zlib.crc32(np.array(tokens, "<u4").tobytes())


def test_file_format_and_selective_reads(spark):
    path = scratch_path(spark, "tokens-test")
    write_tokens(spark.read.parquet(f"{SF}/documents.parquet"), path, Q.WORD_BPE, end_id=1, files=2)
    import glob

    for name in glob.glob(f"{local(path)}/data/part-*"):
        meta = pq.ParquetFile(name).metadata
        columns = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i) for i in range(meta.num_columns)}
        tokens = next(c for p, c in columns.items() if p.startswith("tokens"))
        assert "RLE_DICTIONARY" in tokens.encodings
        assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
        assert all(c.has_offset_index for c in columns.values())
    some = read_tokens(spark, path, first_id=10, last_id=20)
    assert sorted(r.doc_id for r in some.collect()) == list(range(10, 21))
    plan = read_tokens(spark, path, first_id=10, tokens=False)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,10)" in plan and "tokens:array" not in plan


@pytest.mark.parametrize("files", [1, 4])
def test_empty_table(spark, files):
    path = scratch_path(spark, "tokens-test")
    write_tokens(frame(spark, []), path, Q.WORD_BPE, end_id=1, files=files)
    assert read_tokens(spark, path).count() == 0
