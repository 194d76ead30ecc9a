"""Helpers on batches of texts, shared by the operators of this subpackage.

Everything here works on one Arrow batch inside a task: words, shingle hashes
and token ids are numpy arrays over the whole batch, with offsets per document.
Spark decides what a batch is and moves the data between tasks.
"""

from __future__ import annotations

import ctypes
import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space that ends a word, as Python/Java pattern text.
SPACE_CLASS = r"\x20\x09-\x0D"
#: Rows a task hands to Python at once are cut into runs of about this many text bytes.
RUN_BYTES = 6 << 20
#: Bytes of text whose pieces and token ids are in memory at once: they take far more memory than the text.
TOKEN_BYTES = 2 << 20

U64 = np.uint64
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=U64)


def doc_bucket(id_col: str | Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo; null ids fall into no bucket."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(c.cast("string").cast("binary")) % modulus


def runs(batches: Iterator[pa.RecordBatch], text_col: str = "text", limit: int = RUN_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows holding about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        col = batch.column(batch.schema.get_field_index(text_col))
        sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = (np.cumsum(sizes) - sizes) // limit
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], n], strict=True):
            yield batch.slice(a, b - a)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def ragged(offsets: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the ragged rows ``picks`` laid one after another, and their new offsets."""
    starts, lens = offsets[picks], offsets[picks + 1] - offsets[picks]
    ends = np.cumsum(lens)
    out = np.zeros(len(picks) + 1, dtype=np.int64)
    out[1:] = ends
    return np.arange(out[-1]) + np.repeat(starts - out[:-1], lens), out


class Words:
    """Words of every text of a batch: ``ids`` index ``vocab``; document i owns ids[offsets[i]:offsets[i+1]]."""

    def __init__(self, texts: pa.Array, lower: bool = True):
        texts = pc.fill_null(texts, "")
        parts = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
        flat = parts.flatten()
        offsets = parts.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        encoded = flat.dictionary_encode()
        self.vocab = encoded.dictionary
        ids = encoded.indices.to_numpy(zero_copy_only=False)
        empty = pc.index(self.vocab, pa.scalar("", self.vocab.type)).as_py()
        if empty >= 0:  # white space at either end of a text leaves an empty part
            keep = ids != empty
            before = np.zeros(len(ids) + 1, dtype=np.int64)
            np.cumsum(keep, out=before[1:])
            ids, offsets = ids[keep], before[offsets]
        self.ids, self.offsets = ids, offsets

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each entry of ``vocab``; the same in every process."""
        return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.vocab.to_pylist()), dtype=U64, count=len(self.vocab))

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> U64(32))
    h = h * _MIX[0]
    h ^= h >> U64(29)
    h *= _MIX[1]
    return h ^ (h >> U64(32))


def shingle_hashes(word_hash: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word shingles of each document, in order, with offsets.

    A document with fewer words has one shingle, its whole sequence; one without words has none.
    """
    n, lens = len(word_hash), np.diff(offsets)
    full = np.zeros(max(0, n - size + 1), dtype=U64)
    for j in range(size):
        full = mix(full + word_hash[j : n - size + 1 + j] * _MIX[2]) if len(full) else full
    counts = np.where(lens >= size, lens - size + 1, (lens > 0).astype(np.int64))
    out_off = np.zeros(len(lens) + 1, dtype=np.int64)
    np.cumsum(counts, out=out_off[1:])
    out = np.empty(out_off[-1], dtype=U64)
    long = np.flatnonzero(lens >= size)
    src = np.arange(counts[long].sum()) + np.repeat(offsets[long] - np.r_[0, np.cumsum(counts[long])[:-1]], counts[long])
    dst = np.arange(counts[long].sum()) + np.repeat(out_off[long] - np.r_[0, np.cumsum(counts[long])[:-1]], counts[long])
    out[dst] = full[src]
    for i in np.flatnonzero((lens > 0) & (lens < size)):
        h = np.array([lens[i]], dtype=U64)
        for j in range(offsets[i], offsets[i + 1]):
            h = mix(h + word_hash[j : j + 1] * _MIX[2])
        out[out_off[i]] = h[0]
    return out, out_off


def distinct_per_document(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each document, with offsets."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((values, doc))
    v, d = values[order], doc[order]
    first = np.ones(len(v), dtype=bool)
    first[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    out = np.zeros(len(offsets), dtype=np.int64)
    np.cumsum(np.bincount(d[first], minlength=len(offsets) - 1), out=out[1:])
    return v[first], out


def map_runs(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text_col: str = "text") -> DataFrame:
    """``mapInArrow`` over runs of rows; ``fn`` gets and returns one record batch."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, text_col):
            yield fn(run)

    return df.mapInArrow(work, schema)


# --- token ids through the tokenizers library -------------------------------------------------

_LOADED: dict[str, object] = {}
#: White space of one byte, and first bytes of white space of several bytes.
_ASCII_SPACE = np.zeros(256, dtype=bool)
_ASCII_SPACE[[32, *range(9, 14)]] = True
_MAY_START_SPACE = np.zeros(256, dtype=bool)
_MAY_START_SPACE[[32, *range(9, 14), 0xC2, 0xE1, 0xE2, 0xE3]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SIGN = np.zeros(256, dtype=bool)
_SIGN[[i for i in range(33, 127) if not chr(i).isalnum() and i != 39]] = True
#: What a byte may be, in one look-up: a bit for each table above, and one for parts of longer characters.
_KIND = _ASCII_SPACE * np.uint8(1) + _MAY_START_SPACE * np.uint8(2) + _LETTER * np.uint8(4) + _SIGN * np.uint8(8)
_KIND[0x80:] += 16


def translated(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``table[data]`` of bytes, without an index of eight bytes for each."""
    return np.frombuffer(data.tobytes().translate(table.tobytes()), dtype=np.uint8)


def load_tokenizer(path: str):
    """The tokenizer of a file, once per process, single-threaded: Spark runs one task per core."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


def safe_cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Positions where a text may be cut without changing its token ids (text starts included).

    Both vocabularies split a text before any merge: runs of letters, digits or other signs, with
    one blank before them at most, and runs of white space. So a cut is safe before a blank that a
    non-space follows (a run of white space gives up just its last blank to the next word), before
    a line end that follows a plain non-space character, and between a plain letter and a plain
    sign other than the apostrophe, which may begin a contraction.
    """
    n = len(data)
    if n == 0:
        return np.unique(starts[starts < n])
    kind = translated(data, _KIND)
    after = np.ones(n, dtype=bool)
    after[:-1] = (kind[1:] & 2) > 0
    before = np.ones(n, dtype=bool)
    before[1:] = (kind[:-1] & 17) > 0
    letter = np.zeros(n, dtype=bool)
    letter[1:] = (kind[:-1] & 4) > 0
    cut = ((data == 32) & ~after) | ((data == 10) & ~before) | (((kind & 8) > 0) & letter)
    cut[starts[starts < n]] = True
    return np.flatnonzero(cut)


class PieceTable:
    """Ids of the pieces a process has met, so that a word is encoded once and not once per batch.

    A cache alone: it holds at most ``MAX_PIECES`` pieces and ``MAX_BYTES`` of them, as one Arrow array. Beyond, it goes
    on with those met again since, which changes no id; a run with more pieces than that has the table to itself.
    """

    MAX_PIECES = 600_000
    MAX_BYTES = 16 << 20

    def __init__(self, tok):
        self.tok = tok
        self.fold = folding(tok)
        self.clear()

    def clear(self) -> None:
        self.known = pa.array([], pa.string())
        self.offsets = np.zeros(1, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int32)
        self.met = np.zeros(0, dtype=np.int32)

    def _make_room(self, pieces: pa.Array) -> None:
        if self._fits(pieces):
            return
        again = np.flatnonzero(self.met > 1)
        self.known = self.known.take(pa.array(again))
        at, self.offsets = ragged(self.offsets, again)
        self.ids, self.met = self.ids[at], np.zeros(len(again), dtype=np.int32)
        if not self._fits(pieces):
            self.clear()

    def _fits(self, pieces: pa.Array) -> bool:
        return len(self.known) + len(pieces) <= self.MAX_PIECES and self.known.nbytes + pieces.nbytes <= self.MAX_BYTES

    def rows(self, pieces: pa.Array) -> np.ndarray:
        """Row of each piece (the pieces are distinct); unknown ones are encoded first."""
        self._make_room(pieces)
        n, found = len(self.known), pc.index_in(pieces, value_set=self.known)
        rows = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = rows < 0
        if new.any():
            fresh = pieces.filter(pa.array(new))
            rows[new] = np.arange(n, n + len(fresh))
            lens, ids = self._encoded(fresh)
            self.known = pa.concat_arrays([self.known, fresh])
            self.offsets = np.r_[self.offsets, self.offsets[-1] + np.cumsum(lens)]
            self.ids = np.r_[self.ids, ids]
            self.met = np.r_[self.met, np.zeros(len(fresh), dtype=np.int32)]
        self.met[rows] += 1
        return rows

    def _encoded(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each piece, and the ids. Pieces go to the library in lists, as words split already."""
        lens, ids, step = [], [], 200
        for a in range(0, len(pieces), 25 * step):  # an Encoding takes far more memory than its ids
            part = pieces.slice(a, 25 * step).to_pylist()
            lists = [part[i : i + step] for i in range(0, len(part), step)]
            for e, some in zip(
                self.tok.encode_batch(lists, is_pretokenized=True, add_special_tokens=False), lists, strict=True
            ):
                ids.append(np.array(e.ids, dtype=np.int32))
                lens.append(np.bincount(np.array(e.word_ids, dtype=np.int64), minlength=len(some)))
        return np.concatenate(lens), np.concatenate(ids)


_TABLES: dict[str, PieceTable] = {}


def give_back() -> None:
    """Return memory to the system that this worker's earlier tasks used and that Arrow and the C library still hold."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone
    if trim is not None:
        trim(0)


def free_tables() -> None:
    """Give back what tasks of earlier stages left in this worker: pieces met, tokenizers, and unused memory.

    Spark uses a Python worker again for the next stage; one that needs no token ids need not hold them. They are caches alone.
    """
    _TABLES.clear()
    _LOADED.clear()
    give_back()


def folding(tok) -> np.ndarray | None:
    """Bytes that a tokenizer takes for one another, as a table; None if it keeps all apart.

    One that lower-cases all letters and drops white space gives a word the same ids after a blank
    or a line end, in either case: its pieces are then alike more often.
    """
    spec = json.loads(tok.to_str())
    steps = (spec["normalizer"] or {}).get("normalizers", [])
    lower = any(s["type"] == "Lowercase" for s in steps)
    blank = any(s["type"] == "Replace" and s["pattern"] == {"Regex": r"\s+"} and s["content"] == " " for s in steps)
    splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    dropped = any(s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"] for s in splits)
    if not (lower and blank and dropped):
        return None
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[10] = 32
    return table


def _pieces(texts: pa.Array, fold: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Cut positions over all texts, text offsets, and the pieces between the cuts."""
    plain = pa.concat_arrays([texts])  # a copy whose offsets start at 0
    n = len(plain)
    offs = np.frombuffer(plain.buffers()[1], dtype=np.int32, count=n + 1).astype(np.int64)
    raw = plain.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8, count=int(offs[-1])) if raw is not None else np.zeros(0, np.uint8)
    cuts = safe_cuts(data, offs[:-1])
    bounds = np.r_[cuts, len(data)].astype(np.int32)
    data = data if fold is None else translated(data, fold)
    return cuts, offs, pa.Array.from_buffers(pa.string(), len(cuts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every text as ``encode(text, add_special_tokens=False).ids``, with offsets.

    Each distinct piece between safe cuts is encoded once per process. A text that holds the mark
    ``<|`` may hold a special string, whose neighbourhood splits differently: it is encoded whole.
    """
    tok = load_tokenizer(path)
    if path not in _TABLES:
        _TABLES[path] = PieceTable(tok)
    table = _TABLES[path]
    texts = pc.fill_null(texts, "")
    n = len(texts)
    whole = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False).astype(bool)
    cuts, offs, pieces = _pieces(pc.if_else(pa.array(whole), "", texts) if whole.any() else texts, table.fold)
    encoded = pieces.dictionary_encode()
    rows = table.rows(encoded.dictionary)[encoded.indices.to_numpy(zero_copy_only=False)]
    at, ends = ragged(table.offsets, rows)
    ids = table.ids[at]
    doc_off = ends[np.searchsorted(cuts, offs, side="left")]
    if not whole.any():
        return ids, doc_off
    parts = [ids[doc_off[i] : doc_off[i + 1]] for i in range(n)]
    where = np.flatnonzero(whole)
    for i, e in zip(where, tok.encode_batch(texts.take(pa.array(where)).to_pylist(), add_special_tokens=False), strict=True):
        parts[i] = np.asarray(e.ids, dtype=np.int32)
    out = np.zeros(n + 1, dtype=np.int64)
    np.cumsum([len(r) for r in parts], out=out[1:])
    return np.concatenate(parts), out
