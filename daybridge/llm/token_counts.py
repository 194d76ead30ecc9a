"""Token counts of whole texts; huge texts are encoded in overlapping chunks and spliced.

A text of at most ``chunk_chars`` is encoded whole. A longer one is cut into chunks that overlap;
each chunk is encoded with offsets, and two neighbours are joined at a position of their overlap
that is proven stable:

* the characters around it make the splitter of the tokenizer start anew there whatever stands
  before or after (see ``text.safe_cuts``), and no special string can reach over it;
* both encodings have a token boundary there, and agree on all tokens from there to the next
  such position.

If an overlap holds no such pair of positions it is doubled, up to the whole rest of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybridge.llm.text import TOKEN_BYTES, column, load_tokenizer, runs, safe_cuts, token_ids

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 512
COUNT_SCHEMA = "doc_id long, n_bytes long, n_tokens long, n_chunks int"


def stable_positions(text: str) -> list[int]:
    """Positions (in characters) at which the encodings of both sides do not depend on each other.

    A special string holds ``<|`` and no white space: a stretch between two positions that holds
    the mark, and the positions around it, are left out.
    """
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    cuts = safe_cuts(data, np.zeros(1, dtype=np.int64))
    char_at = np.cumsum((data & 0xC0) != 0x80)  # characters up to and with each byte
    at = (char_at[cuts] - 1).tolist()
    marked = "<|" in text
    if not marked:
        return at[1:]
    ends = [*at[1:], len(text)]
    clean = ["<|" not in text[a:b] for a, b in zip(at, ends, strict=True)]
    return [at[i] for i in range(1, len(at)) if clean[i] and clean[i - 1]]


def _tokens_from(offsets: list[tuple[int, int]], position: int) -> int | None:
    """Index of the first token at or after ``position``; None if a token reaches over it."""
    low, high = 0, len(offsets)
    while low < high:
        mid = (low + high) // 2
        if offsets[mid][1] <= position:
            low = mid + 1
        else:
            high = mid
    return None if low < len(offsets) and offsets[low][0] < position else low


def splice_point(text: str, left, right, left_start: int, right_start: int, left_end: int) -> tuple[int, int] | None:
    """Tokens of the left chunk before, and first token of the right chunk after, a common stable position."""
    overlap = text[right_start:left_end]
    stable = stable_positions(overlap)
    for here, after in zip(stable, stable[1:]):
        p, q = right_start + here, right_start + after
        a, b = _tokens_from(left.offsets, p - left_start), _tokens_from(left.offsets, q - left_start)
        c, d = _tokens_from(right.offsets, here), _tokens_from(right.offsets, after)
        if None in (a, b, c, d) or a == b:
            continue
        if left.ids[a:b] == right.ids[c:d]:
            return a, c
    return None


def spliced_ids(text: str, tok, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> tuple[list[int], int]:
    """Ids of a whole text from overlapping chunks, and the number of chunks encoded."""
    ids: list[int] = []
    start, taken, encoded = 0, 0, 1  # the open chunk begins at `start`; its first `taken` tokens are already out
    end = min(len(text), chunk)
    current = tok.encode(text[:end], add_special_tokens=False)
    while end < len(text):
        width, found = overlap, None
        while found is None:
            begin = max(start, end - width)
            stop = min(len(text), begin + max(chunk, 2 * width))
            following = tok.encode(text[begin:stop], add_special_tokens=False)
            encoded += 1
            found = splice_point(text, current, following, start, begin, end)
            if found is not None and found[0] >= taken:
                break
            found = None
            if begin == start:  # no stable position in the open chunk: encode it longer
                end = min(len(text), start + 2 * (end - start))
                current, encoded = tok.encode(text[start:end], add_special_tokens=False), encoded + 1
                if end == len(text):
                    break
                width = overlap
            else:
                width *= 2
        if found is None:
            break
        ids += current.ids[taken : found[0]]
        start, end, current, taken = begin, stop, following, found[1]
    return ids + current.ids[taken:], encoded


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and n_chunks of every whole text.

    A null or empty text counts 0 bytes and 0 tokens. One row per input row, repeated and null ids
    included; columns other than the two named are ignored. Nothing is shuffled.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load_tokenizer(tokenizer)
        for run in runs(batches, "text", TOKEN_BYTES):
            texts = pc.fill_null(column(run, "text"), "")
            n_bytes = pc.binary_length(texts)
            huge = pc.greater(pc.utf8_length(texts), chunk_chars).to_numpy(zero_copy_only=False)
            _, off = token_ids(pc.if_else(pa.array(huge), "", texts), tokenizer)
            n_tokens, chunks = np.diff(off), np.ones(len(off) - 1, dtype=np.int32)
            for i in np.flatnonzero(huge):
                ids, chunks[i] = spliced_ids(texts[i].as_py(), tok, chunk_chars, overlap_chars)
                n_tokens[i] = len(ids)
            yield pa.RecordBatch.from_arrays(
                [column(run, "doc_id"), n_bytes.cast(pa.int64()), pa.array(n_tokens.astype(np.int64)), pa.array(chunks)],
                names=["doc_id", "n_bytes", "n_tokens", "n_chunks"],
            )

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(work, COUNT_SCHEMA)
