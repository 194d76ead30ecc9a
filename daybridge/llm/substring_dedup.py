"""Substring deduplication by recompression.

A text's words get 64-bit names. Each round of recompression joins runs of one name, and a name of
the left half of the alphabet with a following name of the right half (a hash of the name says which
half), into one symbol that is named by its content. The names are hashes, so that all tasks give
equal runs and pairs the same name with no table to exchange, and a text needs no other text for its
rounds. What a symbol is depends on few words around it: these are tracked, round by round, so that
every symbol knows the span of words that fixes it. A window of ``window`` words that holds this span
has the symbol wherever the window occurs.

A window is therefore filed under one of its interior symbols, that of the least name. Neighbouring
windows of one symbol form a unit, with two keys: that of the symbol (its span of words) and that of
the unit (all its words). Spark then counts keys:

1. a symbol that occurs once in the corpus has no repeated window (most units end here),
2. a unit that occurs twice is repeated whole,
3. the windows of the other units, which lie at the ends of repeats, are counted one by one among the
   distinct units of their symbol.

A window counts as repeated only where symbol and unit, or symbol and window, agree: 128 bits of hash.
Counts are summed before they are shuffled, the joins are by key alone, and no step gathers the places
of a repeat, so that a passage of a third of all documents is no hot spot. Windows without interior
symbol (a word repeated over and over) are units of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybridge.llm.columns import words_of
from daybridge.llm.tables import Tables
from daybridge.llm.text import U64, Words, column, mix, runs

WINDOW = 35
#: Rounds of recompression. A symbol then has 2.4 words and is fixed by about 10.
ROUNDS = 3
#: The filter that keeps texts without a wanted key out of a join has 2 to this power bits: 262,144 rows of 16 bytes at most.
FILTER_BITS = 24
RUN_TEXT = 4 << 20
_A, _B = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)
_OUTSIDE = 1 << 40


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix((left * _A) ^ (right + _B))


def _blocks(h: np.ndarray, longest: int) -> list[np.ndarray]:
    """Hashes of the 1, 2, 4, .. words from each position on, up to ``longest`` words."""
    out = [mix(h + _B)]
    while 2 << (len(out) - 1) <= longest:
        step = 1 << (len(out) - 1)
        last = out[-1]
        twice = np.zeros_like(last)
        if len(last) > step:
            twice[:-step] = _joined(last[:-step], last[step:])
        out.append(twice)
    return out


def _span_hash(blocks: list[np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of the words lo..hi: two blocks of a power of two that cover them, and their number."""
    size = hi - lo
    power = np.log2(np.maximum(size, 1)).astype(np.int64)
    out = np.zeros(len(lo), dtype=U64)
    for k in np.unique(power):
        at = np.flatnonzero(power == k)
        out[at] = _joined(blocks[k][lo[at]], blocks[k][hi[at] - (1 << k)])
    return mix(out + size.astype(U64) * _A)


def recompressed(names: np.ndarray, offsets: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after some rounds: name, and the words lo..hi that fix it. All texts at once, one after another.

    ``lo`` or ``hi`` lies far outside where the end of the text has a say. For a boundary between two
    symbols a round looks at both of them, so the words that fix it grow by a symbol on either side.
    """
    n = len(names)
    start = np.arange(n)
    first = np.zeros(n, dtype=bool)
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    lo, hi = start.copy(), start.copy()
    for t in range(rounds):
        m = len(start)
        right = (mix(names + np.array([t + 1], U64) * _A) >> U64(63)).astype(bool)
        gone = np.zeros(m, dtype=bool)
        gone[1:] = ((names[1:] == names[:-1]) | (~right[:-1] & right[1:])) & ~first[1:]
        # Words always begin where they begin; later, the first symbol of a text depends on what stood before.
        begin, end = np.full(m, -_OUTSIDE), np.full(m, _OUTSIDE if t else n)
        begin[1:] = np.where(first[1:], -_OUTSIDE, np.minimum(lo[:-1], start[:-1]))
        end[:-1] = np.where(first[1:], _OUTSIDE, np.maximum(hi[1:], start[1:])) if t else start[1:]
        at = np.flatnonzero(~gone)
        size = np.diff(np.r_[at, m])
        place = (np.arange(m) - np.repeat(at, size)).astype(U64)
        names = mix(np.add.reduceat(mix(names + place * _A), at) + size.astype(U64) * _B) if m else names
        start, lo, hi, first = start[at], begin[at], end[at], first[at]
    last = np.r_[first[1:], True][: len(first)]
    behind = np.r_[hi[1:], 0][: len(hi)]
    return (
        names,
        np.where(first, -_OUTSIDE, np.minimum(lo, start)),
        np.where(last, _OUTSIDE, np.maximum(behind, np.r_[start[1:], n][: len(start)])),
    )


def _least(value: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Index of the least value (the leftmost of them) in each range a..b, both included."""
    power = np.log2(b - a + 1).astype(np.int64)
    out = np.zeros(len(a), dtype=np.int64)
    table = np.arange(len(value))
    for k in range(int(power.max()) + 1 if len(power) else 0):
        if k:
            x, y = table[: -(1 << (k - 1))], table[1 << (k - 1) :]
            table = np.where(value[x] <= value[y], x, y)
        at = np.flatnonzero(power == k)
        x, y = table[a[at]], table[b[at] - (1 << k) + 1]
        out[at] = np.where(value[x] <= value[y], x, y)
    return out


class Units:
    """Units of the windows of some texts.

    ``start``/``end``: first and last window of each unit (word positions over all texts), ``doc``,
    ``symbol`` and ``unit`` keys. ``window``: key of the window at each word position, where one begins.
    """

    def __init__(self, hashes: np.ndarray, offsets: np.ndarray, window: int, rounds: int = ROUNDS):
        count = np.maximum(np.diff(offsets) - window + 1, 0)
        doc = np.repeat(np.arange(len(count)), count)
        at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + offsets[doc]
        blocks = _blocks(hashes, window)
        half = 1 << (len(blocks) - 1)
        full = _joined(blocks[-1][at], blocks[-1][at + window - half])
        names, lo, hi = recompressed(hashes, offsets, rounds)
        inside = (lo > -_OUTSIDE) & (hi < _OUTSIDE) & (hi - lo <= window)
        names, lo, hi = names[inside], lo[inside], hi[inside]
        a, b = np.searchsorted(lo, at, side="left"), np.searchsorted(hi, at + window, side="right") - 1
        some = np.flatnonzero(a <= b)
        chosen = -1 - np.arange(len(at))
        chosen[some] = _least(mix(names + _B), a[some], b[some])
        new = np.ones(len(at), dtype=bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (doc[1:] != doc[:-1])
        head = np.flatnonzero(new)
        tail = np.r_[head[1:], len(at)][: len(head)] - 1
        self.doc, self.start, self.end = doc[head], at[head], at[tail]
        self.symbol = full[head].copy()
        held = chosen[head] >= 0
        own = chosen[head][held]
        self.symbol[held] = _span_hash(blocks, lo[own], hi[own])
        self.unit = mix(_joined(full[head], full[tail]) + (tail - head).astype(U64) * _B)
        self.head, self.tail, self.window, self.at, self.window_doc = head, tail, full, at, doc


def _words(texts: pa.Array) -> tuple[Words, np.ndarray]:
    words = Words(texts, lower=False)
    return words, words.hashes()[words.ids] if len(words.ids) else np.zeros(0, U64)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def _digests(words: Words, keep: np.ndarray | None = None) -> list[str]:
    """sha256 of each text's kept words, joined by one space."""
    ids, offsets = words.ids, words.offsets
    if keep is not None:
        before = np.r_[0, np.cumsum(keep)]
        ids, offsets = ids[keep], before[offsets]
    joined = pc.binary_join(_lists(offsets, words.vocab.take(pa.array(ids))), " ")
    return [sha256(t.as_buffer()).hexdigest() for t in joined]


def _parse(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per text: number of words, digest of all of them, and its distinct units (n: 2 for one that it holds more often)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, "text", RUN_TEXT):
            words, hashes = _words(column(run, "text"))
            u = Units(hashes, words.offsets, window)
            order = np.lexsort((u.unit, u.symbol, u.doc))
            doc, symbol, unit = u.doc[order], u.symbol[order], u.unit[order]
            new = np.ones(len(doc), dtype=bool)
            new[1:] = (doc[1:] != doc[:-1]) | (symbol[1:] != symbol[:-1]) | (unit[1:] != unit[:-1])
            at = np.flatnonzero(new)
            often = np.minimum(np.diff(np.r_[at, len(doc)]), 2).astype(np.int8)
            offsets = np.r_[0, np.cumsum(np.bincount(doc[at], minlength=run.num_rows))]
            yield pa.RecordBatch.from_arrays(
                [
                    column(run, "h"),
                    column(run, "id"),
                    pa.array(words.counts()),
                    pa.array(_digests(words), pa.string()),
                    _lists(offsets, _signed(symbol[at])),
                    _lists(offsets, _signed(unit[at])),
                    _lists(offsets, pa.array(often)),
                ],
                names=["h", "id", "n_words", "kept_sha256", "symbol", "unit", "n"],
            )

    return work


def _windows(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The windows of the units that a text is asked for (column keys)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, "text", RUN_TEXT):
            words, hashes = _words(column(run, "text"))
            u = Units(hashes, words.offsets, window)
            wanted = _asked(u.doc, u.unit, column(run, "keys"))
            picks = np.flatnonzero(wanted)
            order = picks[np.lexsort((u.unit[picks], u.symbol[picks], u.doc[picks]))]
            if len(order):
                same = (u.doc[order][1:] == u.doc[order][:-1]) & (u.symbol[order][1:] == u.symbol[order][:-1])
                same &= u.unit[order][1:] == u.unit[order][:-1]
                order = order[np.r_[True, ~same]]
            size = u.tail[order] - u.head[order] + 1
            at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(u.head[order], size)
            h = column(run, "h").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[u.doc[order]]), _signed(u.symbol[order]), _lists(np.r_[0, np.cumsum(size)], _signed(u.window[at]))],
                names=["h", "symbol", "windows"],
            )

    return work


def _asked(doc: np.ndarray, values: np.ndarray, keys: pa.Array) -> np.ndarray:
    """Which values stand in the list of keys of their own text."""
    offsets = keys.offsets.to_numpy()
    flat = keys.flatten().to_numpy(zero_copy_only=False).view(U64)
    flat_doc = np.repeat(np.arange(len(keys)), np.diff(offsets))
    out = np.zeros(len(values), dtype=bool)
    own = np.searchsorted(doc, np.arange(len(keys) + 1))
    ends = np.searchsorted(flat_doc, np.arange(len(keys) + 1))
    for i in range(len(keys)):
        if own[i] < own[i + 1] and ends[i] < ends[i + 1]:
            out[own[i] : own[i + 1]] = np.isin(values[own[i] : own[i + 1]], flat[ends[i] : ends[i + 1]])
    return out


def _remove(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Words that a repeated window covers; column keys holds the repeated units and windows of a text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, "text", RUN_TEXT):
            words, hashes = _words(column(run, "text"))
            u = Units(hashes, words.offsets, window)
            keys = column(run, "keys")
            whole = np.repeat(_asked(u.doc, u.unit, keys), u.tail - u.head + 1)
            repeated = u.at[whole | _asked(u.window_doc, u.window, keys)]
            edge = np.bincount(repeated, minlength=len(hashes) + window) - np.bincount(
                repeated + window, minlength=len(hashes) + window
            )
            gone = np.cumsum(edge)[: len(hashes)] > 0
            before = np.r_[0, np.cumsum(gone)]
            owner = np.repeat(np.arange(run.num_rows), words.counts())
            new, ends = gone.copy(), gone.copy()
            new[1:] &= ~gone[:-1] | (owner[1:] != owner[:-1])
            ends[:-1] &= ~gone[1:] | (owner[1:] != owner[:-1])
            a, b = np.flatnonzero(new), np.flatnonzero(ends) + 1
            shift = words.offsets[:-1][owner[a]]
            span = pa.StructArray.from_arrays([pa.array(a - shift), pa.array(b - shift)], names=["start", "end"])
            removed = np.r_[0, np.cumsum(np.bincount(owner[a], minlength=run.num_rows))]
            yield pa.RecordBatch.from_arrays(
                [
                    column(run, "id"),
                    pa.array(words.counts()),
                    pa.array(np.diff(before[words.offsets])),
                    pa.array(_digests(words, ~gone), pa.string()),
                    _lists(removed, span),
                ],
                names=["id", "n_words", "n_removed", "kept_sha256", "removed"],
            )

    return work


def _holding(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """Texts joined with their keys (h, keys). A filter of fixed size spares most other texts the shuffle."""
    slot, mask = F.expr(f"h & {(1 << FILTER_BITS) - 1}"), F.expr("shiftleft(1L, cast(h & 63 AS int))")
    bits = keys.groupBy(F.shiftright(slot, 6).alias("slot")).agg(F.bit_or(mask).alias("bits"))
    held = texts.withColumn("slot", F.shiftright(slot, 6)).join(F.broadcast(bits), "slot")
    return held.where(F.col("bits").bitwiseAND(mask) != 0).drop("slot", "bits").join(keys, "h")


def dedup_substrings(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Word spans of each document that other places of the corpus, or of the document itself, repeat.

    Words are runs without white space, unchanged. A word is removed if it lies in a window of ``window``
    words that also starts anywhere else; all windows are judged on the input. Returns a row per row of
    ``docs``: the id, n_words, n_removed, kept_sha256 (of the kept words joined by one space) and removed
    (spans of word numbers, end exclusive; see :func:`kept_text`).

    Null, empty and blank texts have no words. Repeated rows and equal texts repeat each other; null
    and repeated ids are ids like others. Other columns of ``docs`` are not read. An empty table gives none.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # h only says where a text's keys go: a text looks its keys up by content, so that equal h do no harm
    texts = plain.select(F.xxhash64("id", "text").alias("h"), "id", "text")
    steps = Tables(spark)
    parsed = steps.keep(
        "recompressed",
        texts.mapInArrow(
            _parse(window),
            f"h long, id {kind}, n_words long, kept_sha256 string, symbol array<long>, unit array<long>, n array<tinyint>",
        ),
    )
    units = parsed.select("h", F.inline(F.arrays_zip("symbol", "unit", "n")))
    shared = units.groupBy("symbol").agg(F.sum("n").alias("all")).where("all > 1").select("symbol")
    units = steps.keep("shared-units", units.join(shared, "symbol", "left_semi"))
    whole = steps.keep("whole-texts", parsed.select("h", "id", "n_words", "kept_sha256"))
    steps.drop("recompressed")  # most of it are units of symbols that occur once
    classes = units.groupBy("symbol", "unit").agg(F.sum("n").alias("all"), F.min("h").alias("h"))
    classes = steps.keep("unit-classes", classes)

    alone = classes.where("all = 1").select("symbol").distinct()
    asked = classes.join(alone, "symbol", "left_semi").groupBy("h").agg(F.collect_set("unit").alias("keys"))
    asked = steps.keep("asked-units", asked)
    windows = _holding(texts, asked).select("h", "text", "keys")
    windows = windows.mapInArrow(_windows(window), "h long, symbol long, windows array<long>")
    windows = steps.keep("unit-windows", windows)
    single = windows.select("h", "symbol", F.explode("windows").alias("key"))
    twice = single.groupBy("symbol", "key").count().where("count > 1").select("symbol", "key")
    edges = single.join(twice, ["symbol", "key"], "left_semi").select("h", "key")
    again = classes.where("all > 1").select("symbol", "unit")
    insides = units.join(again, ["symbol", "unit"], "left_semi").select("h", F.col("unit").alias("key"))
    marks = steps.keep("repeated-keys", insides.union(edges).groupBy("h").agg(F.collect_set("key").alias("keys")))
    steps.drop("shared-units", "unit-classes", "asked-units", "unit-windows")

    spans = "array<struct<start: long, end: long>>"
    cut = _holding(texts, marks).select("id", "text", "keys").mapInArrow(
        _remove(window), f"id {kind}, n_words long, n_removed long, kept_sha256 string, removed {spans}"
    )
    clean = whole.join(marks, "h", "left_anti").select(
        "id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256", F.array().cast(spans).alias("removed")
    )
    return cut.union(clean).withColumnRenamed("id", id_col)


def kept_text(text: Column, removed: Column) -> Column:
    """A text's words outside the removed spans, joined by one space."""
    words = words_of(text)
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(removed, lambda s: s["end"]))
    starts = F.concat(F.transform(removed, lambda s: s["start"]), F.array(F.size(words).cast("long")))
    gaps = F.transform(
        F.arrays_zip(ends.alias("a"), starts.alias("b")),
        lambda g: F.slice(words, (g["a"] + 1).cast("int"), (g["b"] - g["a"]).cast("int")),
    )
    return F.array_join(F.flatten(gaps), " ")
