"""Benchmark decontamination by SimHash over item-sized windows.

Every benchmark item and every window of its size in a document is a multiset of word shingles.
A window's SimHash follows from running sums of its shingles' bits. A multi-index over the items'
fingerprints splits the 64 bits into ``BLOCKS`` blocks: two fingerprints within ``RADIUS`` bits
agree in some block up to ``RADIUS // BLOCKS`` bits, so looking up each block's value among all
values that near yields every item within the radius. What is found is confirmed by the exact
weighted Jaccard similarity (sum of least over sum of greatest shingle counts).

Of distinct shingles, a pair with similarity 0.8 has a cosine of about 0.89, so that 9.7 of 64 bits
differ on average with a standard deviation of 2.9; the radius of 19 lies more than three deviations
above. Where a shingle repeats (a copy cut short and filled with one word), the cosine can be lower at
the same similarity. So the shingles that a window shares with an item are counted too, and windows with as many
as the threshold needs are confirmed whatever their fingerprint. Windows that share no shingle with any
item have similarity 0; their fingerprints are not computed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybridge.llm.text import U64, Words, column, free_tables, runs, shingle_hashes

RADIUS, BLOCKS = 19, 4
BITS = 64 // BLOCKS
#: Items whose index goes to the tasks at once (about 40 KB each); a larger benchmark takes several passes.
ITEMS_AT_ONCE = 1_000
#: Shingles whose running sums are in memory at once: windows are taken in stretches that cover about so many.
COVER_AT_ONCE = 1 << 15
#: Bytes of text whose words and shingles are in memory at once.
TEXT_AT_ONCE = 2 << 20
HIT_SCHEMA = "doc_id long, item_id long, first_word long, n_words long, similarity double"


def _near_masks(radius: int) -> np.ndarray:
    """All block values with at most ``radius`` bits set."""
    return np.array([sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(BITS), r)])


def simhash(bit_sums: np.ndarray) -> np.ndarray:
    """Fingerprint from sums of +1/-1 per bit: bit set where the sum is above 0."""
    return np.packbits(bit_sums > 0, axis=1).view(U64).reshape(-1)


def _signs(hashes: np.ndarray) -> np.ndarray:
    return (np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) << 1) - 1


def _covered(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All positions of the stretches ``low`` to ``high``, both included, in ascending order and once each."""
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    fresh = np.r_[True, low[1:] > high[:-1]]
    first, n = low[fresh], high[np.r_[fresh[1:], True]] - low[fresh] + 1
    return np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)


def _ends(offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """End of the document of each position."""
    return offsets[np.searchsorted(offsets, starts, side="right")]


def _stretches(starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ascending window starts, cut into stretches that cover about ``COVER_AT_ONCE`` positions each."""
    before = np.r_[0, np.maximum.accumulate(ends)[:-1]]
    covered = np.cumsum(np.maximum(ends - np.maximum(starts, before), 0))
    return np.split(starts, np.flatnonzero(np.diff(covered // COVER_AT_ONCE)) + 1)


class ItemIndex:
    """Fingerprints and shingles of items that share one shingle size, with the multi-index of their blocks."""

    def __init__(self, items: list[tuple[int, np.ndarray, int]], size: int):
        self.size = size
        self.ids = np.array([i for i, _, _ in items], dtype=np.int64)
        self.shingles = [h for _, h, _ in items]
        self.words = np.array([w for _, _, w in items], dtype=np.int64)
        self.prints = np.concatenate([simhash(_signs(h).sum(axis=0, keepdims=True)) for h in self.shingles])
        owner = np.repeat(np.arange(len(items)), [len(h) for h in self.shingles])
        flat = np.concatenate(self.shingles)
        order = np.lexsort((owner, flat))
        self.known, first = np.unique(flat[order], return_index=True)
        self.owner, self.owner_off = owner[order], np.r_[first, len(flat)]
        self.filter = np.zeros(1 << 22, dtype=bool)
        self.filter[self.known & U64((1 << 22) - 1)] = True
        masks = _near_masks(RADIUS // BLOCKS)
        self.tables = []
        for b in range(BLOCKS):
            value = ((self.prints >> U64(b * BITS)) & U64((1 << BITS) - 1)).astype(np.int64)
            keys = (value[:, None] ^ masks[None, :]).reshape(-1)
            order = np.argsort(keys, kind="stable")
            offsets = np.searchsorted(keys[order], np.arange((1 << BITS) + 1))
            self.tables.append((offsets, np.repeat(np.arange(len(items)), len(masks))[order].astype(np.int32)))

    def within_radius(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (fingerprint, item) positions with at most ``RADIUS`` differing bits."""
        found = []
        for b, (offsets, owner) in enumerate(self.tables):
            value = ((prints >> U64(b * BITS)) & U64((1 << BITS) - 1)).astype(np.int64)
            n = offsets[value + 1] - offsets[value]
            w = np.repeat(np.arange(len(prints)), n)
            at = np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(offsets[value], n)
            item = owner[at]
            near = np.bitwise_count(prints[w] ^ self.prints[item]) <= RADIUS
            found.append(w[near] * len(self.ids) + item[near])
        pairs = np.unique(np.concatenate(found))
        return pairs // len(self.ids), pairs % len(self.ids)

    def hits(
        self, shingles: np.ndarray, offsets: np.ndarray, threshold: float = 0.8
    ) -> list[tuple[int, int, int, int, float]]:
        """(document, item, first word, words, similarity) of the best window of each document and item."""
        at = np.flatnonzero(self.filter[shingles & U64((1 << 22) - 1)])
        place = np.minimum(np.searchsorted(self.known, shingles[at]), len(self.known) - 1)
        at, place = at[self.known[place] == shingles[at]], place[self.known[place] == shingles[at]]
        if not len(at):
            return []
        n = self.owner_off[place + 1] - self.owner_off[place]
        item = self.owner[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.owner_off[place], n)]
        at = np.repeat(at, n)
        doc = np.searchsorted(offsets, at, side="right") - 1
        span = self.words[item] - self.size + 1  # shingles in a window of the item's size
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        for length in np.unique(span):
            mine = span == length
            d, p = doc[mine], at[mine]
            # Window starts that cover a hit: a stretch of starts for each hit, cut to the document.
            low = np.maximum(p - length + 1, offsets[d])
            high = np.maximum(np.minimum(p, offsets[d + 1] - length), offsets[d])
            low = np.minimum(low, high)
            starts = _covered(low, high)
            for some in _stretches(starts, np.minimum(starts + length, _ends(offsets, starts))):
                self._windows(shingles, offsets, some, int(length), best)
            self._counted(shingles, offsets, starts, int(length), d, item[mine], p, threshold, best)
        return [(d, i, s, w, sim) for (d, i), (sim, s, w) in best.items()]

    def _windows(self, shingles, offsets, starts, length, best) -> None:
        doc = np.searchsorted(offsets, starts, side="right") - 1
        ends = np.minimum(starts + length, offsets[doc + 1])
        # Running sums over the stretches that the windows cover, one after another.
        fresh = np.ones(len(starts), dtype=bool)
        fresh[1:] = starts[1:] >= np.maximum.accumulate(ends)[:-1]
        group = np.cumsum(fresh) - 1
        g_start = starts[fresh]
        g_end = np.maximum.reduceat(ends, np.flatnonzero(fresh))
        size = g_end - g_start
        base = np.cumsum(size) - size
        cover = np.arange(size.sum()) - np.repeat(base, size) + np.repeat(g_start, size)
        sums = np.zeros((len(cover) + 1, 64), dtype=np.int32)
        np.cumsum(_signs(np.ascontiguousarray(shingles[cover])), axis=0, out=sums[1:])
        shift = base[group] - g_start[group]
        prints = simhash(sums[ends + shift] - sums[starts + shift])
        window, item = self.within_radius(prints)
        wanted = self.words[item] - self.size + 1 == length
        for i in np.unique(item[wanted]):
            w = window[wanted & (item == i)]
            self._confirm(shingles, offsets, starts[w], ends[w], doc[w], int(i), length, best)

    def _confirm(self, shingles, offsets, starts, ends, doc, i, length, best) -> None:
        """Exact similarity of windows to an item; the most similar, then first, window of each document stays."""
        counts = Counter(self.shingles[i].tolist())
        for s, e, d in zip(starts.tolist(), ends.tolist(), doc.tolist(), strict=True):
            mine = Counter(shingles[s:e].tolist())
            common = sum(min(c, counts[h]) for h, c in mine.items() if h in counts)
            sim, key = common / (e - s + length - common), (d, i)
            if key not in best or (sim, -(s - int(offsets[d]))) > (best[key][0], -best[key][1]):
                best[key] = (sim, s - int(offsets[d]), e - s + self.size - 1)

    def _counted(self, shingles, offsets, starts, length, doc, item, place, threshold, best) -> None:
        """Confirm every window that shares as many shingles with an item as the threshold needs.

        At most as many shingles are common as there are positions of the window whose shingle the item has. ``doc``, ``item`` and
        ``place`` list these positions.
        """
        order = np.lexsort((place, item, doc))
        doc, item, place = doc[order], item[order], place[order]
        head = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])])
        tail = np.r_[head[1:], len(doc)]
        room = np.minimum(offsets[doc[head] + 1] - offsets[doc[head]], length)
        share = threshold / (1 + threshold)
        for k in np.flatnonzero(tail - head >= np.floor(share * (room + length))):
            d, i, at = int(doc[head[k]]), int(item[head[k]]), place[head[k] : tail[k]]
            own = starts[np.searchsorted(starts, offsets[d]) : np.searchsorted(starts, offsets[d + 1])]
            ends = np.minimum(own + length, offsets[d + 1])
            shared = np.searchsorted(at, ends) - np.searchsorted(at, own)
            some = shared >= np.floor(share * (ends - own + length))
            if some.any():
                self._confirm(shingles, offsets, own[some], ends[some], np.full(int(some.sum()), d), i, length, best)


def item_blocks(spark: SparkSession, items: DataFrame, id_col: str, text_col: str, size: int) -> Iterator[list]:
    """Indexes over at most ``ITEMS_AT_ONCE`` items each; one block of items at a time is on the driver."""
    texts = items.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")
    )
    blocks = max(1, -(-texts.count() // ITEMS_AT_ONCE))
    for b in range(blocks):
        rows = texts.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).distinct().collect()
        rows.sort(key=lambda r: (r[0], r[1] or ""))
        words = Words(pa.array([r[1] for r in rows], pa.string()))
        hashes, n = words.hashes()[words.ids], words.counts()
        by_size: dict[int, list] = {}
        for k in sorted({min(size, int(x)) for x in n if x}):
            shingles, off = shingle_hashes(hashes, words.offsets, k)
            by_size[k] = [
                (r[0], shingles[off[i] : off[i + 1]], int(n[i])) for i, r in enumerate(rows) if min(size, int(n[i])) == k
            ]
        yield [ItemIndex(found, k) for k, found in by_size.items()]


def _run_hits(texts: pa.Array, indexes: list[ItemIndex], threshold: float) -> list[tuple]:
    words = Words(texts)
    hashes = words.hashes()[words.ids]
    found = []
    for index in indexes:
        shingles, off = shingle_hashes(hashes, words.offsets, index.size)
        for d, i, first, n, sim in index.hits(shingles, off, threshold):
            if sim >= threshold:
                found.append((d, int(index.ids[i]), first, n, sim))
    return sorted(found)


def benchmark_hits(
    docs: DataFrame,
    items: DataFrame,
    shingle_words: int = 5,
    threshold: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Passages of the benchmark in the documents: doc_id, item_id, first_word, n_words, similarity.

    One row per document and item, with its most similar (then first) window. Words are lower-cased
    (A-Z). An item with fewer words than a shingle is one shingle; a null, empty or blank text,
    document or item, matches nothing. A document shorter than an item is one window. Rows that
    share a doc_id, null included, are searched each for itself; items without item_id are not
    searched for. Other columns are ignored. Nothing is shuffled.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    result = None
    for indexes in item_blocks(spark, items, item_id_col, item_text_col, shingle_words):
        shared = spark.sparkContext.broadcast(indexes)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            free_tables()
            for run in runs(batches, "text", TEXT_AT_ONCE):
                found = _run_hits(column(run, "text"), shared.value, threshold)
                if found:
                    d, i, f, n, s = (list(x) for x in zip(*found, strict=True))
                    ids = column(run, "doc_id").take(pa.array(d))
                    yield pa.RecordBatch.from_arrays(
                        [ids, *(pa.array(x, pa.int64()) for x in (i, f, n)), pa.array(s)],
                        names=["doc_id", "item_id", "first_word", "n_words", "similarity"],
                    )

        hits = texts.mapInArrow(work, HIT_SCHEMA)
        result = hits if result is None else result.union(hits)
    return result


def remove_contaminated(
    docs: DataFrame,
    items: DataFrame,
    shingle_words: int = 5,
    threshold: float = 0.8,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, all columns, in whose text no item was found (see ``benchmark_hits``)."""
    spark = docs.sparkSession
    for indexes in item_blocks(spark, items, item_id_col, item_text_col, shingle_words):
        shared = spark.sparkContext.broadcast(indexes)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            free_tables()
            for run in runs(batches, text_col, TEXT_AT_ONCE):
                clean = np.ones(run.num_rows, dtype=bool)
                clean[[x[0] for x in _run_hits(column(run, text_col), shared.value, threshold)]] = False
                yield run.filter(pa.array(clean))

        docs = docs.mapInArrow(work, docs.schema)
    return docs
