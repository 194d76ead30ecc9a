"""Hierarchical Pitman-Yor language model over words, and text scores under it.

A text is the sequence of its words (lower-cased A-Z), then one end. The outcomes are the words met
in training, the end, and one outcome for all other words, as in the add-one base distribution.

Restaurants. The context of a token is the word before it: its class, and 128 hash values of the whole
word within the class. Short words, which are the function words of a language, have classes of their
own, longer ones are classed by their last sign. A context is a restaurant; its parent gathers the
contexts of a class, the next one all classes of a kind (short word, letter, sign, start); the parent of
the kinds is the restaurant without context, whose base distribution is diffuse, so that its new
dishes are the unmet words. A customer is a token and a dish its word; a customer who opens a table sends a
customer to the parent. Seating is sampled by Gibbs sweeps: all customers of a dish in a restaurant get
up and sit down again one by one by the Chinese-restaurant rule, the other dishes' seats held. The rule
is run from opening to opening: with n tables and i guests, the number of guests until the next opening
is geometric with a Beta(strength, i - discount * n) probability, as in Polya's urn, so that a dish with
a billion customers takes as many steps as it has tables. Predictive probabilities are averaged over
the states after the last sweeps; the first ones are not counted.

Plan on the cluster. The texts are dealt into blocks by a hash. Each block sends its distinct
(word, context) pairs with their counts, cut into buckets by word hash, as compact arrays: a word
met a billion times is one entry per block and context. A bucket holds all contexts of its words and samples
their seats; the tables and guests of the restaurants, 66,000 sums over all buckets, are exchanged after
every sweep. A bucket's seats follow from its counts, the sums so far and a fixed seed, so they are sampled
again and not stored, and a state's probabilities add up to one over the words. Then each bucket answers every block with the values of the pairs it asked for, and the
blocks add up their documents. Words are told apart by 48 bits of a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybridge.llm.graph import stored
from daybridge.llm.text import U64, column, mix, runs

END, GAP = 10, 32  # symbols: after a text, between two words
START = 256  # class of a text's first token; 0-127 are last signs, 128-255 short words
SHORT = 3  # bytes of a short word
CONTEXT_BITS, WITHIN_BITS = 16, 7  # of a key; of those, the word's hash within its class
# Restaurant without context, kinds, classes, contexts; chosen by held-out perplexity on the sample tables.
DISCOUNTS = (0.8, 0.75, 0.8, 0.9)
STRENGTH = 1.0
#: Dishes still opening tables, below which arrays cost more than they spare.
FEW = 16
#: Sweeps of all restaurants, after each of which sums are exchanged, and how many of the last states are averaged.
ROUNDS, SAMPLES = 4, 3
BLOCK_BYTES, RUN_BYTES = 16 << 20, 1 << 20
BUCKET_BYTES = 6 << 20  # text bytes for which there is one bucket more

ASKED_SCHEMA = "block long, bucket int, asked binary"
STATE_SCHEMA = "bucket int, blocks array<long>, asked array<binary>"
ANSWER_SCHEMA = "block long, bucket int, answer binary"
SCORE_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, score double"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_CLASSES = START + 1
_CONTEXTS = _CLASSES << WITHIN_BITS
_LAST_SIGN = np.array([b if b < 128 else b & 31 for b in range(256)])
#: Class of each context, and kind of each class: letter, sign, short word, start.
_CLASS = np.arange(_CONTEXTS) >> WITHIN_BITS
_KIND = np.array([0 if c < 32 or chr(c).isalnum() else 1 if c < 128 else 2 if c < START else 3 for c in range(_CLASSES)])
_KINDS = 4
#: Where the sums of all buckets lie: tables of contexts, classes and kinds, met words, customers of contexts.
_SLOTS = np.cumsum([0, _CONTEXTS, _CLASSES, _KINDS, 1, _CONTEXTS])


# --- tokens of a run of texts --------------------------------------------------------------------


def symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts with offsets: word bytes, one gap between words, one end after each text."""
    texts = pa.concat_arrays([pc.fill_null(texts, "")])
    n = len(texts)
    off = np.frombuffer(texts.buffers()[1], dtype=np.int32, count=n + 1).astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8, count=int(off[-1])) if raw is not None else np.zeros(0, np.uint8)
    ends = off[1:] + np.arange(n)
    begins = np.r_[0, ends[:-1] + 1] if n else np.zeros(0, np.int64)
    inside = np.ones(len(data) + n, dtype=bool)
    inside[ends] = False
    out = np.full(len(data) + n, END, dtype=np.uint8)
    out[inside] = _LOWER[data]
    space = _SPACE[out]
    keep = ~space
    keep[:-1] |= space[:-1] & ~space[1:]  # the last sign of a run of white space
    solid = np.flatnonzero(~space)
    if len(solid):
        first = solid[np.minimum(np.searchsorted(solid, begins), len(solid) - 1)]
        keep[first[first > begins] - 1] = False  # white space before the first word
    out[space & inside] = GAP
    keep[ends] = True
    before = np.zeros(len(out) + 1, dtype=np.int64)
    np.cumsum(keep, out=before[1:])
    return out[keep], np.r_[before[begins], before[-1]] if n else np.zeros(1, np.int64)


def tokens(stream: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, context) key of every token, the end included, with offsets per text."""
    n = len(stream)
    power = np.cumprod(np.full(n, _FACTOR, dtype=U64))
    back = np.cumprod(np.full(n, _INVERSE, dtype=U64))
    total = np.zeros(n + 1, dtype=U64)
    np.cumsum((stream.astype(U64) + U64(1)) * power, out=total[1:])
    stop = np.flatnonzero((stream == GAP) | (stream == END))
    start = np.r_[0, stop[:-1] + 1] if len(stop) else stop
    real = stop > start  # an end after nothing spells no word
    stop, start = stop[real], start[real]
    word = mix((total[stop] - total[start]) * back[start])
    short = stop - start <= SHORT
    group = np.where(short, 128 + (word >> U64(57)).astype(np.int64), _LAST_SIGN[stream[stop - 1]])
    group = (group << WITHIN_BITS) | ((word >> U64(57 - WITHIN_BITS)).astype(np.int64) & ((1 << WITHIN_BITS) - 1))
    words_to = np.zeros(n + 1, dtype=np.int64)
    words_to[stop + 1] = 1
    np.cumsum(words_to, out=words_to)
    count = np.diff(words_to[offsets])
    out = np.r_[0, np.cumsum(count + 1)]
    keys = np.full(out[-1], mix(np.array([END], dtype=U64))[0])
    context = np.full(out[-1], START << WITHIN_BITS, dtype=np.int64)
    is_word = np.ones(out[-1], dtype=bool)
    is_word[out[1:] - 1] = False
    keys[is_word] = word
    context[np.flatnonzero(is_word) + 1] = group  # a word is followed by a word or the end
    return (keys & ~U64((1 << CONTEXT_BITS) - 1)) | context.astype(U64), out


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the word hash, so that sorted keys lie in bucket order."""
    return ((keys >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def _context(keys: np.ndarray) -> np.ndarray:
    return (keys & U64((1 << CONTEXT_BITS) - 1)).astype(np.int64)


def _first_of_word(keys: np.ndarray) -> np.ndarray:
    word = keys >> U64(CONTEXT_BITS)
    return np.r_[True, word[1:] != word[:-1]] if len(keys) else np.zeros(0, bool)


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct keys; ``np.unique`` without further answers hashes them, which takes far longer than a sort."""
    keys = np.sort(keys)
    return keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys


def packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys with counts: each word once, then its contexts."""
    first = np.flatnonzero(_first_of_word(keys))
    contexts = np.diff(np.r_[first, len(keys)]).astype("<u2")
    head = np.array([len(first), len(keys)], dtype="<i8")
    parts = (head, keys[first] >> U64(CONTEXT_BITS), contexts, _context(keys).astype("<u2"), counts.astype("<u4"))
    return b"".join(x.tobytes() for x in parts)


def _digest(keys: np.ndarray) -> bytes:
    return np.bitwise_xor.reduce(mix(keys)).astype("<u8").tobytes()


def unpacked(blob: memoryview) -> tuple[np.ndarray, np.ndarray]:
    m, n = (int(x) for x in np.frombuffer(blob, dtype="<i8", count=2))
    at = 16
    word = np.frombuffer(blob, dtype="<u8", count=m, offset=at)
    contexts = np.frombuffer(blob, dtype="<u2", count=m, offset=at + 8 * m)
    context = np.frombuffer(blob, dtype="<u2", count=n, offset=at + 10 * m)
    counts = np.frombuffer(blob, dtype="<u4", count=n, offset=at + 10 * m + 2 * n)
    return np.repeat(word << U64(CONTEXT_BITS), contexts) | context.astype(U64), counts


def block_runs(table: pa.Table) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in table.to_batches():
        for run in runs(iter([batch]), "text", RUN_BYTES):
            yield run, *tokens(*symbols(column(run, "text")))


# --- seating -------------------------------------------------------------------------------------


def seat(customers: np.ndarray, strength: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables after seating the customers of each dish anew.

    ``strength`` gives, for a dish with no table yet, its weight for opening one and what each own
    table adds to it: rows (base, step) so that with n tables the weight is base + step * n.
    """
    tables = (customers > 0).astype(np.int64)
    rows = np.flatnonzero(customers > 1)
    base, step, last = strength[0][rows], strength[1][rows], customers[rows].astype(np.int64)
    n, opened = 1, np.ones(len(rows), dtype=np.int64)  # tables, and guests when the latest was opened
    while len(rows) > FEW:
        weight = np.maximum(base + step * n, 1e-12)
        chance = np.maximum(rng.beta(weight, opened - discount * n), 1e-15)
        opened = opened + rng.geometric(chance)
        n += 1
        more = (opened <= last) & (opened > 0)
        tables[rows[more]] = n
        more &= opened < last
        if not more.all():
            rows, base, step, last, opened = rows[more], base[more], step[more], last[more], opened[more]
    # The hottest dishes go on long after the others: the same draws in the same order, without arrays.
    dishes = list(zip(rows.tolist(), base.tolist(), step.tolist(), last.tolist(), strict=True))
    guests = opened.tolist()
    while dishes:
        chances = [rng.beta(max(b + s * n, 1e-12), i - discount * n) for (_, b, s, _), i in zip(dishes, guests, strict=True)]
        guests = [i + int(rng.geometric(max(chance, 1e-15))) for chance, i in zip(chances, guests, strict=True)]
        n += 1
        for (row, _, _, end), i in zip(dishes, guests, strict=True):
            if i <= end:
                tables[row] = n
        on = [k for k, i in enumerate(guests) if i < dishes[k][3]]
        if len(on) < len(dishes):
            dishes, guests = [dishes[k] for k in on], [guests[k] for k in on]
    return tables


class Seats:
    """The restaurants of one bucket's words, with the sums of all buckets.

    ``at[0]`` holds a row per (word, context), ``at[1]`` per (word, class), ``at[2]`` per (word, kind): the ``where`` of a row is its
    restaurant, ``up`` its row in the next level (the word, in the end).
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, totals: np.ndarray | None, seed: int):
        self.rng = np.random.default_rng([17, seed])
        first = _first_of_word(keys)
        word = np.cumsum(first) - 1
        context = _context(keys)
        self.count = np.bincount(word, counts, minlength=int(first.sum())).astype(np.int64)
        self.where, self.up, owner, place = [context], [], word, context
        for size, parent in ((_CLASSES, _CLASS), (_KINDS, _KIND)):
            pair, up = np.unique(owner * size + parent[place], return_inverse=True)
            owner, place = pair // size, pair % size
            self.where.append(place)
            self.up.append(up)
        self.up.append(owner)
        self.word, self.customers, self.totals = word, [counts], totals
        self.tables = []
        for level in range(3):  # one table for each dish
            self.tables.append((self.customers[level] > 0).astype(np.int64))
            if level < 2:
                self._send(level, fresh=True)

    def _send(self, level: int, fresh: bool = False) -> None:
        """The customers that a level's tables send to the next."""
        sent = np.bincount(self.up[level], self.tables[level], minlength=len(self.where[level + 1])).astype(np.int64)
        if fresh:
            self.customers.append(sent)
        else:
            self.customers[level + 1] = sent

    def sums(self) -> np.ndarray:
        """What the other buckets need, in the order of ``_SLOTS``."""
        sizes = (_CONTEXTS, _CLASSES, _KINDS)
        tables = [np.bincount(self.where[k], self.tables[k], minlength=sizes[k]) for k in range(3)]
        guests = np.bincount(self.where[0], self.customers[0], minlength=_CONTEXTS)
        return np.concatenate([*tables, [(self.count > 0).sum()], guests]).astype(np.int64)

    def _split(self) -> tuple[list[np.ndarray], int, list[np.ndarray]]:
        """Tables by restaurant of each level, met words, and guests by restaurant of each level."""
        contexts, classes, kinds, met, guests = (self.totals[a:b] for a, b in zip(_SLOTS[:-1], _SLOTS[1:], strict=True))
        of_class = np.bincount(_CLASS, contexts, minlength=_CLASSES)
        return [contexts, classes, kinds], int(met[0]), [guests, of_class, np.bincount(_KIND, classes, minlength=_KINDS)]

    def of_words(self) -> np.ndarray:
        """Restaurant without context: a met word has one table, a new table is an unmet word."""
        (_, _, kinds), met, _ = self._split()
        guests = np.bincount(self.up[2], self.tables[2], minlength=len(self.count))
        unmet = STRENGTH + DISCOUNTS[0] * met
        return np.where(guests > 0, guests - DISCOUNTS[0], unmet) / (STRENGTH + kinds.sum())

    def of_level(self, level: int) -> np.ndarray:
        """Probability of each row's word in its restaurant: 0 contexts, 1 classes, 2 kinds."""
        tables, _, guests = self._split()
        parent = (self.of_level(level + 1) if level < 2 else self.of_words())[self.up[level]]
        where, discount = self.where[level], DISCOUNTS[3 - level]
        own = self.customers[level] - discount * self.tables[level]
        return (own + (STRENGTH + discount * tables[level][where]) * parent) / (STRENGTH + guests[level][where])

    def of_contexts(self) -> np.ndarray:
        return self.of_level(0)

    def sweep(self) -> None:
        totals, _, _ = self._split()
        for level in range(3):
            parent = (self.of_level(level + 1) if level < 2 else self.of_words())[self.up[level]]
            discount = DISCOUNTS[3 - level]
            others = STRENGTH + discount * np.maximum(totals[level][self.where[level]] - self.tables[level], 0)
            weight = np.stack([others * parent, discount * parent])
            self.tables[level] = seat(self.customers[level], weight, discount, self.rng)
            if level < 2:
                self._send(level)


# --- tables --------------------------------------------------------------------------------------


def _asked_rows(buckets: int):
    def work(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        found, counted = [], []
        for run, keys, off in block_runs(table):
            held = column(run, "held_out").to_numpy(zero_copy_only=False).astype(bool)
            distinct, at = np.unique(keys, return_inverse=True)
            found.append(distinct)
            counted.append(np.bincount(at, np.repeat(~held, np.diff(off)), minlength=len(distinct)))
        distinct, at = np.unique(np.concatenate(found), return_inverse=True)
        counts = np.bincount(at, np.concatenate(counted), minlength=len(distinct)).astype(np.int64)
        bucket = _bucket(distinct, buckets)
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
        blobs = [packed(distinct[a:b], counts[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.table(
            [pa.array([key[0].as_py()] * len(blobs)), pa.array(bucket[cuts[:-1]], pa.int32()), pa.array(blobs, pa.binary())],
            names=["block", "bucket", "asked"],
        )

    return work


def _state_row(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    order = np.argsort(table.column("block").to_numpy(), kind="stable")
    rows = table.take(pa.array(order))
    return pa.table(
        [
            pa.array([key[0].as_py()], pa.int32()),
            pa.array([rows.column("block").to_pylist()], pa.list_(pa.int64())),
            pa.array([rows.column("asked").to_pylist()], pa.list_(pa.binary())),
        ],
        names=["bucket", "blocks", "asked"],
    )


def _buckets(batches: Iterator[pa.RecordBatch]):
    """(bucket, blocks, key arrays, place of each key in the bucket, first seats) of every row."""
    for batch in batches:
        for row in range(batch.num_rows):
            bucket, blocks, asked = (batch.column(i)[row] for i in range(3))
            pairs = [unpacked(blob.as_buffer()) for blob in asked.values]
            keys = [k for k, _ in pairs]
            distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
            counts = np.bincount(at, np.concatenate([c for _, c in pairs]), minlength=len(distinct)).astype(np.int64)
            yield bucket.as_py(), blocks.as_py(), keys, at, Seats(distinct, counts, None, bucket.as_py())


def _sum_rows(history: list[np.ndarray]):
    """Sums of the state after one more sweep than ``history`` has states."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(_SLOTS[-1], dtype=np.int64)
        for _, _, _, _, seats in _buckets(batches):
            for totals in history:
                seats.totals = totals
                seats.sweep()
            sums += seats.sums()
        slot = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(sums[slot])], names=["slot", "n"])

    return work


def _answer_rows(history: list[np.ndarray]):
    """Averaged probabilities of the last states, each with the sums of that very state."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, blocks, keys, at, seats in _buckets(batches):
            mean = np.zeros(len(seats.word))
            for state, totals in enumerate(history):
                if state:
                    seats.sweep()
                seats.totals = totals
                if state >= len(history) - SAMPLES:
                    mean += seats.of_contexts()
            log_p, end, blobs = np.log10(mean / SAMPLES).astype("<f4"), 0, []
            for k in keys:
                place = at[end : end + len(k)]
                end += len(k)
                count = seats.count[seats.word[place[_first_of_word(k)]]].astype("<i8")
                blobs.append(log_p[place].tobytes() + count.tobytes() + _digest(k))
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), pa.array([bucket] * len(blocks), pa.int32()), pa.array(blobs, pa.binary())],
                names=["block", "bucket", "answer"],
            )

    return work


def _scores(buckets: int):
    def work(texts: pa.Table, answers: pa.Table) -> pa.Table:
        done = []
        for run, keys, off in block_runs(texts):
            distinct, at = np.unique(keys, return_inverse=True)
            done.append((run, distinct, at.astype(np.int32), off))
        schema = pa.schema(
            [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64())]
            + [("log_counts", pa.float64()), ("score", pa.float64())]
        )
        if not done:
            return schema.empty_table()
        asked = _distinct(np.concatenate([d for _, d, _, _ in done]))
        first = _first_of_word(asked)
        bucket = _bucket(asked, buckets)
        log_p, per_word = np.empty(len(asked), dtype="<f4"), []
        blob_of = dict(zip(answers.column("bucket").to_pylist(), answers.column("answer"), strict=True))
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            blob = blob_of[int(bucket[a])].as_buffer()
            words = int(first[a:b].sum())
            if len(blob) != 4 * (b - a) + 8 * words + 8 or bytes(blob[-8:]) != _digest(asked[a:b]):
                raise RuntimeError("the texts are not those that were learnt from: their source changed meanwhile")
            log_p[a:b] = np.frombuffer(blob, dtype="<f4", count=b - a)
            per_word.append(np.frombuffer(blob, dtype="<i8", offset=4 * (b - a), count=words))
        count = np.concatenate(per_word)[np.cumsum(first) - 1]
        out = []
        for run, distinct, at, off in done:
            place = np.searchsorted(asked, distinct)
            c, starts = count[place][at], off[:-1]
            out.append(
                pa.table(
                    [
                        column(run, "doc_id"),
                        column(run, "held_out"),
                        pa.array(np.diff(off)),
                        pa.array(np.add.reduceat((c > 0).astype(np.int64), starts)),
                        pa.array(np.add.reduceat(np.log10(c + 1.0), starts)),
                        pa.array(np.add.reduceat(log_p[place].astype(np.float64)[at], starts)),
                    ],
                    schema=schema,
                )
            )
        return pa.concat_tables(out)

    return work


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the rows that are not held out and score all rows.

    Returns doc_id, held_out, n_tokens (words and the end), n_known (tokens met in training),
    train_tokens, base_score (add-one unigram log10 probability), score (log10 probability under
    the Pitman-Yor model) and perplexity (per token). A null, empty or blank text is the end alone.
    Rows are scored each for itself, whether ids repeat or are null; a null ``held_out`` counts as
    false. Other columns are ignored. An empty table gives an empty result; without training rows
    every token is unmet, with probability 1 in each restaurant.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    blocks, buckets = -(-size // BLOCK_BYTES) or 1, 8 + -(-size // BUCKET_BYTES)
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    # Dealt by place, not by content: rows alike, or without id, go to all blocks.
    texts = texts.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)))
    asked = texts.groupBy("block").applyInArrow(_asked_rows(buckets), ASKED_SCHEMA)
    state = stored(asked.groupBy("bucket").applyInArrow(_state_row, STATE_SCHEMA), "restaurants")
    history: list[np.ndarray] = []
    for _ in range(1 + ROUNDS):  # the first state has one table for each dish
        sums = state.mapInArrow(_sum_rows(history), "slot long, n long").groupBy("slot").agg(F.sum("n")).collect()
        totals = np.zeros(_SLOTS[-1], dtype=np.int64)
        for slot, n in sums:  # a number or two for each restaurant
            totals[slot] = n
        history.append(totals)
    known, learnt = int(totals[_SLOTS[3]]), int(totals[_SLOTS[4] :].sum())
    answers = state.mapInArrow(_answer_rows(history), ANSWER_SCHEMA)
    scored = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scores(buckets), SCORE_SCHEMA)
    base = F.col("log_counts") - F.col("n_tokens") * F.log10(F.lit(float(learnt + known + 1)))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(learnt).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
