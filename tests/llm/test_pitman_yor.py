import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from daybridge.llm import pitman_yor as P
from daybridge.llm import queries as Q
from daybridge.llm.text import U64
from tests.llm.helpers import SF, edge_rows, frame, words


def test_symbols_and_tokens():
    texts = ["  The  red\x0btree ", "", None, " ", "a", "b\nB c"]
    stream, off = P.symbols(pa.array(texts, pa.string()))
    got = [bytes(stream[a:b]) for a, b in zip(off[:-1], off[1:])]
    assert got == [b" ".join(words(t)) + b"\n" for t in texts]
    keys, to = P.tokens(stream, off)
    assert np.diff(to).tolist() == [len(words(t)) + 1 for t in texts]
    word = (keys >> U64(P.CONTEXT_BITS)).tolist()
    assert word[to[5]] == word[to[5] + 1]  # b and B
    assert (P._context(keys)[to[:-1]] == P.START << P.WITHIN_BITS).all()
    blob = P.packed(np.unique(keys), np.arange(len(np.unique(keys))))
    back, counts = P.unpacked(memoryview(blob))
    assert (back == np.unique(keys)).all() and counts.tolist() == list(range(len(back)))


def test_seating_has_the_expected_number_of_tables():
    rng = np.random.default_rng(0)
    n, base, step, d = 40, 0.8, 0.1, 0.5
    tables = P.seat(np.full(20_000, n), np.array([[base] * 20_000, [step] * 20_000]), d, rng)
    chance = {1: 1.0}  # exact distribution of the number of tables, guest by guest
    for i in range(1, n):
        after = Counter()
        for t, p in chance.items():
            w = base + step * t
            after[t + 1] += p * w / (w + i - d * t)
            after[t] += p * (i - d * t) / (w + i - d * t)
        chance = after
    mean = sum(t * p for t, p in chance.items())
    assert abs(tables.mean() - mean) < 0.05
    assert P.seat(np.array([0, 1]), np.zeros((2, 2)), d, rng).tolist() == [0, 1]


def _seat_one_by_one(customers, strength, discount, rng):
    """All dishes that still open tables, in turn, with whole arrays at each step."""
    tables = (customers > 0).astype(np.int64)
    guests = tables.copy()
    active = np.flatnonzero(customers > 1)
    while len(active):
        weight = np.maximum(strength[0][active] + strength[1][active] * tables[active], 1e-12)
        chance = np.maximum(rng.beta(weight, guests[active] - discount * tables[active]), 1e-15)
        opened = guests[active] + rng.geometric(chance)
        more = (opened <= customers[active]) & (opened > 0)
        active = active[more]
        tables[active] += 1
        guests[active] = opened[more]
        active = active[guests[active] < customers[active]]
    return tables


class _Counting:
    """A generator that counts the draws of whole arrays."""

    def __init__(self, seed):
        self.rng, self.arrays = np.random.default_rng(seed), 0

    def beta(self, a, b):
        self.arrays += isinstance(b, np.ndarray)
        return self.rng.beta(a, b)

    def geometric(self, p):
        return self.rng.geometric(p)


def test_seating_of_hot_dishes_draws_alike_without_arrays():
    many = np.random.default_rng(2).zipf(1.4, 3_000).clip(0, 5_000)
    few = np.array([0, 1, 2, 30_000, 20_000, 2])
    for customers in (many, few, few[:0], np.array([1, 0])):
        for base, step, d in ((0.8, 0.1, 0.9), (0.0, 0.0, 0.75), (40.0, 0.5, 0.8)):
            strength = np.array([[base] * len(customers), [step] * len(customers)])
            plain, rng = np.random.default_rng(4), _Counting(4)
            want = _seat_one_by_one(customers, strength, d, plain)
            got = P.seat(customers, strength, d, rng)
            assert got.tolist() == want.tolist()
            assert rng.rng.bit_generator.state == plain.bit_generator.state
            assert rng.arrays < 2 + (np.sort(want)[-P.FEW] if len(want) >= P.FEW else 0)
    assert want.size == 2


def test_distinct_keys():
    keys = np.array([5, 1, 5, (1 << 64) - 1, 0, 1], dtype=U64)
    assert P._distinct(keys).tolist() == [0, 1, 5, (1 << 64) - 1] and keys[0] == 5
    assert P._distinct(keys[:0]).tolist() == []


def _cross(seed):
    """Every pair of 60 words and six contexts, with counts; some words are unmet."""
    rng = np.random.default_rng(seed)
    contexts = np.array([97 << 7, (97 << 7) + 5, 98 << 7, (200 << 7) + 127, 256 << 7, 33 << 7], dtype=U64)
    vocabulary = np.sort(rng.choice(1 << 40, 60, replace=False).astype(U64)) << U64(24)
    keys = (vocabulary[:, None] | contexts[None, :]).reshape(-1)
    counts = rng.poisson(1.5, len(keys))
    counts[np.repeat(rng.random(60) < 0.2, len(contexts))] = 0
    return keys, counts * (rng.random(len(keys)) < 0.7)


def test_probabilities_of_a_context_sum_to_one():
    keys, counts = _cross(3)
    seats = P.Seats(keys, counts, None, 1)
    for _ in range(3):
        seats.totals = seats.sums()
        seats.sweep()
    seats.totals = seats.sums()
    p, met, context = seats.of_contexts(), seats.count[seats.word] > 0, P._context(keys)
    for c in np.unique(context):
        rest = 1 - p[(context == c) & met].sum()
        assert rest > 0  # every unmet word has the probability of the one unmet outcome
        assert np.abs(p[(context == c) & ~met] - rest).max() < 1e-9


def test_answers_of_several_buckets_sum_to_one_and_follow_the_seats():
    """The exchange between buckets, as the query runs it: sums of all, then averaged answers."""
    keys, counts = _cross(5)
    bucket = P._bucket(keys, 3)
    rows = [
        pa.RecordBatch.from_arrays(
            [
                pa.array([b], pa.int32()),
                pa.array([[0, 1]], pa.list_(pa.int64())),
                pa.array([[P.packed(keys[bucket == b], counts[bucket == b]), P.packed(keys[bucket == b], 0 * counts[bucket == b])]], pa.list_(pa.binary())),
            ],
            names=["bucket", "blocks", "asked"],
        )
        for b in np.unique(bucket)
    ]
    history = []
    for _ in range(1 + P.ROUNDS):
        totals = np.zeros(P._SLOTS[-1], dtype=np.int64)
        for row in rows:  # a task for each bucket
            for out in P._sum_rows(history)(iter([row])):
                totals[out.column(0).to_numpy()] += out.column(1).to_numpy()
        history.append(totals)
    assert any((a != b).any() for a, b in zip(history, history[1:]))
    assert totals[P._SLOTS[4] :].sum() == counts.sum()
    word = keys >> U64(P.CONTEXT_BITS)
    met_words = {int(w) for w in word[counts > 0]}
    assert totals[P._SLOTS[3]] == len(met_words)
    p = np.empty(len(keys))
    for out in P._answer_rows(history)(iter(rows)):
        for b, blob, block in zip(out.column(1).to_pylist(), out.column(2).to_pylist(), out.column(0).to_pylist()):
            mine = bucket == b
            assert blob[-8:] == P._digest(keys[mine])
            p[mine] = 10.0 ** np.frombuffer(blob, dtype="<f4", count=int(mine.sum()))
            known = np.frombuffer(blob, dtype="<i8", offset=4 * int(mine.sum()), count=len(np.unique(word[mine])))
            assert known.sum() == counts[mine].sum()
    context, met = P._context(keys), np.isin(word, list(met_words))
    for c in np.unique(context):
        own = context == c
        assert abs(p[own & met].sum() + p[own & ~met].mean() - 1) < 1e-5  # answers are 32-bit floats
        assert np.corrcoef(np.log(p[own & met]), np.log(counts[own & met] + 0.5))[0, 1] > 0.6


def test_base_columns_and_held_out_gain(spark):
    got = {r.doc_id: r for r in Q.op1_lm_scores(spark, SF).collect()}
    rows = Q.table(spark, SF, "documents").select("doc_id", "text").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows}
    text = {r.doc_id: [*words(r.text), None] for r in rows}
    count = Counter(w for i, ws in text.items() if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    for i, ws in text.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(count[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert r.score < 0 and math.isclose(r.perplexity, 10 ** (-r.score / r.n_tokens), rel_tol=1e-9)
    out = [got[i] for i in text if held[i]]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_words_are_learnt_as_contexts(spark):
    """Held-out perplexity far below that of any model of single words, and lower still on what was read."""
    got = Q.op1_lm_scores(spark, "/root/testdata/sf0.01").toPandas()
    of = {k: 10 ** (-g.score.sum() / g.n_tokens.sum()) for k, g in got.groupby("held_out")}
    base = {k: 10 ** (-g.base_score.sum() / g.n_tokens.sum()) for k, g in got.groupby("held_out")}
    assert of[True] < 950 and of[True] < 0.6 * base[True] and of[False] < 0.5 * of[True]


def test_rows_alike_go_to_all_blocks(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_BYTES", 4_000)
    docs = frame(spark, [(None, "the same text again")] * 2_000 + [(1, "another text")])
    sizes = {}
    real = P._asked_rows

    def seen(buckets):
        work = real(buckets)

        def counted(key, table):
            out = work(key, table)
            return out.set_column(1, "bucket", pa.array([table.num_rows] * out.num_rows, pa.int32()))

        return counted

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    blocks = -(-size // P.BLOCK_BYTES)
    dealt = docs.withColumn("held_out", F.lit(False)).withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)))
    for r in dealt.groupBy("block").applyInArrow(seen(4), P.ASKED_SCHEMA).collect():
        sizes[r.block] = r.bucket
    assert len(sizes) == blocks and max(sizes.values()) < 2 * 2_001 / blocks
    assert P.score_texts(docs, F.lit(False)).select("score").distinct().count() == 2


def test_edges(spark):
    rows = edge_rows()
    got = P.score_texts(frame(spark, rows), F.col("doc_id") == 5).collect()
    assert len(got) == len(rows)
    blank = [r for r in got if r.doc_id in (1, 2, 3)]
    assert len({(r.n_tokens, r.score) for r in blank}) == 1 and blank[0].n_tokens == 1
    assert [r.held_out for r in got if r.doc_id is None] == [False, False]
    assert P.score_texts(frame(spark, []), F.lit(False)).count() == 0
    untrained = P.score_texts(frame(spark, rows), F.lit(True)).collect()
    assert len(untrained) == len(rows) and all(r.n_known == 0 and r.train_tokens == 0 for r in untrained)
