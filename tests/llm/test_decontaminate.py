import random
from collections import Counter

import numpy as np
import pyarrow as pa

from daybridge.llm.decontaminate import RADIUS, ItemIndex, benchmark_hits, remove_contaminated
from daybridge.llm.text import U64, mix
from tests.llm.helpers import edge_rows, frame, sentence, words


def brute(docs, items, size=5, threshold=0.8):
    found = set()
    for i, t in docs:
        w = words(t)
        for j, x in items:
            v = words(x)
            k = min(size, len(v))
            if not v or not w or j is None:
                continue
            want = Counter(tuple(v[a : a + k]) for a in range(len(v) - k + 1))
            mine = [tuple(w[a : a + k]) for a in range(len(w) - k + 1)]
            n = sum(want.values())
            for a in range(max(1, len(mine) - n + 1)):
                c = Counter(mine[a : a + n])
                common = sum((c & want).values())
                if common and common >= threshold * (sum(c.values()) + n - common):
                    found.add((i, j))
    return found


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_hits_equal_brute_force(spark):
    rng = random.Random(8)
    items = [(i, sentence(rng, rng.randint(1, 50))) for i in range(30)] + [(30, None), (31, " "), (None, "red1 blue2")]
    docs = edge_rows()
    for i in range(100, 160):
        j, x = rng.choice(items[:30])
        w = x.split()
        if rng.random() < 0.4:  # edited passages, near the threshold too
            for _ in range(rng.randint(1, 2)):
                w[rng.randrange(len(w))] = "edited"
        docs.append((i, " ".join([sentence(rng, rng.randint(0, 60)), " ".join(w).replace("r", "R"), sentence(rng, rng.randint(0, 60))])))
    got = benchmark_hits(frame(spark, docs), items_frame(spark, items))
    rows = got.collect()
    expected = brute(docs, items)
    assert {(r.doc_id, r.item_id) for r in rows} == expected and len(expected) > 20
    text = {i: words(t) for i, t in docs if i and i >= 100}
    for r in rows:
        if r.similarity == 1.0 and r.doc_id >= 100:
            assert text[r.doc_id][r.first_word : r.first_word + r.n_words] == words(dict(items)[r.item_id])
    clean = remove_contaminated(frame(spark, docs), items_frame(spark, items))
    hit = {i for i, _ in expected}
    assert sorted((r.doc_id or -1) for r in clean.collect()) == sorted((i or -1) for i, _ in docs if i not in hit)
    assert clean.columns == frame(spark, []).columns


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(1)
    items = [(i, mix(rng.integers(0, 2**62, 20).astype(U64)), 24) for i in range(60)]
    index = ItemIndex(items, 5)
    flips = np.packbits(rng.random((500, 64)) < rng.random((500, 1)) * 0.6, axis=1).view(U64).reshape(-1)
    prints = index.prints[rng.integers(0, 60, 500)] ^ flips
    w, i = index.within_radius(prints)
    near = np.bitwise_count(prints[:, None] ^ index.prints[None, :]) <= RADIUS
    assert set(zip(w.tolist(), i.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(near))))


def test_empty_tables(spark):
    none = items_frame(spark, [])
    docs = frame(spark, edge_rows())
    assert benchmark_hits(docs, none).count() == 0
    assert benchmark_hits(frame(spark, []), items_frame(spark, [(1, "a b c")])).count() == 0
    assert remove_contaminated(docs, none).count() == docs.count()


def test_long_items_cut_short_and_filled_are_all_found(spark):
    """Fingerprints of a window with a run of one word lie outside the radius at similarity 0.8 and above."""
    rng = random.Random(11)
    items, docs = [], []
    for j, n in enumerate([60, 200, 200, 400, 800] * 6):
        w = [f"w{rng.randint(0, 3000)}" for _ in range(n)]
        items.append((j, " ".join(w)))
        cut = int(n * rng.choice([0.09, 0.10, 0.105, 0.11, 0.13]))
        kind = rng.choice(["filled", "edited", "repeated"])
        if kind == "filled":
            w[n - cut :] = ["filler"] * cut
        elif kind == "repeated":
            w[n - cut :] = w[: cut // 2] * 3
        else:
            for _ in range(max(1, n // 60)):
                w[rng.randrange(n)] = "edited"
        around = [f"x{rng.randint(0, 3000)}" for _ in range(30)]
        docs.append((j, " ".join(around + w + ["filler"] * rng.choice([0, 40]) + around)))
    got = {(r.doc_id, r.item_id) for r in benchmark_hits(frame(spark, docs), items_frame(spark, items)).collect()}
    expected = brute_near(docs, items)
    assert got == expected and len(expected) > 15


def brute_near(docs, items):
    """brute, for pairs of equal number alone: the others share no words."""
    return {pair for d, i in zip(docs, items) for pair in brute([d], [i])}


def test_windows_in_stretches_find_what_one_pass_finds(monkeypatch):
    from daybridge.llm import decontaminate as d

    rng = np.random.default_rng(4)
    items = [(i, rng.integers(1, 1 << 62, 30, dtype=np.uint64), 34) for i in range(6)]
    index = d.ItemIndex(items, 5)
    docs = []
    for i in range(40):
        own = [items[j][1][a : a + 25] for j, a in zip(rng.integers(0, 6, 12), rng.integers(0, 6, 12), strict=True)]
        docs.append(np.concatenate([x for o in own for x in (o, rng.integers(1, 1 << 62, 9, dtype=np.uint64))]))
    docs += [docs[0][:3], docs[1][:0]]
    offsets = np.r_[0, np.cumsum([len(x) for x in docs])]
    shingles, covers = np.concatenate(docs), []
    signs = d._signs
    monkeypatch.setattr(d, "_signs", lambda hashes: covers.append(len(hashes)) or signs(hashes))
    found = []
    for limit in (1 << 30, 100):
        monkeypatch.setattr(d, "COVER_AT_ONCE", limit, raising=False)
        found.append(sorted(index.hits(shingles, offsets)))
        if limit == 100:
            assert max(covers) <= 100 + 2 * 30  # a stretch and a window at either end
        covers.clear()
    assert found[0] == found[1] and len(found[0]) > 40
    low, high = np.array([7, 0, 3, 7]), np.array([9, 2, 5, 7])
    assert d._covered(low, high).tolist() == [0, 1, 2, 3, 4, 5, 7, 8, 9]


def test_a_task_without_token_ids_frees_what_earlier_tasks_left():
    from daybridge.llm import text
    from daybridge.llm.queries import WORD_BPE

    before = text.token_ids(pa.array(["one two  three", None]), WORD_BPE)
    assert text._TABLES and text._LOADED
    text.free_tables()
    assert not text._TABLES and not text._LOADED
    after = text.token_ids(pa.array(["one two  three", None]), WORD_BPE)
    assert all(np.array_equal(a, b) for a, b in zip(before, after, strict=True))
