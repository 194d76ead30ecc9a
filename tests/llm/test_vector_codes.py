import math
import random
from hashlib import sha256

import numpy as np
import pytest

from daybridge.llm import vector_codes as V


def brute(rows, parts, entries, rounds):
    """Plain loops over Python integers: {row number: (id, codes, error)} and the digest of the books."""
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, [math.floor(4096 * x) for x in r[1]]))
    whole = [[math.floor(4096 * x) for x in v] for _, v in kept]
    width = len(whole[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in whole]
    books = [[cut[r][p] for r in range(min(entries, len(cut)))] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = [[] for _ in books[p]]
            for c in cut:
                own[near(p, c[p])[1]].append(c[p])
            books[p] = [[sum(k) // len(o) for k in zip(*o)] if o else b for o, b in zip(own, books[p])]
    out = []
    for (i, _), c in zip(kept, cut):
        found = [near(p, c[p]) for p in range(parts)]
        out.append((i, [e for _, e in found], sum(d for d, _ in found)))
    digest = sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return out, digest


def frame(spark, rows):
    schema = "vec_id long, embedding array<float>, label string, row long, ints string, part int, place long, code string"
    return spark.createDataFrame([(i, v, l, 1, "x", 2, 3, "y") for i, v, l in rows], schema)


def test_equals_plain_loops(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_ROWS", 8)
    rng = random.Random(3)
    centres = [[rng.uniform(-2, 2) for _ in range(16)] for _ in range(5)]
    rows = [(i, [np.float32(c + rng.gauss(0, 0.3)).item() for c in centres[i % 5]], "ab"[i % 2]) for i in range(300)]
    rows += rows[:3]  # repeated rows
    rows += [(None, rows[5][1], None), (7, rows[8][1], None), (400, [0.0] * 16, "a"), (401, [-0.0] * 16, "a")]
    bad = [(2, None, "a"), (3, [1.0] * 15 + [None], "a"), (4, [float("nan")] * 16, "a"), (5, [float("-inf")] + [0.0] * 15, None)]
    rng.shuffle(rows)
    coded = V.encode_vectors(frame(spark, rows + bad), keep=("label",), parts=4, entries=6)
    want, digest = brute([(i, v) for i, v, _ in rows], 4, 6, 6)
    got = [(r.vec_id, list(r.code), r.error) for r in coded.rows.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert coded.books_sha256() == digest
    assert coded.rows.columns == ["vec_id", "label", "code", "error"]


def test_shortlists_hold_every_nearest_entry():
    rng = np.random.default_rng(1)
    book = rng.integers(-50, 50, (16, 4))
    short = 0
    for _ in range(50):
        x = rng.integers(-60, 60, 4) + rng.integers(-4, 5, (20, 4))
        flags = V.shortlists(x.min(axis=0)[None], x.max(axis=0)[None], book)[0]
        every = ((x[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert flags[every].all()
        own, far = V.nearest(x, book, np.flatnonzero(flags))
        assert (own == every).all() and (far == ((x - book[every]) ** 2).sum(axis=1)).all()
        short += flags.sum() < 16
    assert short > 25  # boxes rule entries out


def test_hilbert_keys_step_to_neighbours():
    for axes, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), axis=-1).reshape(-1, axes)
        order = grid[np.argsort(V.hilbert_keys(grid, bits))]
        assert len(np.unique(V.hilbert_keys(grid, bits))) == len(grid)
        assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_empty_and_refused(spark):
    none = V.encode_vectors(frame(spark, []))
    assert none.rows.count() == 0 and none.rows.columns == ["vec_id", "code", "error"] and none.books == []
    assert none.books_sha256() == sha256(b"").hexdigest()
    one = V.encode_vectors(frame(spark, [(1, [1.0] * 8, "a")]))
    assert [tuple(r) for r in one.rows.collect()] == [(1, [0] * 8, 0)]
    for rows in ([(1, [1.0] * 8, "a"), (2, [1.0] * 16, "a")], [(1, [1.0] * 9, "a")], [(1, [3e38] * 8, "a"), (2, [0.0] * 8, "a")]):
        with pytest.raises(ValueError):
            V.encode_vectors(frame(spark, rows))


def test_group_sums_with_hot_rare_and_null_groups(spark, monkeypatch):
    monkeypatch.setattr(V, "HOT_SHARE", 4)
    rows = [("hot", i) for i in range(50)] + [(None, 5), (None, 6)] + [(f"g{i % 20}", i) for i in range(60)]
    out = V.with_group_sum(spark.createDataFrame(rows, "label string, error long"), "label", "error", "total")
    sums = {}
    for g, e in rows:
        sums[g] = sums.get(g, 0) + e
    got = [tuple(r) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(((g, e, sums[g]) for g, e in rows), key=repr)
