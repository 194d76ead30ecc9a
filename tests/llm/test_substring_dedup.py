import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybridge.llm import substring_dedup as D
from daybridge.llm.text import mix
from tests.llm.helpers import edge_rows, frame


def brute(rows, window):
    texts = [(t or "").encode().split() for _, t in rows]
    where = {}
    for d, w in enumerate(texts):
        for i in range(len(w) - window + 1):
            where.setdefault(tuple(w[i : i + window]), []).append((d, i))
    gone = [[False] * len(w) for w in texts]
    for places in where.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i : i + window] = [True] * window
    out = []
    for (i, _), w, g in zip(rows, texts, gone):
        kept = b" ".join(x for x, y in zip(w, g) if not y)
        out.append((i, len(w), sum(g), sha256(kept).hexdigest(), kept.decode()))
    return sorted(out, key=repr)


def check(spark, rows, window):
    docs = frame(spark, rows)
    found = D.dedup_substrings(docs, window)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "removed"]
    got = [tuple(r) for r in found.drop("removed").collect()]
    assert sorted(got, key=repr) == [r[:4] for r in brute(rows, window)]
    return docs, found


def sentence(rng, n, vocabulary):
    return [f"{rng.choice('abcdefgh')}{rng.randint(0, vocabulary)}" for _ in range(n)]


@pytest.mark.parametrize("vocabulary", [400, 1])
def test_equals_brute_force(spark, vocabulary):
    rng = random.Random(vocabulary)
    shared = [sentence(rng, n, vocabulary) for n in (35, 36, 50, 90, 300)]
    rows = []
    for i in range(60):
        parts = sentence(rng, rng.choice([0, 3, 40, 120]), vocabulary)
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, 10)
            parts += s[a : len(s) - rng.randint(0, 10)] + sentence(rng, rng.choice([0, 1, 30]), vocabulary)
        rows.append((i, rng.choice(["\n", " ", " \t "]).join(parts)))
    rows += [(60, " ".join(["same"] * 500)), (61, "same " * 34), (62, "one two " * 60), (63, "Same " * 36)]
    rows += rows[:2] + [(None, rows[3][1]), (None, "x")]
    check(spark, rows, 35)


def test_edge_rows_and_other_windows(spark):
    check(spark, edge_rows(), 35)
    rng = random.Random(9)
    rows = [(i, " ".join(sentence(rng, 60, 2))) for i in range(30)]
    for window in (1, 2, 3, 5, 8, 64):
        check(spark, rows, window)


def test_empty_table(spark):
    assert D.dedup_substrings(frame(spark, [])).count() == 0


def test_spans_give_the_kept_text(spark):
    rng = random.Random(4)
    common = " ".join(sentence(rng, 40, 500))
    rows = [(i, "  ".join([*sentence(rng, 20, 500), common, *sentence(rng, i, 500)])) for i in range(6)] + [(9, None)]
    docs, found = check(spark, rows, 35)
    joined = docs.select("doc_id", "text").join(found, "doc_id")
    got = {r.doc_id: r.kept for r in joined.select("doc_id", D.kept_text(F.col("text"), F.col("removed")).alias("kept")).collect()}
    assert got == {r[0]: r[4] for r in brute(rows, 35)}


def test_interior_symbols_depend_on_their_span_alone():
    """The same words between other words give the same symbols wherever their span lies inside."""
    rng = np.random.default_rng(2)
    for vocabulary in (2, 5, 300):
        middle = rng.integers(0, vocabulary, 60)

        def symbols(before, after):
            words = np.concatenate([rng.integers(0, vocabulary, before), middle, rng.integers(0, vocabulary, after)])
            names, lo, hi = D.recompressed(mix(words.astype(np.uint64)), np.array([0, len(words)]), D.ROUNDS)
            inside = (lo >= before) & (hi <= before + 60)
            return set(zip(names[inside].tolist(), (lo[inside] - before).tolist(), (hi[inside] - before).tolist()))

        first = symbols(0, 0)
        assert first == symbols(7, 3) == symbols(1, 0) == symbols(0, 50)
        assert vocabulary == 2 or len(first) > 10
