import random
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from daybridge.llm import turn_repair as R

SCHEMA = "conv_id long, turn long, role string, text string, conv string, part int, number int, done string, codes int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y", 3) for r in rows], SCHEMA)


def cheapest(rows, most):
    """All edit sequences by exhaustive search: the least cost, and of its audits the ASCII-least."""
    best = {}

    def go(i, state, cost, audit, out, inserts):
        if cost > most or cost > best.get("cost", most):
            return
        if i == len(rows) and state in (0, 3):
            if (cost, audit) < (best.get("cost", most + 1), best.get("audit", "~")):
                best.update(cost=cost, audit=audit, out=list(out))
        due = ("user", "user", "assistant", "user")[state]
        after = {"user": 2, "assistant": 3}[due]
        if inserts < 3:
            go(i, after, cost + 5, audit + "I", [*out, (due, "")], inserts + 1)
        if i == len(rows):
            return
        role, text, fault = rows[i]
        go(i + 1, state, cost + 2, audit + "D", out, 0)
        if fault in ("blank", "duplicate"):
            return
        more = 5 if fault == "truncated" else 0
        if role[:1] and role[:1] in {0: "su", 1: "u", 2: "a", 3: "u"}[state]:
            go(i + 1, {"s": 1, "u": 2, "a": 3}[role[0]], cost + more, audit + "K", [*out, (role, text)], 0)
        go(i + 1, after, cost + 1 + more, audit + "R", [*out, (due, text)], 0)

    go(0, 0, 0, "", [], 0)
    return best


def brute(rows):
    """Figures of each conversation, from the definition."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, items in convs.items():
        items.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, marked = set(), []
        for _, role, text in items:
            end = text.rstrip(" \t\n\v\f\r")[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "" if end in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [t for t, _, _ in items if t is not None]
        found = cheapest(marked, 2 * len(items) + 1)
        lines = "\n".join(f"{r}:{t}" for r, t in found["out"])
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(sum(f == k for _, _, f in marked) for k in ("blank", "duplicate", "truncated")),
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:])),
            found["cost"],
            found["audit"],
            sha256(lines.encode()).hexdigest(),
        )
    return out


def made(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for c in [*range(convs), None]:
        for t in range(rng.randint(1, longest)):
            turn = rng.choice([t, t, t, t + 1, None])
            role = rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"])
            text = rng.choice([f"word {t}.", f"word {t}", "", " \n", None, "same.", f"é {t}! ", " "])
            rows.append((c, turn, role, text))
    rng.shuffle(rows)
    return rows


def figures(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_exhaustive_search(spark, seed):
    rows = made(seed, 60, 6)
    found = R.repair_turns(frame(spark, rows))
    assert found.columns == ["conv_id", *R._FIELDS]
    assert figures(found) == brute(rows)


def test_blocks_give_the_same(spark):
    """Conversations longer than a block, over many tasks: the composed blocks agree with one walk over all rows."""
    rows = made(5, 12, 60)
    rows += rows[:40]  # repeated rows
    whole = figures(R.repair_turns(frame(spark, rows).coalesce(1)))
    for block_rows, block_chars in ((1, 1 << 20), (3, 1 << 20), (1 << 20, 10)):
        dealt = frame(spark, rows).repartition(7)
        assert figures(R.repair_turns(dealt, block_rows=block_rows, block_chars=block_chars)) == whole
    assert {k: v[:5] for k, v in whole.items()} == {k: v[:5] for k, v in _faults(rows).items()}


def _faults(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == conv]
        items = sorted(((t, " " if r is None else r, " " if x is None else x) for _, t, r, x in own), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, kinds = set(), []
        for _, role, text in items:
            end = text.rstrip(" \t\n\v\f\r")[-1:]
            kinds.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end in ".!?" else "truncated")
            seen.add((role, text))
        turns = [t for t, _, _ in items if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        bad = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(items, items[1:]))
        out[conv] = (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), bad)
    return out


def test_walk_with_checkpoints_is_the_cheapest():
    rng = random.Random(8)
    for n in (0, 1, 2, 17, 300):
        codes = bytes(rng.choice([0, 1, 2, 3]) | rng.choice([0, 0, 4, 8]) for _ in range(n))
        vectors = [R.END]
        for c in reversed(codes):
            vectors.append(R.before(c, vectors[-1]))
        edits, state, cost = R.walk(codes, R.START, R.END, True)
        assert cost == vectors[-1][R.START] and state in (R.START, R.ASSISTANT)
        spent, rows = 0, iter(codes)
        for e in edits:
            code = next(rows) if e != "I" else 0
            spent += {"K": 0, "R": 1, "D": 2, "I": 5}[e] + (5 if code & 8 and e in "KR" and not code & 4 else 0)
        assert spent == cost and next(rows, None) is None
        gap, marks = R.checkpoints(codes, R.END)
        assert len(marks) <= gap + 1 and all(m == vectors[n - i * gap] for i, m in enumerate(marks))


def test_empty_dropped_and_long(spark):
    assert R.repair_turns(frame(spark, [])).count() == 0
    nothing = (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    rows = [(1, 0, "user", "a."), (2, 0, "user", "b."), (2, 1, "assistant", "x" * 3_000_000 + ".")]
    found = figures(R.repair_turns(frame(spark, rows), present=F.col("conv_id") != 1))
    long = sha256(("user:b.\nassistant:" + rows[2][3]).encode()).hexdigest()
    assert found == {1: nothing, 2: (0, 0, 0, 0, 0, 0, "KK", long)}


def test_damage(spark):
    rows = [(c, t, "assistant", "A. b! c?") for c in (*range(20), None) for t in (*range(4), None)] + [(3, 1, None, None)]
    got = sorted(((r.conv_id, r.turn, r.role, r.text, r.present) for r in R.damaged(frame(spark, rows)).collect()), key=repr)
    want = []
    for c, t, role, text in rows:
        case = crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if case == 1 else "".join(x for x in text if x not in ".!?") if case == 2 else text
        want += [(c, t, "user" if case == 4 else role, text, case != 0)] * (2 if case == 3 else 1)
    assert got == sorted(want, key=repr) and {g[4] for g in got} == {True, False}
