import json
import random

from pyspark.sql import functions as F

from daybridge.llm.chat import (
    canonical_turns,
    conversation_records,
    format_chat,
    format_records,
    masked_text,
    read_chat,
)

PARTS = ["</s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>", "%", "%25", "%3C", "%5B", "<", "[", "\n", "ok", "é", " ", "<<SYS>>", "|>", "im_end", "%0A"]


def test_layouts(spark):
    say = lambda *t: [list(x) for x in t]
    cases = [
        ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]}, "messages", say(("user", "a"), ("assistant", ""))),
        ({"messages": []}, "messages", []),
        ({"id": 7, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "w"}]}, "conversations", say(("user", "q"), ("assistant", "w"))),
        ({"data": {"turns": [{"speaker": "bot", "text": "hi"}]}}, "chat", say(("assistant", "hi"))),
        ({"instruction": "do", "input": "", "output": "done"}, "instruction", say(("user", "do"), ("assistant", "done"))),
        ({"instruction": "do", "input": "x", "output": "y", "system": "s"}, "instruction", say(("system", "s"), ("user", "do"), ("user", "x"), ("assistant", "y"))),
        ({"prompt": "p", "response": "r"}, "prompt", say(("user", "p"), ("assistant", "r"))),
        ({"question": "p", "answer": 5}, "question", say(("user", "p"), ("assistant", "5"))),
        ({"prompt": "p", "response": "r", "score": 1}, None, []),
        ({"messages": [{"role": "user"}]}, None, []),
        ([1, 2], None, []),
    ]
    rows = [(i, json.dumps(c[0])) for i, c in enumerate(cases)] + [(90, None), (91, "no json {"), (92, "")]
    got = {r.n: r for r in canonical_turns(spark.createDataFrame(rows, "n int, record string")).collect()}
    for i, (_, layout, turns) in enumerate(cases):
        assert (got[i].layout, [list(t) for t in got[i].turns]) == (layout, turns), cases[i]
    assert all(got[i].layout is None and got[i].turns == [] for i in (90, 91, 92))


def test_template_is_reversible(spark):
    rng = random.Random(3)
    rows = []
    for i in range(200):
        turns = [(rng.choice(["user", "assistant", "a\nb", "%0A", ""]), "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 8)))) for _ in range(rng.randint(0, 5))]
        rows.append((i, turns))
    df = spark.createDataFrame(rows, "n int, turns array<struct<role:string,text:string>>")
    text, mask = format_chat(F.col("turns"))
    out = df.select("n", "turns", text.alias("f"), mask.alias("m"))
    got = out.select("n", "f", read_chat(F.col("f")).alias("back"), masked_text(F.col("f"), F.col("m")).alias("loss")).collect()
    want = dict(rows)
    for r in got:
        assert [tuple(t) for t in r.back] == want[r.n]
        assert r.loss == "".join(t for role, t in want[r.n] if role == "assistant")
        assert r.f.count("<|im_start|>") == len(want[r.n]) == r.f.count("<|im_end|>")
        assert not any(c in r.f for c in ("</s>", "[INST]", "[/INST]", "<<SYS>>"))


def test_conversations_with_nulls_and_repeated_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (2, 1, "assistant", "b"), (2, 0, "user", "a"), (2, 0, "user", "a"), (None, 0, "user", "z"), (None, 1, "user", "y"), (3, None, "system", "s"), (4, 0, "human", "h")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = format_records(conversation_records(df)).select("conv_id", "layout", read_chat(F.col("formatted")).alias("t")).collect()
    back = sorted([(r.conv_id, [tuple(t) for t in r.t]) for r in got], key=str)
    expected = [
        (1, [("user", ""), ("", "x")]),
        (2, [("user", "a"), ("user", "a"), ("assistant", "b")]),
        (3, [("system", "s")]),
        (4, [("human", "h")]),
        (None, [("user", "z")]),
        (None, [("user", "y")]),
    ]
    assert back == sorted(expected, key=str)
    assert format_records(conversation_records(df.limit(0))).count() == 0
