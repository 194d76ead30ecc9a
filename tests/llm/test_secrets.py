import hashlib
import math
import random
import re
from collections import Counter

from daybridge.llm import secrets as S
from daybridge.llm.secrets import find_secrets, redact_secrets
from tests.llm.helpers import edge_rows, frame, sentence

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def base_spans(x):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(x) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", x) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", x) if len(m[0]) >= 24])


def masked(x):
    """Lower-case path parts lose their slash, and runs of eight or more equal characters all but seven."""
    x = re.sub(r"(?<![A-Za-z0-9+_-])([a-z]+)/", r"\1 ", x)
    return "".join(" " if re.match("[A-Za-z0-9+/_-]", c) and x[i : i + 8] == c * 8 else c for i, c in enumerate(x))


def added_spans(x, base):
    found, x = [], masked(x)
    for rank, c in enumerate(S.CLASSES, 3):
        for m in re.finditer(f"[{c.alphabet}]+", x):
            s = m[0]
            if len(s) < c.window or not all(re.search(n, s) for n in c.needs):
                continue
            limit = math.floor(c.window * (math.log2(c.window) - c.bits) * (1 << 20))
            groups = []
            for i in range(len(s) - c.window + 1):
                if sum(round(n * math.log2(n) * (1 << 20)) for n in Counter(s[i : i + c.window]).values()) <= limit:
                    if groups and i - groups[-1][1] < c.window:
                        groups[-1][1] = i
                    else:
                        groups.append([i, i])
            for a, b in groups:
                part = s[a : b + c.window]
                if all(re.search(n, part) for n in c.needs) and not any(re.search(k, part) for k in S.ALLOW_LIST):
                    found.append((m.start() + a, rank, m.start() + b + c.window, c.kind))
    out = []
    for f in sorted(found):
        if not any(b[0] < f[2] and f[0] < b[2] for b in base + out):
            out.append(f)
    return out


def rows():
    rng = random.Random(12)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
    out = edge_rows()
    for i in range(20, 90):
        parts = []
        for _ in range(rng.randint(0, 6)):
            kind = rng.randrange(9)
            n = rng.randint(4, 60)
            parts.append(sentence(rng, rng.randint(0, 8)))
            parts.append(
                [
                    f"{rng.choice(['Password', 'API_KEY', 'token', 'secret'])}{rng.choice(['', chr(34)])} {rng.choice('=:')} '{''.join(rng.choice(b64) for _ in range(n))}'",
                    "AKIA" + "".join(rng.choice("ABCXYZ0189") for _ in range(rng.randint(10, 24))),
                    "".join(rng.choice("0123456789abcdef") for _ in range(n)),
                    "".join(rng.choice("0123456789ABCDEF") for _ in range(n)),
                    "".join(rng.choice(b64) for _ in range(n)),
                    "éaaaAAA111" * 4 + "aA1" * 20,
                    "".join(rng.choice(b64) for _ in range(20)) + "example",
                    "日本" + "".join(rng.choice(b64) for _ in range(n)) + "é",
                    "secret=token: abcdefgh",
                ][kind]
            )
        out.append((i, rng.choice([" ", "\n"]).join(parts)))
    return out


def test_spans_equal_brute_force(spark):
    data = rows()
    got = find_secrets(frame(spark, data)).collect()
    expected = []
    for i, t in data:
        base = base_spans(t or "")
        expected.append((i, base, added_spans(t or "", base)))
    seen = [(r.doc_id, [tuple(s) for s in r.base], [tuple(s) for s in r.added]) for r in got]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(seen, key=key) == sorted(expected, key=key)
    assert sum(len(a) for _, _, a in expected) > 20


def all_spans(x):
    """Base spans and all entropy spans, overlapping ones too."""
    return sorted(base_spans(x) + [f for i in range(len(S.CLASSES)) for f in only_class(x, i)])


def only_class(x, i):
    kept, S_CLASSES = S.CLASSES, S.CLASSES
    try:
        S.CLASSES = (S_CLASSES[i],)
        return [(a, 3 + i, e, k) for a, _, e, k in added_spans(x, [])]
    finally:
        S.CLASSES = kept


def test_redaction(spark):
    data = [(i, t) for i, t in rows() if i is not None]
    docs = frame(spark, data)
    clean = redact_secrets(docs)
    assert clean.columns == docs.columns
    expected = []
    for i, t in data:
        if t is None:
            expected.append((i, None))
            continue
        at, out = 0, ""
        for start, _, end, _ in all_spans(t):
            if start >= at:
                out += t[at:start] + "[SECRET]"
            at = max(at, end)
        expected.append((i, out + t[at:]))
    key = lambda r: (r[0], r[1] or "")
    assert sorted([(r.doc_id, r.text) for r in clean.collect()], key=key) == sorted(expected, key=key)


def test_allow_list_and_empty_table(spark):
    text = "key Zx81Kq0Lm27Bv93Tn54R end"
    assert find_secrets(frame(spark, [(1, text)])).first().added
    assert not find_secrets(frame(spark, [(1, text)]), allow=("Kq0",)).first().added
    assert find_secrets(frame(spark, [])).count() == 0
    digest = hashlib.sha256(b"").hexdigest()
    assert digest.startswith("e3b0c442")


def test_no_python_on_the_executors(spark):
    plan = redact_secrets(frame(spark, edge_rows()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def hidden():
    """Secrets beside paths, equal characters and samples, and without three kinds of characters."""
    key = "Zx81Kq0Lm27Bv93Tn54R"
    return [
        ("com/services/T01ABCDEF/B02GHIJKL/" + key, key),
        ("keys/" + key, key),
        ("/opt/keys/" + key, key),
        ("abc/Zx81Kq0Lm27Bv/93Tn54RQw7y", "Zx81Kq0Lm27Bv/93Tn54RQw7y"),
        ("--------" + key, key),
        (key + "=" * 9 + "aaaaaaaaaaaaaaaa" + key, key),
        (key + "_" * 30 + "AnExample4You", key),
        ("k3j9x0q2mf7w1zt8b5vh", "k3j9x0q2mf7w1zt8b5vh"),
        ("JBSWY3DPEHPK3PXP", "JBSWY3DPEHPK3PXP"),
        ("qZtRwYkLmNbVcXsDfGhJpKoU", "qZtRwYkLmNbVcXsDfGhJpKoU"),
    ]


def test_parts_of_allowed_runs_and_further_classes(spark):
    cases = hidden()
    plain = [
        "/usr/local/lib/python/site/packages/numpy/core",
        "internationalization and counterrevolutionaries",
        "example/of/a/long/path/to/nowhere",
        "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY",
        "= " * 30 + "-" * 80 + "x" * 70 + "_" * 40,
        "THEQUICKBROWNFOX getElementsByClassName",
    ]
    docs = frame(spark, [(i, f"a {t} z") for i, t in enumerate([t for t, _ in cases] + plain)])
    got = {r.doc_id: r.text for r in redact_secrets(docs).collect()}
    found = {r.doc_id: r.added for r in find_secrets(docs).collect()}
    for i, (text, secret) in enumerate(cases):
        assert secret not in got[i] and "[SECRET]" in got[i], (text, got[i])
        at = f"a {text} z".index(secret)
        assert any(s.start <= at and s.end >= at + len(secret) - 4 for s in found[i]), (text, found[i])
    for i, text in enumerate(plain, len(cases)):
        assert got[i] == f"a {text} z"


def test_random_strings_are_found(spark):
    rng = random.Random(4)
    for letters, n in (("abcdefghijklmnopqrstuvwxyz0123456789", 32), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 32)):
        data = [(i, "x " + "".join(rng.choice(letters) for _ in range(n)) + " y") for i in range(300)]
        found = find_secrets(frame(spark, data)).where("size(added) + size(base) > 0").count()
        assert found >= 297, (letters, found)


def test_pipeline_stage_redacts_parts(spark):
    import corpus_pipeline

    docs = frame(spark, [(i, f"a {t} z") for i, (t, _) in enumerate(hidden())])
    stage = dict(corpus_pipeline.STAGES)["secret_scan"]
    got = {r.doc_id: r.text for r in stage(spark, docs, "").collect()}
    assert all(secret not in got[i] for i, (_, secret) in enumerate(hidden()))
