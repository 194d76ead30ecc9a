import numpy as np
import pyarrow as pa

from daybridge.llm import byte_cnn as C
from daybridge.llm import queries as Q
from tests.llm.helpers import edge_rows, frame


def test_chunks_cover_every_filter_position():
    for n in [0, 1, 7, 511, 512, 513, 960, 961, 5000]:
        starts = C.chunk_starts(n)
        covered = np.zeros(max(n, 1), bool)
        for s in starts:
            assert s >= 0 and (n <= C.CHUNK or s + C.CHUNK <= n)
            covered[s : s + C.CHUNK] = True
        assert covered.all()
        assert (np.diff(starts) <= C.CHUNK - C.WIDTH).all()


def test_gradients_match_finite_differences():
    r = np.random.default_rng(0)
    model = C.ByteCnn.fresh(1)
    for name in ("embed", "filters", "bias", "head", "head_bias"):
        setattr(model, name, getattr(model, name).astype(np.float64))
    model.head = r.normal(0, 0.3, model.head.shape)
    model.bias = r.normal(0, 0.1, model.bias.shape)
    chunks = [r.integers(32, 90, (k, C.CHUNK)).astype(np.int16) for k in (1, 2, 3)]
    labels = np.array([1.0, 0.0, 1.0])

    def loss():
        total = 0
        for c, y in zip(chunks, labels):
            cols = model.columns(c)
            pooled = np.maximum((cols @ model.filters).max(axis=1) + model.bias, 0)
            p = model.probability(model.features(pooled, np.zeros(1, int)))[0]
            total -= y * np.log(p) + (1 - y) * np.log(1 - p)
        return total / 3 + 0.5e-4 * (model.head**2).sum()

    grads = C._gradients(model, chunks, labels)
    for weights, g in zip((model.embed, model.filters, model.bias, model.head, model.head_bias), grads):
        flat = weights.reshape(-1)
        for at in r.choice(np.flatnonzero(np.abs(g.reshape(-1)) > 1e-5), 3) if (np.abs(g) > 1e-5).any() else []:
            keep, step = flat[at], 1e-5
            flat[at] = keep + step
            up = loss()
            flat[at] = keep - step
            down = loss()
            flat[at] = keep
            assert abs((up - down) / (2 * step) - g.reshape(-1)[at]) < 2e-3 * max(1, abs(g.reshape(-1)[at]))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = Q.table(spark, sf, "labels").select("doc_id", "quality")
    got = Q.op4_quality_classifier(spark, sf).join(labels, "doc_id").where("held_out").toPandas()
    assert (got[got.quality == 0].predicted == 0).mean() > 0.8
    assert (got[got.quality == 1].predicted == 1).mean() > 0.97


def plain_score(model, text):
    """The network as loops over bytes, filters and chunks."""
    data = list(text)
    begins = [0] if len(data) <= C.CHUNK else [*range(0, len(data) - C.CHUNK, C.STEP), len(data) - C.CHUNK]
    pooled = []
    for b in begins:
        chunk = [(data + [C.PAD] * C.CHUNK)[i] for i in range(b, b + C.CHUNK)]
        best = []
        for f in range(C.FILTERS):
            at = []
            for i in range(0, C.CHUNK - C.WIDTH + 1, C.STRIDE):
                vector = [x for byte in chunk[i : i + C.WIDTH] for x in model.embed[byte].tolist()]
                at.append(sum(x * w for x, w in zip(vector, model.filters[:, f].tolist())) + float(model.bias[f]))
            best.append(max(0.0, max(at)))
        pooled.append(best)
    columns = list(zip(*pooled))
    features = [sum(c) / len(c) for c in columns] + [max(c) for c in columns] + [min(c) for c in columns]
    z = sum(x * w for x, w in zip(features, model.head.tolist())) + float(model.head_bias[0])
    return 1 / (1 + np.exp(-z))


def test_scores_equal_a_plain_network():
    r = np.random.default_rng(3)
    model = C.ByteCnn.fresh(2)
    model.head = r.normal(0, 0.2, model.head.shape).astype(np.float32)
    model.bias = r.normal(0, 0.2, model.bias.shape).astype(np.float32)
    texts = ["", "short", "é # & " * 40, "".join(chr(32 + int(x)) for x in r.integers(0, 90, 1_100)), "a" * 513]
    got = model.scores(pa.array([*texts, None]))
    want = [plain_score(model, t.encode()) for t in texts]
    assert np.abs(got[:-1] - want).max() < 1e-5 and got[-1] == got[0]


def test_few_labels_are_learnt():
    good, bad = b"plain words in a row, with stops. ", b"Again Again Again Again | # & Again "
    samples = [(good * (2 + i), 1) for i in range(30)] + [(bad * (2 + i), 0) for i in range(4)]
    scores = C.train(samples).scores(pa.array([(good * 9).decode(), (bad * 9).decode()]))
    assert scores[0] > 0.9 and scores[1] < 0.1


def test_edges(spark):
    rows = edge_rows()
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(4, 1), (7, 0), (7, 0), (None, 1), (6, None), (99, 1)], "doc_id long, quality int")
    model = C.fit_quality(docs, labels)
    got = C.score_quality(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    same = {r.doc_id: r.score for r in got}
    assert same[1] == same[2]  # null and empty
    assert C.keep_quality(docs, model, 0.0).columns == docs.columns
    constant = C.fit_quality(docs, labels.where("quality = 1"))
    assert constant.constant is not None and C.score_quality(docs, constant).count() == len(rows)
    nothing = C.fit_quality(frame(spark, []), labels)
    assert nothing.constant == 0.5 and C.score_quality(frame(spark, []), model).count() == 0


def test_training_is_deterministic_and_long_texts_score_whole():
    samples = [(b"good text here " * 30, 1), (b"&&& ### $$$ " * 40, 0)] * 10
    a, b = C.train(samples), C.train(samples)
    assert (a.filters == b.filters).all()
    clean, junk = "good text here " * 400, "&&& ### $$$ " * 500
    s = a.scores(pa.array([clean, junk, clean + junk]))
    assert s[0] > 0.9 and s[1] < 0.1 and s[2] != s[0]


def test_training_takes_whole_texts_and_one_row_of_an_id(spark, monkeypatch):
    long = "".join(f"w{i} " for i in range(20_000))
    docs = frame(spark, [(1, long), (2, "other"), (2, "second"), (2, "second"), (3, None), (4, "not labelled")])
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, 0), (99, 1)], "doc_id long, quality int")
    found = C.training_sample(docs, labels, "doc_id", "text", "quality")
    assert [y for _, y in found] == [1, 0, 0] and found[0][0] == long.encode() and found[2][0] == b""
    assert found[1][0] in (b"other", b"second")
    again = C.training_sample(docs.repartition(5), labels, "doc_id", "text", "quality")
    assert again == found
    monkeypatch.setattr(C, "TRAIN_BYTES", 1)  # whole documents until the bound, not parts of them
    assert len({b for b, _ in C.training_sample(docs, labels, "doc_id", "text", "quality") if b}) == 1
