"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks of bytes that cover it whole. Every byte gets a learned
vector, learned filters run over each chunk, and each filter keeps its maximum. The chunk maxima
are combined over the document by mean, maximum and minimum, and a logistic output gives one
probability. Training runs on the driver over a bounded sample of labelled documents; scoring runs
on the executors over all bytes of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybridge.llm.text import column, free_tables, runs

CHUNK, STEP = 512, 448  # bytes of a chunk, and from one chunk to the next
WIDTH, STRIDE, VECTOR, FILTERS = 8, 2, 8, 24
PAD = 256
#: Bounds of the training sample: documents, and bytes of text after which no further document is taken.
TRAIN_DOCS, TRAIN_BYTES = 2_000, 64 << 20
#: Passes over the sample and optimiser steps, both at least: few labels get more passes.
EPOCHS, STEPS = 10, 300
BATCH_DOCS, RATE = 16, 0.01
_BLOCK = 128  # chunks convolved at once


def chunk_starts(n: int) -> np.ndarray:
    """Starts of the chunks of a text of ``n`` bytes; the last chunk ends with the text."""
    if n <= CHUNK:
        return np.zeros(1, dtype=np.int64)
    starts = np.arange(0, n - CHUNK + STEP, STEP)
    starts[-1] = n - CHUNK
    return starts


@dataclass
class ByteCnn:
    """Weights of the network. ``constant`` is the score of every text where labels had one class or none."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    head: np.ndarray
    head_bias: np.ndarray
    constant: float | None = None

    @staticmethod
    def fresh(seed: int = 7) -> ByteCnn:
        r = np.random.default_rng(seed)
        embed = r.normal(0, 0.5, (257, VECTOR)).astype(np.float32)
        embed[PAD] = 0
        return ByteCnn(
            embed,
            r.normal(0, (WIDTH * VECTOR) ** -0.5, (WIDTH * VECTOR, FILTERS)).astype(np.float32),
            np.zeros(FILTERS, np.float32),
            np.zeros(3 * FILTERS, np.float32),
            np.zeros(1, np.float32),
        )

    def columns(self, chunks: np.ndarray) -> np.ndarray:
        """Byte vectors under the filters at every position of every chunk."""
        x = self.embed[chunks]
        view = np.lib.stride_tricks.sliding_window_view(x.reshape(len(chunks), -1), WIDTH * VECTOR, axis=1)
        return view[:, :: STRIDE * VECTOR]

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        """Maximum of each filter over each chunk."""
        out = np.empty((len(chunks), FILTERS), np.float32)
        for a in range(0, len(chunks), _BLOCK):
            cols = self.columns(chunks[a : a + _BLOCK])
            y = np.ascontiguousarray(cols).reshape(-1, WIDTH * VECTOR) @ self.filters
            out[a : a + _BLOCK] = y.reshape(cols.shape[0], cols.shape[1], FILTERS).max(axis=1)
        return np.maximum(out + self.bias, 0)

    def features(self, pooled: np.ndarray, starts: np.ndarray) -> np.ndarray:
        n = np.diff(np.r_[starts, len(pooled)])[:, None]
        return np.concatenate(
            [
                np.add.reduceat(pooled.astype(np.float64), starts) / n,
                np.maximum.reduceat(pooled, starts),
                np.minimum.reduceat(pooled, starts),
            ],
            axis=1,
        )

    def probability(self, features: np.ndarray) -> np.ndarray:
        z = (features * self.head.astype(np.float64)).sum(axis=1) + float(self.head_bias[0])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def scores(self, texts: pa.Array) -> np.ndarray:
        """One probability per text; a null or empty text is one chunk of padding."""
        texts = pa.concat_arrays([pc.fill_null(texts, "")])
        n = len(texts)
        if self.constant is not None or n == 0:
            return np.full(n, self.constant if self.constant is not None else 0.5)
        off = np.frombuffer(texts.buffers()[1], dtype=np.int32, count=n + 1).astype(np.int64)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8, count=int(off[-1])) if raw is not None else np.zeros(0, np.uint8)
        begins = [chunk_starts(k) for k in np.diff(off)]
        first = np.r_[0, np.cumsum([len(b) for b in begins])[:-1]]
        begin = np.concatenate([b + o for b, o in zip(begins, off[:-1], strict=True)])
        end = np.repeat(off[1:], [len(b) for b in begins])
        pooled = np.empty((len(begin), FILTERS), np.float32)
        step = _BLOCK * 8
        for a in range(0, len(begin), step):
            pooled[a : a + step] = self.pooled(cut_chunks(data, begin[a : a + step], end[a : a + step]))
        return self.probability(self.features(pooled, first))


def cut_chunks(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Chunks as rows of byte values; positions past the end of a text hold ``PAD``."""
    at = begin[:, None] + np.arange(CHUNK)
    inside = at < end[:, None]
    if len(data) == 0:
        return np.full(at.shape, PAD, dtype=np.int16)
    return np.where(inside, data[np.minimum(at, len(data) - 1)].astype(np.int16), np.int16(PAD))


def text_chunks(text: bytes) -> np.ndarray:
    """All chunks of a text, as it is scored."""
    data = np.frombuffer(text, dtype=np.uint8)
    begin = chunk_starts(len(data))
    return cut_chunks(data, begin, np.full(len(begin), len(data)))


def train(samples: list[tuple[bytes, int]]) -> ByteCnn:
    """Fit on (text in bytes, label) by Adam on the cross entropy, over the chunks that scoring cuts; the same input gives the same weights."""
    labels = np.array([y for _, y in samples], dtype=np.float64)
    model = ByteCnn.fresh()
    if not len(samples) or labels.min() == labels.max():
        model.constant = float((labels.sum() + 1) / (len(labels) + 2))
        return model
    share = labels.mean()
    model.head_bias[0] = np.log(share / (1 - share))
    weights = [model.embed, model.filters, model.bias, model.head, model.head_bias]
    m1, m2 = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    order, step = np.random.default_rng(11), 0
    epochs = max(EPOCHS, -(-STEPS * BATCH_DOCS // len(samples)))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        rows = order.permutation(len(samples))
        for a in range(0, len(rows), BATCH_DOCS):
            step += 1
            batch = rows[a : a + BATCH_DOCS]
            grads = _gradients(model, [text_chunks(samples[i][0]) for i in batch], labels[batch])
            for w, g, u, v in zip(weights, grads, m1, m2, strict=True):
                u += 0.1 * (g - u)
                v += 0.001 * (g * g - v)
                w -= rate * (u / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            model.embed[PAD] = 0
    return model


def _gradients(model: ByteCnn, chunks: list[np.ndarray], labels: np.ndarray) -> list[np.ndarray]:
    counts = np.array([len(c) for c in chunks])
    starts = np.cumsum(counts) - counts
    x = np.concatenate(chunks)
    where, raw = np.empty((len(x), FILTERS), np.int64), np.empty((len(x), FILTERS), model.filters.dtype)
    for a in range(0, len(x), _BLOCK):
        cols = model.columns(x[a : a + _BLOCK])
        y = np.ascontiguousarray(cols).reshape(-1, WIDTH * VECTOR) @ model.filters
        y = y.reshape(cols.shape[0], cols.shape[1], FILTERS)
        at = y.argmax(axis=1)  # the position each filter keeps
        where[a : a + _BLOCK] = at
        raw[a : a + _BLOCK] = np.take_along_axis(y, at[:, None, :], axis=1)[:, 0] + model.bias
    pooled = np.maximum(raw, 0)
    features = model.features(pooled, starts).astype(np.float32)
    delta = ((model.probability(features) - labels) / len(labels)).astype(np.float32)
    d_features = delta[:, None] * model.head
    doc = np.repeat(np.arange(len(chunks)), counts)
    d_mean, d_max, d_min = np.split(d_features, 3, axis=1)
    d_pooled = d_mean[doc] / counts[doc][:, None]
    for part, best in ((d_max, np.maximum.reduceat(pooled, starts)), (d_min, np.minimum.reduceat(pooled, starts))):
        tied = pooled == best[doc]
        d_pooled = d_pooled + tied * part[doc] / np.add.reduceat(tied, starts, dtype=np.float32)[doc]
    d_raw = d_pooled * (raw > 0)
    # Only the kept positions of each chunk and filter pass a gradient on.
    d_filters, d_embed = np.zeros_like(model.filters), np.zeros_like(model.embed)
    for a in range(0, len(x), _BLOCK):
        part, d = x[a : a + _BLOCK], d_raw[a : a + _BLOCK]
        at = where[a : a + _BLOCK, :, None] * STRIDE + np.arange(WIDTH)
        byte = part[np.arange(len(part))[:, None, None], at]
        kept = model.embed[byte].reshape(len(part), FILTERS, WIDTH * VECTOR)
        d_filters += np.einsum("nf,nfk->kf", d, kept, optimize=True)
        np.add.at(d_embed, byte.reshape(-1), (d[:, :, None] * model.filters.T).reshape(-1, VECTOR))
    return [d_embed, d_filters, d_raw.sum(axis=0), delta @ features + 1e-4 * model.head, delta.sum(keepdims=True)]


def training_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_docs: int = TRAIN_DOCS
) -> list[tuple[bytes, int]]:
    """Whole texts of the labelled documents that come first by the hash of their id.

    At most ``max_docs`` labels, and no further document once ``TRAIN_BYTES`` are reached. Of rows that
    share an id one is taken, the same one in every run.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).distinct()
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_docs).collect()
    ids = list(dict.fromkeys(r.doc_id for r in chosen))
    spark = docs.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(i,) for i in ids], "doc_id long"))
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    found = texts.join(wanted, "doc_id").select("doc_id", F.octet_length("text").alias("size"), F.xxhash64("text").alias("hash"))
    rows = {r.doc_id: r for r in found.groupBy("doc_id").agg(F.min(F.struct("hash", "size")).alias("row")).collect()}
    taken, size = [], 0
    for i in ids:
        if i in rows and size < TRAIN_BYTES:
            taken.append((i, rows[i].row["hash"]))
            size += rows[i].row["size"]
    wanted = F.broadcast(spark.createDataFrame(taken, "doc_id long, hash long"))
    one = texts.join(wanted, "doc_id").where(F.xxhash64("text") == F.col("hash")).dropDuplicates(["doc_id"])
    text_of = {r.doc_id: r.text.encode() for r in one.select("doc_id", "text").toLocalIterator()}
    pairs = sorted((r.doc_id, r.y) for r in chosen if r.doc_id in text_of)
    return [(text_of[i], y) for i, y in pairs]


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_docs: int = TRAIN_DOCS,
) -> ByteCnn:
    """Train on the whole texts of at most ``max_docs`` labels (rows without id or label are left out).

    Labels of one class, or none, give a model of constant score: the share of label 1, smoothed.
    """
    return train(training_sample(docs, labels, id_col, text_col, label_col, max_docs))


def score_quality(docs: DataFrame, model: ByteCnn, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row's whole text; null and empty texts are scored as padding. Nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_tables()
        for run in runs(batches, "text"):
            score = shared.value.scores(column(run, "text"))
            yield pa.RecordBatch.from_arrays([column(run, "doc_id"), pa.array(score)], names=["doc_id", "score"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(work, "doc_id long, score double")


def keep_quality(docs: DataFrame, model: ByteCnn, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_tables()
        for run in runs(batches, text_col):
            yield run.filter(pa.array(shared.value.scores(column(run, text_col)) >= threshold))

    return docs.mapInArrow(work, docs.schema)
