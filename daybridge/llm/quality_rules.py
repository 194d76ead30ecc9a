"""Quality rules: counts of a text, and a hashed n-gram log-likelihood ratio against the raw corpus.

Words and neighbouring word pairs (in lower case) are hashed into ``SLOTS`` slots. Two
multinomials over the slots are estimated with add-one smoothing: one from the trusted target
documents, one from the whole raw corpus. A text's ratio is the mean over its n-grams of
log2(target / raw). Weights are whole multiples of 2^-16, so that sums do not depend on the order of
addition and the threshold decides every document the same way on every run.

DataFrame functions alone; the model is ``SLOTS`` numbers whatever the size of the corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybridge.llm.columns import NO_SPACE, indices, let, words_of

SLOTS = 1 << 14
SCALE = 1 << 16
#: Least mean log2 ratio of a text that is kept.
THRESHOLD = -0.12
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Target ids are sent to every task when there are at most this many (8 bytes each).
MAX_BROADCAST_IDS = 1_000_000
# The signs counted as symbols.
SYMBOLS = "[#*$%&|<>]"


def gram_slots(words: Column) -> Column:
    """Slots of all words, then of all neighbouring pairs."""
    slot = lambda *c: F.pmod(F.xxhash64(*c), F.lit(SLOTS)).cast("int")
    low = F.transform(words, lambda w: F.lower(w))
    pairs = lambda w: F.transform(indices(0, F.size(w) - 2), lambda i: slot(F.get(w, i), F.get(w, i + 1)))
    return let(low, lambda w: F.concat(F.transform(w, lambda x: slot(x)), pairs(w)))


def repeated_words(words: Column) -> Column:
    """Words that lie in a three-word window whose words occur twice or more in the text.

    Windows are compared by a 64-bit hash. Those that occur again are found by sorting; the words
    they cover are counted from the sorted starts, each start adding at most three.
    """
    windows = let(
        words,
        lambda w: F.transform(
            indices(0, F.size(w) - 3),
            lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("at")),
        ),
    )

    def covered(s: Column) -> Column:
        again = F.filter(
            s, lambda x, k: x["h"].eqNullSafe(F.get(s, k - 1)["h"]) | x["h"].eqNullSafe(F.get(s, k + 1)["h"])
        )
        starts = F.sort_array(F.transform(again, lambda x: x["at"]))
        start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last"))
        step = lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last"))
        return F.aggregate(starts, start, step, lambda a: a["n"])

    def counted(w: Column) -> Column:
        distinct = F.size(F.array_distinct(F.transform(w, lambda x: x["h"])))
        return F.when(distinct == F.size(w), F.lit(0).cast("bigint")).otherwise(let(F.sort_array(w), covered))

    return let(windows, counted)


def fit_weights(
    docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> list[int]:
    """Weights of the slots from all documents and those whose id is in ``target_ids`` (one id column).

    Slots are counted per task first: ``SLOTS`` rows at most leave a task, and as many reach the driver.
    """
    ids = target_ids.toDF("target_id").where("target_id is not null").distinct()
    if ids.count() <= MAX_BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    flagged = texts.join(ids.withColumn("target", F.lit(1)), F.col("id") == F.col("target_id"), "left")
    grams = flagged.select(F.explode(gram_slots(words_of(F.col("text")))).alias("slot"), "target")
    rows = grams.groupBy("slot").agg(F.count(F.lit(1)).alias("raw"), F.count("target").alias("target")).collect()
    raw, target = [0] * SLOTS, [0] * SLOTS
    for slot, r, t in rows:
        raw[slot], target[slot] = r, t
    n_raw, n_target = sum(raw) + SLOTS, sum(target) + SLOTS
    return [
        round(SCALE * (math.log2((t + 1) / n_target) - math.log2((r + 1) / n_raw))) for r, t in zip(raw, target, strict=True)
    ]


def quality_rules(
    docs: DataFrame,
    weights: list[int],
    threshold: float = THRESHOLD,
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Counts and verdict of every row's whole text, without a shuffle.

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio_sum (of
    the n-gram weights, in 2^-16), n_grams, kept. A text is kept if it passes the base rules and
    its mean weight reaches ``threshold``. A null, empty or blank text has no words, fails the base
    rules and is not kept. One row per input row, whether ids repeat or are null; other columns are
    ignored.
    """
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<bigint>")  # folded to one literal
    texts = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(NO_SPACE))
    add = lambda a, s: a + F.get(table, s)
    counted = texts.select(
        "doc_id",
        let(
            words_of(F.col("text")),
            lambda w: F.struct(
                F.size(w).cast("bigint").alias("n_words"),
                F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
                repeated_words(w).alias("n_repeat_words"),
                F.aggregate(gram_slots(w), F.lit(0).cast("bigint"), add).alias("ratio_sum"),
            ),
        ).alias("w"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
    ).select("doc_id", "w.*", "n_symbols", "n_dup_lines")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    n_grams = F.greatest(2 * F.col("n_words") - 1, F.lit(0))
    good = F.col("ratio_sum") >= F.lit(round(threshold * SCALE)) * n_grams
    return counted.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        "ratio_sum",
        n_grams.alias("n_grams"),
        (~failed & good).alias("kept"),
    )
