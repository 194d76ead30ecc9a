"""Near-duplicate groups by an LSH forest over MinHash signatures.

1. Each document becomes its set of distinct word shingles (64-bit hashes), a 128-bit key of the
   set and a signature of ``trees * depth`` minima, in one pass over the texts. Equal sets form a
   class, found by an aggregate on the key; only one member of a class goes on.
2. Each tree sorts the signatures in an order of its own. Documents that share the first
   ``MIN_PREFIX`` minima of an order form a region; a pair with similarity 0.8 shares one in at
   least one of 24 orders with probability 1 - 3e-6. Regions of at most ``REGION`` documents are
   compared pair by pair. In a larger region the prefix is deepened where the documents lie
   dense: each document meets its next ``NEIGHBOURS`` in sorted order, those with the longest
   common prefix.
3. Candidates are sifted by their whole signatures (five standard errors below the threshold) and
   confirmed on the full shingle sets.
4. Confirmed links give components. The neighbours of a large region are a choice, so an exact way
   follows where they left documents outside the region's main component: documents that share
   large regions form a family, families with such documents are dealt into blocks of about
   ``BLOCK_DOCS``, and each two blocks of a family are compared by one task, signatures first, then
   full sets; only links leave the task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybridge.llm.graph import connected_components, stored
from daybridge.llm.text import U64, Words, column, distinct_per_document, mix, runs, shingle_hashes

TREES, DEPTH, MIN_PREFIX = 24, 6, 4
REGION = 32
NEIGHBOURS = 4
BLOCK_DOCS = 256
#: Candidate ids are sent to every task when there are at most this many (8 bytes each).
MAX_BROADCAST_IDS = 1_000_000
_BLOCK = 1 << 16
RUN_BYTES = 2 << 20

SIGNATURE_SCHEMA = "doc_id long, n_shingles long, k1 long, k2 long, sig binary"
FOREST_SCHEMA = "rep long, region long, tail long"


def _multipliers(count: int) -> np.ndarray:
    return (mix(np.arange(1, count + 1, dtype=U64)) >> U64(32)).astype(np.uint32) | np.uint32(1)


def minhash(values: np.ndarray, offsets: np.ndarray, count: int) -> np.ndarray:
    """``count`` minima of each non-empty set, as a row of unsigned 32-bit integers."""
    mult = _multipliers(count)
    low = (values >> U64(32)).astype(np.uint32)
    out = np.full((len(offsets) - 1, count), np.uint32(0xFFFFFFFF))
    rows = np.flatnonzero(np.diff(offsets))
    first = 0
    while first < len(rows):  # blocks of sets that fit the processor's cache
        last = max(first + 1, int(np.searchsorted(offsets[rows], offsets[rows[first]] + _BLOCK)))
        block = rows[first:last]
        begin, end = offsets[block[0]], offsets[block[-1] + 1]
        starts, part = offsets[block] - begin, low[begin:end]
        for j in range(count):
            out[block, j] = np.minimum.reduceat(part * mult[j], starts)
        first = last
    return out


def set_keys(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit sums over each set; equal sets, and in practice only those, agree in both."""
    keys = []
    for salt in (U64(0x5851F42D4C957F2D), U64(0x14057B7EF767814F)):
        total = np.zeros(len(values) + 1, dtype=U64)
        np.cumsum(mix(values ^ salt), out=total[1:])
        keys.append((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64))
    return keys[0], keys[1]


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    words = Words(texts)
    return distinct_per_document(*shingle_hashes(words.hashes()[words.ids], words.offsets, size))


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, set size, 128-bit set key and signature of each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, "text", RUN_BYTES):
            values, off = shingle_sets(column(run, "text"), size)
            k1, k2 = set_keys(values, off)
            sig = minhash(values, off, TREES * DEPTH)
            blob = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(4 * TREES * DEPTH), len(sig), [None, pa.py_buffer(np.ascontiguousarray(sig))]
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [column(run, "doc_id"), pa.array(np.diff(off)), pa.array(k1), pa.array(k2), blob],
                names=["doc_id", "n_shingles", "k1", "k2", "sig"],
            )

    return docs.mapInArrow(work, SIGNATURE_SCHEMA)


def _matrix(blob: pa.Array) -> np.ndarray:
    raw = blob.buffers()[2]
    width = 4 * TREES * DEPTH
    skip = np.frombuffer(blob.buffers()[1], dtype=np.int32)[blob.offset] if len(blob) else 0
    return np.frombuffer(raw, dtype=np.uint32, count=len(blob) * TREES * DEPTH, offset=int(skip)).reshape(-1, width // 4)


def forest(reps: DataFrame) -> DataFrame:
    """A row per document and tree: region (hash of tree and first minima) and tail (the minima after them)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            sig = _matrix(column(batch, "sig")).reshape(-1, TREES, DEPTH).astype(U64)
            region = np.broadcast_to(np.arange(TREES, dtype=U64), sig.shape[:2])
            for j in range(MIN_PREFIX):
                region = mix(region + (sig[:, :, j] + U64(1)) * U64(0x9E3779B97F4A7C15))
            tail = (sig[:, :, MIN_PREFIX] << U64(31)) | (sig[:, :, MIN_PREFIX + 1] >> U64(1))
            rep = np.repeat(column(batch, "rep").to_numpy(zero_copy_only=False), TREES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rep), pa.array(region.reshape(-1).view(np.int64)), pa.array(tail.reshape(-1).view(np.int64))],
                names=["rep", "region", "tail"],
            )

    return reps.select("rep", "sig").mapInArrow(work, FOREST_SCHEMA)


def _pairs_of_small(rows: DataFrame) -> DataFrame:
    """All pairs of regions that hold at most ``REGION`` documents."""
    groups = rows.groupBy("region").agg(F.sort_array(F.collect_set("rep")).alias("reps"))
    one = groups.select("reps", F.posexplode("reps").alias("i", "a"))
    return one.select("a", F.explode(F.slice("reps", F.col("i") + 2, REGION)).alias("b"))


def _pairs_of_large(rows: DataFrame) -> DataFrame:
    """Each document with the next ones of its region in the sorted order of the tree."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64), np.zeros(0, np.int64)]  # the last rows of the batch before
        for batch in batches:
            reg = np.r_[kept[0], column(batch, "region").to_numpy(zero_copy_only=False)]
            rep = np.r_[kept[1], column(batch, "rep").to_numpy(zero_copy_only=False)]
            a, b = [], []
            for step in range(1, NEIGHBOURS + 1):
                second = np.arange(max(step, len(kept[0])), len(rep))
                near = second[reg[second] == reg[second - step]]
                a.append(rep[near - step])
                b.append(rep[near])
            kept = [reg[-NEIGHBOURS:], rep[-NEIGHBOURS:]]
            a, b = np.concatenate(a), np.concatenate(b)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "region", "tail", "rep").sortWithinPartitions("region", "tail", "rep")
    return ordered.select("region", "rep").mapInArrow(work, "a long, b long")


def _sifted(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose signatures do not rule the threshold out by five standard errors."""
    least = _least_matches(threshold)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                same = (_matrix(column(batch, "sig_a")) == _matrix(column(batch, "sig_b"))).sum(axis=1)
                yield batch.select(["a", "b"]).filter(pa.array(same >= least))

    left = reps.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a"))
    right = reps.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(work, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets have ``100 * intersection >= percent * union``. ``pairs`` is stored."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, "text_a", RUN_BYTES // 2):
            n = run.num_rows
            both = pa.concat_arrays([column(run, "text_a"), column(run, "text_b")])
            values, off = shingle_sets(both, size)
            row = np.repeat(np.arange(2 * n), np.diff(off)) % n
            order = np.lexsort((values, row))
            v, r = values[order], row[order]
            common = np.bincount(r[1:][(v[1:] == v[:-1]) & (r[1:] == r[:-1])], minlength=n)
            union = np.diff(off).reshape(2, n).sum(axis=0) - common
            yield run.select(["a", "b"]).filter(pa.array(100 * common >= percent * union))

    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    if pairs.count() * 2 <= MAX_BROADCAST_IDS:
        ids = F.broadcast(ids)
    wanted = texts.join(ids, "doc_id", "left_semi")
    first = wanted.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    second = wanted.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(work, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest linked doc_id) and kept of every row.

    Words are lower-cased (A-Z). A text with fewer words than a shingle has one shingle; a null,
    empty or blank text has none and is linked with nothing. Rows that share a doc_id count as one
    document. A row without doc_id takes no part in linking: component_id is null, kept is true.
    Other columns are ignored; an empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = stored(signatures(texts, shingle_words), "signatures")
    linked = signed.where("n_shingles > 0 and doc_id is not null")
    classes = linked.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.min_by("sig", "doc_id").alias("sig"))
    reps = stored(classes.select("rep", "k1", "k2", "sig"), "classes")

    trees = forest(reps)
    shared = trees.groupBy("region").count().where("count > 1")
    regions = stored(trees.join(shared, "region"), "regions")
    small, large = regions.where(F.col("count") <= REGION), regions.where(F.col("count") > REGION)
    pairs = _pairs_of_small(small).union(_pairs_of_large(large)).where("a != b").distinct()
    sifted = stored(_sifted(pairs, reps, percent / 100), "sifted")
    links = stored(_confirmed(sifted, texts, shingle_words, percent), "links")
    components = stored(connected_components(links), "components")

    if not large.isEmpty():
        more = _links_of_rest(large, components, reps, texts, shingle_words, percent)
        if not more.isEmpty():
            known = components.select(F.col("id").alias("a"), F.col("component").alias("b"))
            components = stored(connected_components(known.union(more)), "components")

    of_class = reps.select("k1", "k2", "rep").join(components, F.col("rep") == F.col("id"), "left")
    of_class = of_class.select("k1", "k2", F.coalesce("component", "rep").alias("component"))
    member = linked.select("doc_id", "n_shingles", "k1", "k2").join(of_class, ["k1", "k2"])
    alone = signed.where("n_shingles = 0 or doc_id is null")
    found = member.select("doc_id", "n_shingles", F.col("component").alias("component_id")).union(
        alone.select("doc_id", "n_shingles", "doc_id")
    )
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _set_blobs(texts: DataFrame, size: int) -> DataFrame:
    """rep and the sorted shingle hashes of each text, as 64-bit integers in a binary."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, "text", RUN_BYTES // 2):
            values, off = shingle_sets(column(run, "text"), size)
            blobs = [values[a:b].tobytes() for a, b in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([column(run, "rep"), pa.array(blobs, pa.binary())], names=["rep", "shingles"])

    return texts.mapInArrow(work, "rep long, shingles binary")


def _least_matches(threshold: float) -> int:
    """Equal minima below which a signature rules the threshold out, by five standard errors."""
    n = TREES * DEPTH
    return math.floor(n * threshold - 5 * math.sqrt(n * threshold * (1 - threshold)))


def _block_links(percent: int):
    least = _least_matches(percent / 100)

    def work(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        rep, comp, rest, block = (table.column(c).to_numpy() for c in ("rep", "comp", "rest", "block"))
        sig = _matrix(table.column("sig").combine_chunks())
        sets = [np.frombuffer(x.as_buffer(), dtype=U64) for x in table.column("shingles")]
        one, two = key[1].as_py(), key[2].as_py()
        rows, others = np.flatnonzero(block == one), np.flatnonzero(block == two)
        a, b = [], []
        for i in rows.tolist():
            far = others[(comp[others] != comp[i]) & (rest[others] | rest[i])]
            for j in far[(sig[far] == sig[i]).sum(axis=1) >= least].tolist():
                if one == two and j <= i:
                    continue
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    a.append(rep[i])
                    b.append(rep[j])
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return work


def _links_of_rest(
    large: DataFrame, components: DataFrame, reps: DataFrame, texts: DataFrame, size: int, percent: int
) -> DataFrame:
    """Links between components within families that hold documents outside a region's main component (exact)."""
    placed = large.join(components, F.col("rep") == F.col("id"), "left")
    placed = stored(placed.select("region", "rep", F.coalesce("component", "rep").alias("comp")), "placed")
    sizes = placed.groupBy("region", "comp").count()
    main = sizes.groupBy("region").agg(F.max_by("comp", F.struct("count", "comp")).alias("main"))
    rest = placed.join(main, "region").groupBy("rep", "comp").agg(F.max(F.expr("comp != main")).alias("rest"))

    # Families: documents joined by their regions. A region gets a name that no document has.
    region = F.lit(-(1 << 62)) + F.pmod(F.xxhash64("region"), F.lit(1 << 61))
    members = connected_components(stored(placed.select(F.col("rep").alias("a"), region.alias("b")), "members"))
    docs = rest.join(members.select(F.col("id").alias("rep"), F.col("component").alias("family")), "rep")
    docs = stored(docs, "families")
    open_ = docs.groupBy("family").agg(F.count(F.lit(1)).alias("docs"), F.max("rest").alias("any")).where("any")
    blocks = F.ceil(F.col("docs") / BLOCK_DOCS).cast("int")
    dealt = docs.join(open_.select("family", blocks.alias("blocks")), "family").withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    )
    dealt = stored(dealt, "blocks")

    ids = dealt.select("rep")
    ids = F.broadcast(ids) if dealt.count() <= MAX_BROADCAST_IDS else ids
    wanted = texts.withColumnRenamed("doc_id", "rep").join(ids, "rep", "left_semi")
    full = dealt.join(reps.select("rep", "sig"), "rep").join(_set_blobs(wanted, size), "rep")
    pair = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    each = full.select("family", "rep", "comp", "rest", "sig", "shingles", "block", pair)
    one, two = F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two")
    met = each.groupBy("family", one, two).applyInArrow(_block_links(percent), "a long, b long")
    return stored(met.distinct(), "links")


def keep_one_of_each(
    docs: DataFrame, shingle_words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, without near duplicates: of each group the smallest id stays.

    A document is an id with a text. Where rows share an id but not the text, each text is a document of its
    own, under a number drawn from both (below all ids), so that none goes for another's sake. Of rows alike in id and text one
    stays, the same in every run. Rows without id all stay. Null and empty texts are near nothing.
    """
    cols, sid = docs.columns, "__document"
    own, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ids = docs.where(F.col(id_col).isNotNull()).select(own.alias("__id"), F.xxhash64(text).alias("__h")).groupBy("__id")
    ids = ids.agg(F.count("*").alias("__n"), (F.min("__h") != F.max("__h")).alias("__clash")).where("__n > 1")
    ids = stored(ids.select("__id", "__clash"), "repeated-ids")
    repeated = not ids.isEmpty()

    def matched(rows: DataFrame, by: str, keys: DataFrame, kind: str) -> DataFrame:
        keys = F.broadcast(keys) if keys.count() <= MAX_BROADCAST_IDS else keys
        return rows.join(keys, rows[by] == keys["__id"], kind).drop("__id")

    named = docs.withColumn(sid, own)
    if repeated:
        number = -1 - F.pmod(F.xxhash64(own, text), F.lit(1 << 62))
        named = matched(named, sid, ids, "left").withColumn(sid, F.when(F.col("__clash"), number).otherwise(own))
    found = near_duplicates(named.select(sid, F.col(text_col)), shingle_words, percent, sid, text_col)
    found = stored(found, "near-duplicates")
    kept = matched(named, sid, found.where("not kept").select(F.col("doc_id").alias("__id")).distinct(), "left_anti")
    if not repeated:
        return kept.select(*[F.col(f"`{c}`") for c in cols])
    once = kept.where("__clash is null").select(*[F.col(f"`{c}`") for c in cols])
    order = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`").alias("v"))) for c in cols])
    rows = kept.where("__clash is not null").groupBy(sid).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in cols]), order).alias("row"))
    return once.union(rows.select("row.*"))
