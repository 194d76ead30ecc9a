from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from daybridge import add_next_event

STRATEGIES = [("window", 10), ("auto", 10**6), ("split", 2), ("split", 1)]


def test_two_boats(spark):
    df = spark.createDataFrame(
        [("pier 4", "2024-06-03 06:10:00", "heron"), ("pier 4", "2024-06-03 09:25:30", "tern")],
        "berth string, leaves string, boat string",
    ).withColumn("leaves", F.col("leaves").cast("timestamp"))
    out = add_next_event(df, "berth", "leaves", {"boat_next": "boat"})
    assert out.columns == ["berth", "leaves", "boat", "leaves_next", "boat_next", "diff_next"]
    assert dict(out.dtypes)["diff_next"] == "bigint"
    first, second = out.orderBy("leaves").collect()
    assert first == Row(
        berth="pier 4",
        leaves=datetime(2024, 6, 3, 6, 10),
        boat="heron",
        leaves_next=datetime(2024, 6, 3, 9, 25, 30),
        boat_next="tern",
        diff_next=3 * 3600 + 15 * 60 + 30,
    )
    assert (second.leaves_next, second.boat_next, second.diff_next) == (None, None, None)


def _edge_frame(spark):
    rows = [
        ("A", 1, "2023-01-01 10:00:00.900", "x"),
        ("A", 2, "2023-01-01 10:00:02.100", "y"),  # 1.2 s later: gap 1
        ("A", 3, "2023-01-01 10:00:02.100", "z"),  # tie, broken by id
        ("A", 4, None, "n1"),
        ("A", 5, None, "n2"),
        ("B", 6, "2023-01-02 00:00:00", "solo"),
        ("C", 7, "2023-01-01 00:00:00", "c1"),
        ("C", 8, "2023-01-03 00:00:00", "c2"),
    ]
    return spark.createDataFrame(rows, "k string, id int, ts string, attr string").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")
    )


EXPECTED = {
    1: (2, 1),
    2: (3, 0),
    3: (4, None),  # last timed row chains to the first null-time row
    4: (5, None),
    5: (None, None),
    6: (None, None),
    7: (8, 172800),
    8: (None, None),
}


@pytest.mark.parametrize("strategy, seg", STRATEGIES)
def test_nulls_ties_fractions_single_rows(spark, strategy, seg):
    out = add_next_event(
        _edge_frame(spark), "k", "ts", {"id_next": "id"}, ["id"], strategy=strategy, segment_rows=seg
    )
    got = {r.id: (r.id_next, r.diff_next) for r in out.collect()}
    assert got == EXPECTED


@pytest.mark.parametrize("strategy, seg", STRATEGIES)
def test_hot_key_matches_plain_window(spark, strategy, seg):
    # one key holds a third of the rows; numbers as time
    rows = [(0 if i % 3 == 0 else i, i, float(i * 7 % 101), i % 5) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, id long, t double, v long")
    base = add_next_event(df, "k", "t", {"v_next": "v", "id_next": "id"}, ["id"], strategy="window")
    got = add_next_event(df, "k", "t", {"v_next": "v", "id_next": "id"}, ["id"], strategy=strategy, segment_rows=seg * 20)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, base.collect()))


def test_output_name_clash_and_bad_strategy(spark):
    df = _edge_frame(spark)
    with pytest.raises(ValueError):
        add_next_event(df, "k", "ts", {"attr": "attr"})
    with pytest.raises(ValueError):
        add_next_event(df, "k", "ts", strategy="fast")


@pytest.mark.parametrize("strategy, seg", STRATEGIES)
def test_hot_key_with_many_null_times(spark, strategy, seg):
    # a third of the rows share one key, and half of those have no time
    rows = [
        (0 if i % 3 == 0 else i, i, None if (i % 3 == 0 and i % 2 == 0) else f"2024-01-{1 + i % 28:02d} 10:{i % 60:02d}:00", i % 7)
        for i in range(900)
    ]
    df = spark.createDataFrame(rows, "k long, id long, t string, v long").withColumn("t", F.col("t").cast("timestamp_ntz"))
    base = add_next_event(df, "k", "t", {"v_next": "v", "id_next": "id"}, ["id"], strategy="window")
    got = add_next_event(df, "k", "t", {"v_next": "v", "id_next": "id"}, ["id"], strategy=strategy, segment_rows=seg * 15)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, base.collect()))


def _segment_sizes(spark, rows, segment_rows, ties=("id",), schema="k long, id long, t string"):
    """Rows of each (key, range) of the hot rows, dealt as ``add_next_event`` deals them."""
    from daybridge.operators import next_event as ne

    df = spark.createDataFrame(rows, schema).withColumn("t", F.col("t").cast("timestamp_ntz"))
    segments = max(1, round(ne.RANGE_SLACK * df.count() / segment_rows))
    dealt = ne._ranges(df.withColumn(ne._ROW, ne._row_hash(df)), segments, ["k"], "t", list(ties))
    return [r["count"] for r in dealt.groupBy("k", ne._SEG).count().collect()]


BURSTS = {
    "spread": [(0, i, f"2024-01-01 {i % 24:02d}:{(i * 7) % 60:02d}:00") for i in range(2000)],
    "burst": [(0, 0, "1970-01-01 00:00:00")] + [(0, i, f"2024-01-01 10:00:{i % 60:02d}") for i in range(1, 2000)],
    "one time": [(0, i, "2024-01-01 10:00:00") for i in range(2000)],
    "null times": [(0, i, None) for i in range(2000)],
    "null key": [(None, i, f"2024-01-01 {i % 24:02d}:00:00") for i in range(2000)],
    "copies": [(0, 1, "2024-01-01 10:00:00")] * 2000,
}


@pytest.mark.parametrize("case", BURSTS)
@pytest.mark.parametrize("ties", [("id",), ()])
def test_no_range_holds_more_than_twice_its_rows(spark, case, ties):
    sizes = _segment_sizes(spark, BURSTS[case], 200, ties)
    assert sum(sizes) == 2000 and len(sizes) >= 10 and max(sizes) <= 400


def test_text_tie_breaker_and_carried_map(spark):
    rows = [(1, f"n{i % 7}", i % 3, {"a": i}) for i in range(90)]
    df = spark.createDataFrame(rows, "k long, name string, t long, m map<string,int>")
    args = ("k", "t", {"m_next": "m"}, ["name"])
    base = add_next_event(df, *args, strategy="window").collect()
    got = add_next_event(df, *args, strategy="split", segment_rows=9).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, base))


@pytest.mark.parametrize("null_times", [False, True])
def test_ties_without_tie_breaker_give_one_chain(spark, null_times):
    rows = [(i % 2, i, None if null_times else f"2024-01-{1 + i // 300:02d} 00:00:00", i % 11) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, id long, t string, v long").withColumn("t", F.col("t").cast("timestamp_ntz"))
    base = None
    for strategy, seg, parts in [("window", 10, 1), ("window", 10, 7), ("auto", 100, 3), ("split", 40, 5)]:
        out = add_next_event(df.repartition(parts), "k", "t", {"next_id": "id"}, strategy=strategy, segment_rows=seg)
        got = sorted(map(repr, out.collect()))
        chain = [r.next_id for r in out.collect() if r.next_id is not None]
        assert len(chain) == len(set(chain)) == 2998
        base = base or got
        assert got == base  # the same from every plan and input layout


def test_hot_keys_beyond_the_broadcast_bound(spark, monkeypatch):
    from daybridge.operators import next_event as ne

    monkeypatch.setattr(ne, "MAX_BROADCAST_HOT_KEYS", 0)
    rows = [(i % 4 or None, i, float((i * 37) % 500), i % 9) for i in range(800)]
    df = spark.createDataFrame(rows, "k long, id long, t double, v long")
    base = add_next_event(df, "k", "t", {"v_next": "v"}, ["id"], strategy="window")
    got = add_next_event(df, "k", "t", {"v_next": "v"}, ["id"], strategy="split", segment_rows=40)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, base.collect()))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "bigint"])
def test_sketched_segments_give_the_window(spark, kind):
    rows = [(None if i % 3 == 0 else i % 5, i, (i * 7919) % 3600, i % 7) for i in range(3000)]
    rows += [(1, 3000 + i, None, i) for i in range(40)] + [(2, 5000, 17, 1)] * 3
    df = spark.createDataFrame(rows, "k long, id long, s long, v long")
    t = F.col("s") if kind == "bigint" else F.timestamp_seconds(F.col("s") * 86_400 + F.col("s")).cast(kind)
    df = df.withColumn("t", t).drop("s")
    for ties in (["id"], []):
        base = add_next_event(df, "k", "t", {"v_next": "v"}, ties, strategy="window")
        for parts, seg in ((3, 50), (5, 200)):
            got = add_next_event(df.repartition(parts), "k", "t", {"v_next": "v"}, ties, segment_rows=seg)
            assert "sequence" not in got._jdf.queryExecution().optimizedPlan().toString()
            assert sorted(map(repr, got.collect())) == sorted(map(repr, base.collect()))


@pytest.mark.parametrize("case", BURSTS)
def test_segments_stay_near_their_rows_whatever_the_times(spark, case):
    from daybridge.operators import next_event as ne

    df = spark.createDataFrame(BURSTS[case], "k long, id long, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    hot = df.groupBy(F.col("k").alias("_db_k0")).agg(F.count("*").alias("_n"))
    starts = ne._starts(df, hot, 1, 2000, ["k"], "t", 200)
    assert (starts is None) == (case in ("one time", "null times", "copies"))
    if starts is None:
        return
    seen = {}
    real = ne.Window.partitionBy

    def kept(*cols):
        seen["cols"] = cols
        return real(*cols)

    base = df.withColumn(ne._ROW, ne._row_hash(df)).withColumn(ne._PAIR, F.struct("t"))
    linked = ne._segment_lead(base, starts, ["k"], ne.ticks(F.col("t"), df.schema["t"].dataType), [F.col("t").asc_nulls_last()])
    assert linked.count() == 2000
    cuts = [r for r in starts.first()._db_starts]
    ticks = [r[0] for r in df.select(ne.ticks(F.col("t"), df.schema["t"].dataType)).collect()]
    sizes = [sum((a is None or t >= a) and (b is None or t < b) for t in ticks) for a, b in zip([None, *cuts], [*cuts, None])]
    assert sum(sizes) == 2000 and max(sizes) <= 400 and len(sizes) >= 10


def test_the_split_reads_its_input_three_times(spark, tmp_dir):
    rows = [(i % 2, i, f"2024-01-{1 + i % 28:02d} {i % 24:02d}:{i % 60:02d}:00") for i in range(4000)]
    path = f"{tmp_dir}/rows"
    spark.createDataFrame(rows, "k long, id long, t string").withColumn("t", F.col("t").cast("timestamp_ntz")).write.parquet(path)
    df = spark.read.parquet(path)
    reads = spark.sparkContext.accumulator(0)

    def seen(it):
        for batch in it:
            reads.add(batch.num_rows)
            yield batch

    out = add_next_event(df.mapInArrow(seen, df.schema), "k", "t", {"n": "id"}, ["id"], segment_rows=300)
    assert out.count() == 4000 and reads.value <= 3 * 4000


@pytest.mark.parametrize("case", ["spread", "one time", "null times", "null key"])
def test_segments_grow_instead_of_their_number(spark, monkeypatch, case):
    from daybridge.operators import next_event as ne

    asked = []
    real = ne._ranges
    monkeypatch.setattr(ne, "_ranges", lambda rows, segments, *rest: asked.append(segments) or real(rows, segments, *rest))
    monkeypatch.setattr(ne, "MAX_SEGMENTS", 8, raising=False)
    rows = BURSTS[case] + [(i % 50 + 1, 2000 + i, "2024-01-02 00:00:00") for i in range(200)]  # small keys, hot by segment_rows alone
    df = spark.createDataFrame(rows, "k long, id long, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    base = add_next_event(df, "k", "t", {"next_id": "id"}, ["id"], strategy="window")
    got = add_next_event(df, "k", "t", {"next_id": "id"}, ["id"], segment_rows=3)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, base.collect()))
    assert asked == ([9] if case in ("one time", "null times") else [])  # not one for every three rows


def test_many_equal_and_missing_first_times_are_searched_right(spark):
    rows = [(i % 2, i, None if i % 11 == 0 else (i * 37) % 700) for i in range(4000)]
    df = spark.createDataFrame(rows, "k long, id long, t long")
    base = add_next_event(df, "k", "t", {"next_id": "id"}, ["id"], strategy="window")
    got = add_next_event(df, "k", "t", {"next_id": "id"}, ["id"], segment_rows=190)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, base.collect()))
