import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

from daybridge import flatten


def test_struct_and_array_of_structs(spark):
    schema = "crate struct<depth:double, label:string>, weight int, stops array<struct<harbour:string, hours:int>>"
    rows = [((1.5, "tea"), 40, [("Oslo", 3), ("Cork", 9), ("Vigo", 1)])]
    out = flatten(spark.createDataFrame(rows, schema))
    assert out.columns == ["depth", "label", "weight", "harbour", "hours"]
    assert sorted(map(tuple, out.collect())) == [
        (1.5, "tea", 40, "Cork", 9),
        (1.5, "tea", 40, "Oslo", 3),
        (1.5, "tea", 40, "Vigo", 1),
    ]


def _nested(spark):
    schema = T.StructType(
        [
            T.StructField("id", T.IntegerType()),
            T.StructField("xs", T.ArrayType(T.IntegerType())),
            T.StructField("ys", T.ArrayType(T.StringType())),
            T.StructField("m", T.MapType(T.StringType(), T.IntegerType())),
            T.StructField("aa", T.ArrayType(T.ArrayType(T.IntegerType()))),
        ]
    )
    rows = [
        (1, [1, 2], ["a", "b"], {"k": 1}, [[1], [2, 3]]),
        (2, None, ["c"], None, [[4]]),
        (3, [], ["d"], {}, [[5]]),
    ]
    return spark.createDataFrame(rows, schema)


def test_sibling_arrays_multiply_and_empty_arrays_drop_rows(spark):
    out = flatten(_nested(spark))
    assert out.columns == ["id", "xs", "ys", "aa"]
    rows = out.collect()
    # id 1: 2 xs x 2 ys x 3 inner values; ids 2 and 3 have a null / empty array.
    assert len(rows) == 12
    assert {r.id for r in rows} == {1}


def test_outer_keeps_rows_and_map_can_be_kept(spark):
    out = flatten(_nested(spark), outer=True, on_map="keep")
    assert "m" in out.columns
    ids = sorted({r.id for r in out.collect()})
    assert ids == [1, 2, 3]
    row2 = [r for r in out.collect() if r.id == 2]
    assert row2 == [Row(id=2, xs=None, ys="c", m=None, aa=4)]


def test_duplicate_names_are_refused(spark):
    df = spark.createDataFrame([((1,), (2,))], "s1 struct<x:int>, s2 struct<x:int>")
    with pytest.raises(ValueError, match="duplicate"):
        flatten(df)


def test_duplicate_names_follow_the_sessions_rule_on_case(spark):
    df = spark.createDataFrame([((1,), (2,))], "s1 struct<x:int>, s2 struct<X:int>")
    with pytest.raises(ValueError, match="duplicate"):
        flatten(df)
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert flatten(df).columns == ["x", "X"]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_dotted_names(spark):
    df = spark.createDataFrame([((1, 2),)], "`a.b` struct<`c.d`:int, e:int>")
    out = flatten(df)
    assert out.columns == ["c.d", "e"]
    assert out.collect() == [Row(**{"c.d": 1, "e": 2})]


def test_user_defined_types_are_dropped_like_maps(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(1, Vectors.dense([1.0, 2.0]))], ["id", "features"])
    assert flatten(df).columns == ["id"]
    assert flatten(df, on_map="keep").columns == ["id", "features"]
