import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row

from daybridge import ColumnSpec, IngestConfig, ingest_json, project_typed, read_json

BOOK = {"title": "Tides", "copies": {"shelf": "K7", "count": "12"}, "loans": [{"reader": 5}, {"reader": 8}], "x": 1}
BOOK_CONFIG = {
    "data_columns": [
        {"name": "Reader", "type": "bigint", "comment": "who has it"},
        {"name": "title", "type": "string", "comment": "title of the book"},
        {"name": "count", "type": "int", "comment": "copies on the shelf"},
    ],
    "output_table": "default.loans",
    "output_partitions": 3,
    "read": {"schema": "title string, copies struct<count:string>, loans array<struct<READER:bigint>>", "outer": True},
    "bridge": {"keys": ["title"], "tie_breakers": ["Reader"], "lookback_days": 2},
    "utc": {"as_ntz": True},
}


def test_ingest_by_config_file(spark, tmp_dir):
    data, config_file = Path(tmp_dir) / "books.json", Path(tmp_dir) / "config.json"
    data.write_text(json.dumps(BOOK) + "\n")
    config_file.write_text(json.dumps(BOOK_CONFIG))
    config = IngestConfig.from_file(config_file)
    out = ingest_json(spark, str(data), config.specs)
    # names are matched without regard to case, and come out as configured
    assert out.columns == ["Reader", "title", "count"]
    assert sorted(map(tuple, out.collect())) == [(5, "Tides", 12), (8, "Tides", 12)]
    assert dict(out.dtypes)["count"] == "int"
    assert out.schema["count"].metadata == {"comment": "copies on the shelf"}
    assert config.output_table == "default.loans" and config.output_partitions == 3
    assert config.read.outer and config.utc.as_ntz and config.bridge.keys == ("title",)
    assert (config.bridge.tie_breakers, config.bridge.lookback_days) == (("Reader",), 2)
    with pytest.raises(ValueError, match="lookbak"):
        IngestConfig.from_dict({**BOOK_CONFIG, "bridge": {"lookbak": 1}})


def test_typed_projection_date_pattern_and_default_comment(spark):
    df = spark.createDataFrame([("25/12/2023", "2023-12-26", "7", "true", "x")], "a string, b string, c string, d string, e string")
    out = project_typed(
        df,
        [
            ColumnSpec("a", "date", "dd/MM/yyyy", "with pattern"),
            ColumnSpec("b", "date"),
            ColumnSpec("c", "int"),
            {"name": "d", "type": "boolean"},
        ],
    )
    assert out.columns == ["a", "b", "c", "d"]
    assert out.first() == Row(a=date(2023, 12, 25), b=date(2023, 12, 26), c=7, d=True)
    assert out.schema["d"].metadata == {"comment": ""}


def test_bad_values_raise_or_become_null(spark):
    df = spark.createDataFrame([("abc", "2023-13-45")], "n string, d string")
    specs = [ColumnSpec("n", "int"), ColumnSpec("d", "date", "yyyy-MM-dd")]
    with pytest.raises(PySparkException):
        project_typed(df, specs).collect()
    assert project_typed(df, specs, on_error="null").first() == Row(n=None, d=None)


def test_missing_column_is_named(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="zz"):
        project_typed(df, [ColumnSpec("zz", "int")])


def test_multiline_and_corrupt_lines(spark, tmp_dir):
    pretty = Path(tmp_dir) / "pretty.json"
    pretty.write_text(json.dumps({"a": 1, "s": {"b": "x"}}, indent=2))
    assert read_json(spark, str(pretty), multi_line=True).first().a == 1
    bad = Path(tmp_dir) / "bad.json"
    bad.write_text('{"a": 1}\nnot json\n')
    got = read_json(spark, str(bad))
    assert "_corrupt_record" in got.columns
    assert got.count() == 2


def test_pruned_read_schema_gives_the_same_rows(spark, tmp_dir):
    from daybridge.sources.json_source import prune_schema

    rows = [
        {"id": 1, "meta": {"src": "a", "deep": {"x": 1, "y": "u"}}, "tags": ["p", "q"],
         "items": [{"n": 1, "w": 2.5}, {"n": 2, "w": 3.5}], "unused": {"k": 1}, "m": {"a": 1}},
        {"id": 2, "meta": {"src": "b", "deep": {"x": 2, "y": "v"}}, "tags": [],
         "items": [{"n": 3, "w": 1.0}], "unused": {"k": 2}},
        {"id": 3, "meta": {"src": "c"}, "tags": ["r"], "items": None},
        {"id": 4, "tags": ["s", "t", "u"], "items": [{"n": 5}, {"n": 6}, {"n": 7}]},
    ]
    path = Path(tmp_dir) / "nested.json"
    path.write_text("\n".join(json.dumps(r) for r in rows) + "\n")
    for names in (["id", "src"], ["id", "x", "w"], ["id"], ["y", "tags"]):
        specs = [ColumnSpec(n, "string") for n in names]
        full = ingest_json(spark, str(path), specs, prune=False)
        pruned = ingest_json(spark, str(path), specs)
        assert sorted(map(repr, pruned.collect())) == sorted(map(repr, full.collect()))
    narrow = prune_schema(read_json(spark, str(path)).schema, ["id", "src"])
    assert narrow.simpleString() == "struct<id:bigint,items:array<struct<n:bigint>>,meta:struct<src:string>,tags:array<string>>"


def test_single_line_top_level_array(spark, tmp_dir):
    path = Path(tmp_dir) / "array.json"
    path.write_text('[{"a": 1, "s": {"b": "x"}}, {"a": 2, "s": {"b": "y"}}]\n')
    out = ingest_json(spark, str(path), [ColumnSpec("a", "int"), ColumnSpec("b", "string")])
    assert sorted(map(tuple, out.collect())) == [(1, "x"), (2, "y")]


def test_config_ignores_deployment_keys():
    config = IngestConfig.from_dict(
        {
            "data_columns": [{"name": "FlightDate", "type": "date", "format": "yyyy-MM-dd", "comment": "Flight date"}],
            "output_table": "default.flights",
            "output_partitions": 10,
            "EXECUTION_ENVIRONMENT": "local",
            "SPARK_APP_NAME": "loader",
        }
    )
    assert (config.output_table, config.output_partitions) == ("default.flights", 10)
    assert config.specs[0] == ColumnSpec("FlightDate", "date", "yyyy-MM-dd", "Flight date")
