"""JSON functions and payload operators on good, empty, NULL and malformed input."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.functions import (
    batch_prefix,
    epoch_ts,
    extra_keys,
    parse_map,
    parse_ts,
    parse_variant,
    project_keys,
    repair_json,
    safe_cast,
    strip_control,
    structure_records,
    unquote_json,
    variant_path,
)
from siltstone.operators.evolve import SchemaRegistry, conform, infer_schema, merge_types, parse_evolving, widen
from siltstone.operators.flatten import expand_struct, fully_flatten
from siltstone.operators.payload import (
    classify_json_errors,
    error_records,
    ingest_json_quality,
    merge_key_tracking,
    track_keys,
)
from siltstone.operators.quality import quality_issues, quality_summary
from siltstone.sources.files import read_json, stream_json, with_file_metadata
from siltstone.streaming.run import run_stream

PROBE = "probe INT, spot STRUCT<hall: STRING, grid: STRUCT<x: INT, y: INT>>, samples ARRAY<STRUCT<at: INT, val: DOUBLE>>"

# Lines by file; which keys get lost is noted in LOST, what is no JSON at all in BROKEN.
READINGS = {
    "north": [
        '{"probe": 1, "spot": {"hall": "A", "grid": {"x": 1, "y": 2}}, "samples": [{"at": 1, "val": 0.5}]}',
        '{"probe": 2, "spot": {"hall": "A", "grid": {"x": 1, "y": 2, "z": 9}}, "samples": []}',
        '{"probe": 3, "spot": {"hall": "A", "gr',
    ],
    "south": [
        '{"probe": 4, "samples": [{"at": 1, "val": 2}, {"at": 2, "val": 3, "unit": "C"}]}',
        '{"probe": 5, "spot": "lost"}',
        '{"probe": 6, "spot": null, "samples": null}',
        '{"probe": 7, "samples": []}',
        '{"probe": 8}',
    ],
    "west": [
        '{"probe": 9, "samples": [{"at": 1, "val": 1.5},, {"at": 2}]}',
        '{"probe": 10, "spot": {"hall": 12}}',
        '{"probe": 11, "spot": {"grid": {"x": "east", "y": 0}}}',
        "probe twelve",
    ],
}
LOST = {2: {"spot": {"grid": {"z": 9}}}, 4: {"samples": [None, {"unit": "C"}]}, 5: {"spot": "lost"}, 11: {"spot": {"grid": {"x": "east"}}}}
BROKEN = {READINGS["north"][2], READINGS["west"][0], READINGS["west"][3]}


@pytest.fixture
def reading_files(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, lines in READINGS.items():
        (folder / f"{name}.json").write_text("\n".join(lines))
    return str(folder)


def check_readings(df):
    summary = quality_summary(df).first()
    assert (summary.total, summary.rescued, summary.corrupt, summary.coverage_pct) == (12, 4, 3, 58.3)
    issues = quality_issues(df, ["probe"]).collect()
    assert [r.file_name for r in issues] == sorted(r.file_name for r in issues)
    assert {r.probe: json.loads(r["_rescued_data"]) for r in issues if r["_rescued_data"]} == LOST
    assert {r["_corrupt_record"] for r in issues if r["_corrupt_record"]} == BROKEN
    assert df.where("probe = 10").first().spot.hall == "12", "a number read as text is no loss"


def test_readings_batch_and_stream(spark, reading_files, tmp_path):
    schema = StructType.fromDDL(PROBE)
    check_readings(with_file_metadata(read_json(spark, reading_files, schema, corrupt=True), "all"))
    stream = with_file_metadata(stream_json(spark, reading_files, schema, corrupt=True), "all")
    run_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    check_readings(spark.read.parquet(str(tmp_path / "out")))


def test_rescue_edge_cases(spark):
    schema = StructType.fromDDL("a INT, s STRUCT<b: INT, t: STRUCT<c: INT>>, l ARRAY<STRUCT<d: INT>>, m ARRAY<INT>")
    cases = {
        '{"a": 1, "s": {"b": 2, "t": {"c": 3}}, "l": [{"d": 4}], "m": [5]}': (None, False),
        '{"a": null, "s": null, "l": null, "m": null}': (None, False),
        "{}": (None, False),
        '{"s": {"t": {"c": 3, "deep": [1]}}}': ({"s": {"t": {"deep": [1]}}}, False),
        '{"s": "text"}': ({"s": "text"}, False),
        '{"l": [{"d": 1}, {"d": 2, "x": true}]}': ({"l": [None, {"x": True}]}, False),
        "[1, 2]": ([1, 2], False),
        "3": (3, False),
        '{"a": 1': (None, True),
        "": (None, True),
        None: (None, False),
    }
    df = ingest_json_quality(spark.createDataFrame([(k,) for k in cases], "j STRING").withColumn("key", F.col("j")), "j", schema)
    got = {r.key: (json.loads(r["_rescued_data"]) if r["_rescued_data"] else None, r["_corrupt_record"] is not None) for r in df.collect()}
    assert got == cases


def test_filters_do_not_parse_again(spark):
    df = ingest_json_quality(spark.range(1).select(F.concat(F.lit("{"), "id", F.lit("}")).alias("j")), "j", StructType.fromDDL("a INT, b INT"))
    plan = df.where("a > 1 AND b > 1 AND _rescued_data IS NULL")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(a") == 1


def test_repair(spark):
    cases = {
        '{"a":1}': '{"a":1}',
        '"{""a"":1}"': '{"a":1}',
        '"{""a"":""""}"': '{"a":""}',
        ' "{""a"":""b""}" ': '{"a":"b"}',
        '"{\\"a\\":\\"b\\"}"': '{"a":"b"}',
        '"{""a"":""say \\""hi\\""""}"': '{"a":"say \\"hi\\""}',
        '{"a":"x\\u0000y"}': '{"a":"xy"}',
        '"plain"': '"plain"',
        "": "",
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "d STRING")
    assert {r.d: r.r for r in df.select("d", repair_json(F.col("d")).alias("r")).collect()} == cases
    simple = df.where("d IN ('{\"a\":1}', '\"{\"\"a\"\":1}\"')").select(unquote_json(F.col("d")).alias("u"))
    assert {r.u for r in simple.collect()} == {'{"a":1}'}
    assert spark.range(1).select(strip_control(F.lit("a\x01b\x7f\\u0000c")).alias("s")).first().s == "abc"


def test_scalars(spark):
    one = spark.range(1)
    row = one.select(
        batch_prefix(F.lit("/x/2024/1/05/10-30/f.tsv")).alias("p"), batch_prefix(F.lit("/x/f.tsv")).alias("none"),
        batch_prefix(F.lit(None).cast("string")).alias("null"),
        epoch_ts(F.lit("0")).alias("e"), epoch_ts(F.lit("soon")).alias("bad_e"), parse_ts(F.lit("1/2/2024 03:04:05"), "M/d/yyyy HH:mm:ss").alias("t"),
        parse_ts(F.lit("2024"), "M/d/yyyy HH:mm:ss").alias("bad_t"), safe_cast(F.lit("x"), "int").alias("i"),
        variant_path(parse_variant(F.lit('{"a":{"b":"7"}}')), "a.b", "int").alias("v"),
    ).first()
    assert (row.p, row.none, row.null) == ("2024/1/05/10-30", None, None)
    assert row.e.year == 1970 and row.t.minute == 4
    assert (row.bad_e, row.bad_t, row.i, row.v) == (None, None, None, 7)


def test_maps_and_records(spark):
    text = '{"id":"1","private":"yes?","created":86400,"more":{"x":1},"records":[{"id":5,"optionData":{"checkBoxes":["a"],"data":"d","fixedText":true},"zz":1}, {}]}'
    m = parse_map(F.lit(text))
    row = spark.range(1).select(
        *project_keys(m, {"D_id": ("id", "string"), "D_private": ("private", "boolean"), "D_created": ("created", "epoch")}),
        extra_keys(m, ["id", "private", "created", "records"]).alias("extra"), structure_records(m["records"]).alias("r"),
        structure_records(F.lit("{oops")).alias("bad"), structure_records(F.lit(None).cast("string")).alias("absent"),
    ).first()
    assert row.D_id == "1" and row.D_private is not False and row.D_created.day == 2
    assert row.extra == {"more": '{"x":1}'}
    first, second = row.r
    assert (first.record_id, first.option_checkBoxes, first.option_data, first.option_fixedText) == ("5", ["a"], "d", True)
    assert first.record_extra == {"zz": "1"} and second.option_checkBoxes == [] and second.priority is None
    assert row.bad == [] and row.absent == []


def test_flatten(spark):
    df = spark.sql(
        """SELECT 1 AS id, named_struct('a', 1, 'b.c', named_struct('d', 'x')) AS s, array(named_struct('n', 1), named_struct('n', 2)) AS l1,
        array(named_struct('m', 'p'), named_struct('m', 'q')) AS l2, map('k', 1) AS mp, array(1, 2) AS plain"""
    )
    flat = fully_flatten(df)
    assert flat.count() == 4, "two arrays multiply"
    assert set(flat.columns) == {"id", "s_a", "s_b_c_d", "l1_exploded_n", "l2_exploded_m", "mp", "plain"}
    assert flat.first().mp == '{"k":1}' and dict(flat.dtypes)["id"] == "string"
    as_json = fully_flatten(df, arrays="json")
    assert as_json.count() == 1 and json.loads(as_json.first().l1) == [{"n": 1}, {"n": 2}]
    with pytest.raises(ValueError, match="twice"):
        fully_flatten(spark.sql("SELECT 1 AS s_a, named_struct('a', 1) AS s"))
    empty = spark.sql("SELECT 1 AS id, CAST(array() AS array<struct<n: int>>) AS l")
    assert rows(fully_flatten(empty)) == [("1", None)]
    renamed = expand_struct(df.select("id", "s"), "s", "S_", {"a": "first"})
    assert renamed.columns == ["id", "first", "S_b.c"]


def test_inference_and_evolution(spark, tmp_path):
    registry = SchemaRegistry(spark, str(tmp_path / "schemas"))
    batch = lambda *texts: spark.createDataFrame([(t,) for t in texts], "j STRING")
    first = infer_schema(batch('{"a": 1, "n": {"x": "t"}}', "{bad", None, "[1]"), "j", registry, "k")
    assert first.simpleString() == "struct<a:bigint,n:struct<x:string>>"
    second = infer_schema(batch('{"a": 1.5, "OBJECT<": true, "n": {"y": [1]}}', '{"z": null}'), "j", registry, "k")
    assert second["a"].dataType.simpleString() == "double" and second["OBJECT<"].dataType.simpleString() == "boolean"
    assert second["n"].dataType.simpleString() == "struct<x:string,y:array<bigint>>"
    third = infer_schema(batch('{"a": "text"}'), "j", registry, "k", hints="z INT, _corrupt_record STRING")
    assert third["a"].dataType.simpleString() == "string" and third["z"].dataType.simpleString() == "int"
    assert registry.load("k") == third and registry.load("other") is None
    parsed = parse_evolving(batch('{"a": "q"}'), "j", "p", registry, "k")
    assert parsed.first().p.a == "q"
    assert infer_schema(batch("{bad"), "j").fields == []


def test_widen_and_conform(spark):
    wide = widen(spark.sql("SELECT 1 AS a, 'x' AS b"), spark.sql("SELECT CAST(2.5 AS DOUBLE) AS a, true AS c"))
    assert rows(wide) == [(1.0, "x", None), (2.5, None, True)]
    assert merge_types(StructType.fromDDL("a INT"), StructType.fromDDL("a BOOLEAN")).simpleString() == "struct<a:string>"
    assert rows(conform(spark.sql("SELECT 'x' AS a, 1 AS z"), StructType.fromDDL("b INT, a INT"), unfit="null")) == [(None, None)]


def test_keys_and_errors(spark):
    df = spark.sql(
        """SELECT * FROM VALUES ('{"a":1}', 1), ('{"b":1,"a":{"c":2}}', 2), ('{bad', 3), (NULL, 4), ('{"a":null}', 5) AS t(j, ts)"""
    )
    first = track_keys(df.where("ts < 3"), "j", "src", F.col("ts"))
    later = track_keys(df.where("ts > 2"), "j", "src", F.col("ts"))
    assert rows(merge_key_tracking(first, later)) == [("a", 1, 5, "src"), ("b", 2, 2, "src")]
    assert {r.ts for r in error_records(df, "j").collect()} == {3, 4}
    messages = {r.j: r.error_message for r in classify_json_errors(df, "j", ["a"]).collect()}
    assert messages == {"{bad": "Malformed JSON in D column", None: "Malformed JSON in D column", '{"a":null}': "Missing or invalid a"}


def test_inference_takes_objects_only_and_makes_no_schema_per_row(spark, monkeypatch):
    texts = ['\n\t {"c": true}', '{"a": 1}', '{"a": 2, "s": {"q": [1]}}', '[{"z": 1}]', "null", "7", "", "{bad", '"{x"', '\x0b{"v": 1}', "{}", None]
    df = spark.createDataFrame([(x,) for x in texts], "j string")

    def made(*args):
        raise AssertionError("a schema is made of each row")

    monkeypatch.setattr("pyspark.sql.functions.schema_of_variant", made)
    assert infer_schema(df, "j").simpleString() == "struct<a:bigint,c:boolean,s:struct<q:array<bigint>>>"
    assert infer_schema(df.where("j IS NULL"), "j").fieldNames() == []
