"""Type lattices, exact de-duplication, rescue by field, rules in time and the stream log."""

import datetime
import json
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.catalog import base
from siltstone.functions.rescue import shape_pattern
from siltstone.operators.lattice import EvolvingTable, lattice_of, lattice_schema, merge_lattices
from siltstone.operators.quality import TIMED_RULES_SCHEMA, failure_counts, rule_pairs, timed_rules, with_failed_rules
from siltstone.operators.standardize import dedupe_stream_exact
from siltstone.sources.delimited import rescue_fields
from siltstone.streaming.keyed import with_rocksdb
from siltstone.streaming.logged import LOGGED, batch_reports, run_logged


def texts(spark, values):
    return spark.createDataFrame([(json.dumps(v) if not isinstance(v, str) else v,) for v in values], "j STRING")


def schema_of(spark, *batches, **how):
    parts = [lattice_of(texts(spark, b), "j", at, **how) for at, b in enumerate(batches)]
    return lattice_schema(merge_lattices(*parts)), parts


def test_lattice_merges_in_any_order(spark):
    batches = [
        [{"a": 1, "b": {"c": [1, 2], "d": None}}, {"a": 2, "e": [{"x": 1}, {"y": "t"}, None]}, "{broken", [1], 5],
        [{"z": True, "a": 2.5, "b": None, "e": []}],
        [{"a": "text", "b": {"c": [0.5], "f.g": 1}}],
    ]
    schema, parts = schema_of(spark, *[[v for v in b if not isinstance(v, (list, int))] for b in batches])
    assert schema.simpleString() == "struct<a:string,b:struct<c:array<double>,d:string,f.g:bigint>,e:array<struct<x:bigint,y:string>>,z:boolean>"
    assert lattice_schema(merge_lattices(*reversed(parts))) == schema
    counts = {(tuple(r.path), r.kind): (r.n, r.first_seen) for r in merge_lattices(*parts).collect()}
    assert counts[((".a",), "BIGINT")] == (2, 0) and counts[((".z",), "BOOLEAN")] == (1, 1)
    assert lattice_schema(parts[0].limit(0)) == StructType([])


def test_keys_that_are_data_become_a_map(spark):
    wide = spark.range(100_000).select(F.format_string('{"u":{"k%d":{"n":%d}},"v":1}', "id", "id").alias("j"))
    rows_ = lattice_of(wide, "j")
    assert rows_.count() <= 8
    assert lattice_schema(rows_).simpleString() == "struct<u:map<string,struct<n:bigint>>,v:bigint>"
    # A few keys of the same object later: still a map, and earlier keys are taken into it.
    before = lattice_of(texts(spark, [{"u": {"first": {"n": 1}}}]), "j", 0)
    later = lattice_of(texts(spark, [{"u": {"other": {"m": 1}}}]), "j", 2, rows_)
    merged = merge_lattices(before, rows_, later)
    assert lattice_schema(merged).simpleString() == "struct<u:map<string,struct<n:bigint,m:bigint>>,v:bigint>"


def test_rows_of_older_schemas_are_read_by_the_newest(spark, tmp_path):
    table = EvolvingTable(str(tmp_path / "t"), "j", ["id"], most_keys=20)
    batches = [
        [{"n": 1, "o": {"a": 1}, "m": {"p": 1}}, "{no"],
        [{"n": "x", "o": [1], "m": {f"k{i}": i for i in range(60)}}],
        [{"new": [{"q": 1}]}],
    ]
    for at, batch in enumerate(batches):
        df = texts(spark, batch).withColumn("id", F.lit(at))
        table.upsert(df, at)
        table.upsert(df, at)  # a repeated batch changes nothing
    found = sorted((r.asDict(recursive=True) for r in table.read(spark).collect()), key=lambda r: (r["id"], r["n"] is None))
    assert [r["n"] for r in found] == ["1", None, "x", None]
    assert found[0]["o"] == '{"a":1}' and found[2]["o"] == "[1]"
    assert found[0]["m"] == {"p": 1} and found[2]["m"]["k7"] == 7 and found[3]["new"] == [{"q": 1}]


def test_copies_far_apart_leave_one_row(spark, tmp_path):
    data = [(1, "a", None), (1, None, "a"), (2, "b", None), (None, None, None)]
    schema = "k INT, a STRING, b STRING"

    def land(values):
        spark.createDataFrame(values, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = dedupe_stream_exact(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"))
        with_rocksdb(stream, lambda s: s.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c"))
        return rows(spark.read.parquet(f"{tmp_path}/out"))

    first = land(data + data)
    assert first == sorted(data, key=repr)
    assert land([data[0], (3, "c", "d"), data[3]]) == sorted([*data, (3, "c", "d")], key=repr)
    assert land(data) == sorted([*data, (3, "c", "d")], key=repr)


def test_fields_are_rescued_one_by_one(spark):
    lines = [
        'a\t1\t2024-01-02', 'b\tx\t2024-01-02', 'c\t1\tnever\tmore\t', '"d\t""q"" "\t7', "", '""\t\t', '"open\t1\t2024-01-02', 'e\t"5"\t2024-02-30\t""',
    ]
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "id INT, value STRING")
    found = {r.id: tuple(r)[1:] for r in rescue_fields(df, StructType.fromDDL("s STRING, n INT, d DATE")).collect()}
    day = datetime.date(2024, 1, 2)
    expected = {
        0: ("a", 1, day, None), 1: ("b", None, day, {"n": "x"}), 2: ("c", 1, None, {"d": "never", "_c3": "more", "_c4": None}), 3: ('d\t"q" ', 7, None, None),
        4: (None, None, None, None), 5: ("", None, None, None), 6: ('"open\t1\t2024-01-02', None, None, None), 7: ("e", 5, None, {"d": "2024-02-30", "_c3": ""}),
    }
    assert {i: (*r[:3], None if r[3] is None else json.loads(r[3])) for i, r in found.items()} == expected
    long = "x" * 50_000 + '""' * 5_000
    wide = spark.createDataFrame([(0, f'"{long}"\t3')], "id INT, value STRING")
    assert [(len(r.s), r.n) for r in rescue_fields(wide, StructType.fromDDL("s STRING, n INT")).collect()] == [(55_000, 3)]


def test_rules_hold_in_their_time(spark):
    at = [datetime.datetime(2024, 1, d) for d in (1, 10)]
    switch = datetime.datetime(2024, 1, 5)
    rules = timed_rules(
        spark.createDataFrame([("x", "n > 0", None, switch), ("x", "n > 5", switch, None), ("y", "n < 9", switch, None), ("z", "n <> 3", None, None)], TIMED_RULES_SCHEMA)
    )
    data = [(n, t) for n in (0, 3, 7, 12, None) for t in (*at, None)]
    df = spark.createDataFrame(data, "n INT, t TIMESTAMP")

    def failing(n, t):
        out = set()
        if t is not None and not (n is not None and n > (0 if t < switch else 5)):
            out.add("x")
        if t is not None and t >= switch and not (n is not None and n < 9):
            out.add("y")
        if n is None or n == 3:
            out.add("z")
        return out

    marked = with_failed_rules(df, rules, "t")
    names = ["x", "y", "z"]
    for r in marked.collect():
        assert {name for i, name in enumerate(names) if r.failed_rules >> i & 1} == failing(r.n, r.t)
    pairs = {(r.rule, r.other): r.n for r in rule_pairs(failure_counts(marked), rules).collect()}
    expected = {(a, b): sum({a, b} <= failing(*d) for d in data) for a in names for b in names if a <= b}
    assert pairs == {k: n for k, n in expected.items() if n}


def test_the_log_has_failures_and_repeats_once(spark, tmp_path):
    spark.range(6).repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id BIGINT").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    log = f"{tmp_path}/log"
    run_logged(stream.observe("o", F.sum("id").alias("total")), f"{tmp_path}/out", f"{tmp_path}/c", log, "flow")
    reports = batch_reports(spark, log, "o", ("total",)).where("input_rows > 0")
    assert sorted(r.batch_id for r in reports.collect()) == [0, 1, 2]
    assert reports.agg(F.sum("total")).first()[0] == 15 and {r["query"] for r in reports.collect()} == {"flow"}
    spark.read.schema(LOGGED).parquet(log).coalesce(1).write.mode("append").parquet(log + "2")
    spark.read.schema(LOGGED).parquet(log).coalesce(1).write.mode("append").parquet(log + "2")
    assert batch_reports(spark, log + "2").count() == batch_reports(spark, log).count()
    with pytest.raises(Exception):
        run_logged(stream.select(F.raise_error(F.lit("broken")).alias("x")), f"{tmp_path}/out2", f"{tmp_path}/c2", log)
    kinds = [r.event_type for r in spark.read.schema(LOGGED).parquet(log).collect()]
    assert kinds.count("flow_failure") == 1 and kinds.count("flow_ended") == 1


def test_shape_patterns_accept_only_rows_that_lose_nothing(spark):
    schema = StructType.fromDDL("b INT, a STRING, deep STRUCT<x: DOUBLE, l: ARRAY<STRUCT<y: INT>>>, n ARRAY<INT>")
    cases = {
        "{}": True, '{"a":"x","b":1}': True, '{"b":null}': True, '{"deep":{"x":1.5,"l":[{"y":1},{}]}}': True, '{"deep":{"l":[]}}': True, '{"deep":null}': True,
        '{"n":[1,2]}': True, '{"c":1}': False, '{"deep":{"z":1}}': False, '{"deep":{"l":[{"q":1}]}}': False, '{"deep":5}': False, '{"a":{"k":1}}': False, "[1]": False,
        '{"OBJECT":1}': False, '{"a":"x","zz":"OBJECT<>"}': False,
    }
    df = spark.createDataFrame([(k,) for k in cases], "j STRING")
    fits = F.schema_of_variant(F.try_parse_json("j")).rlike(shape_pattern(schema))
    assert {r.j: r.fits for r in df.select("j", fits.alias("fits")).collect()} == cases
    assert shape_pattern(StructType.fromDDL("`odd name` INT")) is None


def test_lattices_of_random_values_lose_nothing(spark, tmp_path):
    rnd = random.Random(9)

    def value(depth):
        kind = rnd.randrange(7 if depth else 5)
        if kind == 5:
            return [value(depth - 1) for _ in range(rnd.randint(0, 3))]
        if kind == 6:
            return {rnd.choice("pqr"): value(depth - 1) for _ in range(rnd.randint(0, 3))}
        return [None, 1, 2.5, "t", True][kind]

    data = [{rnd.choice("abc"): value(2) for _ in range(3)} for _ in range(60)]
    table = EvolvingTable(str(tmp_path / "t"), "j", ["id"])
    for batch in range(3):
        df = spark.createDataFrame([(i, json.dumps(data[i])) for i in range(batch * 20, batch * 20 + 20)], "id INT, j STRING")
        table.upsert(df, batch)
    for r in table.read(spark).collect():
        for name, given in data[r.id].items():
            found = r[name]
            assert (found is None) == (given is None), (r.id, name, given, found)
            if isinstance(given, (int, float)) and isinstance(found, str):
                assert json.loads(found) == given


@pytest.mark.parametrize(
    "query, folder",
    [("json_lattice_stream", "landing"), ("flow_patient_stream", "landing"), ("flow_orders_layout", "bronze"), ("flow_trips_layout", "landing")],
)
def test_landing_files_grow_with_the_table(spark, monkeypatch, tmp_path, query, folder):
    """More rows make more files and not larger ones, and the results are the same."""
    stored = {
        "events": (600, "id AS event_id, timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id) AS ts, id % 50 AS user_id, IF(id % 3 = 0, 'error', 'view') AS event_type, id / 4 AS value"),
        "orders": (600, "id AS o_orderkey, id % 50 AS o_custkey, 'O' AS o_orderstatus, 1.5D AS o_totalprice, timestamp_ntz'1997-01-01 00:00:00' AS o_orderdate, '1-URGENT' AS o_orderpriority"),
        "lineitem": (600, "id AS l_orderkey, 1 AS l_linenumber, 2D AS l_quantity, 3D AS l_extendedprice, 'R' AS l_returnflag"),
        "customer": (50, "id AS c_custkey, format_string('Customer#%09d', id) AS c_name, CAST(id % 5 AS INT) AS c_nationkey, 'A' AS c_mktsegment"),
        "nation": (5, "CAST(id AS INT) AS n_nationkey, concat('NATION_', id) AS n_name"),
    }
    for name, (n, columns) in stored.items():
        spark.range(n).selectExpr(*[c.strip() for c in re.split(r",(?![^(]*\))", columns)]).write.parquet(str(tmp_path / f"{name}.parquet"))
    made, real, found = {}, base.scratch_path, []

    def path(session, name):
        made[name] = real(session, name)
        return made[name]

    monkeypatch.setattr(base, "scratch_path", path)
    for size in (base.FILE_ROWS, 100):
        monkeypatch.setattr(base, "FILE_ROWS", size)
        result = rows(base.ENTRIES[query].build(spark, str(tmp_path)))
        files = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="part-*").load(made[folder])
        found.append((result, files.count()))
    assert found[0][0] == found[1][0] and found[0][1] <= 4 < found[1][1]
