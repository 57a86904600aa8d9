"""Rules, standardization, relational operators, schema log, files and feeds."""

import datetime
import os

import pytest
from conftest import SMALL, rows
from hypothesis import HealthCheck, Phase, given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.operators.changes import change_feed, unkeyed_rows
from siltstone.operators.columns import comparable
from siltstone.operators.evolve import SchemaRegistry, infer_from_new_files, merge_types, parse_evolving
from siltstone.operators.quality import (
    PATIENT_RULES,
    apply_rules,
    combined_predicate,
    expect,
    expect_or_drop,
    load_rules,
    quarantine,
    quarantine_records,
    query_text,
    rules_table,
    split_valid,
    validate,
)
from siltstone.operators.relational import (
    distinct_count,
    enrich,
    explode_rows,
    first_last,
    left_match,
    sum_exploded,
    union_named,
)
from siltstone.operators.schema_log import (
    append_flow_definition,
    describe,
    read_event_log,
    schema_audit,
    schema_diff,
    schema_history,
)
from siltstone.operators.standardize import (
    clean_column_names,
    coalesce_variants,
    dedupe,
    standardize,
    standardize_encoding,
    title_columns,
)
from siltstone.plans.marts import SILVER_ORDER_COLUMNS, TRIP_SCHEMA, sales_by_city, silver_orders, silver_trips, merge_trip_names
from siltstone.plans.patients import practice_history
from siltstone.plans.workload import METHODS, bench_distinct, bench_filter, bench_group, bench_select, parse, run_workload
from siltstone.session import scratch_path, shared_dir
from siltstone.catalog.ingest import FEED_COLUMNS
from siltstone.sources.feeds import feeds_of, ingest_feeds, run_feeds
from siltstone.sources.files import (
    append_by_name,
    read_csv,
    stream_delimited,
    stream_json,
    stream_parquet,
    with_file_metadata,
    with_ingest_audit,
    write_table,
)
from siltstone.sources.generate import make_json_rows
from siltstone.streaming.run import run_stream

def at():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


# Rules

people = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.one_of(st.none(), st.sampled_from(["TX", "x"]))), max_size=12)


@settings(max_examples=8, deadline=None, phases=[Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(people)
def test_valid_and_failed_are_the_input(spark, data):
    df = spark.createDataFrame(data, "id INT, state STRING")
    rules = {"id": "id IS NOT NULL", "state": "state RLIKE '^[A-Z]{2}$'"}
    valid, failed = split_valid(validate(df, rules))
    assert rows(valid.unionByName(failed.drop("failed_constraint"))) == sorted((tuple(d) for d in data), key=repr)
    assert valid.count() == sum(i is not None and s == "TX" for i, s in data) == expect_or_drop(df, rules).count()
    assert quarantine(df, rules).count() == failed.count()


def test_null_is_a_failure_unless_asked(spark):
    df = spark.sql("SELECT CAST(NULL AS STRING) AS s")
    rules = {"s": "s RLIKE 'x'"}
    assert quarantine(df, rules, {"s": "bad s"}).first().quarantine_reason == "bad s"
    assert quarantine(df, rules, null_passes=True).count() == 0
    same, metrics = expect(df, rules)
    assert same is df and rows(metrics) == [("s", 0, 1)]


def test_central_rules(spark):
    rules = rules_table(spark, "f", "t", {"b": "x > 1", "a": "y = 'q'"}).unionByName(rules_table(spark, "f", "t", {"off": "false"}, enabled=False))
    mine = load_rules(rules, "f", "t")
    assert combined_predicate(mine).first().where_clause == "y = 'q' AND x > 1"
    assert query_text(mine, "t").first().sql_text == "SELECT * FROM t WHERE y = 'q' AND x > 1"
    df = spark.sql("SELECT * FROM VALUES (2, 'q'), (1, 'q'), (NULL, 'q') AS t(x, y)")
    assert rows(apply_rules(df, mine)) == [(2, "q")]
    record = quarantine_records(df.where("x = 1"), {"b": "x > 1"}, "f", "t", ["x"], at()).first()
    assert (record.constraint_name, record.constraint_expression, record.record.x) == ("b", "x > 1", 1)
    assert list(PATIENT_RULES)[0] == "id_not_null"


# Standardization


def test_standardize(spark):
    df = spark.sql("SELECT '  café\\t' AS `First Name!`, 1 AS N UNION ALL SELECT '  café\\t', 1 UNION ALL SELECT NULL, 2")
    assert clean_column_names(df).columns == ["first_name_", "n"]
    assert rows(standardize(df)) == [("", 2), ("caf", 1)]
    kept = standardize_encoding(df, strip_latin1=False, null_to_empty=False)
    assert {r[0] for r in kept.collect()} == {"  café", None}
    latin = standardize_encoding(spark.sql("SELECT '日a' AS s"), "US-ASCII")
    assert latin.first().s == "?a"
    assert title_columns(spark.sql("SELECT 'new yORK' AS c"), ["c"]).first().c == "New York"


def test_dedupe_maps_and_variants(spark):
    df = spark.sql(
        """SELECT map('a', 1, 'b', 2) AS m, parse_json('{"x":1,"y":2}') AS v UNION ALL SELECT map('b', 2, 'a', 1), parse_json('{"y":2,"x":1}')
        UNION ALL SELECT NULL, NULL"""
    )
    assert dedupe(df).count() == 2
    assert dedupe(spark.sql("SELECT 1 AS a, 2 AS b UNION ALL SELECT 1, 3"), ["a"]).count() == 1
    assert df.select(comparable(df, "m")).distinct().count() == 2


def test_coalesce_variants(spark):
    df = spark.sql("SELECT CAST(NULL AS INT) AS a1, 2 AS a2")
    assert coalesce_variants(df, {"a": ["a1", "a2", "a3"], "b": ["zzz"]}, missing="null").first() == (2, None)


# Relational


def test_joins_and_pairs(spark):
    left = spark.sql("SELECT * FROM VALUES (1, 'a'), (NULL, 'b'), (3, 'c') AS t(k, v)")
    right = spark.sql("SELECT * FROM VALUES (1, 'x'), (NULL, 'y') AS t(k, w)")
    assert rows(enrich(left, right, ["k"])) == sorted([(1, "a", "x"), (None, "b", None), (3, "c", None)], key=repr)
    assert {(r.k, r.matched) for r in left_match(left, right, ["k"]).collect()} == {(1, True), (None, False), (3, False)}
    assert rows(first_last(left.withColumn("g", F.lit(0)), ["g"], ["v"], ["k"])) == [(0, 1, 3)]
    assert distinct_count(spark.sql("SELECT explode(array(1, 1, NULL)) AS x"), ["x"]).first()[0] == 2
    assert union_named([left, left.select("v", "k")]).count() == 6
    lists = spark.sql("SELECT 1 AS k, array() AS l UNION ALL SELECT 2, array('p', 'q')")
    assert explode_rows(lists, "l").count() == 2 and explode_rows(lists, "l", outer=True).count() == 3


def test_retail_marts(spark):
    orders = spark.sql(
        """SELECT * FROM VALUES ('1', 'ann lee', '86400', 10, array(named_struct('curr', 'USD', 'price', 5, 'qty', 2), named_struct('curr', 'USD', 'price', 1, 'qty', 1))),
        ('1', 'ann lee', 'soon', 11, array()), ('9', 'no one', '0', NULL, NULL) AS t(customer_id, customer_name, order_datetime, order_number, ordered_products)"""
    )
    customers = spark.sql("SELECT '1' AS customer_id, 'ann lee' AS customer_name, 'Chicago' AS city, 'OR' AS state")
    with pytest.raises(Exception, match="number_of_line_items"):
        silver_orders(orders, customers)
    silver = silver_orders(orders, customers, columns=[c for c in SILVER_ORDER_COLUMNS if c in {*orders.columns, *customers.columns, "order_date"}])
    assert silver.count() == 2 and silver.where("order_number = 11").first().order_date is None
    mart = sales_by_city(silver, "Chicago")
    assert rows(mart) == [(datetime.date(1970, 1, 2), "Chicago", "1", "Ann Lee", "USD", 6, 3)]
    plan = sales_by_city(silver, "Chicago")._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan, "elements are summed before the shuffle"


def test_trips_keep_comments(spark):
    raw = spark.sql("SELECT 5 AS tripduration, '1/2/2016 03:04:05' AS starttime, 'bad' AS stoptime, 'SUBSCRIBER' AS usertype")
    trips = silver_trips(merge_trip_names(raw, missing="null"))
    assert trips.schema["trip_duration"].metadata == {"comment": "how long the bike was out, as delivered"}
    row = trips.first()
    assert (row.trip_duration, row.start_time.day, row.stop_time, row.user_type) == (5, 2, None, "Subscriber")
    assert [f.dataType for f in trips.schema] == [f.dataType for f in TRIP_SCHEMA]
    assert describe(trips).where("col_name = 'bike_id'").first().comment == "number of the bike"


def test_practice_history(spark):
    feed = spark.sql(
        """SELECT * FROM VALUES ('{"patientId":"p","practiceId":"q","created":5,"anonymous":true}', 'insert', 1L, TIMESTAMP '2024-01-01'),
        ('{"patientId":"p","practiceId":"q","city":"X"}', 'update_postimage', 2L, TIMESTAMP '2024-01-02'), ('{bad', 'insert', 3L, TIMESTAMP '2024-01-03')
        AS t(D, _change_type, _commit_version, _commit_timestamp)"""
    ).withColumns({c: F.lit(None).cast("string") for c in ("PatientID", "Created", "Updated")})
    got = practice_history(feed, at()).orderBy("EffectiveFrom").collect()
    assert [(r.patientId_from_json, r.city, r.IsCurrent) for r in got] == [("p", None, False), ("p", "X", True)]


# Schema log


def test_schema_log(spark, tmp_path):
    log = str(tmp_path / "log")
    frames = ["SELECT 1 AS id, 'a' AS gone, 1 AS n", "SELECT 1 AS id, 1 AS n", "SELECT 1 AS id, 1.5D AS n, true AS fresh"]
    for day, text in enumerate(frames, 1):
        append_flow_definition(spark.sql(text), "t", log, F.lit(f"2024-01-0{day}").cast("timestamp"))
    append_flow_definition(spark.sql("SELECT 1 AS x"), "other", log, at())
    entries = spark.read.parquet(log)
    history = schema_history(entries, "t").collect()
    assert [(r.before_ts.day, r.after_ts.day) for r in history] == [(2, 3), (1, 2)]
    status = {r.column_name: r.status for r in schema_diff(entries, "t").collect()}
    assert status == {"id": "MATCHED", "gone": "REMOVED", "n": "CHANGED", "fresh": "NEW"}
    assert read_event_log(entries, "flow_definition", d="flow_definition.output_dataset").where("d = 'other'").count() == 1
    assert rows(schema_audit(spark.sql("SELECT 1 AS a, map('k', 1) AS m"), at()).drop("audit_ts")) == [("a", "int"), ("m", "map<string,int>")]


# Files and feeds


def test_quoted_tsv_payload(spark, tmp_path):
    """Escaped quotes are undone on reading, so the payload column needs no repair; `""` in a plain field does."""
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.tsv").write_text('ID\tD\n7\t"{""k"":1,""s"":""a b""}"\n8\t\n')
    stream = stream_delimited(spark, str(folder), "ID STRING, D STRING").select("*", "_metadata")
    named = with_file_metadata(stream.withColumnRenamed("_metadata", "file_info"), "source")
    run_stream(with_ingest_audit(named), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {r.ID: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got["7"].D == '{"k":1,"s":"a b"}' and got["8"].D is None
    assert got["7"].source_file.endswith("a.tsv") and got["7"].ingestTime == got["7"].data_ingestion_ts
    assert rows(read_csv(spark, str(folder), sep="\t").select("ID")) == [("7",), ("8",)]


def test_delimited_rescue(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.tsv").write_text("a\tb\n1\tx\n2\ty\textra\n3\n")
    stream = stream_delimited(spark, str(folder), "a STRING, b STRING", rescue=True)
    log = str(tmp_path / "log")
    run_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"), log, "bronze")
    assert read_event_log(spark.read.parquet(log), "flow_definition", d="flow_definition.output_dataset").first().d == "bronze"
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == sorted(
        [("1", "x", None), ("2", "y", "2\ty\textra"), ("3", None, "3")], key=repr
    )


def test_inference_reads_new_files_only(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    schemas = str(tmp_path / "schemas")
    for day, text in enumerate(['{"a":1}', '{"b":true}'], 1):
        path = folder / f"{day}.json"
        path.write_text(text)
        os.utime(path, (86400 * day, 86400 * day))
        stream = stream_json(spark, str(folder), schema_location=schemas, rescue=False)
    assert stream.columns == ["a", "b", "file_info"]
    os.remove(folder / "2.json")
    (folder / "1.json").write_text("{broken")
    os.utime(folder / "1.json", (86400, 86400))
    again = stream_json(spark, str(folder), schema_location=schemas, rescue=False)
    assert again.columns == stream.columns, "the old file is not looked at again"


def test_stream_parquet_picks_up_new_columns(spark, tmp_path):
    path, schemas, out, cp = (str(tmp_path / n) for n in ("in", "schemas", "out", "cp"))
    spark.sql("SELECT 1 AS a").write.parquet(path)
    run_stream(stream_parquet(spark, path, schemas), out, cp)
    spark.sql("SELECT 2 AS a, 'n' AS b").write.mode("append").parquet(path)
    run_stream(stream_parquet(spark, path, schemas, merge=True), out + "2", cp + "2")
    assert rows(spark.read.parquet(out + "2")) == sorted([(1, None), (2, "n")], key=repr)


def test_feeds(spark, tmp_path):
    root = tmp_path / "feeds"
    for name in ("GdprBacklog", "PatientPractice"):
        (root / name / "2024" / "1" / "2" / "10-00").mkdir(parents=True)
        columns = FEED_COLUMNS[name].split()
        values = ['{"k":1}' if c == "D" else c.lower() for c in columns]
        (root / name / "2024" / "1" / "2" / "10-00" / "x.tsv").write_text("\t".join(columns) + "\n" + "\t".join(values) + "\n")
    feeds = feeds_of(FEED_COLUMNS, str(root), ["GdprBacklog", "PatientPractice"])
    feeds = [type(f)(f.name, f.schema, f.path + "/*/*/*/*") for f in feeds]
    sinks = run_feeds(ingest_feeds(spark, feeds, str(tmp_path / "schemas"), at()), str(tmp_path / "run"))
    plain, payload = spark.read.parquet(sinks["bronze_gdprbacklog"]), spark.read.parquet(sinks["bronze_patientpractice"])
    assert "D_parsed" not in plain.columns and payload.first().D_parsed.k == 1
    assert plain.first().bronze_prefix == "2024/1/2/10-00" and plain.first().ingestDate == datetime.date(2024, 1, 1)
    assert len(FEED_COLUMNS) == 10


def test_layout_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").select("l_returnflag", "l_shipdate", "l_quantity")
    write_table(lines, path, partition_by=["l_returnflag"], cluster_by=["l_shipdate"], clusters=4)
    df = spark.read.parquet(path).where("l_returnflag = 'R' AND l_shipdate > '1998-01-01'").select("l_quantity")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(l_returnflag" in plan and "GreaterThan(l_shipdate" in plan
    assert "ReadSchema: struct<l_shipdate:timestamp_ntz,l_quantity:double>" in plan
    write_table(lines.withColumn("same", F.lit(1)), str(tmp_path / "hot"), cluster_by=["same"], clusters=4)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "hot")).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < lines.count() / 2, "one value does not end in one file"
    write_table(lines, str(tmp_path / "p"), partition_by=["l_returnflag"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == lines.count()
    append_by_name(spark.sql("SELECT 'x' AS b, '7' AS a"), str(tmp_path / "d"), StructType.fromDDL("a INT, b STRING"))
    assert rows(spark.read.parquet(str(tmp_path / "d"))) == [(7, "x")]


def test_values_that_do_not_fit(spark, tmp_path):
    schema = StructType.fromDDL("a INT, b STRING")
    odd = spark.sql("SELECT 'x1' AS a, 'y' AS b UNION ALL SELECT '8', NULL")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        append_by_name(odd, str(tmp_path / "strict"), schema)
    append_by_name(odd, str(tmp_path / "kept"), schema, rescued="lost")
    assert rows(spark.read.parquet(str(tmp_path / "kept"))) == rows(spark.sql("SELECT 8 AS a, CAST(NULL AS STRING) AS b, CAST(NULL AS STRING) AS lost UNION ALL SELECT NULL, 'y', '{\"a\":\"x1\"}'"))


def test_files_of_one_second_and_late_files_are_seen(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    registry = SchemaRegistry(spark, str(tmp_path / "schemas"))
    for name, text, second in (("b", '{"a": 1}', 1_700_000_000), ("c", '{"b": "x"}', 1_700_000_000), ("a", '{"c": 2.5}', 1_600_000_000)):
        (folder / name).write_text(text + "\n")
        os.utime(folder / name, (second, second))
        schema = infer_from_new_files(spark.read, str(folder), "text", "value", registry, "k")
    assert schema.simpleString() == "struct<a:bigint,b:string,c:double>"
    assert infer_from_new_files(spark.read, str(folder), "text", "value", registry, "k") == schema
    assert registry.unseen_files(str(folder), "k").count() == 0


def test_type_merge_keeps_values(spark):
    def merged(a, b):
        return merge_types(StructType.fromDDL(f"x {a}")["x"].dataType, StructType.fromDDL(f"x {b}")["x"].dataType).simpleString()

    assert merged("DECIMAL(10,2)", "DECIMAL(12,2)") == "decimal(12,2)" and merged("DECIMAL(10,2)", "BIGINT") == "decimal(21,2)"
    assert merged("DATE", "TIMESTAMP") == "timestamp" and merged("FLOAT", "DOUBLE") == "double" and merged("SMALLINT", "INT") == "int"
    assert merged("BIGINT", "DOUBLE") == "double" and merged("DECIMAL(38,0)", "DECIMAL(38,38)") == "string" and merged("INT", "BOOLEAN") == "string"
    df = spark.sql("""SELECT '{"n": 12345678901234567890123}' AS j""")
    assert str(parse_evolving(df, "j", "o").first().o.n) == "12345678901234567890123"


def test_null_keys_stay_out_of_the_feed(spark):
    df = spark.sql("SELECT CAST(NULL AS INT) AS k, 1 AS v UNION ALL SELECT NULL, 1 UNION ALL SELECT 3, 1")
    assert change_feed(df, df, ["k"], 1, F.current_timestamp()).collect() == []
    assert unkeyed_rows(df, ["k"]).count() == 2


def test_names_that_clean_to_the_same_and_missing_variants_raise(spark):
    with pytest.raises(ValueError, match="a_b"):
        clean_column_names(spark.sql("SELECT 1 AS `a b`, 2 AS a_b"))
    df = spark.sql("SELECT 1 AS a")
    with pytest.raises(ValueError, match="x"):
        coalesce_variants(df, {"x": ["b", "c"]})
    assert coalesce_variants(df, {"x": ["b"]}, missing="null").first().x is None


class Stub:
    """Just enough of a session to ask for the shared folder."""

    def __init__(self, master, configured=None, set_before=None):
        self.master, self.configured, self.folder = master, configured, set_before
        self.conf = self.sparkContext = self

    def get(self, key, default):
        return self.configured or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_where_shared_files_go():
    stub = Stub("spark://host:7077", configured="hdfs://shared/x/")
    assert shared_dir(stub) == "hdfs://shared/x" and stub.folder == "hdfs://shared/x/"
    assert shared_dir(Stub("yarn", set_before="hdfs://set/y")) == "hdfs://set/y"
    assert "siltstone" in shared_dir(Stub("local[2]"))
    with pytest.raises(ValueError):
        shared_dir(Stub("yarn"))


# Workload


def test_methods_agree(spark, tmp_path):
    data = make_json_rows(spark, 500)
    for build in (bench_select, bench_distinct, bench_group):
        struct, variant = (rows(build(data, m)) for m in METHODS)
        assert struct == variant and struct
    assert bench_filter(data, "variant").count() == 50
    row = parse(data, "from_json").where("id = 14").first().parsed
    assert (row.user, row.tags, row.metadata.ip) == ("user_14", ["tag_0", "tag_1", "tag_2", "tag_3"], "192.168.1.14")
    assert 0 <= row.score <= 100
    assert run_workload(data, str(tmp_path)).count() == 16
    with pytest.raises(ValueError):
        parse(data, "xml")
