"""Keyed state, signed deltas, curve layouts, shredding and digest trees."""

import datetime
import glob
import random
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from siltstone.operators.changes import change_feed
from siltstone.operators.evolve import SchemaRegistry, infer_from_new_files
from siltstone.operators.digests import change_feed_by_digest, changed_buckets, digest_tree
from siltstone.operators.scd import apply_scd1, apply_scd2
from siltstone.operators.shred import reassemble, shred
from siltstone.plans.curve import rank_borders, stored_borders, with_place, write_clustered
from siltstone.plans.patients import patient_history, patient_latest, patient_quarantine
from siltstone.plans.workload import bench_read_back, bench_write
from siltstone.streaming import keyed
from siltstone.streaming.aggregates import SumTarget
from siltstone.streaming.deltas import DeltaMart
from siltstone.streaming.keyed import KeyedScd
from siltstone.streaming.patients import PatientStream

SCHEMA = "k INT, v STRING, _change_type STRING, _commit_version BIGINT, _commit_timestamp TIMESTAMP"
DELETED = "_change_type = 'delete'"
SEQUENCE = ["_commit_version", "_commit_timestamp"]
START = datetime.datetime(2024, 1, 1)


def changes(seed, count, keys=3, versions=40):
    rnd = random.Random(seed)
    kinds = ["insert", "update_preimage", "update_postimage", "delete"]
    out = []
    for _ in range(count):
        version = rnd.randrange(versions)
        key = rnd.choice([None, *range(keys)])
        out.append((key, rnd.choice("abc"), rnd.choice(kinds), version, START + datetime.timedelta(hours=version)))
    return out


def stream(spark, folder, batches):
    for number, batch in enumerate(batches):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{number}")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)


@pytest.mark.parametrize("track", [None, ["v"]])
def test_state_gives_the_rows_of_the_batch_operators(spark, tmp_path, track):
    everything = changes(3, 120)
    batches = [everything[:50], everything[50:90], everything[30:60], everything[90:]]
    whole = spark.createDataFrame(everything, SCHEMA)
    first = KeyedScd(str(tmp_path / "one"), ["k"], SEQUENCE, 1, DELETED)
    first.run(stream(spark, str(tmp_path / "in1"), batches), str(tmp_path / "c1"))
    assert rows(first.read(spark)) == rows(apply_scd1(whole, "k", SEQUENCE, DELETED, first.except_cols))
    second = KeyedScd(str(tmp_path / "two"), ["k"], SEQUENCE, 2, DELETED, track=track)
    second.run(stream(spark, str(tmp_path / "in2"), batches), str(tmp_path / "c2"))
    expected = apply_scd2(whole, "k", SEQUENCE, DELETED, second.except_cols, track=track)
    found = second.read(spark)
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows(found.select(expected.columns)) == rows(expected)


def test_pages_split_and_keep_order():
    class Value:
        held = None

        def get(self):
            return self.held

        def update(self, value):
            self.held = value

    class Map(dict):
        def getValue(self, key):
            return self[key]

        def updateValue(self, key, value):
            self[key] = value

    index, pages = Value(), Map()
    rnd = random.Random(1)
    numbers = rnd.sample(range(5000), 2000)
    for low in range(0, 2000, 100):
        points = keyed._Points(index, pages, 1)
        assert all(points.put((n, True, 0, 0, n)) for n in numbers[low : low + 100])
        assert not points.put((numbers[low], True, 0, 0, -1)) and not points.put((numbers[low], False, 9, 0, -1))
        points.store()
    points = keyed._Points(index, pages, 1)
    before, after = points.around((2500,))
    assert [p[0] for p in after] == sorted(n for n in numbers if n >= 2500)
    assert [p[0] for p in before] == sorted((n for n in numbers if n < 2500), reverse=True)
    assert len(points.ids) > 5 and max(len(p[0]) for p in pages.values()) <= keyed.PAGE


def test_a_batch_writes_only_the_keys_it_touches(spark, tmp_path):
    first = [(k, "a", "insert", 1, START) for k in range(200)]
    second = [(k, "b", "update_postimage", 2, START + datetime.timedelta(hours=2)) for k in range(10)]
    target = KeyedScd(str(tmp_path / "t"), ["k"], SEQUENCE, 2, DELETED)
    target.run(stream(spark, str(tmp_path / "in"), [first, second]), str(tmp_path / "c"))
    written = spark.read.parquet(f"{tmp_path}/t/{keyed.BATCH}=1")
    assert {r.k for r in written.select("k").distinct().collect()} == set(range(10))
    assert target.read(spark).where("IsCurrent").count() == 200


def test_mart_follows_moves_and_deletes_and_folds(spark, tmp_path):
    schema = "city STRING, amount DECIMAL(10,2), _change_type STRING"
    first = [("a", 5, "insert"), ("a", 7, "insert"), ("b", None, "insert"), ("a", 7, "update_preimage"), ("b", 7, "update_postimage")]
    second = [("a", 5, "delete"), ("b", 7, "update_preimage"), ("c", 9, "update_postimage"), ("d", 1, "unknown")]
    mart = DeltaMart(str(tmp_path / "m"), ["city"], ["amount"])

    def feed(rows_):
        spark.createDataFrame([(c, None if x is None else Decimal(x), k) for c, x, k in rows_], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        mart.run(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/c")
        return {r.city: (None if r.amount is None else int(r.amount), r.n_rows) for r in mart.read(spark).collect()}

    assert feed(first) == {"a": (5, 1), "b": (7, 2)}
    mart.fold(spark)
    expected = {"b": (None, 1), "c": (9, 1)}
    assert feed(second) == expected
    mart.fold(spark)
    assert {r.city for r in mart.read(spark).collect()} == set(expected)
    with pytest.raises(ValueError):
        DeltaMart(str(tmp_path / "x"), ["k"], ["f"]).run(spark.readStream.schema("k INT, f DOUBLE, _change_type STRING").parquet(f"{tmp_path}/in"), f"{tmp_path}/c2")


def hilbert(x, y, order):
    """Plain walk down the quadrants."""
    place = 0
    size = 1 << (order - 1)
    while size:
        rx, ry = int(bool(x & size)), int(bool(y & size))
        place += size * size * ((3 * rx) ^ ry)
        x, y = x & (size - 1), y & (size - 1)
        if not ry:
            if rx:
                x, y = size - 1 - x, size - 1 - y
            x, y = y, x
        size >>= 1
    return place


def test_curve_visits_every_cell_once_and_steps_to_neighbours(spark):
    for axes, bits in ((2, 3), (3, 2)):
        side = 1 << bits
        cells = spark.range(side**axes)
        for i in range(axes):
            cells = cells.withColumn(f"a{i}", (F.floor(F.col("id") / side**i) % side).cast("int"))
        borders = {f"a{i}": [float(v) for v in range(1, side)] for i in range(axes)}
        walked = with_place(cells, borders, bits, "place").orderBy("place").collect()
        assert [r.place for r in walked] == list(range(side**axes))
        for a, b in zip(walked, walked[1:]):
            assert sum(abs(a[f"a{i}"] - b[f"a{i}"]) for i in range(axes)) == 1
    assert sorted(hilbert(x, y, 3) for x in range(8) for y in range(8)) == list(range(64))


def test_either_filter_skips_most_files(spark, tmp_path):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    path = str(tmp_path / "curve")
    write_clustered(lines.where("l_orderkey % 2 = 0"), path, ["l_partkey", "l_shipdate"], 64)
    write_clustered(lines.where("l_orderkey % 2 = 1"), path, ["l_partkey", "l_shipdate"], 64, "append")
    assert rows(spark.read.parquet(path).select("l_orderkey", "l_linenumber")) == rows(lines.select("l_orderkey", "l_linenumber"))
    files = glob.glob(f"{path}/*.parquet")
    for column, share in (("l_partkey", 0.05), ("l_shipdate", 0.05)):
        low, high = sorted(r[0] for r in lines.select(column).collect())[:: int(lines.count() * share) - 1][3:5]
        touched = 0
        for f in files:
            meta = pq.ParquetFile(f)
            at = meta.schema_arrow.names.index(column)
            groups = [meta.metadata.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
            touched += any(not (s.max < low or s.min > high) for s in groups)
        assert touched / len(files) < 0.35, (column, touched, len(files))


def test_curve_takes_nulls_text_and_constant_columns(spark, tmp_path):
    df = spark.range(500).selectExpr("id", "IF(id % 7 = 0, NULL, concat('n', id % 90)) AS name", "1 AS same", "CAST(NULL AS DOUBLE) AS nothing")
    path = str(tmp_path / "t")
    write_clustered(df, path, ["name", "same", "nothing"], 4)
    assert rows(spark.read.parquet(path)) == rows(df)
    write_clustered(df.limit(0), str(tmp_path / "empty"), ["name"], 2)
    assert rank_borders(df.limit(0), ["id"]) == {"id": []}
    with pytest.raises(ValueError):
        write_clustered(df, path, ["id"], 4, "append")


NESTED = """id INT, name STRING, deep STRUCT<x: INT, lines: ARRAY<STRUCT<a: STRING, tags: ARRAY<STRING>, parts: ARRAY<STRUCT<n: INT, m: MAP<STRING,INT>>>>>>,
    notes ARRAY<STRUCT<t: STRING>>, plain ARRAY<INT>"""


def nested_value(rnd, kind):
    if rnd.random() < 0.2:
        return None
    if kind == "parts":
        return [None if rnd.random() < 0.2 else (rnd.choice([None, 1, 2]), rnd.choice([None, {}, {"k": 1}])) for _ in range(rnd.randint(0, 3))]
    if kind == "lines":
        return [None if rnd.random() < 0.2 else (rnd.choice([None, "x"]), rnd.choice([None, [], ["t", None]]), nested_value(rnd, "parts")) for _ in range(rnd.randint(0, 3))]
    if kind == "deep":
        return (rnd.choice([None, 5]), nested_value(rnd, "lines"))
    return [None if rnd.random() < 0.2 else (rnd.choice([None, "n"]),) for _ in range(rnd.randint(0, 3))]


def test_shreds_come_back_exactly(spark):
    rnd = random.Random(4)
    data = [(i, rnd.choice([None, "a"]), nested_value(rnd, "deep"), nested_value(rnd, "notes"), rnd.choice([None, [], [1, None]])) for i in range(150)]
    df = spark.createDataFrame(data, NESTED)
    tables = shred(df, ["id"])
    assert sorted(tables) == ["", "deep.lines", "deep.lines.parts", "notes"]
    back = reassemble(tables, df.schema, ["id"])
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    # Sibling arrays do not multiply.
    assert tables["notes"].count() == sum(len(r[3] or []) for r in data)
    assert reassemble(shred(df.limit(0), ["id"]), df.schema, ["id"]).collect() == []


def test_digest_feed_joins_changed_buckets_only(spark, tmp_path):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet").select("o_orderkey", "o_totalprice", "o_orderstatus")
    touched = F.col("o_orderkey") == 7
    after = orders.where("o_orderkey <> 5").withColumn("o_orderstatus", F.when(touched, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus")))
    after = after.unionByName(spark.createDataFrame([(10**9, 1.0, "N")], orders.schema))
    trees = [digest_tree(df, ["o_orderkey"]) for df in (orders, after)]
    present = {r.o_orderkey for r in orders.collect()}
    assert changed_buckets(*trees).count() == len({5, 7} & present) + 1
    at = F.lit(START)
    expected = rows(change_feed(orders, after, ["o_orderkey"], 3, at))
    feed = change_feed_by_digest(orders, after, ["o_orderkey"], 3, at, (trees[0], None))
    assert rows(feed) == expected and expected
    plan = feed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("FullOuter") < plan.index("LeftSemi")
    assert rows(change_feed_by_digest(orders, orders, ["o_orderkey"], 3, at)) == []
    assert len(rows(change_feed_by_digest(orders.limit(0), orders, ["o_orderkey"], 3, at))) == orders.count()


def test_a_delete_that_fails_a_rule_closes_its_version(spark, tmp_path):
    good = '{"id":"7","name":"n","state":"TX","zipCode":"12345","private":true,"created":1000000}'
    rows_ = [("7", "b", good, "insert", 1), ("7", "b", "{}", "delete", 2), (None, "b", "{}", "delete", 3), ("8", "b", "{}", "insert", 1)]
    feed = spark.createDataFrame([(*r, START + datetime.timedelta(hours=r[4])) for r in rows_], "ID STRING, BusinessID STRING, D STRING, _change_type STRING, _commit_version BIGINT, _commit_timestamp TIMESTAMP")
    feed = feed.selectExpr("*", "'s' AS Shard", "'1' AS Created", "'2' AS Updated")
    at = F.lit(START)
    history = patient_history(feed, at).collect()
    assert [(r.ID, r.IsCurrent) for r in history] == [("7", False)]
    assert patient_latest(feed, at).collect() == []
    assert patient_quarantine(feed, at).count() == 3
    flow = PatientStream(str(tmp_path / "p"), buckets=2)
    flow.upsert(feed, 0)
    assert [(r.ID, r.IsCurrent) for r in flow.patients(spark).collect()] == [("7", False)] and flow.failed(spark).count() == 3


def test_a_repeated_batch_replaces_its_folder_of_the_curve(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "id % 7 AS k")
    path = str(tmp_path / "t")
    for batch in (0, 1, 1):
        write_clustered(df, path, ["id", "k"], 3, "append", folder=f"batch={batch}")
    assert spark.read.option("basePath", path).parquet(f"{path}/batch=*").count() == 200
    assert stored_borders(spark, path) is not None


def test_a_stored_variant_is_read_by_path(spark, tmp_path):
    rows_ = spark.createDataFrame([('{"user":"u","metadata":{"device":"d","ip":"i"},"id":1}',)], "value STRING")
    bench_write(rows_.withColumnRenamed("value", "json_str"), "variant", str(tmp_path / "v"))
    back = bench_read_back(spark, "variant", str(tmp_path / "v"))
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<parsed:struct<0:string>>" in plan and [r.user for r in back.collect()] == ["u"]


def test_sums_are_the_same_after_folding(spark, tmp_path):
    target = SumTarget(str(tmp_path / "sums"), ["k"], ["n"])

    def total():
        return {r.k: r.n for r in target.read(spark).collect()}

    for batch in range(3):
        target.upsert(spark.createDataFrame([("a", 1), ("b", batch)], "k STRING, n BIGINT"), batch)
    assert total() == {"a": 3, "b": 3}
    target.fold(spark)
    assert total() == {"a": 3, "b": 3}
    for _ in range(2):
        target.upsert(spark.createDataFrame([("a", 5), ("c", 1)], "k STRING, n BIGINT"), 3)
    assert total() == {"a": 8, "b": 3, "c": 1}
    target.fold(spark)
    assert total() == {"a": 8, "b": 3, "c": 1}


def test_new_files_are_looked_at_in_groups(spark, tmp_path):
    registry = SchemaRegistry(spark, str(tmp_path / "schemas"))
    for at in range(5):
        spark.createDataFrame([(f'{{"k{at}":1}}',)], "value STRING").coalesce(1).write.mode("append").text(str(tmp_path / "in"))
    path = str(tmp_path / "in")
    groups = [g.count() for g in registry.unseen_groups(path, "x", "*.txt", 2)]
    assert groups == [2, 2, 1]
    first = next(registry.unseen_groups(path, "x", "*.txt", 2))
    registry.mark_seen(first, "x")
    assert sum(g.count() for g in registry.unseen_groups(path, "x", "*.txt", 2)) == 3
    schema = infer_from_new_files(spark.read, path, "text", "value", SchemaRegistry(spark, str(tmp_path / "other")), "x")
    assert sorted(schema.fieldNames()) == [f"k{at}" for at in range(5)]


def test_a_position_goes_out_once_in_a_batch(spark, tmp_path):
    """Its row and its bounds in one row, also where a better row for it comes in the same batch."""
    batch = [("k", v, "update_postimage", n, START + datetime.timedelta(hours=n)) for n in range(5) for v in ("a", "b")]
    schema = "k STRING, v STRING, _change_type STRING, _commit_version BIGINT, _commit_timestamp TIMESTAMP"
    spark.createDataFrame(batch, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    target = KeyedScd(str(tmp_path / "t"), ["k"], ["_commit_version"], 2)
    target.run(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5 and target.read(spark).count() == 5
