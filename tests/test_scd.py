"""Change data: order of arrival, repeats, ties, deletes, NULL keys, and keys that hold most rows."""

import datetime
import random

import pytest
from conftest import SMALL, rows
from hypothesis import HealthCheck, Phase, given, settings, strategies as st
from pyspark.sql import functions as F

from siltstone.operators.changes import change_feed, commit_summary, drop_reserved
from siltstone.operators.scd import apply_scd1, apply_scd2, unusable_changes, validity_columns
from siltstone.plans.ordered import Timeline
from siltstone.operators.relational import consecutive_pairs, rank_rows
from siltstone.streaming.run import run_batches
from siltstone.streaming.targets import ScdTarget

SCHEMA = "k INT, v STRING, _change_type STRING, _commit_version BIGINT, _commit_timestamp TIMESTAMP"
DELETED = "_change_type = 'delete'"
SEQUENCE = ["_commit_version", "_commit_timestamp"]
START = datetime.datetime(2024, 1, 1)
SLOW = dict(deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])


def change(k, v, kind, version):
    return (k, v, kind, version, START + datetime.timedelta(hours=version))


def frame(spark, changes):
    return spark.createDataFrame(changes, SCHEMA)


def model_scd1(changes):
    latest = {}
    for c in sorted(changes, key=lambda c: (c[3], c[2] != "delete")):
        if c[0] is not None and c[2] != "update_preimage":
            latest[c[0]] = c
    return sorted((c[0], c[1]) for c in latest.values() if c[2] != "delete")


def model_scd2(changes):
    by_key = {}
    for c in changes:
        if c[0] is not None and c[2] != "update_preimage":
            by_key.setdefault(c[0], {})[c[3]] = c
    out = []
    for versions in by_key.values():
        ordered = [versions[v] for v in sorted(versions)]
        for c, after in zip(ordered, ordered[1:] + [None]):
            if c[2] != "delete":
                out.append((c[0], c[1], c[4], after[4] if after else datetime.datetime(9999, 12, 31), after is None))
    return sorted(out)


unique_changes = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(1, 3)), st.sampled_from("abc"),
        st.sampled_from(["insert", "update_preimage", "update_postimage", "delete"]), st.integers(1, 20),
    ),
    min_size=1, max_size=20, unique_by=lambda c: (c[0], c[3]),
).map(lambda cs: [change(*c) for c in cs])


@settings(max_examples=8, **SLOW)
@given(unique_changes, st.randoms())
def test_scd_matches_model_in_any_order(spark, changes, rnd):
    shuffled = changes + changes[: len(changes) // 2]  # half of them delivered twice
    rnd.shuffle(shuffled)
    df = frame(spark, shuffled)
    except_cols = ["_change_type", *SEQUENCE]
    assert rows(apply_scd1(df, "k", SEQUENCE, DELETED, except_cols)) == sorted(model_scd1(changes), key=repr)
    expected = sorted(model_scd2(changes), key=repr)
    assert rows(apply_scd2(df, "k", SEQUENCE, DELETED, except_cols)) == expected
    assert rows(apply_scd2(df, "k", SEQUENCE, DELETED, except_cols, hot_rows=2)) == expected


def test_ties_do_not_depend_on_arrival(spark):
    tied = [change(1, "a", "insert", 5), change(1, "b", "insert", 5), change(1, "c", "delete", 5), change(2, "x", "insert", 1)]
    results = set()
    for seed in range(4):
        random.Random(seed).shuffle(tied)
        one = rows(apply_scd1(frame(spark, tied), "k", SEQUENCE, DELETED).select("k", "v"))
        two = rows(apply_scd2(frame(spark, tied), "k", SEQUENCE, DELETED).select("k", "v", "IsCurrent"))
        assert [r[:2] for r in two] == one
        results.add(repr(one))
    assert len(results) == 1
    assert "'c'" not in results.pop(), "a live row wins over a delete of the same sequence"


def test_map_columns_take_part(spark):
    df = spark.sql("SELECT 1 AS k, map('a', '1', 'b', '2') AS m, 1 AS s UNION ALL SELECT 1, map('b', '2', 'a', '1'), 2 UNION ALL SELECT 1, map('a', '9'), 3")
    spans = apply_scd2(df, "k", "s", track=["m"])
    assert sorted(r["m"]["a"] for r in spans.collect()) == ["1", "9"], "equal maps in another key order are no change"


def test_one_row_per_key_leaves_each_task(spark):
    """Type 1 keeps the newest row per key before the shuffle, deletes included."""
    df = frame(spark, [change(1, "a", "insert", 1)])
    plan = apply_scd1(df, "k", SEQUENCE, DELETED)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1


def test_unusable_changes(spark):
    df = frame(spark, [change(None, "a", "insert", 1), change(1, "b", "insert", 2)])
    assert [r.v for r in unusable_changes(df, "k", SEQUENCE).collect()] == ["a"]


def test_validity_columns_and_reserved(spark):
    df = frame(spark, [change(1, "a", "insert", 1)])
    row = validity_columns(df, "_commit_timestamp").first()
    assert row.EffectiveTo == datetime.datetime(9999, 12, 31) and row.IsCurrent
    assert drop_reserved(df).columns == ["k", "v"]


def test_change_feed_round_trip(spark):
    """Applying the feed between two snapshots to the first one gives the second."""
    before = spark.createDataFrame([(1, "a", {"x": 1}), (2, "b", {"x": 2}), (3, None, None)], "k INT, v STRING, m MAP<STRING,INT>")
    after = spark.createDataFrame([(1, "a", {"x": 5}), (3, "c", None), (4, "d", {})], "k INT, v STRING, m MAP<STRING,INT>")
    at = F.lit("2024-01-01").cast("timestamp")
    feed = change_feed(before, after, ["k"], 2, at)
    kinds = {(r["_change_type"], r["k"]) for r in feed.collect()}
    assert kinds == {
        ("delete", 2), ("insert", 4), ("update_preimage", 1), ("update_postimage", 1), ("update_preimage", 3), ("update_postimage", 3),
    }
    first = before.withColumns({"_change_type": F.lit("insert"), "_commit_version": F.lit(1).cast("bigint"), "_commit_timestamp": at})
    target = apply_scd1(first.unionByName(feed), "k", SEQUENCE, DELETED, ["_change_type", *SEQUENCE])
    assert rows(target) == rows(after)
    assert {r.change_type: r.rcrd_cnt for r in commit_summary(feed).collect()}["update_postimage"] == 2


@pytest.mark.parametrize("hot_rows", [7, 100, 10_000])
def test_split_keys_change_nothing(spark, hot_rows):
    """One key holds a third of all rows."""
    events = spark.read.parquet(f"{SMALL}/events.parquet").withColumn(
        "user_id", F.when(F.expr("event_id % 3 = 0"), F.lit(-1)).otherwise(F.col("user_id"))
    )
    args = (events, "user_id", ["ts", "event_id"])
    plain = apply_scd2(*args, track=["event_type"], valid_from="ts")
    split = apply_scd2(*args, track=["event_type"], valid_from="ts", hot_rows=hot_rows)
    assert rows(plain) == rows(split)
    keyed = (events, ["user_id"], ["ts", "event_id"])
    assert rows(rank_rows(*keyed)) == rows(rank_rows(*keyed, hot_rows=hot_rows))
    assert rows(consecutive_pairs(*keyed, ["event_type"])) == rows(consecutive_pairs(*keyed, ["event_type"], hot_rows=hot_rows))


def test_hot_rows_are_spread(spark):
    events = spark.read.parquet(f"{SMALL}/events.parquet").withColumn("one", F.lit(1))
    total = events.count()
    line = Timeline.of(events, ["one"], ["ts", "event_id"], hot_rows=total // 8)
    sizes = [r["count"] for r in line.hot.groupBy("__slice").count().collect()]
    assert sum(sizes) == total and line.cold.count() == 0
    assert len(sizes) >= 6 and max(sizes) < total // 3


def test_slices_are_not_as_many_as_small_limits_go_into_the_rows(spark):
    """Every slice reports to the driver, so a limit of five rows must not make four hundred of them."""
    df = spark.range(2000).select(F.lit(1).alias("k"), "id")
    line = Timeline.of(df, ["k"], ["id"], hot_rows=5)
    assert line.hot.count() == 2000
    assert line.hot.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [tuple(r) for r in line.with_row_number("n").frame().orderBy("id").collect()] == [(1, i, i + 1) for i in range(2000)]


def test_hot_keys_are_joined(spark):
    df = spark.sql("SELECT id % 4 AS k, id FROM range(40) UNION ALL SELECT NULL, id FROM range(7)")
    assert rows(rank_rows(df, ["k"], ["id"])) == rows(rank_rows(df, ["k"], ["id"], hot_rows=5))


def test_null_keys_form_their_own_group(spark):
    df = spark.sql("SELECT IF(id % 2 = 0, NULL, 1) AS k, id FROM range(20)")
    assert rows(rank_rows(df, ["k"], ["id"])) == rows(rank_rows(df, ["k"], ["id"], hot_rows=3))


@pytest.mark.parametrize("scd_type", [1, 2])
def test_stream_equals_batch_and_replay_changes_nothing(spark, tmp_path, scd_type):
    rnd = random.Random(scd_type)
    changes = [
        change(rnd.choice([1, 1, 1, 2, 3, None]), rnd.choice("abc"), rnd.choice(["insert", "update_postimage", "delete"]), v)
        for v in range(60)
    ]
    rnd.shuffle(changes)
    landing = str(tmp_path / "landing")
    frame(spark, changes).repartition(3).write.parquet(landing)
    target = ScdTarget(str(tmp_path / "target"), ["k"], SEQUENCE, scd_type, DELETED, buckets=4)
    batches = {}

    def upsert(batch, batch_id):
        batches[batch_id] = batch.collect()
        target.upsert(batch, batch_id)

    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(landing)
    run_batches(stream, upsert, str(tmp_path / "checkpoint"))
    assert len(batches) == 3
    apply = apply_scd1 if scd_type == 1 else apply_scd2
    expected = rows(apply(frame(spark, changes), ["k"], SEQUENCE, DELETED, ["_change_type", *SEQUENCE]))
    assert rows(target.read(spark)) == expected
    for batch_id, replayed in batches.items():
        target.upsert(spark.createDataFrame(replayed, SCHEMA), batch_id)
    assert rows(target.read(spark)) == expected
    old = target.compact(spark)
    stored = spark.read.parquet(target.changes_path(spark))
    assert target.changes_path(spark) != old
    assert stored.count() == (3 if scd_type == 1 else sum(c[0] is not None for c in changes))
    target.upsert(spark.createDataFrame(batches[0], SCHEMA), 0)
    target.upsert(frame(spark, [change(2, "late", "insert", 0), change(9, "new", "insert", 99)]), 3)
    more = changes + [change(2, "late", "insert", 0), change(9, "new", "insert", 99)]
    expected = rows(apply(frame(spark, more), ["k"], SEQUENCE, DELETED, ["_change_type", *SEQUENCE]))
    assert rows(target.read(spark)) == expected
    assert target.quarantined(spark).count() == sum(c[0] is None for c in changes)


def test_target_widens_and_empties(spark, tmp_path):
    target = ScdTarget(str(tmp_path / "t"), ["k"], ["s"], delete_when="gone", buckets=2)
    target.upsert(spark.sql("SELECT 1 AS k, 1 AS s, false AS gone, 'a' AS v"), 0)
    target.upsert(spark.sql("SELECT 1 AS k, CAST(2 AS BIGINT) AS s, true AS gone"), 1)
    assert target.read(spark).count() == 0, "the deleted key is gone although its bucket is empty now"
    target.upsert(spark.sql("SELECT 2 AS k, 3 AS s, false AS gone, 'b' AS v, 'new' AS extra"), 2)
    target.upsert(spark.sql("SELECT 1 AS k, 1 AS s, false AS gone, 'late' AS v"), 3)
    assert [(r.k, r.v, r.extra) for r in target.read(spark).collect()] == [(2, "b", "new")], "a late row stays deleted"


def test_deferred_refresh(spark, tmp_path):
    """Batches only store changes; one refresh later the table is the same, and a second one has nothing to do."""
    target = ScdTarget(str(tmp_path / "t"), ["k"], ["s"], 2, buckets=2, refresh_each_batch=False)
    for batch_id, (k, s) in enumerate([(1, 5), (2, 1), (1, 2)]):
        target.upsert(spark.sql(f"SELECT {k} AS k, {s} AS s"), batch_id)
    target.refresh(spark)
    expected = [(1, 2, 2, 5, False), (1, 5, 5, None, True), (2, 1, 1, None, True)]
    assert rows(target.read(spark)) == sorted(expected, key=repr)
    target.refresh(spark)
    target.upsert(spark.sql("SELECT 2 AS k, 9 AS s"), 3)
    target.refresh(spark)
    assert (2, 1, 1, 9, False) in rows(target.read(spark))
