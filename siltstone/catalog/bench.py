"""The JSON access workload, over one generated JSON row per event."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..plans.workload import (
    METHODS,
    bench_distinct,
    bench_fields,
    bench_filter,
    bench_group,
    bench_parse,
    bench_read_back,
    bench_select,
    bench_write,
    run_workload,
)
from ..sources.generate import json_rows_for
from .base import Tables, register


def rows(t: Tables) -> DataFrame:
    return json_rows_for(t("events"), "event_id")


def _both(build: Callable[[str], DataFrame]) -> DataFrame:
    """The same query by struct and by VARIANT."""
    frames = [build(method).withColumn("method", F.lit(method)) for method in METHODS]
    return reduce(DataFrame.unionByName, frames)


def _both_sql(select: str) -> str:
    return " UNION ALL ".join(f"SELECT q.*, '{method}' AS method FROM ({select}) AS q" for method in METHODS)


@register("json_bench_parse", "BEN-1", _both_sql("SELECT count(*) AS n, count(*) AS n_parsed FROM events"))
def parse(t: Tables) -> DataFrame:
    def counted(method: str) -> DataFrame:
        parsed = F.col("parsed.id") if method == "from_json" else F.col("parsed")
        return bench_parse(rows(t), method).agg(F.count(F.lit(1)).alias("n"), F.count(parsed).alias("n_parsed"))

    return _both(counted)


@register(
    "json_bench_select", "BEN-2", _both_sql("SELECT concat('user_', event_id % 100) AS user, concat('device_', event_id % 10) AS device FROM events").replace("AS user", 'AS "user"')
)
def select(t: Tables) -> DataFrame:
    return _both(lambda m: bench_select(rows(t), m))


@register("json_bench_filter", "BEN-3", _both_sql("SELECT event_id AS id FROM events WHERE event_id % 10 = 1"))
def filtered(t: Tables) -> DataFrame:
    return _both(lambda m: bench_filter(rows(t), m).select("id"))


@register("json_bench_distinct", "BEN-4 REL-9", _both_sql("SELECT count(DISTINCT event_id % 100) AS n_users FROM events"))
def distinct(t: Tables) -> DataFrame:
    return _both(lambda m: bench_distinct(rows(t), m))


@register(
    "json_bench_group", "BEN-5", _both_sql("SELECT concat('device_', event_id % 10) AS device, count(*) AS n FROM events GROUP BY 1")
)
def grouped(t: Tables) -> DataFrame:
    return _both(lambda m: bench_group(rows(t), m))


@register("json_bench_write", "BEN-6", _both_sql("SELECT event_id AS id FROM events"))
def written(t: Tables) -> DataFrame:
    def stored(method: str) -> DataFrame:
        path = t.scratch("bench")
        bench_write(rows(t), method, path)
        return t.spark.read.parquet(path).select("id")

    return _both(stored)


@register(
    "json_bench_read_back", "BEN-7", _both_sql("SELECT concat('user_', event_id % 100) AS user_name FROM events")
)
def read_back(t: Tables) -> DataFrame:
    def again(method: str) -> DataFrame:
        path = t.scratch("bench")
        bench_write(rows(t), method, path)
        return bench_read_back(t.spark, method, path).withColumnRenamed("user", "user_name")

    return _both(again)


@register(
    "json_bench_fields", "BEN-8",
    _both_sql("SELECT event_id AS id, concat('user_', event_id % 100) AS user_name, concat('192.168.1.', event_id % 255) AS ip FROM events"),
)
def fields(t: Tables) -> DataFrame:
    return _both(lambda m: bench_fields(rows(t), m).withColumnRenamed("user", "user_name"))


# Rows each timed step has.
BENCHMARKS = {
    "B1_parse": "count(*)",
    "B2_select": "count(*)",
    "B3_filter": "count(*) FILTER (WHERE event_id % 10 = 1)",
    "B4_distinct": "least(count(*), 1)",
    "B5_group": "count(DISTINCT event_id % 10)",
    "B6_write": "count(*)",
    "B7_read": "count(*)",
    "B8_fields": "count(*)",
}


@register(
    "json_bench_results", "BEN-9",
    " UNION ALL ".join(
        f"SELECT '{b}' AS benchmark, '{m}' AS method, CAST({n} AS BIGINT) AS n_rows, true AS timed FROM events" for b, n in BENCHMARKS.items() for m in METHODS
    ),
)
def results(t: Tables) -> DataFrame:
    """The stored results table; durations differ from run to run, so only their presence is shown."""
    path = t.scratch("bench")
    run_workload(rows(t), path).write.parquet(f"{path}/results")
    stored = t.spark.read.parquet(f"{path}/results")
    return stored.select("benchmark", "method", "n_rows", (F.col("duration_sec") > 0).alias("timed"))
