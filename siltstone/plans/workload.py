"""JSON access workload: the same queries over a typed struct and over VARIANT."""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from ..functions.jsoncols import parse_struct, parse_variant, variant_path

# The row schema, method names and query names.
ROW_SCHEMA = (
    StructType()
    .add("id", LongType())
    .add("user", StringType())
    .add("score", IntegerType())
    .add("tags", ArrayType(StringType()))
    .add("metadata", StructType().add("ip", StringType()).add("device", StringType()))
)
METHODS = ("from_json", "variant")
DEVICE = "device_1"


def parse(rows: DataFrame, method: str) -> DataFrame:
    """`parsed` as a struct or as a VARIANT, from the JSON text in `json_str`."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    text = F.col("json_str")
    value = parse_struct(text, ROW_SCHEMA) if method == "from_json" else parse_variant(text)
    return rows.withColumn("parsed", value)


def field(path: str, method: str, data_type: str = "string"):
    if method == "from_json":
        return F.col(f"parsed.{path}")
    return variant_path(F.col("parsed"), path, data_type)


def bench_parse(rows: DataFrame, method: str) -> DataFrame:
    return parse(rows, method).select("parsed")


def bench_select(rows: DataFrame, method: str) -> DataFrame:
    return parse(rows, method).select(field("user", method).alias("user"), field("metadata.device", method).alias("device"))


def bench_filter(rows: DataFrame, method: str) -> DataFrame:
    return parse(rows, method).where(field("metadata.device", method) == DEVICE)


def bench_distinct(rows: DataFrame, method: str) -> DataFrame:
    users = parse(rows, method).select(field("user", method).alias("user")).distinct()
    return users.agg(F.count(F.lit(1)).alias("n_users"))


def bench_group(rows: DataFrame, method: str) -> DataFrame:
    devices = parse(rows, method).groupBy(field("metadata.device", method).alias("device"))
    return devices.agg(F.count(F.lit(1)).alias("n"))


def bench_write(rows: DataFrame, method: str, path: str) -> int:
    """Store the parsed rows; returns how many they are."""
    seen = Observation()
    parse(rows, method).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return seen.get["n"]


def bench_read_back(spark: SparkSession, method: str, path: str) -> DataFrame:
    return spark.read.parquet(path).select(field("user", method).alias("user"))


def bench_fields(rows: DataFrame, method: str) -> DataFrame:
    """The earlier two-cell form: id, user and metadata.ip."""
    return parse(rows, method).select(
        field("id", method, "bigint").alias("id"), field("user", method).alias("user"), field("metadata.ip", method).alias("ip")
    )


def _run(df: DataFrame) -> int:
    """How many rows a frame has. A mere count would let Spark prune the parse away; here every row is computed."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    return seen.get["n"]


def run_workload(rows: DataFrame, path: str, methods=METHODS, repeats: int = 1, warm_up: bool = False) -> DataFrame:
    """Seconds and rows per (benchmark, method): median of `repeats` runs."""
    spark = rows.sparkSession
    results = []
    for method in methods:
        target = f"{path}/{method}"
        steps: dict[str, Callable[[], int]] = {
            "B1_parse": lambda: _run(bench_parse(rows, method)),
            "B2_select": lambda: _run(bench_select(rows, method)),
            "B3_filter": lambda: _run(bench_filter(rows, method)),
            "B4_distinct": lambda: _run(bench_distinct(rows, method)),
            "B5_group": lambda: _run(bench_group(rows, method)),
            "B6_write": lambda: bench_write(rows, method, target),
            "B7_read": lambda: _run(bench_read_back(spark, method, target)),
            "B8_fields": lambda: _run(bench_fields(rows, method)),
        }
        for name, step in steps.items():
            if warm_up:
                step()
            seconds = []
            for _ in range(repeats):
                start = time.perf_counter()
                n_rows = step()
                seconds.append(time.perf_counter() - start)
            results.append((name, method, statistics.median(seconds), n_rows))
    return spark.createDataFrame(results, "benchmark STRING, method STRING, duration_sec DOUBLE, n_rows BIGINT")
