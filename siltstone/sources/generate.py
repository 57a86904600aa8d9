"""JSON rows for the access workload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def json_row(key: Column) -> Column:
    """One JSON object made from a numeric id; the score is a hash, so it is the same in every run."""
    tags = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda j: F.concat(F.lit("tag_"), (j - 1).cast("string")))
    return F.to_json(
        F.struct(
            key.alias("id"),
            F.concat(F.lit("user_"), (key % 100).cast("string")).alias("user"),
            F.pmod(F.xxhash64(key), F.lit(101)).cast("int").alias("score"),
            F.slice(tags, F.lit(1), (key % 5).cast("int")).alias("tags"),
            F.struct(
                F.concat(F.lit("192.168.1."), (key % 255).cast("string")).alias("ip"),
                F.concat(F.lit("device_"), (key % 10).cast("string")).alias("device"),
            ).alias("metadata"),
        )
    )


def make_json_rows(spark: SparkSession, n: int) -> DataFrame:
    return json_rows_for(spark.range(n), "id")


def json_rows_for(df: DataFrame, id_col: str) -> DataFrame:
    """`id` and `json_str` for every row of a table."""
    key = F.col(id_col).cast("bigint")
    return df.select(key.alias("id"), json_row(key).alias("json_str"))
