"""Running streams to completion."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import observe_expectations
from ..operators.schema_log import append_flow_definition
from .aggregates import SumTarget


def _start(df: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    writer = df.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()


def run_stream(df: DataFrame, sink: str, checkpoint: str, log_path: str | None = None, dataset: str | None = None) -> list[dict]:
    """Append everything available to Parquet and stop; a second run takes only what is new.

    With `log_path`, the run notes the schema of `dataset` in the event log. Returns the progress reports
    Spark still holds, the latest hundred by default: good to look at, not to count from (see
    `store_expected`).
    """
    query = _start(df, sink, checkpoint)
    query.awaitTermination()
    if log_path is not None:
        append_flow_definition(df, dataset or sink, log_path, F.current_timestamp())
    return [json.loads(p.json) for p in query.recentProgress]


def run_streams(streams: Mapping[str, tuple[DataFrame, str, str]]) -> None:
    """Several streams at once, one query each; raises the first failure after all have ended."""
    queries = [_start(*stream) for stream in streams.values()]
    failures = []
    for query in queries:
        try:
            query.awaitTermination()
        except Exception as error:  # noqa: BLE001 - the other queries must be awaited first
            failures.append(error)
    if failures:
        raise failures[0]


def run_batches(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand every micro-batch to `each(batch, batch_id)` until nothing is left."""
    query = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def store_expected(df: DataFrame, rules: Mapping[str, str], sink: str, counts: SumTarget, checkpoint: str) -> None:
    """Store every micro-batch unchanged, and beside it how many of its rows pass each rule.

    Rows are counted while they are written. `counts` needs the measures `total` and the names of the
    rules, and no keys. A repeated batch replaces its rows and its counts, however many batches ran.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        observe_expectations(batch, rules, seen).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
        names = ["total", *rules]
        row = batch.sparkSession.createDataFrame([tuple(seen.get[n] for n in names)], ", ".join(f"`{n}` long" for n in names))
        counts.upsert(row, batch_id)

    run_batches(df, store, checkpoint)


def store_batches(df: DataFrame, transform: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str) -> None:
    """Store `transform` of every micro-batch, one folder per batch; a repeated batch replaces its folder.

    Inside a batch Spark re-plans at run time, so joins with a static table split skewed keys,
    and the static table is read afresh.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    run_batches(df, store, checkpoint)
