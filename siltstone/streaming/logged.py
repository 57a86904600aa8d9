"""The event log of running streams, written by a listener."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

# Kinds of events.
PROGRESS, FAILURE, ENDED = "flow_progress", "flow_failure", "flow_ended"
LOGGED = "timestamp STRING, event_type STRING, query STRING, run_id STRING, batch_id BIGINT, details STRING"


class ProgressLog(StreamingQueryListener):
    """Appends what Spark reports of every micro-batch, and how a query ended, to a log below `path`.

    Reports are written FLUSH at a time and when their query ends, so a run of any length keeps few of them in memory. A report that
    is written again, as after a failure between writing and noting it, is told apart by run and batch when the log is read.
    """

    FLUSH = 50

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.held: list[tuple] = []
        self.ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        report = event.progress
        self._add(report.timestamp, PROGRESS, report.name or str(report.id), str(report.runId), report.batchId, report.json)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        kind = FAILURE if event.exception else ENDED
        self._add(None, kind, str(event.id), str(event.runId), None, json.dumps({"exception": event.exception}), flush=True)
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def _add(self, *row, flush: bool = False) -> None:
        self.held.append(row)
        if flush or len(self.held) >= self.FLUSH:
            rows, self.held = self.held, []
            self.spark.createDataFrame(rows, LOGGED).coalesce(1).write.mode("append").parquet(self.path)

    def wait(self, run_id: str, seconds: float = 60) -> None:
        """Until the end of a run is in the log; reports come after the query itself has ended."""
        if not self.ended.setdefault(run_id, threading.Event()).wait(seconds):
            raise TimeoutError(f"no end of run {run_id} was reported")


def run_logged(df: DataFrame, sink: str, checkpoint: str, log_path: str, name: str | None = None) -> None:
    """Append all that is available to Parquet, with every micro-batch and the end in the log; failures are logged and raised."""
    spark = df.sparkSession
    log = ProgressLog(spark, log_path)
    spark.streams.addListener(log)
    try:
        writer = df.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
        query = (writer.queryName(name) if name else writer).outputMode("append").trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        finally:
            log.wait(str(query.runId))
    finally:
        spark.streams.removeListener(log)


def batch_reports(spark: SparkSession, log_path: str, observed: str | None = None, metrics: tuple[str, ...] = ()) -> DataFrame:
    """(query, run_id, batch_id, input_rows, ...): one row per micro-batch, with the metrics of an observation (`DataFrame.observe`)."""
    log = spark.read.schema(LOGGED).parquet(log_path).where(F.col("event_type") == PROGRESS).dropDuplicates(["run_id", "batch_id"])
    named = [F.get_json_object("details", f"$.observedMetrics.{observed}.{m}").cast("bigint").alias(m) for m in metrics]
    return log.select("query", "run_id", "batch_id", F.get_json_object("details", "$.numInputRows").cast("bigint").alias("input_rows"), *named)
