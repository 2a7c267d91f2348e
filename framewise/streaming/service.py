"""Long-running queries: poll, keep their progress as a table, stop between batches."""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("name", T.StringType()),
                         T.StructField("batch", T.LongType()), T.StructField("at", T.StringType()),
                         T.StructField("n_rows", T.LongType()), T.StructField("state_rows", T.LongType()),
                         T.StructField("late_rows", T.LongType()), T.StructField("millis", T.LongType())])
_KEEP = 512  # progress rows held between two writes of the table


class ProgressTable(StreamingQueryListener):
    """Progress of all queries of a session, one row per batch, appended to a folder of the shared
    storage: when ``_KEEP`` rows are there, and on ``flush``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.rows: list[tuple] = []
        self.failures: dict[str, str] = {}
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        states = p.get("stateOperators") or []
        row = (p["runId"], p.get("name"), int(p["batchId"]), p["timestamp"], int(p.get("numInputRows", 0)),
               sum(int(s.get("numRowsTotal", 0)) for s in states), sum(int(s.get("numRowsDroppedByWatermark", 0)) for s in states),
               int((p.get("durationMs") or {}).get("triggerExecution", 0)))
        with self.lock:
            self.rows.append(row)
            full = len(self.rows) >= _KEEP
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failures[str(event.runId)] = event.exception

    def flush(self) -> None:
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def table(self) -> DataFrame:
        """What has been written so far."""
        return self.spark.read.schema(PROGRESS).parquet(self.path)


def start_service(df: DataFrame, fmt: str, out: str, checkpoint: str, mode: str = "append",
                  every: str = "1 second") -> StreamingQuery:
    """Poll the source every ``every``; stop with :func:`run_for` or :func:`stop_after_batch`."""
    return (df.writeStream.format(fmt).outputMode(mode).option("path", out)
              .option("checkpointLocation", checkpoint).trigger(processingTime=every).start())


def stop_after_batch(query: StreamingQuery, patience: float = 60.0) -> None:
    """Stop once no batch is running, so that what was read has been committed (a batch that goes on
    beyond ``patience`` seconds is stopped, and done again by the next run)."""
    until = time.monotonic() + patience
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
        time.sleep(0.02)
    query.stop()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")


def run_for(query: StreamingQuery, seconds: float) -> None:
    """Let a service run for ``seconds``, then stop it between two batches."""
    query.awaitTermination(seconds)
    stop_after_batch(query)
