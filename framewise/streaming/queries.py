"""Structured Streaming operators and runners.

Sources are file streams with fixed schemas.  Sinks live below the shared
checkpoint folder: append-mode results go to a Parquet file sink (exactly
once through the sink's commit log); update-mode results go through
``foreachBatch`` into a keyed table (``upsert``), whose reads touch one
generation and the batches since.  Rows without an event time can be in no
window; they come out flagged, through a gate on the same source
(``rejects``).  Tests and the registered queries run with
``trigger(availableNow=True)``; services (``service``) use ``processingTime``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import as_instant, as_wall_clock, parse_stream_time
from ..schemas import EVENTS, WATERMARK
from ..session import fresh_path
from .feeder import BURST_RECORD
from .rejects import gated, start_gate
from .service import run_for, start_service  # noqa: F401 - the runners of this module and those of services together
from .upsert import UpsertTable


# ---- sources ----

def _is_file(spark: SparkSession, path: str, schema) -> bool:
    """Whether a table is one file, by what a batch read of it would open."""
    files = spark.read.schema(schema).parquet(path).inputFiles()
    return len(files) == 1 and files[0].rstrip("/").endswith("/" + path.rsplit("/", 1)[-1])


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema,
                 max_files_per_batch: int | None = None) -> DataFrame:
    """A table as a file stream: its folder of part files, or — when the
    table is a single file — its parent folder filtered to that file.

    ``max_files_per_batch`` bounds each micro-batch of a large backlog
    (``availableNow`` still drains all of it, in several batches); files
    are taken oldest first, so time-ordered arrivals keep the watermark
    semantics."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    reader = spark.readStream.schema(schema)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    if _is_file(spark, path, schema):
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return reader.parquet(path)


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream; the wall-clock ``ts`` becomes the
    instant it denotes in UTC, so it can carry a watermark."""
    return table_stream(spark, sf_dir, "events", EVENTS).withColumn("ts", as_instant("ts"))


def burst_stream(spark: SparkSession, root: str, max_files: int | None = None) -> DataFrame:
    """Burst files as a stream; ``timestamp`` parsed from the ``Time`` text."""
    r = spark.readStream.schema(BURST_RECORD)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(root).withColumn("timestamp", as_instant(parse_stream_time("Time")))


# ---- operators ----

def max_letter_per_key(stream: DataFrame, key: str, letter: str, ts: str) -> DataFrame:
    """The application's stream aggregate: greatest letter per key, with a
    watermark that cannot evict (the grouping has no event-time column), so
    state grows with the number of keys.  Kept for compatibility; the form
    whose state ends is ``burst_state.greatest_letters``."""
    return (stream.withWatermark(ts, WATERMARK)
                  .groupBy(key).agg(F.max(letter).alias("max_letter")))


def windowed_counts(stream: DataFrame, ts: str, size: str, keys: list[str],
                    extra_aggs: dict | None = None) -> DataFrame:
    """Tumbling event-time windows with a watermark: state is dropped once a
    window closes; append mode emits each closed window exactly once, update
    mode every change.  A row whose ``ts`` is null is in no window: take
    :func:`run_windows`, which reports it.
    ``extra_aggs`` maps output names to aggregate Columns."""
    extra = extra_aggs or {}
    aggs = [F.count(F.lit(1)).alias("n")] + [c.alias(name) for name, c in extra.items()]
    return (stream.withWatermark(ts, WATERMARK)
                  .groupBy(F.window(ts, size), *keys).agg(*aggs)
                  .select(F.date_format(as_wall_clock("window.start"), "yyyy-MM-dd HH:mm:ss")
                           .alias("window_start"),
                          *keys, "n", *extra.keys()))


def explode_stream_pixels(stream: DataFrame) -> DataFrame:
    return stream.select("frame_id", F.posexplode("Pixels").alias("pos", "pixel"))


# ---- runners ----

def _check(q: StreamingQuery) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")


def _start_append(df: DataFrame, fmt: str, options: dict | None, kind: str,
                  out: str | None, checkpoint: str | None) -> tuple[StreamingQuery, str]:
    spark = df.sparkSession
    out = out or fresh_path(spark, kind)
    checkpoint = checkpoint or fresh_path(spark, kind + "-ckpt")
    w = (df.writeStream.format(fmt).outputMode("append")
           .option("checkpointLocation", checkpoint)
           .option("path", out).trigger(availableNow=True))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    return w.start(), out


@contextmanager
def state_store(spark: SparkSession, key: str, provider: str) -> Iterator[None]:
    """The state store that queries started inside use (a query keeps the one it started with)."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, provider)
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def run_append(df: DataFrame, fmt: str = "parquet", options: dict | None = None,
               kind: str = "stream-out", out: str | None = None,
               checkpoint: str | None = None) -> str:
    """Run to the end of the available input; return the sink folder.
    Passing the ``out``/``checkpoint`` of an earlier run resumes that query."""
    q, out = _start_append(df, fmt, options, kind, out, checkpoint)
    _check(q)
    return out


def run_append_parallel(sinks: list[tuple[DataFrame, str, dict | None, str]]) -> list[str]:
    """Start several append queries (each with its own checkpoint) at once —
    e.g. a raw tee next to the main sink — and wait for all of them."""
    started = [_start_append(df, fmt, opts, kind, None, None) for df, fmt, opts, kind in sinks]
    for q, _ in started:
        _check(q)
    return [out for _, out in started]


def _start_update(df: DataFrame, keys: list[str], out: str, checkpoint: str) -> StreamingQuery:
    spark = df.sparkSession
    UpsertTable(spark, out, keys).create(df.schema)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        UpsertTable(batch.sparkSession, out, keys).write(batch, batch_id)

    return (df.writeStream.outputMode("update").foreachBatch(upsert)
              .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def run_update(df: DataFrame, keys: list[str], kind: str = "stream-upsert", out: str | None = None,
               checkpoint: str | None = None) -> str:
    """Update-mode aggregate, upserted by ``keys``; windows that are still open at the end of the input
    come out too.  Passing the ``out``/``checkpoint`` of an earlier run resumes it."""
    spark = df.sparkSession
    out = out or fresh_path(spark, kind)
    _check(_start_update(df, keys, out, checkpoint or fresh_path(spark, kind + "-ckpt")))
    return out


def latest_per_key(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Current value of every key written by :func:`run_update`."""
    return UpsertTable(spark, out, keys).read()


def run_windows(stream: DataFrame, ts: str, size: str, keys: list[str], extra_aggs: dict | None = None,
                kind: str = "windows", out: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Run :func:`windowed_counts` over the available input and return its windows, and for the rows
    without an event time one row per key with a null ``window_start``.  The rows themselves, flagged,
    are in ``<out>/gate`` (``rejects.gated``).  The ``out``/``checkpoint`` of an earlier run resume it."""
    spark = stream.sparkSession
    out = out or fresh_path(spark, kind)
    checkpoint = checkpoint or f"{out}/checkpoint"
    extra = extra_aggs or {}
    window_keys = ["window_start", *keys]
    started = [_start_update(windowed_counts(stream, ts, size, keys, extra), window_keys, f"{out}/windows", f"{checkpoint}/windows"),
               start_gate(stream, ts, f"{out}/gate", f"{checkpoint}/gate", parts=("rejected",))]
    for q in started:
        _check(q)
    rejected = gated(spark, f"{out}/gate", stream.schema).where("is_reject")
    aggs = [F.count(F.lit(1)).alias("n")] + [c.alias(name) for name, c in extra.items()]
    timeless = rejected.groupBy(*keys).agg(*aggs).withColumn("window_start", F.lit(None).cast("string"))
    return latest_per_key(spark, f"{out}/windows", window_keys).unionByName(timeless)
