"""Registered streaming queries (run with ``availableNow``, read back)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import ntz_micros
from ..session import fresh_path
from ..sources import fixtures as fx
from ..streaming import feeder
from ..streaming import queries as SQ
from ..streaming import rejects as RJ
from .catalog import register


def _bursts(spark, sf):
    return feeder.write_bursts(fx.frames(spark, sf), fresh_path(spark, "bursts-in"))


@register("stream_max_letter", sql="SELECT user_id, max(event_type) AS max_letter FROM events GROUP BY user_id")
def stream_max_letter(spark, sf):
    """Greatest event type per user, update mode, upserted per batch."""
    agg = SQ.max_letter_per_key(SQ.events_stream(spark, sf), "user_id", "event_type", "ts")
    return SQ.latest_per_key(spark, SQ.run_update(agg, ["user_id"], "max-letter"), ["user_id"])


@register("stream_window_append", sql="""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n
FROM events GROUP BY ALL""")
def stream_window_append(spark, sf):
    """Hourly counts per event type, upserted per batch; the watermark evicts closed windows, and events
    without a time are one row per type with a null window."""
    return SQ.run_windows(SQ.events_stream(spark, sf), "ts", "1 hour", ["event_type"], kind="window-counts")


@register("stream_pixel_explode", fixtures=("frames",), sql="""
SELECT frame_id, CAST(generate_subscripts(pixels, 1) - 1 AS INT) AS pos, unnest(pixels) AS pixel FROM fx_frames""")
def stream_pixel_explode(spark, sf):
    """Two sinks running in parallel on one stream: the raw records (Parquet)
    and the exploded pixels (CSV with header), each with its own checkpoint."""
    stream = SQ.burst_stream(spark, _bursts(spark, sf))
    _, out = SQ.run_append_parallel([
        (stream.drop("timestamp"), "parquet", None, "raw-tee"),
        (SQ.explode_stream_pixels(stream), "csv", {"header": "true"}, "pixel-csv"),
    ])
    return spark.read.schema("frame_id BIGINT, pos INT, pixel INT").option("header", "true").csv(out)


@register("stream_multi_source", fixtures=("frames",), sql="""
SELECT strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS window_start, stream_name, count(*) AS n,
       max(label) AS max_label
FROM fx_frames GROUP BY ALL""")
def stream_multi_source(spark, sf):
    """All streams in one query: ``stream_name`` (the partition folder) is a
    key of the one-second windows."""
    stream = SQ.burst_stream(spark, _bursts(spark, sf))
    return SQ.run_windows(stream, "timestamp", "1 second", ["stream_name"], {"max_label": F.max("label")}, kind="multi-source")


@register("stream_late_data", fixtures=("frames",), sql="""
WITH b AS (SELECT min(epoch_us(ts)) + (max(epoch_us(ts)) - min(epoch_us(ts))) // 2 AS middle FROM fx_frames),
h AS (SELECT * FROM fx_frames, b WHERE epoch_us(ts) >= middle)
SELECT strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS window_start, stream_name, count(*) AS n
FROM h GROUP BY ALL""")
def stream_late_data(spark, sf):
    """Two arrivals, out of order.  The frames of the later half of the time span land and are
    processed first; the query then restarts from its checkpoint when the earlier half lands, which
    is behind the watermark and dropped."""
    frames = fx.frames(spark, sf)
    first, last = frames.agg(F.min(ntz_micros("ts")), F.max(ntz_micros("ts"))).first()
    later = ntz_micros("ts") >= (first or 0) + ((last or 0) - (first or 0)) // 2
    root, out = fresh_path(spark, "bursts-in"), fresh_path(spark, "late-data")
    for arrival in (frames.where(later), frames.where(~later)):
        feeder.write_bursts(arrival, root)
        counts = SQ.run_windows(SQ.burst_stream(spark, root), "timestamp", "1 second", ["stream_name"], out=out)
    return counts


_BAD_TIME = {"text": "frame_id % 7 = 3", "empty": "frame_id % 7 = 5", "null": "frame_id % 11 = 4"}
_RAW_TIME = f"""CASE WHEN {_BAD_TIME['null']} THEN NULL WHEN {_BAD_TIME['text']} THEN 'bad ' || CAST(frame_id AS VARCHAR)
  WHEN {_BAD_TIME['empty']} THEN '' ELSE strftime(ts, '%Y%m%d %H:%M:%S') END"""


def damaged_bursts(spark, sf):
    """Burst records some of whose ``Time`` texts are no time, empty or null."""
    time = (F.when(F.expr(_BAD_TIME["null"]), F.lit(None).cast("string"))
             .when(F.expr(_BAD_TIME["text"]), F.concat(F.lit("bad "), F.col("frame_id").cast("string")))
             .when(F.expr(_BAD_TIME["empty"]), F.lit("")).otherwise(F.col("Time")))
    return feeder.burst_records(fx.frames(spark, sf)).withColumn("Time", time)


@register("stream_reject_times", fixtures=("frames",), sql=f"""
SELECT frame_id, stream_name, {_RAW_TIME} AS time, try_strptime({_RAW_TIME}, '%Y%m%d %H:%M:%S') IS NULL AS is_reject FROM fx_frames""")
def stream_reject_times(spark, sf):
    """Every burst record through the gate: with a valid time, or flagged and with its text."""
    root = fresh_path(spark, "bursts-in")
    damaged_bursts(spark, sf).write.partitionBy("stream_name").parquet(root)
    stream = SQ.burst_stream(spark, root).drop("Pixels")
    rows = RJ.gated(spark, RJ.run_gate(stream, "timestamp"), stream.schema)
    return rows.select("frame_id", "stream_name", F.col("Time").alias("time"), "is_reject")


@register("stream_windows_with_rejects", fixtures=("frames",), sql=f"""
SELECT strftime(date_trunc('second', try_strptime({_RAW_TIME}, '%Y%m%d %H:%M:%S')), '%Y-%m-%d %H:%M:%S') AS window_start,
       stream_name, count(*) AS n FROM fx_frames GROUP BY ALL""")
def stream_windows_with_rejects(spark, sf):
    """One-second windows of every stream; records without a valid time are a row of their own."""
    root = fresh_path(spark, "bursts-in")
    damaged_bursts(spark, sf).write.partitionBy("stream_name").parquet(root)
    return SQ.run_windows(SQ.burst_stream(spark, root), "timestamp", "1 second", ["stream_name"])
