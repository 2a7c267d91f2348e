"""Burst files: frames landing as Parquet files in a folder, the hand-over
point between the frame producer and the streaming queries.

Record layout follows the application's stream records (``Filename`` = burst
name, ``Time`` = ``yyyyMMdd HH:mm:ss`` text, ``Pixels``) plus the keys we carry
(``frame_id``, ``label``); files are partitioned by ``stream_name`` so one
streaming query serves every stream (partition column = key column).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import format_burst_time, format_stream_time

BURST_RECORD = T.StructType([
    T.StructField("frame_id", T.LongType()),
    T.StructField("Filename", T.StringType()),
    T.StructField("Time", T.StringType()),
    T.StructField("Pixels", T.ArrayType(T.IntegerType())),
    T.StructField("label", T.IntegerType()),
    T.StructField("stream_name", T.StringType()),
])


def burst_records(frames: DataFrame) -> DataFrame:
    return frames.select(
        "frame_id",
        F.concat_ws("_", "stream_name", format_burst_time("ts")).alias("Filename"),
        format_stream_time("ts").alias("Time"),
        F.col("pixels").alias("Pixels"),
        "label", "stream_name")


def write_bursts(frames: DataFrame, root: str) -> str:
    """Append one arrival of burst files to ``root``."""
    burst_records(frames).write.mode("append").partitionBy("stream_name").parquet(root)
    return root
