"""Bursts: frames of one stream inside one second.

Names, times and per-burst letters.  Per-burst aggregates are two-level
(count per (burst, letter), then one pick per burst) so each level is a
partial/final hash aggregate and a hot burst never gathers its raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import burst_name, burst_part, format_burst_time, frame_in_second
from .ranking import first_k_per_group


def with_burst(frames: DataFrame) -> DataFrame:
    return frames.withColumns({"burst": format_burst_time("ts"),
                               "idx": frame_in_second("ts")})


def names(frames: DataFrame) -> DataFrame:
    b = with_burst(frames)
    return b.select("frame_id", burst_name("stream_name", "ts", "idx").alias("burst_name"))


def parse_names(named: DataFrame, col: str = "burst_name") -> DataFrame:
    return named.select("frame_id", burst_part(col, 1).alias("stream_name"),
                        burst_part(col, 2).alias("burst"),
                        burst_part(col, 3).cast("int").alias("idx"))


def max_letter(lettered: DataFrame, letter_col: str = "letter") -> DataFrame:
    """Alphabetically greatest letter per burst (the application's ``max``)."""
    return (lettered.groupBy("stream_name", "burst")
                    .agg(F.max(letter_col).alias("max_letter")))


def mode_label(frames: DataFrame, label_col: str = "label") -> DataFrame:
    """Most frequent label per burst; ties go to the greatest label."""
    counts = (with_burst(frames).groupBy("stream_name", "burst", label_col)
                                .agg(F.count(F.lit(1)).alias("n")))
    best = counts.groupBy("stream_name", "burst").agg(
        F.max(F.struct("n", label_col)).alias("_b"))
    return best.select("stream_name", "burst", F.col("_b")[label_col].alias("mode_label"),
                       F.col("_b.n").alias("n"))


def sample_rate(frames: DataFrame, per_second: int) -> DataFrame:
    """Keep the first ``per_second`` frames of every second of every stream."""
    sec = F.date_trunc("second", F.col("ts"))
    return first_k_per_group(frames.withColumn("_sec", sec), ["stream_name", "_sec"],
                             ["ts", "frame_id"], per_second).drop("_sec")
