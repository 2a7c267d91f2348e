"""DataFrame-level frame operators: explode to pixels and rebuild frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_pixels(frames: DataFrame, key: str = "frame_id") -> DataFrame:
    """One row per pixel, keeping the frame key and the position."""
    return frames.select(key, F.posexplode("pixels").alias("pos", "pixel"))


def regroup(flat: DataFrame, n: int) -> DataFrame:
    """``(gpos, pixel)`` rows of one long pixel stream -> frames of ``n``
    consecutive positions, ``(chunk_id, pixels)``.  Each group holds exactly
    ``n`` rows, so no task ever receives more than one frame per key."""
    return (flat.groupBy(F.floor(F.col("gpos") / n).cast("long").alias("chunk_id"))
                .agg(F.array_sort(F.collect_list(F.struct("gpos", "pixel"))).alias("_s"))
                .select("chunk_id", F.transform("_s", lambda s: s["pixel"]).alias("pixels")))
