"""Schemas of the data model and the fixed label dictionary."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must match the surveyed application for identical results:
# the 29 classes in index order (A..Z are 0..25), the file-name tokens that map
# to 26..28, the display glyphs of those three, and the class a name that is not
# in the dictionary falls back to.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPECIAL_NAMES = ["del", "nothing", "space"]          # label ids 26, 27, 28
SPECIAL_GLYPHS = ["Del", "N", "Space"]               # displayed names of 26, 27, 28
UNKNOWN_LABEL = 27
AGE_ORDER = ["Ages 6 to 11", "Ages 12 to 19", "Ages 20 to 39",
             "Ages 40 to 59", "Ages 60 to 79"]
EXCLUDED_AGE_GROUP = "Ages 6 to 79"
STREAM_TIME_FORMAT = "yyyyMMdd HH:mm:ss"
BURST_TIME_FORMAT = "yyyyMMddHHmmss"
WATERMARK = "10 seconds"


def label_rows() -> list[tuple[int, str, str]]:
    """(label_id, label_name, glyph) for the 29 classes."""
    rows = [(i, c, c) for i, c in enumerate(LETTERS)]
    rows += [(26 + i, n, g) for i, (n, g) in enumerate(zip(SPECIAL_NAMES, SPECIAL_GLYPHS))]
    return rows


LABELS_DIM = T.StructType([
    T.StructField("label_id", T.IntegerType(), False),
    T.StructField("label_name", T.StringType(), False),
    T.StructField("glyph", T.StringType(), False),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def wide_schema(first: str, n: int, prefix: str = "pixel", start: int = 0) -> T.StructType:
    """``first INT, {prefix}{start} … INT`` — the wide CSV layouts."""
    return T.StructType([T.StructField(first, T.IntegerType(), True)] + [
        T.StructField(f"{prefix}{i}", T.IntegerType(), True) for i in range(start, start + n)])
