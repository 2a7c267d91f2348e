"""Scalar column functions: file names, labels, ages, burst names, times.

Each function maps Columns to a Column built from Spark built-ins, so it stays
inside whole-stage code generation and is usable from the DataFrame API.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import BURST_TIME_FORMAT, STREAM_TIME_FORMAT

BURST_NAME_PATTERN = r"^(.*)_(\d{14})_(\d+)$"
LABEL_PREFIX_PATTERN = r"^([^0-9_]+)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def file_stem(path) -> Column:
    """Base name up to the first dot: ``/a/b/A_1.v1.jpg`` -> ``A_1``."""
    return F.substring_index(F.substring_index(_c(path), "/", -1), ".", 1)


def label_token(stem) -> Column:
    """Text before the first underscore."""
    return F.substring_index(_c(stem), "_", 1)


def label_token_regex(stem) -> Column:
    """Text before the first digit or underscore."""
    return F.regexp_extract(_c(stem), LABEL_PREFIX_PATTERN, 1)


def try_int(x) -> Column:
    return _c(x).try_cast("int")


def try_double(x) -> Column:
    return _c(x).try_cast("double")


def blank_to_null(x) -> Column:
    return F.nullif(F.trim(_c(x)), F.lit(""))


def letter_ordinal(letter) -> Column:
    """``A`` -> 0 … ``Z`` -> 25."""
    return F.ascii(_c(letter)) - F.ascii(F.lit("A"))


def ordinal_letter(i) -> Column:
    return F.char((_c(i) + 65).cast("long"))


def age_from(age_group) -> Column:
    """Lower bound of ``Ages a to b`` (null when the text has another shape)."""
    a = _c(age_group)
    return F.substr(a, F.lit(6), F.instr(a, " to") - 6).try_cast("int")


# ---- time-zone independent timestamps ----
# Wall-clock times are TIMESTAMP_NTZ; event-time operators that need instants
# (watermarks, windows) read a wall-clock time as UTC.  Results therefore do
# not depend on the session time zone.

def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_from_micros(micros) -> Column:
    return F.timestamp_add("MICROSECOND", _c(micros), epoch_ntz())


def ntz_micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00 of a wall-clock time."""
    return F.timestamp_diff("MICROSECOND", epoch_ntz(), _c(ts))


def as_instant(ts) -> Column:
    """Wall-clock time (NTZ) -> the instant it denotes in UTC."""
    return F.timestamp_micros(ntz_micros(_c(ts).cast("timestamp_ntz")))


def as_wall_clock(instant) -> Column:
    """Instant -> its UTC wall-clock time (NTZ)."""
    return ntz_from_micros(F.unix_micros(_c(instant)))


def format_burst_time(ts) -> Column:
    return F.date_format(_c(ts), BURST_TIME_FORMAT)


def format_stream_time(ts) -> Column:
    return F.date_format(_c(ts), STREAM_TIME_FORMAT)


def parse_stream_time(text) -> Column:
    """``yyyyMMdd HH:mm:ss`` text -> wall-clock time (NTZ); malformed -> null.
    (Parsed in the session zone and read back in it, which is the identity
    on the wall clock.)"""
    return F.try_to_timestamp(_c(text), F.lit(STREAM_TIME_FORMAT)).cast("timestamp_ntz")


def epoch_seconds(ts) -> Column:
    """Seconds since 1970-01-01 00:00 of a wall-clock time."""
    return F.timestamp_diff("SECOND", epoch_ntz(), _c(ts))


def frame_in_second(ts, period_us: int = 200000) -> Column:
    """Index of a frame inside its one-second burst."""
    return ((ntz_micros(ts) % 1000000) / period_us).cast("int")


def burst_name(stream, ts, idx) -> Column:
    """``{stream}_{yyyyMMddHHmmss}_{i}``."""
    return F.concat_ws("_", _c(stream), format_burst_time(ts), _c(idx).cast("string"))


def burst_part(name, k: int) -> Column:
    """Inverse of :func:`burst_name`: 1 = stream, 2 = burst time, 3 = index."""
    return F.regexp_extract(_c(name), BURST_NAME_PATTERN, k)


def keyed_bucket(key, buckets: int = 100) -> Column:
    """Stable 0..buckets-1 from the md5 of the key (same value in any engine)."""
    h = F.conv(F.substring(F.md5(_c(key).cast("string")), 1, 8), 16, 10).cast("long")
    return (h % buckets).cast("int")
