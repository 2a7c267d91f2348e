"""File sources and sinks: CSV (typed, strings, inferred, headerless),
Parquet, text lines, whole binary files and decoded images."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pixels import bytes_to_ints
from ..operators.ranking import ranked


# ---- CSV ----

def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", header).csv(path)
    return path


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType,
                   header: bool = True) -> DataFrame:
    """Explicit schema: no inference pass, malformed values become null."""
    return spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(path)


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """Header row names the columns; every value stays a string."""
    return spark.read.format("csv").option("header", "true").load(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Types inferred from the data (costs one extra pass over the files)."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_csv_headerless(spark: SparkSession, path: str, names: list[str],
                        types: list[T.DataType] | None = None) -> DataFrame:
    """No header line: names (and types) are given by the caller."""
    types = types or [T.IntegerType()] * len(names)
    schema = T.StructType([T.StructField(n, t, True) for n, t in zip(names, types)])
    return spark.read.schema(schema).option("header", "false").csv(path)


# ---- CSV of bare numbers ----

def read_csv_rows_as_arrays(spark: SparkSession, path: str) -> DataFrame:
    """``(path, values ARRAY<DOUBLE>)``: every line of comma-separated numbers as one array, of any
    length; a text that is no number is null in its place."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    return lines.select("path", F.transform(F.split("value", ","), lambda v: F.trim(v).try_cast("double")).alias("values"))


def read_csv_column(spark: SparkSession, path: str, name: str, kind: str, header: bool = True) -> DataFrame:
    """``(path, position, <name>)`` of a one-column CSV: the position of every value in its file, from 0.

    A file is read in splits by different tasks.  Inside a split rows come in order, and
    ``file_block_start`` orders the splits, so the position is a rank by (split, order in the split); it
    is taken over ranges, and one long file spans many tasks."""
    rows = spark.read.schema(f"{name} {kind}").option("header", header).csv(path) \
                .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start"), name)
    placed = ranked(rows.withColumn("_order", F.monotonically_increasing_id()), ["path"], ["_start", "_order"], "_rank")
    return placed.select("path", (F.col("_rank") - 1).alias("position"), name)


# ---- Parquet / text ----

def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def append_lines(df: DataFrame, path: str, col: str = "line") -> str:
    """Append one text line per row (each line carries its own key, so files
    may be written by many tasks in parallel)."""
    df.select(F.col(col).cast("string").alias("value")).write.mode("append").text(path)
    return path


# ---- whole files and images ----

MERGED = 32  # splits of small picture files that one task reads


def read_binary_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, modificationTime, length, content`` per file."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)


def read_images(spark: SparkSession, path: str, drop_invalid: bool = False) -> DataFrame:
    """Decoded images: ``image.origin/height/width/nChannels/mode/data`` (BGR); a file that cannot be
    decoded stays, with height -1.

    Spark counts 4 MB for opening a file, so a scan of small files has a task for every 32 of them; up
    to ``MERGED`` such splits are read by one task, while there is one for each shuffle partition."""
    images = spark.read.format("image").option("dropInvalid", drop_invalid).load(path)
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    splits = images.rdd.getNumPartitions()
    return images.coalesce(max(least, -(-splits // MERGED)))


def image_pixels(images: DataFrame) -> DataFrame:
    """Flatten the image struct and turn its bytes into ``pixels ARRAY<INT>``; undecodable
    files are flagged ``is_reject``."""
    return images.select(
        F.col("image.origin").alias("origin"), F.col("image.height").alias("height"),
        F.col("image.width").alias("width"), F.col("image.nChannels").alias("channels"),
        bytes_to_ints(F.col("image.data")).alias("pixels"), (F.col("image.height") < 0).alias("is_reject"))
