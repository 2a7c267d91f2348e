"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path, shared_dir

#: ASCII white space as a Java or Python regex class: `[\x20\x09-\x0D]`
SPACE = r"[\x20\x09-\x0D]"
#: A-Z and their lower-case forms, for ``F.translate``
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, kind: str) -> DataFrame:
    """Write to a new folder below ``spark.checkpoint.dir`` and read back: cuts the lineage, and
    survives the loss of any executor."""
    path = fresh_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fold(col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor`` (null ids count as empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))), F.lit(divisor))


def unique_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (Spark's names ignore case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``mapInArrow`` of a function on one record batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch)

    return df.mapInArrow(run, schema)
