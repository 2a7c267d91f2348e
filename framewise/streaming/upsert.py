"""A keyed table that a stream upserts into, read at a cost that does not grow with its age.

Layout below one folder of the shared storage::

    generation=<k>        the latest row of every key up to a batch, written once
    after=<k>/_batch=<n>  the rows of the batches since, one folder per batch id
    pointer-<k % 2>       which generation is current and the last batch it holds

Every ``every`` batches the current generation and the batches after it become the next
generation.  A pointer is rewritten only while the other one is intact, so a reader always finds one:
switching generations is atomic.  A replayed batch replaces its own folder, or is already part of a
generation and is left out; either way it changes nothing.  When a generation is replaced, the one
before it is emptied (readers may still be on the last one).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.errors.exceptions.base import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTER = T.StructType([T.StructField("generation", T.LongType()), T.StructField("batch", T.LongType())])
BATCH = "_batch"
EVERY = 16  # batches between generations


class UpsertTable:
    """``schema``, ``keys``: of the rows; a table that exists is taken up where it was."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], every: int = EVERY):
        self.spark, self.path, self.keys, self.every = spark, path.rstrip("/"), keys, every

    # ---- state ----

    def _pointer(self) -> tuple[int, int] | None:
        """(current generation, its last batch); None before the first one."""
        found = []
        for slot in (0, 1):
            try:
                found += [tuple(r) for r in self.spark.read.schema(POINTER).parquet(f"{self.path}/pointer-{slot}").collect()]
            except (AnalysisException, PySparkException):
                continue  # not written yet, or being replaced: the other one holds
        return max(found, default=None)

    def _commit(self, generation: int, batch: int) -> None:
        row = self.spark.createDataFrame([(generation, batch)], POINTER).coalesce(1)
        row.write.mode("overwrite").parquet(f"{self.path}/pointer-{generation % 2}")

    def _start(self, generation: int, batch: int, rows: DataFrame) -> None:
        """A generation and its (empty) tail, both written before the pointer names them."""
        rows.write.mode("overwrite").parquet(f"{self.path}/generation={generation}")
        self._empty(rows.schema, f"{self.path}/after={generation}/{BATCH}={batch}", drop=BATCH)
        self._commit(generation, batch)

    def _empty(self, schema: T.StructType, path: str, drop: str | None = None) -> None:
        none = self.spark.createDataFrame([], schema)
        (none.drop(drop) if drop else none).coalesce(1).write.mode("overwrite").parquet(path)

    # ---- use ----

    def create(self, schema: T.StructType) -> None:
        """Make the table if there is none at its path."""
        if self._pointer() is None:
            typed = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
            self._start(0, -1, self.spark.createDataFrame([], typed).coalesce(1))

    def write(self, rows: DataFrame, batch: int) -> None:
        """The rows of one batch, each key at most once."""
        generation, last = self._pointer()
        if batch <= last:
            return  # replayed, and already part of the generation
        rows.write.mode("overwrite").parquet(f"{self.path}/after={generation}/{BATCH}={batch}")
        if batch - last >= self.every:
            self._start(generation + 1, batch, self._latest(generation))
            if generation:
                schema = self.spark.read.parquet(f"{self.path}/generation={generation - 1}").schema
                for old in (f"generation={generation - 1}", f"after={generation - 1}"):
                    self._empty(schema, f"{self.path}/{old}")

    def _latest(self, generation: int) -> DataFrame:
        base = self.spark.read.parquet(f"{self.path}/generation={generation}")
        tail = self.spark.read.schema(base.schema).parquet(f"{self.path}/after={generation}")
        values = [c for c in base.columns if c not in self.keys]
        newest = F.max_by(F.struct(*values), BATCH).alias("_v")
        return base.unionByName(tail).groupBy(*self.keys).agg(newest).select(*self.keys, "_v.*")

    def read(self) -> DataFrame:
        """The current row of every key: one generation and the batches after it."""
        return self._latest(self._pointer()[0]).drop(BATCH)

    def files(self) -> int:
        """Files that a read opens."""
        generation = self._pointer()[0]
        return sum(len(self.spark.read.parquet(f"{self.path}/{p}={generation}").inputFiles()) for p in ("generation", "after"))
