"""Rows without a valid event time: they can be in no window, and they are not lost.

Windows drop a row whose time is null.  The same source is therefore also read through a gate that
parts every micro-batch in two under one batch id: rows with a time, and rows without, flagged and
with their text.  Both parts and the counts of the batch (taken by ``observe`` during the write) are
one folder per batch id, which a replayed batch replaces, so a restart writes no row twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import fresh_path

PARTS = ("accepted", "rejected")
COUNTS = T.StructType([T.StructField(n, T.LongType()) for n in ("n_rows", "n_rejected")])


def start_gate(stream: DataFrame, ts: str, out: str, checkpoint: str, parts: tuple[str, ...] = PARTS) -> StreamingQuery:
    """Start parting ``stream`` by whether ``ts`` is null, below ``out``.  ``parts`` may leave out the
    accepted rows where another query of the same source takes them."""

    def gate(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"gate-{batch_id}")
        bad = F.col(ts).isNull()
        marked = batch.withColumn("is_reject", bad)
        counted = marked.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(bad.cast("long")), F.lit(0)).alias("n_rejected"))
        flag = F.when(F.col("is_reject"), "rejected").otherwise("accepted")
        rows = counted.withColumn("part", flag)
        if "accepted" not in parts:
            rows = rows.where("is_reject")
        # one write, one pass over the batch: the folder of the batch holds its parts
        rows.write.mode("overwrite").partitionBy("part").parquet(f"{out}/rows/_batch={batch_id}")
        counts = seen.get
        spark = batch.sparkSession
        spark.createDataFrame([(int(counts["n_rows"]), int(counts["n_rejected"]))], COUNTS).coalesce(1) \
             .write.mode("overwrite").parquet(f"{out}/counts/_batch={batch_id}")

    return (stream.writeStream.outputMode("append").foreachBatch(gate)
                  .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def gated(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """All rows that passed the gate: the stream's columns, ``is_reject``, ``_batch``."""
    typed = T.StructType([*schema.fields, T.StructField("is_reject", T.BooleanType()),
                          T.StructField("_batch", T.LongType()), T.StructField("part", T.StringType())])
    return spark.read.schema(typed).parquet(f"{out}/rows").drop("part")


def gate_counts(spark: SparkSession, out: str) -> DataFrame:
    """``_batch``, ``n_rows``, ``n_rejected``."""
    typed = T.StructType([*COUNTS.fields, T.StructField("_batch", T.LongType())])
    return spark.read.schema(typed).parquet(f"{out}/counts")


def run_gate(stream: DataFrame, ts: str, out: str | None = None, checkpoint: str | None = None) -> str:
    """Part all of the available input; the folder of an earlier run with its checkpoint resumes it."""
    out = out or fresh_path(stream.sparkSession, "gate")
    query = start_gate(stream, ts, out, checkpoint or f"{out}/checkpoint")
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    return out
