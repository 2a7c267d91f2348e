"""Ordered per-group positions that stay balanced when one group is huge.

``row_number() OVER (PARTITION BY g ORDER BY o)`` (or a running sum) sends a
whole group to one task.  Here the rows are range-partitioned on ``(g, o)``
instead, so a hot group spans many partitions; a row's position is its
position inside its partition plus the total of the same group in earlier
partitions.  The per-(partition, group) block table is tiny (at most
partitions + groups rows), so the join back is broadcast by AQE from its
measured size.

Range boundaries come from sampling, so the placed rows are checkpointed
(reliably, to ``spark.checkpoint.dir``) before they are read twice.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir


def _placed(df: DataFrame, keys: list[str], partitions: int | None) -> DataFrame:
    """Range-partitioned, sorted, numbered and checkpointed rows.  The input
    is persisted while the range sampler and the checkpoint both read it
    (spilling to disk if needed; lost blocks are recomputed from lineage)."""
    spark = df.sparkSession
    shared_dir(spark)  # make sure a checkpoint folder is set
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return (src.repartitionByRange(n, *keys)
                   .sortWithinPartitions(*keys)
                   .withColumn("_pid", F.spark_partition_id())
                   .withColumn("_mid", F.monotonically_increasing_id())
                   .checkpoint(eager=True))
    finally:
        src.unpersist()


def _offsets(placed: DataFrame, group_cols: list[str], weight) -> DataFrame:
    blocks = (placed.groupBy("_pid", *group_cols)
                    .agg(F.sum(weight).alias("_blk"), F.min("_mid").alias("_first")))
    before = Window.partitionBy(*group_cols).orderBy("_pid") \
                   .rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumns({"_offset": F.coalesce(F.sum("_blk").over(before), F.lit(0)),
                               "_total": F.sum("_blk").over(Window.partitionBy(*group_cols))}) \
                 .select("_pid", *group_cols, "_offset", "_first", "_total")


def _with_offsets(placed: DataFrame, blocks: DataFrame, group_cols: list[str]) -> DataFrame:
    """Each placed row with its block's columns (null is a group like any other)."""
    keys = ["_pid", *group_cols]
    right = blocks.withColumnsRenamed({c: f"_block_{c}" for c in keys})
    on = [placed[c].eqNullSafe(right[f"_block_{c}"]) for c in keys]
    return placed.join(right, on).drop(*[f"_block_{c}" for c in keys])


def ranked(df: DataFrame, group_cols: list[str], order_cols: list[str],
           rank_col: str = "rn", partitions: int | None = None) -> DataFrame:
    """Exact ``row_number()`` per group in ``order_cols`` order."""
    placed = _placed(df, [*group_cols, *order_cols], partitions)
    out = _with_offsets(placed, _offsets(placed, group_cols, F.lit(1)), group_cols)
    return (out.withColumn(rank_col, (F.col("_offset") + F.col("_mid") - F.col("_first") + 1)
                           .cast("long"))
               .drop("_pid", "_mid", "_offset", "_first", "_total"))


def running_sum(df: DataFrame, group_cols: list[str], order_cols: list[str], weight: str,
                out_col: str = "cum", partitions: int | None = None, total_col: str = "_total") -> DataFrame:
    """Inclusive running sum of ``weight`` per group in ``order_cols`` order,
    and the group's whole weight in ``total_col``.
    Inside a partition the sum is a window over ``(partition, group)``, which
    hashes a hot group's blocks to different tasks."""
    placed = _placed(df, [*group_cols, *order_cols], partitions)
    local = Window.partitionBy("_pid", *group_cols).orderBy("_mid") \
                  .rowsBetween(Window.unboundedPreceding, 0)
    out = _with_offsets(placed.withColumn("_local", F.sum(weight).over(local)),
                        _offsets(placed, group_cols, F.col(weight)), group_cols)
    return (out.withColumn(out_col, F.col("_offset") + F.col("_local"))
               .withColumnRenamed("_total", total_col)
               .drop("_pid", "_mid", "_offset", "_first", "_local"))


def first_k_per_group(df: DataFrame, group_cols: list, order_cols: list, k: int,
                      rank_col: str = "rn") -> DataFrame:
    """Top-k per group.  Spark plans ``row_number() <= k`` with a partial
    WindowGroupLimit before the shuffle, so each map task sends at most k rows
    per group and a hot group never arrives whole."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
