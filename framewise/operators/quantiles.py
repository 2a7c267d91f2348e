"""Exact discrete quantiles per group, distributed.

For quantile ``q`` of a group with ``n`` non-null values the result is the
smallest value ``v`` whose running count reaches ``ceil(q * n)`` — the value
a sort of the group would have at that rank (DuckDB ``quantile_disc``,
``percentile_approx`` with unbounded accuracy).

1. count rows per (group, value)    — partial aggregation, one shuffle
2. running count and total per group in value order, over the *distinct*
   values: the range-partitioned running sum of ``operators.ranking``, so a
   hot group spans many tasks and its total comes with the block table
3. pick, per quantile, the value whose count interval holds the rank: a local
   test and a partial aggregate.

One plan at every size; memory per task is bounded and the answer is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import running_sum


def exact_quantiles(df: DataFrame, group_cols: list[str], value_col: str, qs: dict[str, float],
                    partitions: int | None = None) -> DataFrame:
    v = F.col(value_col)
    counts = df.where(v.isNotNull()).groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_c"))
    cum = running_sum(counts, group_cols, [value_col], "_c", "_cum", partitions, total_col="_n")
    picks = []
    for name, q in qs.items():
        rank = F.greatest(F.ceil(F.col("_n") * F.lit(q)), F.lit(1))
        hit = (F.col("_cum") >= rank) & (F.col("_cum") - F.col("_c") < rank)
        picks.append(F.min(F.when(hit, v)).alias(name))
    return cum.groupBy(*group_cols).agg(*picks)
