"""Training-set preparation: leak-free splits, sampling, previews."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import keyed_bucket
from .ranking import ranked


def _keys(b: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``b``: partial aggregation collapses a repeated key in
    every task before the shuffle, so the join never buffers a hot key."""
    return b.select(key).distinct()


def minus(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of ``a`` whose key is absent from ``b`` (keeps duplicates of a)."""
    return a.join(_keys(b, key), key, "left_anti")


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of ``a`` whose key is present in ``b`` — what ``minus`` removes."""
    return a.join(_keys(b, key), key, "left_semi")


def every_nth(df: DataFrame, group_col: str, order_col: str, n: int) -> DataFrame:
    """Positions 0, n, 2n … of each group in ``order_col`` order (skew-safe)."""
    r = ranked(df, [group_col], [order_col])
    return r.where((F.col("rn") - 1) % n == 0)


def keyed_split(df: DataFrame, key: str, train_pct: int) -> DataFrame:
    """Deterministic split by the md5 of the key: the same row always lands
    on the same side, on any cluster size and in any engine."""
    return df.withColumn("is_train", keyed_bucket(key) < train_pct)


def first_n(df: DataFrame, order_cols: list[str], n: int) -> DataFrame:
    return df.orderBy(*order_cols).limit(n)


POISSON_BITS = 32


def poisson_bounds(fraction: float) -> list[int]:
    """A row is drawn once for each bound its 32-bit hash reaches: the cumulated Poisson probabilities."""
    bounds, term, total = [], math.exp(-fraction), 0.0
    for k in range(1, 64):
        total += term
        bound = round(total * 2 ** POISSON_BITS)
        if bound >= 2 ** POISSON_BITS:
            break
        bounds.append(bound)
        term *= fraction / k
    return bounds


def random_preview(df: DataFrame, key: str, fraction: float, seed: int = 42, copy: str = "copy") -> DataFrame:
    """Preview with replacement: every row comes out a Poisson number of times, of mean ``fraction``, by the
    md5 of ``seed:key``, with the number of the draw in ``copy``.  The same rows are drawn on any
    cluster, partitioning and engine; there is no shuffle."""
    text = F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))
    h = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    times = sum((F.when(h >= b, 1).otherwise(0) for b in poisson_bounds(fraction)), F.lit(0))
    return df.withColumn(copy, F.explode(F.when(times > 0, F.sequence(F.lit(0), times - 1))))
