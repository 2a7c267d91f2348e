"""Minimax contiguous partition of documents into shards.

Groups of equal texts are atomic and ordered by the SHA-256 of their text.  The smallest feasible
shard capacity is found by binary search with a greedy check, and the order is cut there.

The greedy check runs on the driver over blocks of the order, never over all groups: a block is all
groups that share a hash prefix.  Two relaxations bracket the answer: blocks that may not be cut
(reachable, so an upper bound) and blocks of several groups that may be cut anywhere (a lower
bound).  Blocks near a cut are refined by one more byte of the prefix, in one aggregate over the
groups, until both bounds agree; the capacity is then exact.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

_REFINED = 512       # blocks refined in a round (256 times as many rows come back at most)
_SLOT_ROWS = 20_000  # rows numbered by one window group


class Blocks(NamedTuple):
    prefix: list[str]    # hash prefix where the block begins
    ends: np.ndarray     # running weight up to and including the block
    whole: np.ndarray    # one group only: cannot be cut


def _greedy(blocks: Blocks, shards: int, capacity: int, loose: bool) -> list[int] | None:
    """Ends of the shards filled one after another, or None where ``shards`` do not suffice.
    ``loose``: a block of several groups may be cut anywhere."""
    at, cuts, total = 0, [], int(blocks.ends[-1])
    for _ in range(shards):
        if at >= total:
            break
        j = int(np.searchsorted(blocks.ends, at + capacity, "right"))
        to = int(blocks.ends[j - 1]) if j else 0
        if loose and j < len(blocks.ends) and not blocks.whole[j]:
            to = at + capacity
        if to <= at:
            return None
        at = to
        cuts.append(at)
    return cuts if at >= total else None


def _least(blocks: Blocks, shards: int, loose: bool) -> int:
    """The smallest capacity that the greedy check accepts."""
    total = int(blocks.ends[-1])
    low, high = -(-total // shards), total
    while low < high:
        mid = (low + high) // 2
        if _greedy(blocks, shards, mid, loose):
            high = mid
        else:
            low = mid + 1
    return low


def _open(blocks: Blocks, shards: int, low: int, high: int) -> np.ndarray:
    """Blocks of several groups in which a cut of some capacity in [low, high] may fall."""
    starts = np.r_[0, blocks.ends[:-1]]
    several = ~blocks.whole
    near = several & (blocks.ends - starts > low)
    far = _greedy(blocks, shards, high, True) or []
    at = 0
    for to in far:  # the strict walk at the low capacity lags the loose walk at the high one
        j = int(np.searchsorted(blocks.ends, at + low, "right"))
        at = int(blocks.ends[j - 1]) if j and blocks.ends[j - 1] > at else at
        near |= several & (blocks.ends > at) & (starts < to)
    found = np.flatnonzero(near)
    return found[np.argsort(starts[found] - blocks.ends[found], kind="stable")][:_REFINED]


def _measure(groups: DataFrame, digits: int, among: list[str] | None = None) -> dict[str, tuple[int, int]]:
    """prefix of ``digits`` hex digits -> (weight, groups); at most 65,536 rows, or 256 for each of
    the given shorter prefixes."""
    if among:
        groups = groups.where(F.substring("h", 1, len(among[0])).isin(among))
    rows = groups.groupBy(F.substring("h", 1, digits).alias("p")).agg(F.sum("w"), F.count(F.lit(1)))
    return {r[0]: (r[1], r[2]) for r in rows.collect()}


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[str]]:
    """(smallest capacity, hash prefixes where shards 1, 2, ... begin) for ``groups``: ``h`` (64 hex
    digits, distinct) and ``w`` (long weight, positive)."""
    parts = _measure(groups, 4)
    if not parts:
        return 0, []
    while True:
        prefix = sorted(parts)
        weight = np.array([parts[p][0] for p in prefix], np.int64)
        blocks = Blocks(prefix, np.cumsum(weight), np.array([parts[p][1] == 1 for p in prefix]))
        low, high = _least(blocks, shards, True), _least(blocks, shards, False)
        if low == high:
            ends = _greedy(blocks, shards, high, False)[:-1]
            return high, [prefix[int(np.searchsorted(blocks.ends, e, "right"))] for e in ends]
        again = [prefix[i] for i in _open(blocks, shards, low, high)]
        for size in sorted({len(p) for p in again}):
            some = [p for p in again if len(p) == size]
            finer = _measure(groups, size + 2, some)
            for p in some:
                del parts[p]
            parts |= finer


def shard_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shards: int = 16) -> DataFrame:
    """(``id_col``, size, text_crc32, law, shard, slot, grown_shard), one row per input row.

    ``size`` is the UTF-8 bytes of the text (null: none) plus 1.  Rows of equal texts form a group
    that stays in one shard (null counts as the empty text); the largest shard is as small as any
    contiguous cut of the groups in hash order allows (law ``bytes``).  ``slot`` numbers the rows
    of a shard from 0 without gaps; ``grown_shard`` is null under this law.  Null and repeated ids
    get rows of their own; shards may stay empty; an empty table gives none."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = saved(df.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                           F.crc32(text).alias("crc"), F.sha2(text, 256).alias("h"),
                           F.monotonically_increasing_id().alias("row")), "sizes")
    groups = saved(rows.groupBy("h").agg(F.sum("size").alias("w")), "groups")
    _, begins = minimax_cuts(groups, shards)
    shard = reduce(lambda a, b: a + b, [(F.col("h") >= F.lit(b)).cast("int") for b in begins], F.lit(0))
    spread = rows.count() // (_SLOT_ROWS * shards) + 1
    # the row number deals repeated rows (equal id and text) to all parts of their shard
    placed = rows.select("*", shard.alias("shard"),
                         F.pmod(F.xxhash64("id", "h", "row"), F.lit(spread)).cast("int").alias("part"))
    sizes = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "part").orderBy("id", "h")
    numbered = placed.withColumn("rn", F.row_number().over(within) - 1).join(offsets, ["shard", "part"])
    return numbered.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
                           F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("rn")).cast("long").alias("slot"),
                           F.lit(None).cast("int").alias("grown_shard"))
