"""SimHash near-duplicates with pivot distance tables.

1. Every text becomes a 64-bit fingerprint: the majority of each bit over the XXH64 hashes of its
   word shingles.  Equal fingerprints are one row from here on.
2. A pivot table holds, for every fingerprint, its Hamming distances to ``PIVOTS`` reference
   fingerprints, kept per segment of the bits (their sum over the segments is the plain distance).
3. Two fingerprints at ``d`` or fewer differing bits agree on at least two of ``d + 2`` segments,
   and there all their pivot coordinates are equal.  Rows therefore meet in buckets keyed by the
   coordinates of two segments; all other pairs are discarded by a coordinate difference without
   being formed.  Within a bucket, pairs whose full pivot distances differ by more than ``d``
   anywhere are discarded (triangle inequality), and survivors are verified on the bits.
4. A bucket reports a spanning forest of its links, not all pairs.  Buckets above ``TILE`` rows are
   cut into blocks, and every pair of blocks is its own group, so no bucket is one task.
5. Components of the links give the smallest reachable id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, saved, unique_name
from .components import components

PIVOTS = [xxhash.xxh64_intdigest(b"reference %d" % i) for i in range(16)]
TILE = 4096
_SLICE = 1 << 15  # shingles summed at a time, so a very long text needs little memory
_SMALL = 8        # buckets up to this size are compared together, row against shifted row


def fingerprint(text: bytes | None, shingle: int) -> int:
    """SimHash of one text: A-Z lower-cased, words between ASCII white space, ``shingle`` words
    joined by one space (fewer words: the whole sequence; none: zero)."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    last = min(shingle, len(words)) - 1
    for at in range(0, n, _SLICE):
        to = min(n, at + _SLICE)
        digests = b"".join([digest(line[a:b - 1], 42)
                            for a, b in zip(starts[at:to], ends[at + last:to + last])])
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int, keyed: bool = False) -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed long; ``keyed``: also ``key``, the hash of
    its text."""
    names = ["id", "fp", "key"] if keyed else ["id", "fp"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]], names)

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"),
                     *([_key(F.col(text_col))] if keyed else []))
    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _segments(max_bits: int) -> list[int]:
    """Bit masks (signed) of ``max_bits + 2`` runs of nearly equal width."""
    cuts = [64 * i // (max_bits + 2) for i in range(max_bits + 3)]
    masks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _buckets(fps: DataFrame, max_bits: int) -> DataFrame:
    """(key, fp): one row per pair of segments, keyed by their pivot coordinates."""
    signed = [p - (1 << 64) if p >> 63 else p for p in PIVOTS]
    masks = _segments(max_bits)
    bits = 4 if 64 // (max_bits + 2) < 15 else 7  # of one coordinate
    per_long = 64 // bits

    def coords(mask: int) -> list:
        far = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(p)).bitwiseAND(F.lit(mask))).cast("long") for p in signed]
        parts = [far[i:i + per_long] for i in range(0, len(far), per_long)]
        return [reduce(lambda a, b: F.shiftleft(a, bits).bitwiseOR(b), part) for part in parts]

    table = fps.select("fp", *[c.alias(f"s{i}_{j}") for i, m in enumerate(masks)
                               for j, c in enumerate(coords(m))])
    of = {i: [c for c in table.columns if c.startswith(f"s{i}_")] for i in range(len(masks))}
    keys = [F.xxhash64(F.lit(n), *of[i], *of[j])
            for n, (i, j) in enumerate(combinations(range(len(masks)), 2))]
    return table.select("fp", F.explode(F.array(*keys)).alias("key"))


def _far(fps: np.ndarray) -> np.ndarray:
    """Full pivot distances, one row per pivot."""
    return np.stack([np.bitwise_count(fps ^ np.uint64(p)) for p in PIVOTS]).astype(np.int8)


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links of a spanning forest of one bucket: a breadth-first walk over what is not yet reached."""
    far, links = _far(fps), []
    rest = np.arange(len(fps))
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = rest
            for row in far:
                near = near[np.abs(row[near] - row[at]) <= max_bits]
                if not len(near):
                    break
            near = near[np.bitwise_count(fps[near] ^ fps[at]) <= max_bits]
            if len(near):
                links.append((np.full(len(near), fps[at]), fps[near]))
                rest = rest[~np.isin(rest, near, assume_unique=True)]
                queue.extend(near)
    return links


def _links(group: np.ndarray, fps: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links within runs of equal ``group``."""
    cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
    sizes = np.diff(cuts)
    out = []
    for i in np.flatnonzero(sizes > _SMALL):
        out += _forest(np.unique(fps[cuts[i]:cuts[i + 1]]), max_bits)
    few = np.repeat(sizes <= _SMALL, sizes)
    far = _far(fps)
    left = np.flatnonzero(few[:-1] & (group[1:] == group[:-1]))
    for step in range(1, _SMALL):
        left = left[left + step < len(group)]
        left = left[group[left + step] == group[left]]
        if not len(left):
            break
        pairs = left
        for row in far:
            pairs = pairs[np.abs(row[pairs] - row[pairs + step]) <= max_bits]
        pairs = pairs[np.bitwise_count(fps[pairs] ^ fps[pairs + step]) <= max_bits]
        out.append((fps[pairs], fps[pairs + step]))
    return out


def links(fps: DataFrame, max_bits: int, tile: int = TILE) -> DataFrame:
    """(a, b): links between the distinct fingerprints of ``fps`` whose transitive closure is that
    of all pairs at ``max_bits`` or fewer differing bits."""
    rows = _buckets(fps, max_bits)
    # written, so that the join has a plain shuffle on both sides and AQE can split a large bucket
    sizes = saved(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    blocks = F.ceil(F.col("n") / F.lit(tile)).cast("int")
    placed = (rows.join(sizes, "key").withColumn("blocks", blocks)
                  .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")))
    # a block meets every block of its bucket once: blocks (i, j) form the group i * blocks + j
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiles = (placed.select("key", "fp", "block", "blocks", other.alias("other"))
                   .select("key", (F.least("block", "other") * F.col("blocks") + F.greatest("block", "other"))
                           .alias("tile"), "fp"))
    tiles = (tiles.select(F.xxhash64("key", "tile").alias("g"), "fp")
                  .repartition("g").sortWithinPartitions("g"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_g, held_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def found(pairs) -> pa.RecordBatch:
            a = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, np.uint64)
            b = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.uint64)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            g = np.concatenate([held_g, batch.column(0).to_numpy()])
            f = np.concatenate([held_f, batch.column(1).to_numpy().view(np.uint64)])
            whole = int(np.searchsorted(g, g[-1], "left")) if len(g) else 0  # the last group may go on
            held_g, held_f = g[whole:], f[whole:]
            if whole:
                yield found(_links(g[:whole], f[:whole], max_bits))
        if len(held_g):
            yield found(_links(held_g, held_f, max_bits))

    return tiles.mapInArrow(run, "a long, b long").distinct()


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                   max_bits: int = 4, tile: int = TILE) -> DataFrame:
    """One row per input row: ``id_col`` (long), ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest id reachable over links of ``max_bits`` or fewer differing
    bits, the row itself included.  Null and empty texts have fingerprint zero and link like any
    other; null ids never name a component (a component of null ids only has a null
    ``component_id``); repeated rows and ids give one row each; an empty table gives none; other
    columns are not read."""
    return (_named(fingerprints(df, id_col, text_col, shingle), max_bits, tile)
            .select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    "component_id"))


def _named(docs: DataFrame, max_bits: int, tile: int = TILE) -> DataFrame:
    """``docs`` (id, fp, other columns) with ``component_id``."""
    docs = checkpointed(docs)
    distinct = docs.groupBy("fp").agg(F.min("id").alias("least"))
    linked = components(links(distinct.select("fp"), max_bits, tile))
    linked = checkpointed(linked)
    members = linked.unionAll(linked.select(F.col("root").alias("node"), "root").distinct())
    named = saved(members.join(distinct, F.col("node") == F.col("fp")).select("fp", "root", "least"), "members")
    # the aggregated side of each join is written: AQE then splits the other side's hot keys
    names = saved(named.groupBy("root").agg(F.min("least").alias("name")), "names")
    named = named.join(names, "root").select("fp", "name")
    label = saved(distinct.join(named, "fp", "left")
                          .select("fp", F.coalesce("name", "least").alias("component_id")), "labels")
    return docs.join(label, "fp")


def simhash_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                  max_bits: int = 4) -> DataFrame:
    """The rows of ``df``, all columns, one document of each group: that with the smallest id.
    Rows are told apart by id and text: a repeated id loses only the texts whose group has a smaller
    id.  Rows of a group that share the kept id stay together; rows with a null id stay (they name no
    group)."""
    groups = _named(fingerprints(df, id_col, text_col, shingle, keyed=True), max_bits)
    gone, key = unique_name(df, "gone"), unique_name(df, "gone_key")
    lose = groups.where(F.col("id") != F.col("component_id")).select(F.col("id").alias(gone), F.col("key").alias(key))
    lose = saved(lose.distinct(), "gone")  # as above: AQE splits the rows of a repeated id and text
    same = (df[id_col].cast("long") == lose[gone]) & (_key(df[text_col]) == lose[key])
    return df.join(lose, same, "left_anti")
