"""MinHash near-duplicates with tensored banding.

1. Every text becomes the set of the 64-bit hashes of its word shingles; equal sets are one class
   from here on.
2. Two collections of ``bands`` half keys, each made of ``ROWS`` minhashes, give ``bands ** 2`` table
   keys: every pair of a half key of one collection with one of the other.  ``2 * ROWS * bands``
   minhashes thus do the work of ``2 * ROWS * bands ** 2``.  A pair at the threshold misses all
   tables only if it misses a whole collection; ``bands`` is the least number that keeps the chance
   of either below ``MISS``.
3. A bucket is not expanded into pairs.  Its centre is the member that meets the most others in all
   tables; the star of a centre holds all members of its buckets.  Members first meet their centre.
   Where a star is then not one component, its rows meet in blocks (every pair of blocks its own
   group), each with only what it differs in from the centre.  A block counts all intersections as
   matrix products and reports a spanning forest of the links, never the pairs.  Blocks of rows that are linked to the centre already do not meet.
4. Every link is confirmed on the full sets; components of the links give the smallest id.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, unique_name
from .components import components
from .words import hash_words, mix

ROWS = 2            # minhashes of a half key
MISS = 1e-5         # chance that a pair at the threshold misses one collection of half keys
BLOCK = 1 << 18     # set members of a block, about
BLOCK_ROWS = 512    # rows of a block, about
_COLUMNS = 1 << 13  # set members counted at a time
_PIECE = 1 << 22    # bytes of text hashed at a time
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Plan(NamedTuple):
    """Sizes that follow from the threshold."""
    shingle: int
    percent: int
    bands: int
    agree: int  # minhashes that a pair at the threshold shares, but for a chance of one in a million

    @classmethod
    def of(cls, shingle: int, percent: int) -> Plan:
        share = percent / 100
        bands = math.ceil(math.log(MISS) / math.log(1 - share ** ROWS)) if share < 1 else 1
        n, total, agree = 2 * ROWS * bands, 0.0, 0
        while total < 1e-6 and share < 1:
            total += math.comb(n, agree) * share ** agree * (1 - share) ** (n - agree)
            agree += 1
        return cls(shingle, percent, bands, max(0, agree - 1))


def shingle_sets(column: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its ``shingle``-word sequences (fewer words: the
    whole sequence; none: an empty set).  A-Z is lower-cased, words stand between ASCII white space."""
    column = column.cast(pa.large_binary())
    sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(sizes) // _PIECE
    cuts = np.r_[0, np.flatnonzero(np.diff(piece)) + 1, len(column)] if len(column) else [0, 0]
    for lo, hi in zip(cuts, cuts[1:]):
        words = hash_words(column.slice(lo, hi - lo))
        h = words.hashes
        joined = np.zeros(max(0, len(h) - shingle + 1), np.uint64)
        for i in range(shingle):
            joined = joined * _STEP + h[i:len(h) - shingle + 1 + i]
        joined = mix(joined)
        for a, b in zip(words.bounds, words.bounds[1:]):
            if b - a >= shingle:
                yield np.unique(joined[a:b - shingle + 1])
            elif b > a:
                whole = np.array([b - a], np.uint64)
                for x in h[a:b]:
                    whole = whole * _STEP + x
                yield mix(whole)
            else:
                yield np.zeros(0, np.uint64)


def _minhashes(sets: list[np.ndarray], n: int) -> np.ndarray:
    """``n`` minhashes of each (non-empty) set, one row per set."""
    factors = mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.empty((len(sets), n), np.uint64)
    sizes = np.array([len(s) for s in sets])
    piece = np.cumsum(sizes) // (1 << 18)
    cuts = np.r_[0, np.flatnonzero(np.diff(piece)) + 1, len(sets)]
    for lo, hi in zip(cuts, cuts[1:]):
        values = np.concatenate(sets[lo:hi])
        starts = np.cumsum(sizes[lo:hi]) - sizes[lo:hi]
        for i, factor in enumerate(factors):
            out[lo:hi, i] = np.minimum.reduceat(values * factor, starts)
    return out


_SIGNATURE = "id long, text_key long, size long, digest binary, half array<long>, marks array<int>"


def signatures(df: DataFrame, id_col: str, text_col: str, plan: Plan) -> DataFrame:
    """(id, text_key, size, digest, half, marks): one row per row of ``df``; ``half`` holds the half keys of
    both collections, ``marks`` 16 bits of each minhash.  Texts without words have size 0."""
    n = 2 * ROWS * plan.bands

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column(2), plan.shingle))
            sizes = np.array([len(s) for s in sets], np.int64)
            half = np.zeros((len(sets), 2 * plan.bands), np.uint64)
            marks = np.zeros((len(sets), n), np.int32)
            full = np.flatnonzero(sizes)
            if len(full):
                low = _minhashes([sets[i] for i in full], n)
                marks[full] = (mix(low) & np.uint64(0xFFFF)).astype(np.int32)
                keys = np.zeros((len(full), 2 * plan.bands), np.uint64)
                for i in range(ROWS):
                    keys = mix(keys * _STEP + low[:, i::ROWS])
                half[full] = keys
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.array(list(half.view(np.int64)), pa.list_(pa.int64())), pa.array(list(marks), pa.list_(pa.int32()))],
                ["id", "text_key", "size", "digest", "half", "marks"])

    return _rows(df, id_col, text_col).mapInArrow(run, _SIGNATURE)


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_key"),
                     text.cast("binary").alias("text"))


def _stars(classes: DataFrame, plan: Plan) -> DataFrame:
    """(centre, rank, node): the members of every star, the centre included; ``rank`` puts the centres that
    meet more others first.  A star of two is left out where their minhashes rule a link out."""
    pairs = [(i, j) for i in range(plan.bands) for j in range(plan.bands)]
    keys = F.array(*[F.xxhash64(F.lit(n), F.col("half")[i], F.col("half")[plan.bands + j])
                     for n, (i, j) in enumerate(pairs)])
    rows = classes.select("node", F.explode(keys).alias("key"))
    # written, so that the join has a plain shuffle on both sides and AQE can split a large bucket
    shared = saved(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    members = saved(rows.join(shared, "key"), "bucket-rows")
    degree = saved(members.groupBy("node").agg((-F.sum("n")).alias("rank")), "degrees")
    centre = members.join(degree, "node").groupBy("key").agg(F.min(F.struct("rank", "node")).alias("c"))
    centre = saved(centre.select("key", F.col("c.node").alias("centre"), F.col("c.rank").alias("rank")), "centres")
    stars = saved(members.join(centre, "key").select("centre", "rank", "node").distinct(), "stars")

    size = saved(stars.groupBy("centre").agg(F.count(F.lit(1)).alias("n"), F.max("node").alias("hi"), F.min("node").alias("lo")), "star-sizes")
    marks = classes.select("node", "marks")
    two = size.where("n = 2").join(marks.withColumnsRenamed({"node": "hi", "marks": "hi_marks"}), "hi") \
              .join(marks.withColumnsRenamed({"node": "lo", "marks": "lo_marks"}), "lo")
    agree = F.size(F.filter(F.zip_with("hi_marks", "lo_marks", lambda x, y: x == y), lambda same: same))
    hopeless = saved(two.where(agree < plan.agree).select("centre"), "far-stars")
    return saved(stars.join(hopeless, "centre", "left_anti"), "near-stars")


def _sets(df: DataFrame, id_col: str, text_col: str, classes: DataFrame, stars: DataFrame, plan: Plan) -> DataFrame:
    """(node, hashes): the full set of every class in a star, from the text of its first document."""
    wanted = classes.join(stars.select("node").distinct(), "node", "left_semi")
    wanted = saved(wanted.select("node", F.col("first.id").alias("own"), F.col("first.text_key").alias("own_key")), "wanted")
    rows = _rows(df, id_col, text_col)
    # the classes in stars grow with the input, so they are not broadcast: one plan at every size
    texts = rows.join(wanted.hint("merge"), (rows["text_key"] == wanted["own_key"]) & rows["id"].eqNullSafe(wanted["own"]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets(batch.column(1), plan.shingle)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "hashes"])

    sets = texts.select("node", "text").mapInArrow(run, "node long, hashes binary")
    return saved(sets.groupBy("node").agg(F.first("hashes").alias("hashes")), "sets")


_RAY = "centre long, node long, rank long, size long, centre_size long, common long, linked boolean, diff binary"


def _rays(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(centre, node, rank, size, centre_size, common, linked, diff): every member beside its centre, on
    the full sets.  ``diff`` is what only one of the two has; from it and ``common`` follow the
    intersections of all members (see ``links_among``)."""
    both = stars.join(sets.select(F.col("node").alias("centre"), F.col("hashes").alias("set_a")), "centre") \
                .join(sets.select("node", F.col("hashes").alias("set_b")), "node")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y in zip(batch.column(3), batch.column(4)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                diff = np.setxor1d(x, y, assume_unique=True)
                common = (len(x) + len(y) - len(diff)) // 2
                out.append((len(y), len(x), common, 100 * common >= percent * (len(x) + len(y) - common), diff.tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            columns = [pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 5, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], [f.split()[0] for f in _RAY.split(", ")])

    return saved(both.select("centre", "node", "rank", "set_a", "set_b").mapInArrow(run, _RAY), "rays")


def _open_rows(rays: DataFrame) -> DataFrame:
    """(centre, node, root, size, centre_size, common, diff, linked, blocks, other_blocks, block): the members
    of the stars that are not one component.  Equal roots are linked (the converse is not needed: it only
    saves tests).  ``linked`` members have their centre's root; their blocks come after the others'."""
    # a centre outranks the members of its buckets, so the first centre of a node leads upwards
    links = rays.where("linked and node <> centre")
    up = saved(links.groupBy("node").agg(F.min(F.struct("rank", "centre")).alias("c")).select("node", F.col("c.centre").alias("root")), "up")
    for _ in range(2):
        further = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
        up = saved(up.join(further, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "up")
    rooted = rays.join(up, "node", "left").withColumn("root", F.coalesce("root", "node"))
    weight = F.col("size") + F.col("centre_size") - 2 * F.col("common")  # members of diff
    light = saved(rooted.select("centre", "node", "root", weight.alias("weight")), "rooted")
    whole = light.groupBy("centre").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n"),
                                        F.max(F.when(F.col("centre") == F.col("node"), F.col("root"))).alias("centre_root"))
    unsettled = saved(whole.where("lo < hi and n > 2").select("centre", "centre_root"), "open")
    light = light.join(unsettled, "centre").withColumn("linked", F.col("root") == F.col("centre_root"))

    def blocks(linked: bool):
        own = F.col("linked") == F.lit(linked)
        return F.greatest(F.ceil(F.sum(F.when(own, F.col("weight")).otherwise(0)) / F.lit(BLOCK)),
                          F.ceil(F.count(F.when(own, 1)) / F.lit(BLOCK_ROWS))).cast("int")

    counts = light.groupBy("centre", "centre_root").agg(blocks(False).alias("other_blocks"), blocks(True).alias("linked_blocks"))
    rows = rooted.join(saved(counts, "block-counts"), "centre").withColumn("linked", F.col("root") == F.col("centre_root"))
    at = F.xxhash64("node")
    block = F.when(F.col("linked"), F.col("other_blocks") + F.pmod(at, F.col("linked_blocks"))).otherwise(F.pmod(at, F.col("other_blocks")))
    return rows.select("centre", "node", "root", "size", "centre_size", "common", "diff", "linked", "other_blocks",
                       (F.col("other_blocks") + F.col("linked_blocks")).alias("blocks"), block.cast("int").alias("block"))


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest of a symmetric matrix of links."""
    left, out = np.ones(len(linked), bool), []
    for first in range(len(linked)):
        if not left[first]:
            continue
        left[first] = False
        queue = [first]
        while queue:
            at = queue.pop()
            new = np.flatnonzero(linked[at] & left)
            left[new] = False
            out += [(at, int(i)) for i in new]
            queue += new.tolist()
    return out


def links_among(diffs: list[np.ndarray], sizes: np.ndarray, common: np.ndarray, centre_size: int, roots: np.ndarray,
                percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between members of different roots.

    ``diffs``: members of the symmetric difference with the centre, ``common``: size of the intersection
    with it.  What two rows both lack of the centre, and both have beside it, is the intersection of
    their diffs, so their own intersection is ``common_x + common_y - centre_size + |diff_x & diff_y|``."""
    _, column, times = np.unique(np.concatenate(diffs), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(diffs)), [len(d) for d in diffs])
    shared = times[column] > 1
    row, column = row[shared], column[shared]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    column = np.cumsum(np.r_[0, np.diff(column) != 0]) if len(column) else column
    both = (common[:, None] + common[None] - centre_size).astype(np.float64)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        a, b = np.searchsorted(column, (lo, lo + _COLUMNS))
        part = np.zeros((len(diffs), _COLUMNS), np.float32)
        part[row[a:b], column[a:b] - lo] = 1
        both += part @ part.T
    linked = 100 * both >= percent * (sizes[:, None] + sizes[None] - both)
    return _forest(linked & (roots[:, None] != roots[None]))


def _rest(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): links inside the open stars, found block against block."""
    # an open block meets every block, a linked one the open blocks: blocks i <= j form the group (i, j)
    partner = F.explode(F.sequence(F.lit(0), F.when(F.col("linked"), F.col("other_blocks")).otherwise(F.col("blocks")) - 1))
    group = F.xxhash64("centre", F.least("block", "partner"), F.greatest("block", "partner"))
    tiles = rows.withColumn("partner", partner).select(group.alias("g"), "node", "root", "size", "centre_size", "common", "diff")
    tiles = tiles.repartition("g").sortWithinPartitions("g")

    def found(rows: list[tuple]) -> pa.RecordBatch:
        nodes, roots, sizes, centre, common = (np.array(c, np.int64) for c in list(zip(*rows))[:5])
        pairs = links_among([np.frombuffer(r[5], np.uint64) for r in rows], sizes, common, int(centre[0]), roots, percent)
        a, b = nodes[[i for i, _ in pairs]], nodes[[j for _, j in pairs]]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], ["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for g, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if g != now and held:
                    if len(held) > 1:
                        yield found(held)
                    held = []
                now = g
                held.append(row)
        if len(held) > 1:
            yield found(held)

    return tiles.mapInArrow(run, "a long, b long").distinct()


def _links(df: DataFrame, id_col: str, text_col: str, classes: DataFrame, plan: Plan) -> DataFrame | None:
    """(a, b): links between classes whose transitive closure is that of all pairs at the threshold; None
    where no two classes share a bucket."""
    stars = _stars(classes, plan)
    if not stars.take(1):
        return None
    sets = _sets(df, id_col, text_col, classes, stars, plan)
    rays = _rays(stars, sets, plan.percent)
    links = rays.where("linked and node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b"))
    return links.unionAll(saved(_rest(_open_rows(rays), plan.percent), "rest"))


def minhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: ``id_col`` (long), ``n_shingles``, ``component_id``, ``kept``.

    Two texts are linked if their sets of ``shingle``-word sequences have ``percent`` hundredths of
    their union in common; ``component_id`` is the smallest id reachable over links, the row itself
    included, and ``kept`` says that it is the row's own.  Null and empty texts, and those of white
    space only, have an empty set and no link: they keep their own id.  Repeated rows and ids give
    one row each.  Null ids name no component: a component of null ids only has a null
    ``component_id`` and is kept.  An empty table gives none; other columns are not read.

    Sets are compared by 64-bit hashes of their sequences, classes by 128 bits of their sets."""
    named = _named(df, id_col, text_col, Plan.of(shingle, percent))
    return named.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), "component_id",
                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _named(df: DataFrame, id_col: str, text_col: str, plan: Plan) -> DataFrame:
    """(id, text_key, size, component_id): one row per row of ``df``."""
    docs = saved(signatures(df, id_col, text_col, plan), "minhashes")
    one = docs.where("size > 0").groupBy("digest").agg(
        F.min("id").alias("least"), F.min(F.struct("id", "text_key")).alias("first"), F.first("size").alias("size"),
        F.first("half").alias("half"), F.first("marks").alias("marks"))
    classes = saved(one.withColumn("node", F.monotonically_increasing_id()), "classes")
    edges = _links(df, id_col, text_col, classes, plan)
    named = classes.select("node", "digest", "least")
    if edges is not None:
        roots = saved(components(edges), "roots")
        rooted = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        names = saved(rooted.groupBy("root").agg(F.min("least").alias("name")), "names")
        named = rooted.join(names, "root").select("digest", F.col("name").alias("least"))
    # the aggregated side of the join is written: AQE then splits the rows of a hot class
    label = saved(named.select("digest", F.col("least").alias("component_id")), "labels")
    rows = docs.select("id", "text_key", "size", "digest")
    alone = rows.where("size = 0").select("id", "text_key", "size", F.col("id").alias("component_id"))
    return rows.where("size > 0").join(label, "digest").select(*alone.columns).unionAll(alone)


def minhash_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                  percent: int = 80) -> DataFrame:
    """The rows of ``df``, all columns, of one document of each group: that with the smallest id.
    Rows are told apart by id and text: a repeated id loses only the texts whose group has a smaller
    id.  Rows with a null id go where their group has an id."""
    named = _named(df, id_col, text_col, Plan.of(shingle, percent))
    own, key = unique_name(df, "lost"), unique_name(df, "lost_key")
    lost = named.where(~F.col("id").eqNullSafe(F.col("component_id"))).select(F.col("id").alias(own), F.col("text_key").alias(key))
    lost = saved(lost.distinct(), "lost")  # as above: AQE splits the rows of a repeated id and text
    same = df[id_col].cast("long").eqNullSafe(lost[own]) & (F.xxhash64(F.coalesce(df[text_col], F.lit(""))) == lost[key])
    return df.join(lost, same, "left_anti")
