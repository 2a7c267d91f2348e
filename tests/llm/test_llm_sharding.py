from __future__ import annotations

import random
import zlib

import pytest

from framewise.llm import sharding


def least_capacity(weights, shards):
    def fits(capacity):
        used, room = 0, 0
        for w in weights:
            if w > capacity:
                return False
            if w > room:
                used, room = used + 1, capacity
            room -= w
        return used <= shards
    low, high = 0, sum(weights)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def check(rows, originals, shards):
    assert len(rows) == len(originals)
    texts = {}
    for r in rows:
        texts.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    assert all(len(s) == 1 for s in texts.values())
    for s in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert all(0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None for r in rows)


def test_documents(documents):
    rows = sharding.shard_documents(documents).collect()
    originals = {r.doc_id: r.text for r in documents.collect()}
    check(rows, originals, 16)
    for r in rows:
        raw = (originals[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    import hashlib
    groups = {}
    for t in originals.values():
        raw = (t or "").encode()
        h = hashlib.sha256(raw).hexdigest()
        groups[h] = groups.get(h, 0) + len(raw) + 1
    best = least_capacity([groups[h] for h in sorted(groups)], 16)
    loads = [0] * 16
    for r in rows:
        loads[r.shard] += r.size
    assert max(loads) == best


@pytest.mark.parametrize("n,shards,top", [(1, 4, 10), (3, 16, 9), (5000, 7, 30), (20_000, 16, 100_000)])
def test_capacity_is_the_smallest(spark, n, shards, top):
    import hashlib
    rnd = random.Random(n)
    rows = sorted((hashlib.sha256(str(i).encode()).hexdigest(), rnd.randrange(1, top)) for i in range(n))
    df = spark.createDataFrame(rows, "h string, w long")
    capacity, begins = sharding.minimax_cuts(df, shards)
    assert capacity == least_capacity([w for _, w in rows], shards)
    loads = [0] * shards
    for h, w in rows:
        loads[sum(h >= b for b in begins)] += w
    assert max(loads) == capacity


def test_blocks_that_share_long_prefixes(spark):
    rnd = random.Random(8)
    rows = sorted({("ab" * 3 + "%058x" % rnd.getrandbits(232)): rnd.randrange(1, 50) for _ in range(4000)}.items())
    capacity, _ = sharding.minimax_cuts(spark.createDataFrame(rows, "h string, w long"), 16)
    assert capacity == least_capacity([w for _, w in rows], 16)


def test_odd_rows(odd, empty):
    rows = sharding.shard_documents(odd).collect()
    check(rows, [None] * odd.count(), 16)
    assert {r.size for r in rows if r.doc_id in (1, 2)} == {1}
    assert sharding.shard_documents(empty).count() == 0
    clash = odd.withColumnsRenamed({"lang": "h", "source": "shard", "n_chars": "slot"})
    assert sharding.shard_documents(clash).count() == odd.count()


def test_repeated_rows_are_dealt_to_all_parts(spark, monkeypatch):
    """Half of the rows are one id and text: the numbering of slots spreads them over many groups."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(sharding, "_SLOT_ROWS", 50)
    rows = spark.range(4000).selectExpr("if(id % 2 = 0, 0, id) as doc_id", "if(id % 2 = 0, 'the same', concat('text ', id)) as text")
    parts = []
    window = sharding.Window.partitionBy

    def seen(*cols):
        parts.append(cols)
        return window(*cols)

    monkeypatch.setattr(sharding.Window, "partitionBy", seen)
    placed = sharding.shard_documents(rows, shards=4)
    assert ("shard", "part") in parts
    got = placed.collect()
    hot = [r for r in got if r.doc_id == 0]
    assert len(hot) == 2000 and len({r.shard for r in hot}) == 1
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    # the hot rows' slots are spread over their whole shard, not one run of it
    slots = sorted(r.slot for r in hot)
    total = sum(r.shard == hot[0].shard for r in got)
    assert total == 2000 or slots[-1] - slots[0] > 2000
    numbered = placed.select(F.col("doc_id")).count()
    assert numbered == 4000
