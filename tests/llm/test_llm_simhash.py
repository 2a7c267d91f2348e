from __future__ import annotations

import random

import numpy as np
import xxhash

from framewise.llm import simhash
from framewise.llm.components import components


def slow_fingerprint(text, k=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(fps: dict, bits: int) -> dict:
    root = {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(fps)
    for i in ids:
        for j in ids:
            if j > i and (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_fingerprint_equals_plain_definition(documents):
    texts = [r.text for r in documents.select("text").limit(60).collect()]
    for text in [*texts, "", None, "a b", "A  b\tc\nd e", "é È x y z"]:
        assert simhash.fingerprint(None if text is None else text.encode(), 4) == slow_fingerprint(text)


def test_groups_equal_all_pairs(documents):
    rows = documents.select("doc_id", "text").collect()
    want = slow_groups({r.doc_id: slow_fingerprint(r.text) for r in rows}, 4)
    got = {r.doc_id: r.component_id for r in simhash.simhash_groups(documents).collect()}
    assert got == want


def test_links_of_a_crowded_bucket_in_tiles(spark):
    rnd = random.Random(5)
    base = [rnd.getrandbits(64) for _ in range(30)]
    fps = {b for x in base for _ in range(40) for b in [x ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randrange(4)))
                                                        & (2**64 - 1)]}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = simhash.links(df, 4, tile=16)
    got = {r.node: r.root for r in components(edges).collect()}
    arr = {f: f & (2**64 - 1) for f in signed}
    assert {f: got.get(f, f) for f in signed} == slow_groups(arr, 4)


def test_forest_keeps_the_closure():
    rng = np.random.default_rng(1)
    fps = np.unique(rng.integers(0, 2**63, 4, np.uint64)[rng.integers(0, 4, 300)] ^ (np.uint64(1) << rng.integers(0, 12, 300).astype(np.uint64)))
    pairs = simhash._forest(fps, 4)
    assert sum(len(a) for a, _ in pairs) < len(fps)
    root = slow_groups({int(f): int(f) for f in fps}, 4)
    for a, b in pairs:
        assert all(root[int(x)] == root[int(y)] for x, y in zip(a, b))


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)}


def test_odd_rows(odd, empty):
    rows = simhash.simhash_groups(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].fingerprint == "0" * 16 and by[1].component_id == by[2].component_id == by[3].component_id == 1
    assert by[5].component_id == by[None].component_id == 4
    assert simhash.simhash_groups(empty).count() == 0
    kept = sorted(r.doc_id for r in simhash.simhash_dedup(odd).where("doc_id is not null").collect())
    assert kept == [1, 4, 7, 8, 9]


def test_clashing_column_names(odd):
    df = odd.withColumnsRenamed({"lang": "fp", "source": "component_id", "n_chars": "gone"})
    assert simhash.simhash_dedup(df).columns == df.columns
    assert simhash.simhash_groups(df).count() == df.count()


def test_unique_texts_of_a_repeated_id_stay(docs_of):
    twin, own = "one text that two ids hold " * 3, "another text with words of its own kind " * 3
    rows = [(1, twin), (5, twin), (5, own), (5, twin), (6, None), (5, ""), (None, twin)]
    kept = [(r.doc_id, r.text) for r in simhash.simhash_dedup(docs_of(rows)).collect()]
    assert sorted(kept, key=repr) == sorted([(1, twin), (5, own), (5, ""), (None, twin)], key=repr)
