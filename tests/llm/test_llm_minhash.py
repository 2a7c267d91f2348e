from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from framewise.llm import minhash
from framewise.llm.minhash import Plan, minhash_dedup, minhash_groups, shingle_sets


def plain_set(text, shingle):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").encode().lower().decode())
    if len(words) < shingle:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + shingle]) for i in range(len(words) - shingle + 1)}


def slow(rows, shingle, percent):
    """(id, size, component) of every row, by all pairs."""
    sets = [plain_set(t, shingle) for _, t in rows]
    name = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                old, new = max(name[i], name[j]), min(name[i], name[j])
                name = [new if n == old else n for n in name]
    least = {n: min((rows[k][0] for k in range(len(rows)) if name[k] == n and rows[k][0] is not None), default=None) for n in set(name)}
    return sorted(((d, len(s), d if not s else least[n]) for (d, _), s, n in zip(rows, sets, name)), key=repr)


def got(df, **kw):
    rows = minhash_groups(df, **kw).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr)


def made(seed=3):
    """Families of texts around the threshold, so that bridges and near misses are frequent."""
    rng = np.random.default_rng(seed)
    rows = []
    for family in range(6):
        base = [f"w{family}x{i}" for i in rng.integers(0, 400, 120)]
        for _ in range(12):
            words = list(base)
            for at in rng.integers(0, len(words), rng.integers(0, 7)):
                words[at] = f"new{rng.integers(0, 30)}"
            rows.append((int(rng.integers(0, 10_000)) * 100 + len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize("block, rows", [(minhash.BLOCK, minhash.BLOCK_ROWS), (400, 3)])
def test_equals_all_pairs(docs_of, monkeypatch, block, rows):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "BLOCK_ROWS", rows)
    made_rows = made()
    assert got(docs_of(made_rows), shingle=3, percent=85) == slow(made_rows, 3, 85)


def test_block_counts_are_exact():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(60)]
    roots, centre = rng.integers(0, 40, 60), np.unique(rng.integers(0, 60, 40).astype(np.uint64))
    common = np.array([len(np.intersect1d(s, centre)) for s in sets])
    sizes = np.array([len(s) for s in sets])
    forest = minhash.links_among([np.setxor1d(s, centre) for s in sets], sizes, common, len(centre), roots, 25)
    all_pairs = [(i, j) for i in range(60) for j in range(i) if roots[i] != roots[j]
                 and 4 * len(np.intersect1d(sets[i], sets[j])) >= len(np.union1d(sets[i], sets[j]))]

    def groups(pairs):
        name = list(range(60))
        for i, j in pairs:
            old, new = max(name[i], name[j]), min(name[i], name[j])
            name = [new if x == old else x for x in name]
        return name

    assert groups(forest) == groups(all_pairs) and len(forest) < 60 < len(all_pairs)


def test_odd_rows(odd, empty, docs_of):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(odd, shingle=3, percent=85) == slow(rows, 3, 85)
    assert got(empty) == []
    clash = odd.select("doc_id", "text", *[F.lit(1).alias(c) for c in ("id", "node", "size", "root", "component_id", "kept", "lost")])
    assert got(clash, shingle=3, percent=85) == slow(rows, 3, 85)
    kept = minhash_dedup(clash, shingle=3, percent=85)
    assert kept.columns == clash.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 7, 8, 9]
    assert minhash_dedup(empty).count() == 0
    same = docs_of([(None, "a b c d"), (None, "a b c d"), (6, "x y z"), (6, "a b c d"), (5, "A b c D")])
    assert got(same, shingle=3, percent=85) == [(5, 2, 5), (6, 1, 6), (6, 2, 5), (None, 2, 5), (None, 2, 5)]
    assert sorted((r.doc_id, r.text) for r in minhash_dedup(same, shingle=3, percent=85).collect()) == [(5, "A b c D"), (6, "x y z")]


def test_large_group_of_near_copies(docs_of, monkeypatch):
    """A hot bucket is not expanded into pairs: copies meet their centre, and what is far from it meets in
    blocks that report links only."""
    counts = {"rays": 0, "rest": 0}
    first, rest = minhash._rays, minhash._rest

    def rays(stars, sets, percent):
        counts["rays"] += stars.count()
        return first(stars, sets, percent)

    def blocks(rows, percent):
        out = rest(rows, percent)
        counts["rest"] += out.count()
        return out

    monkeypatch.setattr(minhash, "_rays", rays)
    monkeypatch.setattr(minhash, "_rest", blocks)
    rng = np.random.default_rng(1)
    base = [f"word{i}" for i in range(200)]
    rows = []
    for i in range(600):
        words = list(base)
        for at in rng.integers(0, 200, 1 + i % 12):  # from one edit, linked, to twelve, far from every other copy
            words[at] = f"own{i}x{at}"
        rows.append((i, " ".join(words)))
    assert got(docs_of(rows), shingle=3, percent=85) == slow(rows, 3, 85)
    assert counts["rays"] < 20 * len(rows) and counts["rest"] < len(rows)


def test_plan():
    plan = Plan.of(3, 85)
    assert plan.bands == 9 and 2 * (1 - 0.85 ** 2) ** plan.bands < 1e-4
    assert Plan.of(5, 80).bands > plan.bands and Plan.of(5, 100).bands == 1


def test_sets():
    texts = ["A b c d", "a B\tc  d", "a b", None, "", "a b c d a b c d"]
    sets = list(shingle_sets(pa.array(texts), 3))
    assert [len(s) for s in sets] == [2, 2, 1, 0, 0, 4] and (sets[0] == sets[1]).all()
