from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewise.llm import spelling
from framewise.llm.queries import QUERIES
from framewise.llm.spelling import LETTERS, Regions, Tree, count_vectors, letter_codes, near_words, packed, spelling_variants


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def slow_near(counts):
    """Near words by shared patterns: a letter masked, or a letter less."""
    masks, cuts = defaultdict(set), defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            masks[w[:i] + "?" + w[i + 1:]].add(w)
            cuts[w[:i] + w[i + 1:]].add(w)
    near = defaultdict(set)
    for group in masks.values():
        for w in group:
            near[w] |= group - {w}
    for w in counts:
        for longer in cuts.get(w, ()):
            near[w].add(longer)
            near[longer].add(w)
    return near


def slow(rows, min_chars=7, min_count=2, factor=10, drop=31):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % drop == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= min_chars and n >= min_count}
    near = slow_near(counts)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= factor * n:
            form[w] = best
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return sorted(out)


def got(df, **kw):
    return sorted(tuple(r) for r in spelling_variants(df, **kw).select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("sample, leaf", [(1 << 16, 1 << 14), (500, 100)])
def test_whole_table(documents, sample, leaf):
    want = slow([(r.doc_id, r.text) for r in documents.collect()])
    rows = got(documents, sample=sample, leaf=leaf)
    assert rows == want and sum(w[4] for w in want) > 100 and any(w[1] for w in want)


def test_query(spark, sf_dir, documents):
    result = QUERIES["op11_spelling_variants"](spark, sf_dir)
    assert set(result.columns) == {"word", "form", "root", "n", "n_near", "form_n"}
    assert sorted(r.word for r in result.collect()) == [w[0] for w in slow([(r.doc_id, r.text) for r in documents.collect()])]


def test_chains_ties_and_odd_rows(docs_of, odd, empty):
    words = {"abcdefg": 1100, "abcdefh": 100, "abcdxfh": 10, "zzzzzzzz": 3, "zzzzzzz": 30, "zzzzzzy": 30, "gfedcba": 5, "straßenö": 2, "a" * 3000: 2, "a" * 3001: 40}
    rows = [(1, "\n".join(f"{w.upper() if i % 2 and w.isascii() else w}," for w, n in words.items() for i in range(n))), (None, "zzzzzzz ×zzzzzzz÷ 7abcdefg"), (2, None), (3, "")]
    for drop in (31, 1 << 40):
        assert got(docs_of(rows), drop=drop) == slow(rows, drop=drop)
    chain = {r[0]: r for r in got(docs_of(rows), drop=1 << 40)}
    assert chain["abcdxfh"][1:3] == ("abcdefh", "abcdefg") and chain["zzzzzzzz"][1] == "zzzzzzz"
    assert got(odd, min_chars=3) == slow([(r.doc_id, r.text) for r in odd.collect()], min_chars=3)
    assert got(empty) == []
    clash = docs_of(rows).select("doc_id", "text", *[F.lit(1).alias(c) for c in ("word", "n", "id", "leaf", "home")])
    assert got(clash) == slow(rows)


def test_equal_counts_in_parts(spark):
    """Words of equal letter counts cannot be cut apart; they are dealt in parts and still all meet."""
    rng = random.Random(4)
    words = {"".join(rng.sample("abcdefgh", 8)) for _ in range(900)} | {"".join(rng.sample("abcdefgh", 8)) + "h" for _ in range(300)}
    counts = {w: rng.randrange(1, 50) for w in words}
    rows = near_words(spark.createDataFrame(list(counts.items()), "word string, n long"), sample=1 << 16, leaf=100).collect()
    near = slow_near(counts)
    assert {r.word: r.n_near for r in rows} == {w: len(x) for w, x in near.items() if x}
    assert all(r.best == min(near[r.word], key=lambda x: (-counts[x], x)) and r.best_n == counts[r.best] for r in rows)


def test_trees_find_all_within_reach():
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdeé"), 9)) for _ in range(700)]
    vectors = count_vectors(letter_codes(words, 9))
    away = np.abs(np.minimum(vectors, 3).astype(int)[:, None] - vectors[None]).sum(axis=2)
    tree = Tree(vectors)
    for far in (1, 2):
        pairs = {(int(a), int(b)) for q, r in tree.near(packed(vectors), far) for a, b in zip(q, r)}
        assert pairs == set(zip(*(x.tolist() for x in np.nonzero(away <= far))))
    regions = Regions.cut(vectors, 1.0, leaf=50)
    assert len(regions.parts) > 8
    home = np.zeros(len(words), int) - 1
    for leaf, at in regions.reach(vectors, 0):
        assert (home[at] == -1).all()
        home[at] = leaf
    assert (home >= 0).all()
    sent = {(leaf, int(i)) for leaf, at in regions.reach(vectors, 2) for i in at}
    assert all((home[j], i) in sent for i, j in zip(*(x.tolist() for x in np.nonzero(away <= 2))))


def test_letter_order():
    words = ["abcdefg", "abcdefh", "abcdegf", "bacdefg", "gabcdef", "abcdeff", "aaaaaaa"]
    for a in words:
        for b in [*words, *[w[:i] + c + w[i:] for w in words for i in range(8) for c in "axg"]]:
            x, y = letter_codes([a], 7), letter_codes([b], len(b))
            same = spelling._one_replaced(x, y) if len(b) == 7 else spelling._one_inserted(x, y)
            assert bool(same[0]) == one_edit(a, b), (a, b)
    assert len(LETTERS) == 90
