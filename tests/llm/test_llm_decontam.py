from __future__ import annotations

import re

from pyspark.sql import functions as F

from framewise.llm import decontam

WORD = "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def slow(doc, items, width=13):
    w, hit, found = words(doc), set(), set()
    for item, text in items:
        t = words(text)
        n = min(width, len(t))
        for i in range(max(1, len(t) - width + 1) if t else 0):
            for at in range(len(w) - n + 1):
                if w[at:at + n] == t[i:i + n]:
                    hit |= set(range(at, at + n))
                    found.add(item)
    return len(w), len(hit), sorted(str(f) for f in found if f is not None)


ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"),
         (2, "alpha beta"), (3, ""), (4, None), (10, "the"), (None, "zeta eta"), (1, "gamma delta"), (5, "the the the")]
DOCS = [(1, "x One TWO three four five six seven eight nine ten eleven twelve thirteen y"), (2, "alpha, beta! alpha beta"),
        (3, "the the the the"), (4, "zeta eta theta"), (5, None), (6, ""), (7, "clean text of no concern"),
        (7, "gamma-delta"), (None, "alpha"), (8, "one two three four five six seven eight nine ten eleven twelve thirteen "
        "fourteen fifteen sixteen one two"), (9, "beta alpha"), (10, "alpha"), (11, "beta")]


def test_matches_equal_plain_search(spark, docs_of):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for slice_bytes in (1 << 20, 40):  # one slice and several
        got = decontam.contamination(docs_of(DOCS), items, item_bytes=slice_bytes).collect()
        have = sorted((str(r.id), r.n_words, r.n_hit, tuple(r["items"])) for r in got)
        want = sorted((str(d), *slow(t, ITEMS)[:2], tuple(slow(t, ITEMS)[2])) for d, t in DOCS)
        assert have == want
        for r in got:
            assert r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words)


def test_documents_equal_plain_search(documents, spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    lists = [(r.item_id, r.text) for r in items.limit(12).collect()]
    some = spark.createDataFrame(lists, "item_id long, text string")
    got = {r.id: r for r in decontam.contamination(documents, some).collect()}
    for r in documents.limit(60).collect():
        n, hit, found = slow(r.text, lists)
        g = got[str(r.doc_id)]
        assert (g.n_words, g.n_hit, g["items"]) == (n, hit, found)


def test_proximity(spark, docs_of):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = docs_of([(1, "gamma x beta y alpha"), (2, "alpha " + "x " * 9 + "beta gamma"), (3, "alpha beta"), (4, "alpha beta gamma")])
    index = decontam.build_index(docs)
    got = {r.id: list(r["items"]) for r in decontam.find_items(index, items, near=4).collect()}
    assert got == {"1": ["1"], "2": [], "3": [], "4": ["1"]}


def test_decontaminate_drops_and_keeps(odd, empty, spark):
    items = spark.createDataFrame([(1, "long text of some words long text of some words"), (2, None)], "item_id long, text string")
    kept = decontam.decontaminate(odd.withColumnRenamed("lang", "bad_id"), items)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 5, 7, 8]
    none = items.where(F.lit(False))
    assert decontam.contamination(odd, none).where("contaminated").count() == 0
    assert decontam.contamination(odd, none).count() == odd.count()
    assert decontam.contamination(empty, items).count() == 0


def test_clean_rows_of_a_null_or_repeated_id_stay(docs_of, spark):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    rows = [(None, "alpha beta gamma"), (None, "clean words"), (None, None), (None, "clean words"), (3, "alpha beta gamma"),
            (3, "other clean words"), (3, "alpha beta gamma"), (4, "more clean words")]
    kept = [(r.doc_id, r.text) for r in decontam.decontaminate(docs_of(rows), items).collect()]
    assert sorted(kept, key=repr) == sorted((r for r in rows if "alpha" not in (r[1] or "")), key=repr)
