from __future__ import annotations

from collections import Counter

import numpy as np

from framewise.llm.lines import CountTable, dedup_lines

STRIP = " \t\n\x0b\x0c\r"


def slow(rows, min_docs, min_chars):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(STRIP))
    held = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        drop = [len(key(x)) >= min_chars and held[key(x)] >= min_docs for x in lines]
        out.append((d, len(lines), sum(drop), "\n".join(x for x, k in zip(lines, drop) if not k)))
    return sorted(out, key=repr)


def got(df, **kw):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in dedup_lines(df, **kw).collect()), key=repr)


def test_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    for min_docs, min_chars, shard in ((10, 1, 1 << 17), (2, 5, 50)):
        assert got(documents, min_docs=min_docs, min_chars=min_chars, shard_lines=shard) == slow(rows, min_docs, min_chars)


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(odd, min_docs=2) == slow(rows, 2, 1)
    assert dedup_lines(empty).count() == 0


def test_names_and_trailing_newlines(docs_of):
    df = docs_of([(i, "Shared \n x%d\n\n" % i) for i in range(12)]).withColumnsRenamed({"lang": "drop", "n_chars": "N_LINES"})
    rows = dedup_lines(df).collect()
    assert all(r.text == f" x{r.doc_id}\n\n" and r.n_dropped == 1 and r.n_lines == 4 for r in rows)
    assert dedup_lines(df).columns == ["doc_id", "text", "drop", "source", "n_lines", "n_dropped"]


def test_count_table_is_perfect_and_minimal():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(1, 2**64, 20_000, np.uint64))
    counts = rng.integers(1, 1000, len(keys))
    table = CountTable(keys, counts)
    index, found = table._index(keys)
    assert found.all() and (np.sort(index) == np.arange(len(keys))).all()
    assert (table.count(keys) == counts).all()
    strangers = rng.integers(1, 2**64, 5000, np.uint64)
    assert not table.count(strangers[~np.isin(strangers, keys)]).any()
    assert not CountTable(keys[:0], counts[:0]).count(keys[:5]).any()
