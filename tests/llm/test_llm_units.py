from __future__ import annotations

import random
import re
import time

from framewise.llm.units import dedup_units


def pieces(text):
    return [(m.start(), m.end()) for m in re.finditer(r"[^.!?,;:\n]*[.!?,;:\n]*", text or "") if m.group().split()]


def slow(rows, min_words):
    def key(part):
        return " ".join(part.lower().split())
    first = {}
    for d, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        for i, (a, b) in enumerate(pieces(t)):
            first.setdefault(key(t[a:b]), (d, i))
    out = []
    for d, t in rows:
        runs, now = [], []
        for i, (a, b) in enumerate(pieces(t)):
            if first[key(t[a:b])] != (d, i):
                now.append((a, b))
            else:
                runs, now = [*runs, now], []
        spans = [(run[0][0], run[-1][1]) for run in [*runs, now] if sum(len(t[a:b].split()) for a, b in run) >= min_words]
        kept = t or ""
        for a, b in reversed(spans):
            kept = kept[:a] + kept[b:]
        out.append((d, kept, spans))
    return sorted(out, key=repr)


def got(df, n):
    return sorted(((r.doc_id, r.text, [tuple(s) for s in r.removed]) for r in dedup_units(df, min_words=n).collect()), key=repr)


def test_equals_plain_definition(documents, docs_of, empty):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert got(documents, 8) == slow(rows, 8)
    made = [(3, "A b c\nx\na  B c"), (1, "q\na b C"), (2, None), (4, ""), (None, "z z z\nz z z"), (5, "x\nx"), (6, "...a b c. ,a b c")]
    assert got(docs_of(made), 3) == slow(made, 3)
    assert dedup_units(empty).count() == 0
    twice = dedup_units(docs_of([(1, "a b c"), (1, "a b c")]).withColumnRenamed("lang", "removed"), min_words=3).collect()
    assert [r.text for r in twice] == ["a b c"] * 2


def test_passage_of_short_lines(docs_of):
    terms = "\n".join(f"clause {i} of these terms holds" for i in range(9))
    made = [(1, f"own start here\n{terms}"), (2, f"another beginning\n{terms}\n\nown start here"),
            (3, "clause 3 of these terms holds\nthe rest is new and long enough to stand alone")]
    rows = {r.doc_id: r for r in dedup_units(docs_of(made)).collect()}
    assert rows[1].text == made[0][1]
    assert rows[2].text == "another beginning\n" and [tuple(s) for s in rows[2].removed] == [(18, len(made[1][1]))]
    assert rows[3].text == made[2][1]


def prose(rng, words):
    out = [f"{rng.choice('abcdefghij')}{rng.randrange(900)}" + rng.choice(["", "", "", "", "", ",", "."]) for _ in range(words)]
    return " ".join(out)


def test_passage_inside_a_line_and_beside_an_edit(docs_of):
    rng = random.Random(1)
    passage = prose(rng, 60)
    edited = passage.split()
    edited[3] = "changed"
    made = [(1, f"{prose(rng, 40)}. {passage}. {prose(rng, 40)}"), (2, f"{prose(rng, 80)} {passage} {prose(rng, 30)}"),
            (3, f"{prose(rng, 50)}. {' '.join(edited)}"), (4, prose(rng, 300))]
    rows = {r.doc_id: r for r in dedup_units(docs_of(made)).collect()}
    assert not rows[1].removed and not rows[4].removed
    for i in (2, 3):
        assert len(rows[i].removed) == 1
        a, b = rows[i].removed[0]
        assert made[i - 1][1][a:b].strip() in made[0][1] and len(made[i - 1][1][a:b].split()) >= 25
        assert rows[i].text == made[i - 1][1][:a] + made[i - 1][1][b:]


def test_long_texts_take_linear_time(docs_of):
    text = "\n".join(f"line {i % 977} repeats in this text." for i in range(40_000))
    began = time.time()
    rows = {r.doc_id: r for r in dedup_units(docs_of([(1, text), (2, text)])).collect()}
    assert rows[2].text == "" and time.time() - began < 60


def test_repeated_row_spans_tasks(spark, docs_of):
    """Half of the rows are one id and text: the join back to the texts deals them to several tasks."""
    passage = " ".join(f"w{i}" for i in range(40))
    rows = docs_of([(1, f"{passage}.")] + [(i + 10, f"own{i} {passage[:9]}.") for i in range(50)]).union(
        spark.range(3000).selectExpr(f"5 as doc_id", f"'{passage}. end' as text", "'en' as lang", "'s' as source", "0L as n_chars"))
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        parts = dedup_units(rows.repartition(16)).rdd.glom().map(lambda p: sum(r.doc_id == 5 and r.text.strip() == "end" for r in p)).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(parts) == 3000 and max(parts) < 1500
