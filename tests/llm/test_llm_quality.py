from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from framewise.llm import linefreq, rules

SPACE = "[\x20\x09-\x0D]+"


def slow(text):
    t = text or ""
    w = [x for x in re.split(SPACE, t) if x]
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))


def test_counts_equal_plain_definition(documents, odd):
    for df in (documents, odd):
        rows = linefreq.line_frequency_rules(df).drop("kept").collect()
        texts = Counter((r.doc_id, *slow(r.text)) for r in df.collect())
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == texts
        assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in rows)


def test_lines_count_per_host_and_reject_the_depleted(docs_of):
    own = " ".join(f"w{i}" for i in range(40))
    shared = "A  Shared line of  many words " + " ".join(f"s{i}" for i in range(30))
    rows = [(i, f"{shared}\n{own} {i}", "en", "hot", 1) for i in range(6)]
    rows += [(10 + i, f"{shared.lower()}\nx{i} y z", "en", "hot", 1) for i in range(6)]
    rows += [(30 + i, f"{shared}\nq{i} r s", "en", host, 1) for i, host in enumerate(["a", "b", None, None])]
    got = {r.doc_id: r for r in linefreq.line_frequency_rules(docs_of(rows), max_docs=10).collect()}
    n = len(shared.split())
    assert all(got[i].kept and got[i].removed_words == n for i in range(6))
    assert all(not got[10 + i].kept and got[10 + i].removed_words == n for i in range(6))
    assert all(got[30 + i].kept and got[30 + i].removed_words == 0 for i in range(4))


def test_plan_has_no_python(documents, empty):
    df = linefreq.line_frequency_rules(documents)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert linefreq.line_frequency_rules(empty).count() == 0


def test_repeated_rows_count_and_agree(docs_of):
    rows = [(1, "twice held line of some words here\nown " + "word " * 30)] * 3
    got = linefreq.line_frequency_rules(docs_of(rows), max_docs=2).collect()
    assert len(got) == 3 and {r.removed_words for r in got} == {38}


def test_frequent_lines_are_cut_out_of_the_text(docs_of):
    own = " ".join(f"w{i}" for i in range(30))
    rows = [(i, f"Shared  line\n{own} {i}\n\n shared LINE\nend {i}\n", "en", "hot", 1) for i in range(4)]
    rows += [(None, f"shared line\n{own} x", "en", "hot", 1)] * 2 + [(9, f"shared line\n{own}", "en", "hot", 1)]
    rows += [(9, f"shared line\n{own}", "en", None, 1), (10, "shared line", "en", "hot", 1), (11, None, "en", "hot", 1)]
    got = linefreq.line_frequency_rules(docs_of(rows), max_docs=4).collect()
    have = sorted(((r.doc_id, r.text, r.removed, r.removed_words) for r in got), key=repr)
    want = [(i, f"{own} {i}\n\nend {i}\n", [0, 3], 4) for i in range(4)]
    want += [(None, f"{own} x", [0], 2)] * 2 + [(9, own, [0], 2), (9, f"shared line\n{own}", [], 0)]
    want += [(10, "", [0], 2), (11, "", [], 0)]
    assert have == sorted(want, key=repr)


def test_classifier_on_held_out_labels(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = rules.fit(docs, labels)
    scored = rules.score_documents(docs, model)
    n, right = (scored.join(labels.select("doc_id", "quality"), "doc_id").where("held_out")
                .agg(F.count("*"), F.sum((F.col("predicted") == F.col("quality")).cast("int"))).first())
    assert right / n > 0.95
    kept = rules.keep_good(docs.withColumnRenamed("lang", "odd"), model)
    assert kept.columns == ["doc_id", "text", "odd", "source", "n_chars"]
    assert kept.count() == scored.where("predicted = 1").count()


def test_score_ignores_all_but_the_text(docs_of, odd, empty, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    docs = docs_of([(i, ("good words in a row %d" if i % 2 else "### $$$ %d") % i) for i in range(40)])
    model = rules.fit(docs, labels)
    score = {r.doc_id: r.score for r in rules.score_documents(docs, model).collect()}
    moved = docs.withColumns({"doc_id": F.col("doc_id") + 1000, "source": F.lit("x"), "lang": F.lit("y")})
    assert {r.doc_id - 1000: r.score for r in rules.score_documents(moved, model).collect()} == score
    got = rules.score_documents(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert rules.score_documents(empty, model).count() == 0
    assert rules.keep_good(empty, model).count() == 0


@pytest.mark.parametrize("known,score", [([], 0.5), ([(0, 1), (1, 1)], 0.75)])
def test_without_both_labels(docs_of, spark, known, score):
    docs = docs_of([(i, "some text") for i in range(4)])
    model = rules.fit(docs, spark.createDataFrame(known, "doc_id long, quality int"))
    assert {round(r.score, 9) for r in rules.score_documents(docs, model).collect()} == {score}


def test_paths_become_tidy_rules():
    text = """Forest
  Tree 0 (weight 1.0):
    If (feature 0 <= 2.5)
     If (feature 0 <= 1.5)
      Predict: 0.0
     Else (feature 0 > 1.5)
      Predict: 1.0
    Else (feature 0 > 2.5)
     Predict: 1.0
"""
    f = rules.STATISTICS[0]
    assert rules.paths(text) == [((f, True, 2.5),), ((f, True, 1.5),), ((f, False, 1.5), (f, True, 2.5)), ((f, False, 2.5),)]
