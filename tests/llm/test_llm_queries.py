from __future__ import annotations

import re

import pytest

import __spark_entry__ as E
import corpus_pipeline
from framewise.llm.queries import ORACLE, QUERIES
from oracle_harness import compare


def test_registered():
    assert [k.split("_")[0] for k in QUERIES] == ["op1", "op2", "op3", "op4", "op5", "op6", "op7", "op8", "op9", "op10", "op11",
                                                   "op12", "op13"]
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_sql(spark, con, sf_dir, key):
    ok, msg = compare(QUERIES[key](spark, sf_dir), con, ORACLE[key])
    assert ok, msg


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE) - {"op11_spelling_variants", "op13_conversation_repair"}))
def test_one_row_per_document(spark, sf_dir, documents, key):
    rows = QUERIES[key](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in documents.select("doc_id").collect())


def test_personal_data_columns(spark, sf_dir, documents):
    import hashlib

    from test_llm_tokens_pii import slow_spans

    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    rows = QUERIES["op10_pii"](spark, sf_dir).collect()
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 0
    for r in rows:
        base = slow_spans(texts[r.doc_id])
        kinds = [k for _, _, k in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds.count(k) for k in ("email", "ip", "card", "phone")]
        listed = [f"{k}:{s}:{e}" for s, e, k in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x.split(":")[0] not in ("iban", "ssn", "nir", "dni", "secret", "")] == listed
        assert r.n_spans == len([x for x in r.spans.split(",") if x]) == len([x for x in r.scores.split(",") if x])
    # every planted token is found
    for r in rows:
        token = re.search(r'token = "([0-9a-f]{40})"', texts[r.doc_id])
        assert not token or f"secret:{token.start(1)}:{token.end(1)}" in r.spans.split(",")


def test_token_digests(spark, sf_dir, documents):
    import hashlib

    from test_llm_tokens_pii import library

    theirs = library()
    got = {r.doc_id: r for r in QUERIES["op7_bpe"](spark, sf_dir).collect()}
    for r in documents.collect():
        ids = theirs.encode(r.text or "", add_special_tokens=False).ids
        mine = got[r.doc_id]
        assert mine.n_tokens == len(ids)
        assert mine.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert mine.decoded_sha256 == hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_pipeline_stage_by_stage(spark, sf_dir, documents):
    from test_llm_decontam import slow as contaminated
    from test_llm_lines import slow as deduped
    from test_llm_simhash import slow_fingerprint, slow_groups

    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "line dedup", "simhash near-dedup", "benchmark decontamination", "bpe"]
    good = stages["quality classifier"](spark, documents, sf_dir).cache()
    assert good.columns == documents.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    ids = {r.doc_id for r in good.collect()}
    known = [d for d in labels if d in {r.doc_id for r in documents.select("doc_id").collect()}]
    assert sum((d in ids) == bool(labels[d]) for d in known) / len(known) > 0.9

    lines = stages["line dedup"](spark, good, sf_dir).cache()
    want = deduped([(r.doc_id, r.text) for r in good.collect()], 10, 1)
    assert lines.columns == documents.columns
    assert sorted(((r.doc_id, r.text) for r in lines.collect()), key=repr) == sorted(((w[0], w[3]) for w in want), key=repr)

    near = stages["simhash near-dedup"](spark, lines, sf_dir).cache()
    groups = slow_groups({r.doc_id: slow_fingerprint(r.text) for r in lines.collect()}, 4)
    assert near.columns == documents.columns
    assert sorted(r.doc_id for r in near.collect()) == sorted(set(groups.values()))

    clean = stages["benchmark decontamination"](spark, near, sf_dir).cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    verdict = {r.doc_id: contaminated(r.text, items)[:2] for r in near.collect()}
    assert clean.columns == documents.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, (n, h) in verdict.items() if not (h and 20 * h >= n))

    tokens = stages["bpe"](spark, clean, sf_dir)
    assert tokens.count() == clean.count() == corpus_pipeline.run(spark, sf_dir).count()


def test_stages_on_empty_documents(spark, sf_dir, empty):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0, name


def test_clashing_columns_change_nothing(odd, spark, sf_dir):
    """Inputs with columns named like the operators' own."""
    from framewise.llm import bpe, linefreq, ngram
    from framewise.llm.queries import vocabulary_path
    from pyspark.sql import functions as F

    names = ("id", "text_key", "key", "chunk", "held_out", "score", "ids", "n_tokens", "decoded", "kept", "removed", "n_words", "h", "line")
    clash = odd.select(*odd.columns, *[F.lit("x").alias(c) for c in names])

    def rows(df, columns):
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)

    for run, columns in ((ngram.score_documents, ("doc_id", "n_tokens", "base_score", "score")),
                         (lambda d: bpe.encode_documents(d, vocabulary_path()), ("doc_id", "ids", "decoded")),
                         (linefreq.line_frequency_rules, ("doc_id", "n_words", "n_dup_lines", "kept"))):
        assert rows(run(clash), columns) == rows(run(odd), columns)
