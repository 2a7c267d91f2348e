from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from framewise.llm import ngram
from framewise.llm.eliasfano import EliasFano, Level
from framewise.llm.words import ALNUM, hash_words


def slow_scores(rows, order, strength):
    def tokens(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return [*[w for w in re.split("[\x20\x09-\x0D]+", low) if w], None]

    held = {i: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for i, (d, _) in enumerate(rows)}
    grams = [Counter() for _ in range(order + 1)]
    texts = [tokens(t) for _, t in rows]
    for i, t in enumerate(texts):
        if not held[i]:
            padded = ["<s>"] * (order - 1) + t
            for k in range(1, order + 1):
                for j in range(len(t)):
                    end = j + order
                    grams[k][tuple(padded[end - k:end])] += 1
            grams[0]["texts"] += 1
    total, distinct = sum(grams[1].values()), len(grams[1])
    out = []
    for i, t in enumerate(texts):
        padded = ["<s>"] * (order - 1) + t
        base = score = 0.0
        for j, w in enumerate(t):
            end = j + order
            p = (grams[1][(w,)] + 1) / (total + distinct + 1)
            base += math.log10(p)
            for k in range(2, order + 1):
                context = tuple(padded[end - k:end - 1])
                above = grams[0]["texts"] if j == 0 else grams[k - 1][context]
                weight = strength[min(k - 2, len(strength) - 1)]
                p = (grams[k][tuple(padded[end - k:end])] + weight * p) / (above + weight)
            score += math.log10(p)
        out.append((held[i], len(t), sum(grams[1][(w,)] > 0 for w in t), total, base, score))
    return out


@pytest.mark.parametrize("order", [2, 3])
def test_scores_equal_plain_counts(documents, order):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    want = {d: w for (d, _), w in zip(rows, slow_scores(rows, order, ngram.STRENGTH))}
    got = ngram.score_documents(documents, order=order, chunk_bytes=1 << 17, shard_keys=1 << 12).collect()
    assert len(got) == len(rows)
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert r.base_score == pytest.approx(w[4], rel=1e-9) and r.score == pytest.approx(w[5], rel=1e-5)


def test_model_beats_the_base_on_held_out_texts(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet")
    base, score = ngram.score_documents(docs).where("held_out").selectExpr("sum(base_score)", "sum(score)").first()
    assert score > base


def test_odd_rows(odd, empty, docs_of):
    got = ngram.score_documents(odd).collect()
    assert len(got) == odd.count() and all(r.n_tokens >= 1 and r.score < 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert ngram.score_documents(empty).count() == 0
    only = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    alone = ngram.score_documents(docs_of([(only, "never learnt")])).first()  # no training rows
    assert (alone.train_tokens, alone.n_known, alone.base_score, alone.score) == (0, 0, 0.0, 0.0)


def test_elias_fano_round_trip_and_successor():
    rng = np.random.default_rng(3)
    for bound, n in ((100, 40), (1 << 40, 1000), (1 << 64, 5000), (10, 0), (7, 7)):
        values = np.sort(rng.integers(0, bound, n, np.uint64)) if n else np.zeros(0, np.uint64)
        seq = EliasFano(*EliasFano.pack(values, bound))
        assert (seq.get(np.arange(n)) == values).all()
        asked = np.concatenate([values, rng.integers(0, bound, 200, np.uint64)])
        assert (seq.successor(asked) == np.searchsorted(values, asked, "left")).all()


def test_level_finds_members_only():
    rng = np.random.default_rng(4)
    keys = np.unique((rng.integers(0, 300, 4000, np.uint64) << np.uint64(32)) | rng.integers(0, 2**32, 4000, np.uint64))
    codes = rng.integers(1, 60000, len(keys)).astype(np.uint16)
    level = Level(keys[::2], codes[::2], 32)
    found = level.find(keys)
    assert (found[::2] == codes[::2]).all() and not found[1::2].any()
    level.close()
    nothing = Level(keys[:0], codes[:0], 32)
    assert not nothing.find(keys).any()
    nothing.close()


def test_quantised_counts():
    counts = np.array([0, 1, 2, 1000, 1024, 1025, 50_000, 10**9])
    back = ngram.restore(ngram.quantise(counts))
    assert (back[:5] == counts[:5]).all() and np.abs(back[5:] / counts[5:] - 1).max() < 0.0011


def test_word_hashes_follow_the_words():
    import pyarrow as pa
    texts = ["The the THE", None, "", "a-b a b", "ünï Ünï x" * 3, "z " * 1000]
    words = hash_words(pa.array(texts), ALNUM)
    plain = [re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for t in texts]
    assert np.diff(words.bounds).tolist() == [len(p) for p in plain]
    flat = [w for p in plain for w in p]
    assert len({(h, w) for h, w in zip(words.hashes.tolist(), flat)}) == len(set(flat)) == len(set(words.hashes.tolist()))
    sliced = hash_words(pa.array(texts).slice(3, 2), ALNUM)
    assert (sliced.hashes == words.hashes[words.bounds[3]:words.bounds[5]]).all()
