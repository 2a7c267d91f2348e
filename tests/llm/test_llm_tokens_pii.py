from __future__ import annotations

import random
import re

import public_tokenizers
from tokenizers import Tokenizer

from framewise.llm import bpe, pii
from framewise.llm.queries import vocabulary_path

ODD_TEXTS = ["", " ", "Hello, WORLD's don't 12345", "<|endoftext|>x <|startoftext|>a<|endoftext|>", "<|endof text|>",
             "ΣΑΣ Σ ΟΔΟΣ", "İstanbul ǅ ﬁ", "é ́x àb", "a\x1cb c\x1fd \x85 \xa0 e f　g", "日本語 テスト 👩‍👩‍👧 🇩🇪",
             "'s 'T it'S x'll", "½ ² Ⅷ 12³", "a​b﻿c", "---===+++ ...", "word " * 500, "x" * 5000, "\x00\x01\x7f"]


def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def same(ours, theirs, text):
    ids = theirs.encode(text, add_special_tokens=False).ids
    n, joined, decoded = ours.encode(text)
    assert (n, joined) == (len(ids), " ".join(map(str, ids))), repr(text)
    assert decoded == theirs.decode(ids, skip_special_tokens=False), repr(text)


def test_bpe_equals_the_library(documents):
    theirs = library()
    with open(vocabulary_path(), encoding="utf-8") as f:
        ours = bpe.Bpe(f.read())
    for text in [*ODD_TEXTS, *(r.text or "" for r in documents.select("text").collect())]:
        same(ours, theirs, text)
    rnd = random.Random(6)
    marks = [*"aAbéȨ́́ \n\t'.,!0٣ßΣςσ \x1c<|>", "<|endoftext|>", "的", "한", "ﬀ", "'re", "K", "Å"]
    for _ in range(1500):
        same(ours, theirs, "".join(rnd.choices(marks, k=rnd.randrange(1, 30))))


def test_bpe_caches_keep_two_generations(monkeypatch):
    """Many different words: the caches stay bounded, a word met all the time stays, results are the library's."""
    monkeypatch.setattr(bpe, "_CACHE", 50)
    theirs = library()
    with open(vocabulary_path(), encoding="utf-8") as f:
        ours = bpe.Bpe(f.read())
    rnd = random.Random(8)
    for _ in range(300):
        same(ours, theirs, " ".join(["always", *("".join(rnd.choices("abcdeé", k=rnd.randrange(1, 40))) for _ in range(9))]))
        assert "always" in ours.chunks or "always" in ours.old_chunks
        assert all(len(c) <= 50 for c in (ours.words, ours.old_words, ours.chunks, ours.old_chunks))


def test_bpe_odd_rows(odd, empty):
    rows = bpe.encode_documents(odd, vocabulary_path()).collect()
    assert len(rows) == odd.count()
    assert all((r.n_tokens, r.ids, r.decoded) == (0, "", "") for r in rows if r.doc_id in (1, 2, 3))
    assert bpe.encode_documents(empty, vocabulary_path()).count() == 0


def slow_spans(text):
    found = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            found.append((m.start(), m.end(), "card"))
    found += [(m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_spans_equal_plain_patterns(documents):
    rnd = random.Random(7)
    made = ["".join(rnd.choices(["a", "@", ".", "b-", "1", "25", "255.", "300.", " ", "+1", "4111 1111 1111 1111", "-", "(", ")", "é"],
                                k=rnd.randrange(1, 25))) for _ in range(4000)]
    for text in [*made, *(r.text or "" for r in documents.collect())]:
        assert pii.base_spans(text) == slow_spans(text), text


def test_checksums_and_context():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89 3704 0044 0532 0130 00") and not pii.mod97("DE88370400440532013000")
    assert [s[2] for s in pii.more_spans("IBAN GB82 WEST 1234 5698 7654 32 please")] == ["iban"]
    assert pii.more_spans("GB82 WEST 1234 5698 7654 33") == []
    assert [s[2] for s in pii.more_spans("his SSN is 536-22-1234.")] == ["ssn"]
    assert pii.more_spans("part 536-22-1234 of the list") == pii.more_spans("ssn 000-22-1234") == []


def test_pii_odd_rows(odd, empty):
    rows = {r.doc_id: r.spans for r in pii.find_personal_data(odd).collect()}
    assert rows[1] == rows[2] == rows[3] == []
    assert [(s.kind, s.start, s.end, s.base) for s in rows[7]] == [("ip", 13, 20, True), ("email", 21, 27, True)]
    assert pii.find_personal_data(empty).count() == 0
    assert pii.find_personal_data(odd.withColumnsRenamed({"lang": "spans", "source": "id"})).count() == odd.count()


def test_ibans_after_other_words_and_each_other():
    two = "DE89 3704 0044 0532 0130 00 GB29 NWBK 6016 1331 9268 19"
    spans = [(0, 27), (28, 55)]
    assert [(s, e) for s, e, _ in pii.more_spans(two)] == spans
    assert [(s, e) for s, e, _ in pii.more_spans("AB12 DE89370400440532013000")] == [(5, 27)]
    assert [(s, e) for s, e, _ in pii.more_spans(two.replace("00 GB", "00, GB"))] == [(0, 27), (29, 56)]
    assert pii.more_spans("AB12 DE88370400440532013000 CD34 EF56") == []


def test_context_decides_the_added_kinds():
    from framewise.llm.pii import more_spans

    def kinds(text):
        return [k for _, _, k in more_spans(text)]

    key = "9742a250774262d69ad6a86100194ed53da5a0ef"
    assert kinds(f'the token = "{key}"') == ["secret"] and kinds(f"see {key}") == [] and kinds(f"auth fix, commit {key}") == []
    assert kinds("password: " + "a" * 40) == [] and kinds("password: 1234567890123456789012345") == []  # no letters, or no mixture
    assert kinds("password: pneumonoultramicroscopicsilicovolcanoconiosis1") == ["secret"]
    iban = "DE89 3704 0044 0532 0130 00"
    assert kinds(f"pay {iban} now") == ["iban"] and kinds(f"serial {iban}") == [] and kinds(f"serial of the bank account {iban}") == ["iban"]
    assert kinds("SSN 219-09-9999") == ["ssn"] and kinds("219-09-9999") == [] and kinds("SSN or part number 219-09-9999") == []
    assert kinds("DNI 12345678Z") == ["dni"] and kinds("12345678Z") == [] and kinds("DNI 12345678A") == [] and kinds("NIE X1234567L") == ["dni"]
    nir = "2 55 08 14 168 025 38"
    assert kinds(f"n. {nir}.") == ["nir"] and kinds("n. 2 55 08 14 168 025 39.") == [] and kinds(f"order number {nir}") == []
    spans = more_spans(f"x token {key} y")
    assert spans == [(8, 48, "secret")]
