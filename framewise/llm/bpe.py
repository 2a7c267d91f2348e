"""BPE encoding and decoding of whole texts with a given vocabulary file.

A word's merges run from a priority queue of merge ranks over a doubly linked list of symbols;
entries whose pair has changed are stale and skipped.  Words repeat, so each Python worker keeps
the results of the words it has met lately: two bounded generations, of which the older one is
dropped when the younger one is full; a string met again moves to the younger one.  The file's text is read by the driver and
broadcast; its size is checked.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_FILE = 32 << 20       # bytes of a vocabulary file that may be broadcast
_CACHE = 1 << 17          # strings of a generation of a worker's caches; two generations are kept
_SHORT, _NO_RANK = 24, 1 << 60  # symbols merged in a plain loop; the rank of a pair without a merge
_ROWS, _CHARS = 256, 4 << 20  # rows and result characters of an output batch
#: Characters that str.split() takes for white space and Unicode's White_Space property does not.
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def _byte_characters() -> list[str]:
    """One printable character for each byte: visible Latin-1 bytes stand for themselves, the rest
    take the code points from 256 on, in order."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


class Bpe:
    """The tokenizer of one vocabulary file: NFC, lower case, pattern split, byte characters, merges."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        model = spec["model"]
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.suffix = model["end_of_word_suffix"] or ""
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in (self.vocab | added).items()}
        self.added = added
        self.split_added = regex.compile("(%s)" % "|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.rank: dict[tuple[int, int], int] = {}
        self.product: list[int] = []
        for pair in model["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank.setdefault((self.vocab[a], self.vocab[b]), len(self.product))
            self.product.append(self.vocab[a + b])
        patterns = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.pattern = regex.compile(patterns[0])
        self.bytes = _byte_characters()
        self.words: dict[str, tuple[int, ...]] = {}
        self.chunks: dict[str, tuple[int, str, str]] = {}
        self.old_words: dict[str, tuple[int, ...]] = {}
        self.old_chunks: dict[str, tuple[int, str, str]] = {}

    def merge(self, ids: list[int]) -> list[int]:
        """Apply the merges of the lowest ranks first, leftmost first among equals."""
        rank, product = self.rank, self.product
        n = len(ids)
        if n <= _SHORT:
            ranks = [rank.get(p, _NO_RANK) for p in zip(ids, ids[1:])]
            while ranks and (r := min(ranks)) != _NO_RANK:
                i = ranks.index(r)
                ids[i:i + 2] = [product[r]]
                del ranks[i]
                if i:
                    ranks[i - 1] = rank.get((ids[i - 1], ids[i]), _NO_RANK)
                if i < len(ranks):
                    ranks[i] = rank.get((ids[i], ids[i + 1]), _NO_RANK)
            return ids
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [(r, i) for i in range(n - 1) if (r := rank.get((ids[i], ids[i + 1]))) is not None]
        heapify(queue)
        while queue:
            r, i = heappop(queue)
            j = after[i]
            if ids[i] < 0 or j < 0 or rank.get((ids[i], ids[j])) != r:
                continue  # stale: the pair is gone
            ids[i], ids[j] = product[r], -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (s := rank.get((ids[i], ids[k]))) is not None:
                    heappush(queue, (s, i))
            if (h := before[i]) >= 0 and (s := rank.get((ids[h], ids[i]))) is not None:
                heappush(queue, (s, h))
        return [x for x in ids if x >= 0]

    def word(self, word: str) -> tuple[int, ...]:
        found = self.words.get(word)
        if found is None:
            found = self.old_words.get(word)
            if found is None:
                symbols = [self.bytes[b] for b in word.encode()]
                symbols[-1] += self.suffix
                found = tuple(self.merge([self.vocab[s] for s in symbols if s in self.vocab]))
            if len(word) < 64:
                if len(self.words) >= _CACHE:
                    self.words, self.old_words = {}, self.words
                self.words[word] = found
        return found

    def piece(self, text: str) -> list[int]:
        """Ids of a text without white space that matters to its neighbours."""
        out: list[int] = []
        for part in self.split_added.split(text) if self.split_added and "<" in text else (text,):
            if part in self.added:
                out.append(self.added[part])
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            for word in self.pattern.findall(part.lower()):
                out += self.word(word)
        return out

    def encoded(self, chunk: str) -> tuple[int, str, str]:
        """(number of ids, the ids joined by spaces, their vocabulary strings joined by spaces)"""
        found = self.old_chunks.get(chunk)
        if found is None:
            ids = self.piece(chunk)
            found = len(ids), " ".join(map(str, ids)), " ".join([self.strings[i] for i in ids])
        if len(chunk) < 64:
            if len(self.chunks) >= _CACHE:
                self.chunks, self.old_chunks = {}, self.chunks
            self.chunks[chunk] = found
        return found

    def encode(self, text: str) -> tuple[int, str, str]:
        chunks = [text] if any(c in text for c in _SEPARATORS) else text.split()
        make = self.encoded
        rows = [self.chunks.get(c) or make(c) for c in chunks]
        return (sum([r[0] for r in rows]), " ".join([r[1] for r in rows if r[0]]),
                " ".join([r[2] for r in rows if r[0]]))


_loaded: dict[int, Bpe] = {}  # of this worker, by broadcast


def encode_documents(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_tokens, ids, decoded), one row per input row: the ids as decimals joined by one
    space, and their vocabulary strings (of the file at path ``vocabulary``) joined by one space.

    Added tokens found in a text keep their own id; no special tokens are put around it.  Null and
    empty texts have no ids and decode to the empty text; texts of any length are encoded whole;
    null and repeated ids pass through; an empty table gives none."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read(MAX_FILE + 1)
    if len(spec) > MAX_FILE:
        raise ValueError(f"{vocabulary} is over {MAX_FILE} characters, too large to broadcast")
    sent = df.sparkSession.sparkContext.broadcast(spec)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(sent.value)
        if key not in _loaded:
            _loaded.clear()
            _loaded[key] = Bpe(sent.value)
        bpe = _loaded[key]
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                row = bpe.encode(text or "")
                out.append((doc, *row))
                size += len(row[1]) + len(row[2])
                if len(out) >= _ROWS or size >= _CHARS:
                    yield _batch(out)
                    out, size = [], 0
            if out:
                yield _batch(out)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                          ["id", "n_tokens", "ids", "decoded"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, n_tokens long, ids string, decoded string").withColumnRenamed("id", id_col)
