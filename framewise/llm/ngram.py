"""Language-model scores from a sharded Elias-Fano n-gram trie.

1. Documents fall into chunks by a hash.  A chunk counts its n-grams of each order and asks the
   shards about its distinct ones, one binary row per chunk and shard.
2. N-grams go to shards by ranges of their keys: hash of the context, shifted by four bits of the
   successor's hash (so a context met at every third word is spread over 16 ranges), then 24 bits
   of the successor.  Two contexts of one last word are thus told apart by 32 bits.  Requests are
   Elias-Fano coded.  A shard adds the chunks' training counts up, builds its level of the trie
   (``eliasfano.Level``: contexts, pointers, successors, quantised counts, memory-mapped) and answers
   the chunks from it.  Levels are not linked with each other, and none is kept.
3. The chunk's documents are scored from the answers, interpolating the orders with Dirichlet
   smoothing: p_k = (c_k + strength * p_(k-1)) / (c_(k-1) of the context + strength), down to the
   add-one unigram.  Unigram counts are exact, those of higher orders are quantised to 16-bit codes
   (exact to 1024 occurrences, then within 0.1 %).

Nothing is pruned: the model holds every n-gram of every training document.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold
from .eliasfano import EliasFano, Level
from .words import byte_column, hash_words, mix

CHUNK_BYTES = 8 << 20     # text a chunk is sized for
SHARD_KEYS = 1 << 20      # n-grams a shard is sized for
ORDER = 3
STRENGTH = (200.0, 4.0)  # of the orders 2, 3, ...; the last one holds for all above
KEY_BITS = (64, 56)       # of a key of order 1 and above, SUCCESSOR_BITS of them from the last token
SUCCESSOR_BITS = 24
_END, _BEGIN = np.uint64(0x656E64), np.uint64(0x626567696E)  # marks beside the hashed words
_EXACT, _STEP = 1024, 0.002


def quantise(counts: np.ndarray) -> np.ndarray:
    """Codes of counts: themselves up to 1024, then logarithmic steps of 0.2 %."""
    big = np.log(np.maximum(counts, _EXACT) / _EXACT) / np.log1p(_STEP)
    return np.where(counts <= _EXACT, counts, np.minimum(_EXACT + np.rint(big), 65535)).astype(np.uint16)


def restore(codes: np.ndarray) -> np.ndarray:
    codes = codes.astype(np.float64)
    return np.where(codes <= _EXACT, codes, _EXACT * np.exp((codes - _EXACT) * np.log1p(_STEP)))


class Tokens:
    """Tokens of a column of texts with an end mark after each text, and their n-gram keys."""

    def __init__(self, texts, held_out: np.ndarray):
        words = hash_words(texts)
        n = len(words.bounds) - 1
        self.token = np.insert(words.hashes, words.bounds[1:], _END)
        self.bounds = words.bounds + np.arange(n + 1)
        self.train = np.repeat(~held_out, np.diff(self.bounds))
        self.first = np.zeros(len(self.token), bool)
        self.first[self.bounds[:-1]] = True

    def before(self, values: np.ndarray, at_first) -> np.ndarray:
        """The value of the token before, ``at_first`` for the first token of a text."""
        return np.where(self.first, at_first, np.r_[values[:1], values[:-1]])

    def keys(self, order: int) -> np.ndarray:
        """Order 1: the token.  Above: upper part from the context, shifted to one of 16 places by the
        token, and lower part from the token."""
        if order == 1:
            return self.token
        context = last = self.before(self.token, _BEGIN)
        for _ in range(order - 2):
            last = self.before(last, _BEGIN)
            context = mix(context) ^ last
        token = mix(self.token)
        place = (mix(context) + (token << np.uint64(60))) >> np.uint64(64 - KEY_BITS[1] + SUCCESSOR_BITS)
        return (place << np.uint64(SUCCESSOR_BITS)) | (token >> np.uint64(64 - SUCCESSOR_BITS))


def _distinct(tokens: Tokens, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct keys, training counts, place of each token's key)"""
    keys, where = np.unique(tokens.keys(order), return_inverse=True)
    return keys, np.bincount(where, weights=tokens.train, minlength=len(keys)).astype(np.uint32), where


def _by_shard(keys: np.ndarray, order: int, shards: int) -> Iterator[tuple[int, int, int]]:
    """(shard, from, to): shards are equal ranges of the upper 32 bits of the keys."""
    shard = ((keys >> np.uint64(KEY_BITS[order > 1] - 32)) * np.uint64(shards)) >> np.uint64(32)
    cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True]) if len(keys) else []
    return ((int(shard[a]), int(a), int(b)) for a, b in zip(cuts, cuts[1:]))


def _range(shard: int, order: int, shards: int) -> tuple[int, int]:
    """(first key, number of keys) of a shard's range."""
    low = KEY_BITS[order > 1] - 32
    first, last = (-(-s * (1 << 32) // shards) for s in (shard, shard + 1))
    return first << low, (last - first) << low


def _packed(rows: DataFrame, chunks: int) -> DataFrame:
    """(chunk, ids, held_out, sizes, texts): the rows of each batch by chunk, texts compressed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk = batch.column(3).to_numpy()
            data, offsets = byte_column(batch.column(1))
            ids, held = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            order = np.argsort(chunk, kind="stable")
            cuts = np.flatnonzero(np.r_[True, chunk[order][1:] != chunk[order][:-1], True])
            out = []
            for a, b in zip(cuts, cuts[1:]):
                own = order[a:b]
                texts = b"".join([data[offsets[i]:offsets[i + 1]].tobytes() for i in own])
                out.append((int(chunk[own[0]]), [ids[i] for i in own], [held[i] for i in own],
                            (offsets[own + 1] - offsets[own]).tolist(), zstandard.compress(texts, 3)))
            types = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                             ["chunk", "ids", "held_out", "sizes", "texts"])

    rows = rows.select("id", F.col("text").cast("binary"), "held_out",
                       F.pmod(F.xxhash64("id", "text"), F.lit(chunks)).cast("long"))
    return rows.mapInArrow(run, "chunk long, ids array<bigint>, held_out array<boolean>, "
                                "sizes array<bigint>, texts binary")


def _unpacked(table: pa.Table) -> tuple[list, Tokens]:
    """(ids, tokens) of one chunk."""
    ids, held, sizes = ([x for row in table[c].to_pylist() for x in row] for c in ("ids", "held_out", "sizes"))
    data = b"".join([zstandard.decompress(t) for t in table["texts"].to_pylist()])
    offsets = np.r_[0, np.cumsum(np.array(sizes, np.int64))].astype(np.int64)
    texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return ids, Tokens(texts, np.array(held, bool))


def _requests(chunked: DataFrame, shards: dict[int, int]) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        (_, tokens), chunk, out = _unpacked(table), table["chunk"][0].as_py(), []
        for order, n in shards.items():
            keys, counts, _ = _distinct(tokens, order)
            for s, a, b in _by_shard(keys, order, n):
                some = counts[a:b]
                small = some.astype(np.uint8) if some.max() < 256 else some
                first, span = _range(s, order, n)
                packed, n_keys, low_bits = EliasFano.pack(keys[a:b] - np.uint64(first), span)
                out.append((order, s, chunk, n_keys, low_bits, packed.tobytes(), zstandard.compress(small.tobytes(), 1)))
        types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], _REQUEST_NAMES)

    return chunked.groupBy("chunk").applyInArrow(run, "order int, shard int, chunk long, n long, low_bits int, "
                                               "keys binary, counts binary")


_REQUEST_NAMES = ["order", "shard", "chunk", "n", "low_bits", "keys", "counts"]


def _keys(blob: bytes, n: int, low_bits: int) -> np.ndarray:
    packed = EliasFano(np.frombuffer(blob, np.uint64), n, low_bits)
    return packed.get(np.arange(n))


def _answers(requests: DataFrame) -> DataFrame:
    """(chunk, order, shard, codes) in the order of the chunk's keys."""

    def run(table: pa.Table) -> pa.Table:
        order, shard = table["order"][0].as_py(), table["shard"][0].as_py()
        asked = [_keys(*x) for x in zip(*(table[c].to_pylist() for c in ("keys", "n", "low_bits")))]
        blobs = [zstandard.decompress(b) for b in table["counts"].to_pylist()]
        counts = np.concatenate([np.frombuffer(b, np.uint8 if len(b) == len(k) else np.uint32).astype(np.uint32)
                                 for b, k in zip(blobs, asked)])
        keys, where = np.unique(np.concatenate(asked), return_inverse=True)
        counts = np.bincount(where, weights=counts, minlength=len(keys)).astype(np.int64)
        if order == 1:  # the vocabulary: exact counts
            codes = [counts[np.searchsorted(keys, a)].astype(np.uint32) for a in asked]
        else:
            level = Level(keys[counts > 0], quantise(counts[counts > 0]), SUCCESSOR_BITS)
            codes = [level.find(a) for a in asked]
            level.close()
        n = len(asked)
        return pa.table([table["chunk"], pa.array([order] * n, pa.int32()), pa.array([shard] * n, pa.int32()),
                         pa.array([zstandard.compress(c.tobytes(), 1) for c in codes], pa.binary())], ["chunk", "order", "shard", "codes"])

    return requests.groupBy("order", "shard").applyInArrow(run, "chunk long, order int, shard int, codes binary")


def _vocabulary(rows: DataFrame) -> tuple[int, int, int]:
    """(training tokens, distinct training tokens, bytes of all texts); the distinct words and
    their counts are summed per batch, then over all batches."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = Tokens(batch.column(0), batch.column(1).to_numpy(zero_copy_only=False))
            keys, n = np.unique(tokens.token[tokens.train], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["w", "n"])

    found = (rows.select("text", "held_out").mapInArrow(run, "w long, n long")
                 .groupBy("w").agg(F.sum("n").alias("n")).agg(F.sum("n"), F.count(F.lit(1))).first())
    return found[0] or 0, found[1], rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def score_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
                    strength: tuple[float, ...] = STRENGTH, chunk_bytes: int = CHUNK_BYTES,
                    shard_keys: int = SHARD_KEYS) -> DataFrame:
    """(``id_col``, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row.

    Tokens: words between ASCII white space, A-Z lower-cased, then one end mark per text.  Training
    rows are those whose crc32(id as text) modulo 7 is not 2.  ``base_score`` sums log10 of the
    add-one unigram, ``score`` log10 of the model's probability of the whole text.  Null and empty
    texts are one end mark; null ids fold as empty text; repeated rows are scored, and learnt from,
    one by one; without training rows every probability is the uniform one; an empty table gives
    none."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), (fold(id_col, 7) == 2).alias("held_out"))
    total, distinct, size = _vocabulary(rows)
    chunks = max(1, -(-size // chunk_bytes))
    shards = {1: max(1, -(-size // (16 * shard_keys)))} | {k: max(1, -(-size // (6 * shard_keys))) for k in range(2, order + 1)}
    chunked = _packed(rows, chunks)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table([pa.array([], t) for t in _SCORE_TYPES], _SCORE_NAMES)
        ids, tokens = _unpacked(left)
        got = {(o, s): b for o, s, b in zip(*(right[c].to_pylist() for c in ("order", "shard", "codes")))}
        p, above = None, None
        for k, n in shards.items():
            keys, _, place = _distinct(tokens, k)
            blobs = [zstandard.decompress(got[(k, s)]) for s, _, _ in _by_shard(keys, k, n)]
            codes = np.frombuffer(b"".join(blobs), np.uint32 if k == 1 else np.uint16)
            if k == 1:
                count = codes[place].astype(np.float64)
                n_known = np.add.reduceat((count > 0).astype(np.int64), tokens.bounds[:-1])
                starts = count[tokens.bounds[1] - 1]  # training texts: each has one end mark
                p = base = (count + 1) / (total + distinct + 1)
            else:
                count = restore(codes)[place]
                weight = strength[min(k - 2, len(strength) - 1)]
                p = (count + weight * p) / (tokens.before(above, starts) + weight)
            above = count
        held_out = ~tokens.train[tokens.bounds[:-1]]
        return pa.table([pa.array(ids, pa.int64()), pa.array(held_out), pa.array(np.diff(tokens.bounds)), pa.array(n_known),
                         pa.array(np.full(len(held_out), total, np.int64)),
                         pa.array(np.add.reduceat(np.log10(base), tokens.bounds[:-1])),
                         pa.array(np.add.reduceat(np.log10(p), tokens.bounds[:-1]))], _SCORE_NAMES)

    answers = _answers(_requests(chunked, shards))
    return (chunked.groupBy("chunk").cogroup(answers.groupBy("chunk"))
                   .applyInArrow(run, "id long, held_out boolean, n_tokens long, n_known long, "
                                      "train_tokens long, base_score double, score double")
                   .withColumnRenamed("id", id_col))


_SCORE_NAMES = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
_SCORE_TYPES = [pa.int64(), pa.bool_(), *[pa.int64()] * 3, pa.float64(), pa.float64()]
