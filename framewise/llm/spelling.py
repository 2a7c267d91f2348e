"""Spelling variants: k-d trees over the letter counts of words.

One inserted or deleted letter changes one count by one, one replaced letter changes two: words one
edit apart are at L1 distance two at most.  For every pair of lengths (n with n, n with n + 1), the
words within that distance come from range searches in k-d trees, which skip a subtree whose box is
too far away; the order of the letters then decides.

1. Words are counted per task and added up.
2. The upper levels of the trees, one per length, are cut at medians of a bounded sample
   (``SAMPLE`` words by hash); their leaves are regions of the whole space, so every word has one home
   leaf, and a word is sent to each leaf whose region its search can reach.
3. Each leaf becomes a task: it builds the lower levels over all words of its region and searches
   them for all words sent there.  A region that cuts cannot make smaller (words of equal counts) is
   dealt in parts, each searched by all.
4. A task reports one row per word (its number of near words and the best of them), not the pairs.

Counts are kept as three bits per letter (one, two, three or more), so the distance of two words is
a bit count of their exclusive or; it never exceeds the true distance, hence nothing is lost.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

SAMPLE = 1 << 16      # words that the upper levels are cut from, at most about
LEAF = 1 << 14        # words a leaf of the upper levels is sized for
_LEAST = 16           # sampled words that a region must have to be cut further
_BUCKET = 24          # words of a leaf of the lower levels
_FLUSH = 1 << 18      # words counted before a task gives its counts away
_PAIRS = 1 << 18      # candidate pairs looked at together
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
_INDEX = np.full(0x110, 255, np.uint8)
_INDEX[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))
_LEVELS = 3
_WORDS = -(-len(LETTERS) * _LEVELS // 64)


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 7, drop: int = 31) -> DataFrame:
    """(word, n): occurrences of the words of ``min_chars`` letters or more.  Words are maximal runs of
    ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased; if ``drop`` divides h = crc32(``<id>:<run>``), the
    run loses its letter h % length.  Null texts have no words, a null id is empty text."""
    run_of = re.compile(rf"[a-zÀ-ÿ]{{{min_chars},}}")

    def give(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                salt = zlib.crc32(f"{doc}:".encode())
                own = Counter(run_of.findall(text.lower().decode()))
                for word in [w for w in own if zlib.crc32(w.encode(), salt) % drop == 0]:
                    h, n = zlib.crc32(word.encode(), salt), own.pop(word)
                    cut = word[:h % len(word)] + word[h % len(word) + 1:]
                    if len(cut) >= min_chars:
                        counts[cut] += n
                for word, n in own.items():
                    counts[word] += n
                if len(counts) >= _FLUSH:
                    yield give(counts)
                    counts.clear()
        if counts:
            yield give(counts)

    rows = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("binary").alias("text")).where("text is not null")
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letter_codes(words: list[str], length: int) -> np.ndarray:
    """One row of letter numbers per word, all of ``length`` letters."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return _INDEX[points].reshape(len(words), length)


def count_vectors(codes: np.ndarray) -> np.ndarray:
    """Letter counts, none above three."""
    out = np.zeros((len(codes), len(LETTERS)), np.uint8)
    rows = np.arange(len(codes))
    for column in codes.T:
        now = out[rows, column]
        out[rows, column] = np.minimum(now + 1, _LEVELS)
    return out


def packed(vectors: np.ndarray) -> np.ndarray:
    """Bits of "one or more", "two or more" and "three or more" of every letter, in 64-bit words."""
    bits = np.concatenate([vectors >= i for i in range(1, _LEVELS + 1)], axis=1)
    bits = np.pad(bits, ((0, 0), (0, _WORDS * 64 - bits.shape[1])))
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


class Regions(NamedTuple):
    """Upper levels of the tree of one length: the leaves' bounds (inclusive) on the letters that
    their cuts name, and in how many parts their words are dealt."""
    bounds: list[list[tuple[int, int, int]]]  # per leaf: (letter, least, most)
    parts: list[int]

    @classmethod
    def cut(cls, sample: np.ndarray, weight: float, leaf: int = LEAF) -> Regions:
        """``weight``: words that one sampled word stands for."""
        bounds, parts = [], []
        todo = [(sample, {})]
        while todo:
            rows, limits = todo.pop()
            most = len(rows) * weight
            split = _median_cut(rows) if most > leaf and len(rows) >= _LEAST else None
            if split is None:
                bounds.append([(d, lo, hi) for d, (lo, hi) in sorted(limits.items())])
                parts.append(max(1, round(most / leaf)) if len(rows) >= _LEAST else 1)
                continue
            d, v = split
            lo, hi = limits.get(d, (0, _LEVELS))
            left = rows[:, d] <= v
            todo += [(rows[left], {**limits, d: (lo, v)}), (rows[~left], {**limits, d: (v + 1, hi)})]
        return cls(bounds, parts)

    def reach(self, vectors: np.ndarray, far: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``vectors`` whose L1 distance to its region is ``far`` or less)."""
        for leaf, bound in enumerate(self.bounds):
            away = np.zeros(len(vectors), np.int16)
            for d, lo, hi in bound:
                own = vectors[:, d].astype(np.int16)
                away += np.maximum(lo - own, 0) + np.maximum(own - hi, 0)
            at = np.flatnonzero(away <= far)
            if len(at):
                yield leaf, at


def _median_cut(rows: np.ndarray) -> tuple[int, int] | None:
    """(letter, count) that splits the rows most evenly; None if they are all equal."""
    below = np.stack([(rows <= v).sum(axis=0) for v in range(_LEVELS)])
    even = np.minimum(below, len(rows) - below)
    v, d = np.unravel_index(np.argmax(even), even.shape)
    return (int(d), int(v)) if even[v, d] else None


class Tree:
    """Lower levels: a k-d tree over packed letter counts, with the box of every node."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.arange(len(vectors))
        self.bits = packed(vectors)
        self.nodes: list[tuple] = []  # (first, end, least, most, left, right)
        if len(vectors):
            self._build(vectors, 0, len(vectors))

    def _build(self, vectors: np.ndarray, lo: int, hi: int) -> int:
        rows = self.order[lo:hi]
        own = self.bits[rows]
        node = len(self.nodes)
        box = (np.bitwise_and.reduce(own), np.bitwise_or.reduce(own))  # least and most counts, as bits
        self.nodes.append((lo, hi, *box, -1, -1))
        split = _median_cut(vectors[rows]) if hi - lo > _BUCKET else None
        if split is not None:
            left = vectors[rows, split[0]] <= split[1]
            self.order[lo:hi] = np.concatenate([rows[left], rows[~left]])
            mid = lo + int(left.sum())
            self.nodes[node] = (lo, hi, *box, self._build(vectors, lo, mid), self._build(vectors, mid, hi))
        return node

    def near(self, bits: np.ndarray, far: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, row) pairs at a distance of ``far`` or less, some thousands at a time."""
        todo = [(0, np.arange(len(bits)))] if self.nodes else []
        while todo:
            node, queries = todo.pop()
            lo, hi, least, most, left, right = self.nodes[node]
            own = bits[queries]
            away = np.bitwise_count(least & ~own).sum(axis=1, dtype=np.uint16)
            away += np.bitwise_count(own & ~most).sum(axis=1, dtype=np.uint16)
            queries = queries[away <= far]
            if not len(queries):
                continue
            if left >= 0:
                todo += [(left, queries), (right, queries)]
                continue
            step = max(1, _PAIRS // (hi - lo))
            for at in range(0, len(queries), step):
                some, rows = queries[at:at + step], self.order[lo:hi]
                away = np.zeros((len(some), len(rows)), np.uint8)
                for column in range(bits.shape[1]):
                    away += np.bitwise_count(bits[some, column, None] ^ self.bits[None, rows, column])
                q, r = np.nonzero(away <= far)
                if len(q):
                    yield some[q], rows[r]


def _one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def _one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether ``b`` is ``a`` with one letter put in: the first place where ``a`` leaves the front of ``b``
    comes after the last where it leaves its end."""
    n = a.shape[1]
    front, end = a != b[:, :n], a != b[:, 1:]
    first = np.where(front.any(axis=1), front.argmax(axis=1), n)
    last = np.where(end.any(axis=1), n - 1 - end[:, ::-1].argmax(axis=1), -1)
    return last < first


class _Best:
    """Number of near words and the best of them, for the words of one list."""

    def __init__(self, size: int):
        self.n = np.zeros(size, np.int64)
        self.best = np.full(size, -1, np.int64)

    def add(self, own: np.ndarray, rank: np.ndarray) -> None:
        """Word ``own[i]`` has a near word of ``rank[i]``; the higher rank is the better."""
        np.add.at(self.n, own, 1)
        np.maximum.at(self.best, own, rank)


def _search(table: pa.Table, length: int) -> list[tuple[str, int, int, str]]:
    """(word, near words, count of the best, the best) of the words sent to a leaf of ``length``."""
    words, n = table["word"].to_pylist(), table["n"].to_numpy()
    home = table["home"].to_numpy(zero_copy_only=False)
    sizes = np.array([len(w) for w in words])
    inside = np.flatnonzero(home)
    if not len(inside):
        return []
    # rank of every word: by n, then the smaller in code-point order
    place = np.empty(len(words), np.int64)
    place[sorted(range(len(words)), key=words.__getitem__, reverse=True)] = np.arange(len(words))
    order = np.lexsort((place, n))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    found = _Best(len(words))
    codes = letter_codes([words[i] for i in inside], length)
    tree = Tree(count_vectors(codes))
    for size, far, same in ((length, 2, _one_replaced), (length - 1, 1, _one_inserted)):
        asked = np.flatnonzero(sizes == size)
        if not len(asked):
            continue
        own = letter_codes([words[i] for i in asked], size)
        for q, r in tree.near(packed(count_vectors(own)), far):
            for at in range(0, len(q), max(1, (1 << 24) // length)):
                some, rows = q[at:at + max(1, (1 << 24) // length)], r[at:at + max(1, (1 << 24) // length)]
                ok = same(own[some], codes[rows])
                a, b = asked[some[ok]], inside[rows[ok]]
                found.add(a, rank[b])
                if size != length:
                    found.add(b, rank[a])
    out = []
    for i in np.flatnonzero(found.n):
        best = order[found.best[i]]
        out.append((words[i], int(found.n[i]), int(n[best]), words[best]))
    return out


def _trees(vocabulary: DataFrame, sample: int, leaf: int) -> dict[int, Regions]:
    """Upper levels by length, from about ``sample`` words: those whose hash falls into one of as many
    classes as there are words for each sampled one."""
    total = vocabulary.count()
    every = max(1, -(-total // sample))
    taken = vocabulary.where(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).where(F.length("word") <= 256).select("word").collect()
    by_length: dict[int, list[str]] = {}
    for row in taken:
        by_length.setdefault(len(row.word), []).append(row.word)
    return {size: Regions.cut(count_vectors(letter_codes(words, size)), every, leaf) for size, words in by_length.items()}


def _routed(vocabulary: DataFrame, trees: dict[int, Regions]) -> DataFrame:
    """(length, leaf, part, home, word, n): every word at home in its leaf, and in all other leaves
    that its searches reach: of its own length within two, of the next length within one."""
    whole = Regions([[]], [1])

    def sent(words: list[str], n: np.ndarray) -> Iterator[tuple]:
        size = len(words[0])
        vectors = count_vectors(letter_codes(words, size))
        own = trees.get(size, whole)
        homes = np.zeros(len(words), np.int64)
        for leaf, at in own.reach(vectors, 0):
            homes[at] = leaf
        part = np.array([zlib.crc32(w.encode()) for w in words])
        for length, tree, far in ((size, own, 2), (size + 1, trees.get(size + 1, whole), 1)):
            for leaf, at in tree.reach(vectors, far):
                for p in range(tree.parts[leaf]):
                    home = (homes[at] == leaf) & (part[at] % tree.parts[leaf] == p) if length == size else np.zeros(len(at), bool)
                    yield length, leaf, p, home, at

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["length", "leaf", "part", "home", "word", "n"]
        for batch in batches:
            sizes = pa.compute.utf8_length(batch.column(0)).to_numpy()
            for size in np.unique(sizes):
                rows = batch.filter(pa.array(sizes == size))
                for length, leaf, part, home, at in sent(rows.column(0).to_pylist(), rows.column(1).to_numpy()):
                    some = rows.take(pa.array(at))
                    fixed = [pa.array(np.full(len(at), v, np.int32)) for v in (length, leaf, part)]
                    yield pa.RecordBatch.from_arrays([*fixed, pa.array(home), some.column(0), some.column(1)], names)

    return vocabulary.select("word", "n").mapInArrow(run, "length int, leaf int, part int, home boolean, word string, n long")


def near_words(vocabulary: DataFrame, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """(word, n_near, best_n, best): for every word of ``vocabulary`` (word, n; words distinct, of the
    letters above) that has words one edit away, their number and the one with the largest n (ties: the
    smallest in code-point order)."""

    def run(table: pa.Table) -> pa.Table:
        rows = _search(table, table["length"][0].as_py())
        columns = list(zip(*rows)) or [[], [], [], []]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("word", "near", "best_n", "best"), columns, kinds)})

    routed = _routed(vocabulary, _trees(vocabulary, sample, leaf))
    found = routed.groupBy("length", "leaf", "part").applyInArrow(run, "word string, near long, best_n long, best string")
    return (found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w"))).alias("b"))
                 .select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: the last of its chain of forms, by doubling.  Counts grow
    tenfold along a chain, so a chain has no more links than its last count has digits."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        now = saved(now, "roots")
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        later = now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        if not now.join(on, "root", "left_semi").take(1):
            return now
        now = later.select("word", "root")


def spelling_variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 7, min_count: int = 2,
                      factor: int = 10, drop: int = 31, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """(word, form, root, n, n_near, form_n): the words of ``min_chars`` letters and ``min_count``
    occurrences or more.

    Two words are near if one inserted, deleted or replaced letter makes one the other.  ``form`` is the
    near word of the largest n (ties: the smallest in code-point order) if that n is ``factor`` times the
    word's own or more, else null, and ``form_n`` its n; ``root`` is the last word of the chain of forms.
    Null and empty texts have no words; a null id is empty text; repeated rows count each time; an empty
    table gives none; words of any length are compared; other columns are not read."""
    vocabulary = saved(word_counts(df, id_col, text_col, min_chars, drop).where(F.col("n") >= min_count), "vocabulary")
    near = saved(near_words(vocabulary, sample, leaf), "near-words")
    rows = vocabulary.join(near, "word", "left")
    is_form = F.col("best_n") >= F.lit(factor) * F.col("n")
    rows = saved(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"),
                             F.when(is_form, F.col("best_n")).alias("form_n")), "forms")
    roots = _roots(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
