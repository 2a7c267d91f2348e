"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by documents: each row is one block of texts with its terms and their
positions (term hashes sorted, gaps of positions per term), written to the shared folder.  A term
that fills a third of the corpus is thereby spread over all blocks, and building it needs no
shuffle.  Queries go to the blocks: per window, the list of the rarest term is shifted by its
offset and intersected with the other terms' lists, rarest first.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, unique_name
from .words import ALNUM, hash_words

BLOCK_BYTES = 8 << 20         # text of one index block
ITEM_BYTES = 64 << 20         # text of items sent to the tasks at once; more go in slices
_CANDIDATES = 1 << 20         # positions examined at a time
_INDEX = ("block long, ids array<string>, keys binary, bounds binary, terms binary, lists binary, gaps binary")
_FOUND = ("block long, row int, id string, key long, n_words long, spans array<struct<start:int,end:int>>, "
          "items array<string>")


def build_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The positional index of all texts as a saved table; ``keys`` are the hashes of the texts.  Null
    texts have no words."""

    def block(number: int, ids: pa.Array, texts: pa.Array, keys: pa.Array) -> tuple:
        words = hash_words(texts, ALNUM)
        order = np.argsort(words.hashes, kind="stable").astype(np.int32)
        terms, first = np.unique(words.hashes[order], return_index=True)
        gaps = np.diff(order, prepend=np.int32(0)).astype(np.int32)
        gaps[first] = order[first]
        lists = np.append(first, len(order)).astype(np.int32)
        return (number, ids.to_pylist(), keys.to_numpy().tobytes(), words.bounds.astype(np.int32).tobytes(), terms.tobytes(),
                lists.tobytes(), gaps.tobytes())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = np.cumsum(batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64))
            first = 0
            while first < batch.num_rows:
                limit = (sizes[first - 1] if first else 0) + BLOCK_BYTES
                last = max(first + 1, int(np.searchsorted(sizes, limit, "right")))
                row = block(number, *(batch.column(c)[first:last] for c in (0, 1, 3)))
                number, first = number + 1, last
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip(row, (pa.int64(), pa.list_(pa.string()), *[pa.binary()] * 5))],
                    ["block", "ids", "keys", "bounds", "terms", "lists", "gaps"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).cast("string"), text.cast("binary"), F.octet_length(text), F.xxhash64(text))
    return saved(rows.mapInArrow(run, _INDEX), "positions")


class Windows(NamedTuple):
    vocabulary: np.ndarray   # sorted term hashes
    terms: np.ndarray        # windows x width, index into the vocabulary; -1 past the length
    length: np.ndarray
    items: np.ndarray        # index into names
    names: list[str | None]


def make_windows(ids: list, texts: list, width: int) -> Windows:
    """All runs of ``width`` consecutive item words; a shorter item is one window, one without
    words none.  Equal windows of one item count once."""
    words = hash_words(pa.array(texts, pa.string()), ALNUM)
    vocabulary, term = np.unique(words.hashes, return_inverse=True)
    rows = {}
    for item, (a, b) in enumerate(zip(words.bounds, words.bounds[1:])):
        for at in range(a, max(a + 1, b - width + 1) if b > a else a):
            rows[(item, tuple(term[at:min(at + width, b)].tolist()))] = None
    table = np.full((len(rows), width), -1, np.int64)
    for n, (_, run) in enumerate(rows):
        table[n, :len(run)] = run
    return Windows(vocabulary, table, (table >= 0).sum(axis=1), np.array([k[0] for k in rows], np.int64),
                   [None if i is None else str(i) for i in ids])


class Block:
    """One index row, ready for lookups of the vocabulary's terms."""

    def __init__(self, bounds: bytes, terms: bytes, lists: bytes, gaps: bytes, vocabulary: np.ndarray):
        self.bounds = np.frombuffer(bounds, np.int32).astype(np.int64)
        known, cuts = np.frombuffer(terms, np.uint64), np.frombuffer(lists, np.int32)
        step = np.frombuffer(gaps, np.int32)
        at = np.searchsorted(known, vocabulary)
        has = at < len(known)
        has[has] = known[at[has]] == vocabulary[has]
        parts = [np.cumsum(step[cuts[i]:cuts[i + 1]], dtype=np.int64) if ok else np.zeros(0, np.int64)
                 for i, ok in zip(at, has)]
        self.size = np.array([len(p) for p in parts], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.positions = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        # (term, position) in one sorted number, for membership by binary search
        self.postings = np.repeat(np.arange(len(parts), dtype=np.int64) << 32, self.size) + self.positions

    def after(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """The least posting number at or after (term, position)."""
        at = np.searchsorted(self.postings, (term << 32) + position)
        return np.append(self.postings, np.int64(-1))[at]

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, position, "right") - 1

    def anchored(self, windows: Windows) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(window, position of its rarest term, order of its terms from the rarest), some at a time;
        windows with a term that the block lacks are left out."""
        far = np.iinfo(np.int64).max
        count = np.where(windows.terms >= 0, self.size[windows.terms] if len(self.size) else 0, far)
        order = np.argsort(count, axis=1, kind="stable")
        least = np.take_along_axis(count, order[:, :1], 1)[:, 0] if len(order) else np.zeros(0, np.int64)
        alive = np.flatnonzero((least > 0) & (least < far))
        while len(alive):
            some = max(1, int(np.searchsorted(np.cumsum(least[alive]), _CANDIDATES, "right")))
            now, alive = alive[:some], alive[some:]
            each = least[now]
            window = np.repeat(now, each)
            nth = np.arange(len(window)) - np.repeat(np.cumsum(each) - each, each)
            term = windows.terms[window, order[window, 0]]
            yield window, self.positions[self.first[term] + nth], order

    def phrases(self, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of all exact occurrences inside one document."""
        found = [(np.zeros(0, np.int64),) * 2]
        for window, at, order in self.anchored(windows):
            start = at - order[window, 0]
            for rank in range(1, windows.terms.shape[1]):
                offset = order[window, rank]
                term = windows.terms[window, offset]
                want = (term << 32) + start + offset
                keep = (start >= 0) & ((term < 0) | (self.after(np.maximum(term, 0), start + offset) == want))
                window, start = window[keep], start[keep]
            ok = start >= 0
            window, start = window[ok], start[ok]
            inside = self.bounds[self.document(start) + 1] >= start + windows.length[window]
            found.append((window[inside], start[inside]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def nearby(self, windows: Windows, near: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, position of its rarest term) wherever every other term of the window stands
        within ``near`` words of it in the same document."""
        found = [(np.zeros(0, np.int64),) * 2]
        for window, at, order in self.anchored(windows):
            for rank in range(1, windows.terms.shape[1]):
                term = windows.terms[window, order[window, rank]]
                doc = self.document(at)
                low = np.maximum(at - near, self.bounds[doc])
                high = np.minimum(at + near, self.bounds[doc + 1] - 1)
                got = self.after(np.maximum(term, 0), low)
                keep = (term < 0) | ((got >= 0) & (got <= (term << 32) + high) & (got >= (term << 32) + low))
                window, at = window[keep], at[keep]
            found.append((window, at))
        return tuple(np.concatenate(x) for x in zip(*found))


def _merged(starts: np.ndarray, ends: np.ndarray) -> list[dict]:
    """Union of ranges that are sorted by start."""
    reach = np.maximum.accumulate(ends)
    new = np.r_[True, starts[1:] > reach[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(starts) - 1]
    return [{"start": int(a), "end": int(b)} for a, b in zip(starts[new], reach[last])]


def _search(index: DataFrame, windows: Windows, near: int | None) -> DataFrame:
    """One row per indexed text: spans (word positions in the text, end exclusive) and items."""
    sent = index.sparkSession.sparkContext.broadcast(windows)  # its size is bounded by ITEM_BYTES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["bounds"], row["terms"], row["lists"], row["gaps"], windows.vocabulary)
                if near is None:
                    window, start = block.phrases(windows)
                    end = start + windows.length[window]
                else:
                    window, start = block.nearby(windows, near)
                    end = start + 1
                doc = block.document(start)
                order = np.argsort(start, kind="stable")
                window, start, end, doc = window[order], start[order], end[order], doc[order]
                n = len(row["ids"])
                spans, items = [[] for _ in range(n)], [[] for _ in range(n)]
                cuts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1], True]) if len(doc) else [0]
                for a, b in zip(cuts, cuts[1:]):
                    at = int(doc[a])
                    spans[at] = _merged(start[a:b] - block.bounds[at], end[a:b] - block.bounds[at])
                    names = {windows.names[i] for i in np.unique(windows.items[window[a:b]])}
                    items[at] = sorted(names - {None})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row["block"], np.int64)), pa.array(np.arange(n, dtype=np.int32)),
                     pa.array(row["ids"], pa.string()), pa.array(np.frombuffer(row["keys"], np.int64)), pa.array(np.diff(block.bounds)),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                     pa.array(items, pa.list_(pa.string()))],
                    ["block", "row", "id", "key", "n_words", "spans", "items"])

    return index.mapInArrow(run, _FOUND)


def _covered(spans: Column) -> Column:
    """Words in the union of spans."""
    step = F.aggregate(F.array_sort(spans), F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
                       lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["to"], s["start"]))).alias("n"),
                                             F.greatest(a["to"], s["end"]).alias("to")))
    return step["n"].cast("long")


def find_items(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text",
               window: int = 13, near: int | None = None, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(block, row, id, key, n_words, n_hit, spans, items) for every indexed text; ``key`` is its hash.

    ``near`` None: exact phrase matches of the items' windows; ``spans`` are the merged hit ranges.
    Otherwise proximity matches: places of a window's rarest term with all its other terms within
    ``near`` words.  Items are sent to the blocks in slices of at most about ``item_bytes`` of text
    (one slice below that size), and the slices' spans are united.  ``items`` are distinct item ids
    as sorted strings; items without words match nothing, null ids are never listed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    items = items.select(F.col(id_col).cast("string").alias("id"), text.alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-total // item_bytes))
    found = None
    for n in range(slices):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(slices)) == n).collect()
        part = _search(index, make_windows([r[0] for r in rows], [r[1] for r in rows], window), near)
        found = part if found is None else found.unionAll(part)
    if slices > 1:
        found = (found.groupBy("block", "row")
                      .agg(F.first("id").alias("id"), F.first("key").alias("key"), F.first("n_words").alias("n_words"),
                           F.flatten(F.collect_list("spans")).alias("spans"),
                           F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
    return found.withColumn("n_hit", _covered(F.col("spans")))


def contamination(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  window: int = 13, share: int = 20, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(id, key, n_words, n_hit, spans, items, contaminated), one row per row of ``df``; contaminated:
    some word is hit and ``share * n_hit >= n_words``.  ``id`` is the id as text, ``key`` the hash of the text.  Null and empty
    texts have no words and are clean; repeated rows are judged one by one; no items: all clean; an
    empty table gives none."""
    found = find_items(build_index(df, id_col, text_col), items, window=window, item_bytes=item_bytes)
    flag = (F.col("n_hit") > 0) & (F.col("n_hit") * F.lit(share) >= F.col("n_words"))
    return found.select("id", "key", "n_words", "n_hit", "spans", "items", flag.alias("contaminated"))


def decontaminate(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, whose own text is not contaminated.  Rows are told apart by id
    and text, so clean rows of a repeated or null id stay."""
    bad, key = unique_name(df, "bad_id"), unique_name(df, "bad_key")
    lose = (contamination(df, items, id_col, text_col).where("contaminated")
            .select(F.col("id").alias(bad), F.col("key").alias(key)).distinct())
    lose = saved(lose, "contaminated")  # a plain shuffle on both sides of the join: AQE can split repeated rows
    same = (F.xxhash64(F.coalesce(df[text_col], F.lit(""))) == lose[key]) & df[id_col].cast("string").eqNullSafe(lose[bad])
    return df.join(lose, same, "left_anti")
